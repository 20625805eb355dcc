"""Rider-type classifier on historical trips."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, TargetEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bikeflow.session import work_folder

MEMBER, CASUAL = "member", "casual"
FEATURES = {
    "rideable_type": "rideable_type_index",
    "start_station_name": "start_station_index",
    "end_station_name": "end_station_index",
}


def with_label(history: DataFrame) -> DataFrame:
    """1 for members, 0 for everybody else, unknown included."""
    return history.withColumn("label", F.when(F.col("member_casual") == MEMBER, 1).otherwise(0))


def indexer(history: DataFrame) -> StringIndexerModel:
    """Category indexes by frequency, ties by name; unknown and NULL categories come last."""
    return StringIndexer(
        inputCols=list(FEATURES), outputCols=list(FEATURES.values()), handleInvalid="keep"
    ).fit(history)


def held_out(key: str) -> Column:
    """Three rows in sixteen, by a digest of their id: the same on every run and in every engine."""
    return F.right(F.md5(F.col(key).cast("string")), F.lit(1)).isin("0", "1", "2")


def fit(history: DataFrame, seed: int = 42, trees: int = 20, max_depth: int = 5, smoothing: float = 20.0) -> PipelineModel:
    """Index the three categories, replace each by its share of members, assemble them, fit a random forest.

    A category is one number, pulled to the overall share while it is rare, whatever the number of
    categories: the statistics of a tree node do not grow with the stations. Unknown and NULL categories have the overall share.

    Every stage passes over the rows more than once. What it reads is landed before: the categories and the label, then the
    numbers that stand for them, so that no pass of the forest filters, indexes and encodes the history again.
    """
    spark = history.sparkSession
    folder = work_folder(spark, "riders")
    labelled = _landed(with_label(history).select(*FEATURES, "label"), f"{folder}/categories")
    shares = [f"{c}_share" for c in FEATURES.values()]
    encoder = TargetEncoder(
        inputCols=list(FEATURES.values()), outputCols=shares, labelCol="label", targetType="binary", smoothing=smoothing, handleInvalid="keep"
    )
    # The encoder marks its numbers as categories, which a tree would give a bin each.
    plain = [f"{c}_value" for c in FEATURES.values()]
    numbers = SQLTransformer(statement="SELECT *, " + ", ".join(f"{s} + 0.0D AS {v}" for s, v in zip(shares, plain)) + " FROM __THIS__")
    assembler = VectorAssembler(inputCols=plain, outputCol="features")
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=max_depth, seed=seed)
    coding = Pipeline(stages=[indexer(labelled), encoder, numbers]).fit(labelled)
    values = _landed(coding.transform(labelled).select("label", *plain), f"{folder}/values")
    return PipelineModel([*coding.stages, assembler, forest.fit(assembler.transform(values))])


def _landed(rows: DataFrame, folder: str) -> DataFrame:
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def evaluate(model: PipelineModel, history: DataFrame) -> dict[str, float]:
    """Accuracy and area under the curve on rows the model has not seen, beside the share of the larger class."""
    scored = model.transform(with_label(history))
    right, members = scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")), F.avg("label")).first()
    area = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction").evaluate(scored)
    return {"accuracy": right, "majority": max(members, 1 - members), "area": area}


def predict(model: PipelineModel, history: DataFrame) -> DataFrame:
    """Predicted rider type next to the original one."""
    decoded = F.when(F.col("prediction") == 1, MEMBER).otherwise(CASUAL)
    return model.transform(history).withColumn("predicted_member_casual", decoded)


def overwrite_rider_type(predicted: DataFrame) -> DataFrame:
    """Predictions in place of ``member_casual``."""
    return predicted.withColumn("member_casual", F.col("predicted_member_casual")).drop("predicted_member_casual")
