"""Landing folders to append-only tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from bikeflow.operators.sinks import write_clustered
from bikeflow.streaming.partitions import Folder

BatchStep = Callable[[DataFrame, int], None]


def launch(writer: DataStreamWriter, every: str | None = None) -> StreamingQuery:
    """Process everything that has landed, then stop; failures are raised here.

    With ``every`` (such as "1 minute") the query keeps running and is returned at once.
    """
    if every:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_stream(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    cluster_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    gather: bool = True,
    every: str | None = None,
) -> StreamingQuery:
    """Append the new rows of a stream to a Parquet folder.

    Without clustering this is Spark's file sink, exactly once by its own log. With
    ``cluster_by`` each micro-batch is laid out and written to a folder of its own, which a
    repeated micro-batch replaces. ``gather=False`` sorts each task's rows where they are:
    no shuffle, for tables that are mostly read in full.
    """
    if not cluster_by:
        writer = rows.writeStream.format("parquet").outputMode("append").option("path", target)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        return launch(writer.option("checkpointLocation", checkpoint), every)

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{target}/batch={batch_id}"
        if gather:
            write_clustered(batch, folder, cluster_by, partition_by)
        else:
            rows = batch.sortWithinPartitions(*partition_by, *cluster_by)
            rows.write.mode("overwrite").partitionBy(*partition_by).parquet(folder)

    return each_batch(rows, write, checkpoint, every)


def each_batch(
    rows: DataFrame, step: BatchStep, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Run ``step(batch, batch_id)`` for each micro-batch of what has landed."""
    return launch(rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint), every)


def merge_batches(spark: SparkSession, target: str, keep: int = 16, partition_by: Sequence[str] = ()) -> int:
    """Merge the ``batch=<n>`` folders of a target when there are more than ``keep``, into files of full size beside it.

    Streams that read the target never see the merged files, as these lie in a folder of their own, and have to
    have taken up the batches before. Once there are more than ``keep`` merges, they become one. A merge counts when its
    mark is written; its sources are deleted behind that, and after a crash ``read_batches`` leaves out those that are
    left. Returns how many folders were merged.
    """
    aside = Folder(spark, _merged(target))
    batches, merges = _whole(spark, target)
    if len(batches) > keep:
        folders = [f"{target}/batch={n}" for n in batches]
        _merge(spark, folders, f"upto={batches[-1]}", aside, {"batches": batches}, partition_by)
        merges.append(f"upto={batches[-1]}")
    marks = {m: aside.get(f"{m}.done") for m in merges}
    if len(merges) > keep:
        whole = f"all-{merges[-1]}"
        held = sorted({n for m in marks.values() for n in m["batches"]})
        _merge(spark, [f"{aside.path}/{m}" for m in merges], whole, aside, {"batches": held, "merges": merges}, partition_by)
        marks[whole] = aside.get(f"{whole}.done")
    # Sources of merges that count.
    for mark in marks.values():
        for n in mark["batches"]:
            Folder(spark, target).delete(f"batch={n}")
        for m in mark.get("merges", ()):
            aside.delete(f"{m}.done")
            aside.delete(m)
    return len(batches) if len(batches) > keep else 0


def _merged(target: str) -> str:
    return f"{target.rstrip('/')}_merged"


def _whole(spark: SparkSession, target: str) -> tuple[list[int], list[str]]:
    """(batches that no merge holds, merges that count and that no other merge holds), oldest first."""
    aside = Folder(spark, _merged(target))
    names = [n.removesuffix(".done") for n in aside.names() if n.endswith(".done")]
    marks = {n: aside.get(f"{n}.done") for n in names}
    gone = {n for m in marks.values() for n in m.get("merges", ())}
    held = {n for m in marks.values() for n in m["batches"]}
    numbers = (int(n.removeprefix("batch=")) for n in Folder(spark, target).names() if n.startswith("batch="))
    return sorted(n for n in numbers if n not in held), sorted((n for n in names if n not in gone), key=lambda n: int(n.split("=")[1]))


def _merge(spark: SparkSession, folders: list[str], name: str, aside: Folder, mark: dict, partition_by: Sequence[str]) -> None:
    rows = _together(spark, folders)
    rows = rows.hint("rebalance", *partition_by) if partition_by else rows.hint("rebalance")
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{aside.path}/{name}")
    aside.put(f"{name}.done", mark)


def _together(spark: SparkSession, folders: list[str]) -> DataFrame:
    parts = [spark.read.parquet(f) for f in folders]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows


def read_batches(spark: SparkSession, target: str) -> DataFrame:
    """The rows of all batches of a target, merged or not, each once."""
    batches, merges = _whole(spark, target)
    return _together(spark, [f"{_merged(target)}/{m}" for m in merges] + [f"{target}/batch={n}" for n in batches])
