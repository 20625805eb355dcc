"""Tables from queries, overwrite, clustering, history load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ELECTRIC = "electric_bike"
# Of what is laid out for long: keys are hex digests, which a codec without entropy coding leaves as long as they are.
CODEC = "zstd"


def create_table_as(df: DataFrame, name: str, path: str | None = None, mode: str = "errorifexists") -> None:
    """Create a Parquet table from a query. The default fails when the table exists."""
    writer = df.write.format("parquet").mode(mode)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> None:
    create_table_as(df, name, path, mode="overwrite")


def clustered(df: DataFrame, keys: Sequence[str], together: Column | None = None) -> DataFrame:
    """Deal rows out by ranges of all ``keys`` and sort each task's rows by them.

    Files then hold ranges of the first key that do not contain one another, which Parquet
    statistics can skip; a hot value of the first key is split by the later ones. With
    ``together`` rows are gathered by that value instead, as a rebalance that adaptive
    execution splits where one value is hot.
    """
    if together is None:
        return df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    gathered = df.withColumn("__together", together).hint("rebalance", "__together")
    return gathered.sortWithinPartitions(*keys).drop("__together")


def write_clustered(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str],
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    together: Column | None = None,
    pieces: int = 1,
    tasks: int | None = None,
) -> None:
    """Write Parquet, in folders by ``partition_by``, sorted by ``cluster_by`` within files.

    With folders the rows are gathered per folder, in ``pieces`` even shares of it, by at least ``tasks`` tasks if given.
    """
    if partition_by:
        shared = df.withColumn("__piece", F.pmod(F.xxhash64(*df.columns), F.lit(pieces))) if pieces > 1 else df
        places = [*partition_by, "__piece"] if pieces > 1 else partition_by
        gathered = shared.hint("rebalance", *([tasks] if tasks else []), *places).drop("__piece")
        laid_out = gathered.sortWithinPartitions(*partition_by, *cluster_by)
    else:
        laid_out = clustered(df, cluster_by, together)
    writer = laid_out.write.mode(mode).option("partitionOverwriteMode", "static").option("compression", CODEC)
    writer.partitionBy(*partition_by).parquet(path)


def load_history(trips: DataFrame, table: str, path: str | None = None) -> None:
    """Published trips into a table, electric bikes only."""
    overwrite_table(trips.filter(F.col("rideable_type") == ELECTRIC), table, path)


def first_rows(df: DataFrame, n: int = 100) -> DataFrame:
    """A few rows for inspection."""
    return df.limit(n)
