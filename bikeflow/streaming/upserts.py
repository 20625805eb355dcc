"""Keyed upserts per micro-batch: type 1 tables and type 2 histories.

Order is settled by the sequence column, never by arrival, so late and repeated rows end up
where they belong. Only the partitions that a batch falls in are read and rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from bikeflow.operators.enrich import split_rejects
from bikeflow.operators.scd import history, latest_per_key
from bikeflow.streaming.ingest import BatchStep
from bikeflow.streaming.partitions import PartitionedTable


def upsert_latest(
    table: PartitionedTable, keys: Sequence[str], sequence: str, rejects: str | None = None
) -> BatchStep:
    """Type 1 step: one row per key. Rows with a NULL key go to the ``rejects`` folder, if any."""

    def step(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_rejects(batch, keys)
        if rejects:
            bad.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
        # Arrived and stored rows are ranked together; of a key that the batch holds often, each task sends one row.
        table.merge(good, lambda stored, _: latest_per_key(good.unionByName(stored), keys, sequence), batch_id)

    return step


def upsert_history(
    log: PartitionedTable,
    ranges: PartitionedTable,
    keys: Sequence[str],
    sequence: str,
    untracked: Sequence[str] = (),
    rejects: str | None = None,
) -> BatchStep:
    """Type 2 step: keep the change log, and set the ranges right of the keys that changed.

    A late row can split, extend or join ranges, and where a split range goes on is known to the log only; so
    the ranges of a changed key come from its log, and those of all other keys pass as they are. Log
    and ranges have the same partitions. Rows with a NULL key or sequence go to the ``rejects`` folder, if any.
    """
    keys = list(keys)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        good, bad = split_rejects(batch, [*keys, sequence])
        if rejects:
            bad.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
        entry = [*keys, sequence]
        touched = log.merge(good, lambda stored, _: latest_per_key(good.unionByName(stored), entry, sequence), batch_id)
        if not touched:
            return
        changed = good.select(*keys).distinct()
        mine = log.read(spark, touched).join(changed, keys, "left_semi")
        new = history(mine, keys, sequence, untracked, unique=True)
        ranges.create(spark, new.schema)

        def settled(stored: DataFrame, _: list[str]) -> DataFrame:
            return new.unionByName(stored.join(changed, keys, "left_anti"))

        ranges.merge(changed, settled, batch_id)

    return step
