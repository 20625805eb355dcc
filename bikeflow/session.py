"""Session defaults and shared work folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


def build_session(
    master: str | None = None, app: str = "bikeflow", shuffle_tasks: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the library is written for.

    ``shuffle_tasks`` is how many partitions each shuffle starts with; adaptive execution merges
    the small ones but adds none, so give the largest shuffle's bytes over the bytes a task may
    hold (100 TB at 256 MB: 400,000). ``conf`` overrides anything.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_tasks:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(shuffle_tasks))
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return pin_utc(builder.getOrCreate())


def pin_utc(spark: SparkSession) -> SparkSession:
    """Epoch <-> timestamp text depends on the session zone, so all jobs run in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)
    return spark


def on_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Where none is named, one is made on this machine if it is the only one, as in tests;
    on a cluster that is an error, as executors would write where others cannot read.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not on_one_machine(spark.sparkContext.master):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bikeflow-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared root; never reused between runs."""
    return f"{shared_root(spark)}/bikeflow/{name}-{uuid.uuid4().hex}"
