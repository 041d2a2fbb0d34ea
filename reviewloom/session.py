"""Session settings and the shared folder every job may write to."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: How Parquet that holds texts is written: zstd takes about half the room of the default codec.
STORED = {"compression": "zstd"}


def build_session(app: str = "reviewloom", cores: int | str = "*", **conf) -> SparkSession:
    """Local session for tests and benchmarks; on a cluster use the given one."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, conf: dict[str, object]):
    """``conf`` holds for what is run inside."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names storage every executor can reach. Where it is unset, a local
    session (one process) gets a temporary folder; a cluster gets an error, as there no machine's own
    folder would do.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="reviewloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df, purpose: str):
    """Write ``df`` to the shared folder and read it back: cuts the lineage
    with a copy that survives the loss of any executor."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.options(**STORED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
