"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = str(Path(__file__).resolve().parents[1])


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose machines do not share that folder, install the package or pass it with --py-files."""
    known = spark.sparkContext.environment
    if _ROOT not in known.get("PYTHONPATH", "").split(":"):
        known["PYTHONPATH"] = ":".join(filter(None, [_ROOT, known.get("PYTHONPATH", "")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of an input folder."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as spark.checkpoint.dir names it.

    Only where that is unset, in a local session, a temporary folder of this machine stands in."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="fieldloom-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write df once to the shared folder and read it back.

    That cuts the lineage: no later stage depends on shuffle files or caches of an executor, and what was
    non-deterministic is fixed."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/fieldloom/{label}-{uuid.uuid4().hex}"
    # Once it is written, the shuffle files behind it serve nothing more.
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, "false")
    try:
        spark.conf.set(cleanup, "true")
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a few numbers each that are sent to every executor at most; beyond that, a join shuffles.
BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Mark df, whose rows are a few numbers wide, for broadcast if it is counted and has no more rows than that."""
    return F.broadcast(df) if df.count() <= most else df
