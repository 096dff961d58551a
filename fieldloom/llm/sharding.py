"""Sharding by a two-pass external shuffle, in DataFrame functions only.

Pass one tags every record with a seeded 64-bit hash and writes it; the hash scatters the records uniformly
into buckets that fit in a task's memory. Pass two gathers one bucket at a time, puts it into Fisher-Yates
order (Spark's ``shuffle`` is that algorithm) and gives each record its place in the whole order: the
bucket's offset and the position within it. The places 0..N-1 are cut into equal ranges, the shards, so
the law ``rows`` holds: shard sizes are at most one apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Bytes of records that one bucket may hold on average, and the least number of buckets for each shard.
BUCKET_BYTES = 32 << 20
BUCKETS_PER_SHARD = 4


def external_shuffle(
    df: DataFrame,
    n_shards: int,
    seed: int = 20,
    size=None,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Deal df's rows into n_shards shards in a uniformly random order.

    Returns ``record`` (a struct of all of df's columns, so no name can clash), ``bucket``, ``shard`` and
    ``slot``, the place in the shard, from 0 without gaps. ``size`` is a column with a record's bytes; without
    it 64 bytes are assumed. Rows are never compared with one another: nulls, empty texts, ties and
    repeated rows are records like any other, each with its own place. An empty df gives an empty result;
    with fewer rows than shards some shards stay empty. The hash is of the record's position, not of a
    column, so no frequent value fills a bucket; writing the tag fixes it against recomputed tasks.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    tagged = common.written(
        df.select(
            F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("record"),
            (F.lit(64) if size is None else size).cast("long").alias("bytes"),
            F.xxhash64(F.lit(seed), F.spark_partition_id(), F.monotonically_increasing_id()).alias("tag"),
        ),
        "scattered",
    )
    total = tagged.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    n_buckets = max(BUCKETS_PER_SHARD * n_shards, -(-total // bucket_bytes))
    # The tag's high bits as a fraction of 2**63 choose the bucket.
    bucket = F.floor(F.shiftrightunsigned("tag", 32).cast("double") / F.lit(float(1 << 32)) * F.lit(n_buckets)).cast("long")

    # One row per bucket, of which there are total / bucket_bytes: a small table even in one task.
    order = Window.orderBy("bucket")
    offsets = (
        tagged.groupBy(bucket.alias("bucket"))
        .agg(F.count("*").alias("n"))
        .select(
            "bucket",
            (F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("offset"),
            F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
        )
    )
    by_tag = lambda a, b: F.when(a["tag"] < b["tag"], -1).when(a["tag"] > b["tag"], 1).otherwise(0)
    gathered = (
        tagged.groupBy(bucket.alias("bucket"))
        .agg(F.collect_list(F.struct("tag", "record")).alias("rows"))
        .join(offsets, "bucket")
        # In a fixed order of buckets, and of rows in them, the random numbers are the same in every attempt.
        .sortWithinPartitions("bucket")
        .select("bucket", "offset", "total", F.shuffle(F.array_sort("rows", by_tag), F.lit(seed)).alias("rows"))
    )
    placed = gathered.select("bucket", "total", "offset", F.posexplode("rows").alias("at", "row"))
    return placed.select(F.col("row.record").alias("record"), "bucket", "total", (F.col("offset") + F.col("at")).alias("rank")).select(
        "record",
        "bucket",
        # rank * n_shards div total, in whole numbers.
        F.expr(f"CAST((rank * {n_shards}L) div total AS INT)").alias("shard"),
        F.expr(f"rank - ((((rank * {n_shards}L) div total) * total + {n_shards - 1}L) div {n_shards}L)").alias("slot"),
    )


def write_shards(df: DataFrame, path: str, n_shards: int, **options) -> None:
    """Shuffle df and write it as Parquet, one folder for each shard.

    The second pass writes what it has: a task's buckets go to the shards that they reach, without another shuffle.
    Rows carry their slot, and each file holds its rows in the order of slots."""
    placed = external_shuffle(df, n_shards, **options)
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards under the law ``rows``; a null text counts as empty."""
    documents = common.table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("record.text"), F.lit(""))
    size = (F.octet_length(F.coalesce("text", F.lit(""))) + 16).cast("long")
    return external_shuffle(documents, 40, size=size).select(
        F.col("record.doc_id").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op10_sharding": op10_sharding}
ORACLES: dict[str, str] = {}
