"""The tidy metric table as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions.text import natural_key

SCHEMA = "metric STRING, vineyard_id STRING, row_id STRING, value DOUBLE, unit STRING"
#: The order of the metrics in a file.
ORDER = ("block_count", "row_count", "total_row_length", "total_canopy_area", "total_interrow_area", "canopy_area", "interrow_area", "row_length")


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).option("header", "true").csv(path).na.fill("", ["vineyard_id", "row_id"])


def lookup(metrics: DataFrame, metric: str) -> float | None:
    """The first value of a metric."""
    row = metrics.filter(F.col("metric") == metric).orderBy("vineyard_id", "row_id").select("value").first()
    return row.value if row else None


def ordered(metrics: DataFrame) -> DataFrame:
    """Totals first, then per block both areas, then the rows; values with two decimals, counts whole."""
    place = F.array_position(F.array(*[F.lit(m) for m in ORDER]), F.col("metric"))
    per_block = F.col("metric").isin("canopy_area", "interrow_area")
    stage = F.when(per_block, 6).when(F.col("metric") == "row_length", 8).otherwise(place)
    value = F.when(F.col("unit") == "count", F.col("value").cast("long").cast("string")).otherwise(F.format_string("%.2f", F.bround("value", 2)))
    keyed = metrics.select("*", stage.alias("_s"), place.alias("_p"))
    return keyed.orderBy("_s", natural_key(F.col("vineyard_id")), natural_key(F.col("row_id")), "_p").select("metric", "vineyard_id", "row_id", value.alias("value"), "unit")


def write(metrics: DataFrame, path: str) -> None:
    ordered(metrics).coalesce(1).write.mode("overwrite").option("header", "true").option("emptyValue", "").csv(path)
