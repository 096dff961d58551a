"""Training labels: COCO segmentations in, YOLO text lines out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions.text import fixed

COCO = """images ARRAY<STRUCT<id: BIGINT, file_name: STRING, width: DOUBLE, height: DOUBLE>>, categories ARRAY<STRUCT<id: BIGINT, name: STRING>>,
annotations ARRAY<STRUCT<category_id: BIGINT, image_id: BIGINT, segmentation: STRING>>"""
#: The classes that are kept.
CLASSES = {"trunk": 0, "vine_row": 1}


def read_coco(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, width, height, cls, polygon: flat coordinates) of the kept classes' first polygons; run-length masks,
    which are no arrays, are left out."""
    doc = spark.read.schema(COCO).option("multiLine", "true").json(path)
    images = doc.select(F.explode("images").alias("i")).select("i.*").withColumnRenamed("id", "image_id")
    categories = doc.select(F.explode("categories").alias("c")).select(F.col("c.id").alias("category_id"), "c.name")
    polygon = F.get(F.from_json("segmentation", "array<array<double>>"), F.lit(0))
    annotations = doc.select(F.explode("annotations").alias("a")).select("a.category_id", "a.image_id", F.col("a.segmentation").alias("segmentation"))
    kept = annotations.filter(F.col("segmentation").startswith("[")).select("category_id", "image_id", polygon.alias("polygon")).filter("polygon IS NOT NULL")
    cls = F.element_at(F.create_map(*[F.lit(x) for p in CLASSES.items() for x in p]), F.col("name"))
    return kept.join(categories, "category_id").join(images, "image_id").select("file_name", "width", "height", cls.alias("cls"), "polygon").filter("cls IS NOT NULL")


def yolo_line(cls: Column, polygon: Column, width: Column, height: Column) -> Column:
    """'class x y x y ...' with coordinates as shares of the image, held in [0, 1]; null under three points."""
    share = lambda v, i: F.least(F.greatest(v / F.when(i % 2 == 0, width).otherwise(height), F.lit(0.0)), F.lit(1.0))
    text = F.transform(polygon, lambda v, i: fixed(share(v, i), 6))
    return F.when(F.size(polygon) >= 6, F.concat_ws(" ", F.array(cls.cast("string")), text))


def label_files(objects: DataFrame) -> DataFrame:
    """(file_name, text): an image's lines; images without any are left out."""
    lines = objects.select("file_name", yolo_line(F.col("cls"), F.col("polygon"), F.col("width"), F.col("height")).alias("line")).filter("line IS NOT NULL")
    return lines.groupBy("file_name").agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("text"))


def split_of(name: Column) -> Column:
    """train and valid both train, test validates."""
    return F.when(name.isin("train", "valid"), "train").when(name == "test", "val")


def write_labels(files: DataFrame, path: str) -> None:
    """Lines by split and file: partitioned text (split, file_name, text)."""
    files.select("split", "file_name", "text").write.mode("overwrite").partitionBy("split", "file_name").text(path)


def data_yaml(path: str, classes: dict[str, int] = CLASSES) -> str:
    names = "".join(f"  {i}: {n}\n" for n, i in sorted(classes.items(), key=lambda x: x[1]))
    return f"path: {path}\ntrain: images/train\nval: images/val\nnames:\n{names}"
