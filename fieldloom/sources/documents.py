"""Documents that are one file by their format: written from sorted parts, read in pieces."""

from __future__ import annotations

import itertools
import json
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom import session

#: Bytes of a path's files up to which they are read whole; larger ones are read in pieces.
WHOLE = 1 << 24
#: Characters at the ends of splits that the driver puts together at most; beyond that, files are read whole.
ENDS = 1 << 26


def write(lines: DataFrame, order: list[str], path: str, head: str, foot: str, skip: int = 0) -> None:
    """The column line, in the order of the columns named, between head and foot as one text file in a folder; the first
    line loses its first `skip` bytes.

    The parts are sorted and written by many tasks; only their bytes pass through one stream, which holds a buffer."""
    spark, path = lines.sparkSession, path.rstrip("/")
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    lines.filter("line IS NOT NULL").orderBy(*order).select("line").write.option("compression", "none").text(parts)
    at, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    store = at(path).getFileSystem(conf)
    names = [s.getPath() for s in store.listStatus(at(parts)) if s.getPath().getName().startswith("part-")]
    store.delete(at(path), True)
    out = store.create(at(f"{path}/_part-00000.txt"), True)
    try:
        out.write(bytearray(f"{head}\n".encode()))
        for name in sorted(names, key=lambda p: (int(p.getName().split("-")[1]), p.getName())):
            part = store.open(name)
            if skip and store.getFileStatus(name).getLen():
                part.seek(skip)
                skip = 0
            spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
            part.close()
            store.delete(name, False)
        out.write(bytearray(f"{foot}\n".encode()))
    finally:
        out.close()
    if not store.rename(at(f"{path}/_part-00000.txt"), at(f"{path}/part-00000.txt")):
        raise OSError(f"no file could be put into {path}")
    store.create(at(f"{path}/_SUCCESS"), True).close()
    store.delete(at(parts), True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of the files at a path, which may be a pattern."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(store.getContentSummary(s.getPath()).getLength() for s in store.globStatus(place) or [])


def pieces(spark: SparkSession, path: str, mark: str) -> DataFrame:
    """(file, block, value): the text between marks; each belongs to the split of the file that it begins in, and a split's
    pieces follow one another within a task."""
    session.importable(spark)
    text = spark.read.option("lineSep", mark).text(path)
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def splits(batches) -> Iterator[tuple[int, int, Iterator[list[str]]]]:
    """(file, block, lists of pieces in order) of each split in a task's batches."""

    def runs():
        for b in batches:
            file, block = (b.column(c).to_numpy() for c in ("file", "block"))
            cuts = [0, *(np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), len(file)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi > lo:
                    yield int(file[lo]), int(block[lo]), b.column("value").slice(lo, hi - lo).to_pylist()

    for (file, block), several in itertools.groupby(runs(), key=lambda r: r[:2]):
        yield file, block, (values for _, _, values in several)


def ends(parts: DataFrame) -> dict[int, list[tuple[int, dict]]] | None:
    """What each split says of its two ends (column edge, JSON), by file and in order; None if that is too much for the
    driver or a split could not be read."""
    edges = parts.filter("edge IS NOT NULL").select("file", "block", "edge")
    if (edges.agg(F.sum(F.length("edge"))).first()[0] or 0) > ENDS:
        return None
    found = sorted((r.file, r.block, json.loads(r.edge)) for r in edges.collect())
    if any(e.get("wrong") for _, _, e in found):
        return None
    return {f: [(b, e) for _, b, e in several] for f, several in itertools.groupby(found, key=lambda r: r[0])}
