"""Raster files: a reader of plain TIFF tiles and writers of tiles and map pyramids, run in the workers."""

from __future__ import annotations

import math
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIXELS = "path string, x int, y int, r int, g int, b int"
_SIZES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "Q", 11: "f", 12: "d", 16: "Q"}


def tiff_tags(data: bytes) -> tuple[str, dict[int, tuple]]:
    """The byte order and the tags of a TIFF's first image."""
    order = {b"II": "<", b"MM": ">"}[data[:2]]
    (at,) = struct.unpack(order + "I", data[4:8])
    (n,) = struct.unpack(order + "H", data[at : at + 2])
    tags = {}
    for i in range(n):
        tag, kind, count = struct.unpack(order + "HHI", data[at + 2 + 12 * i : at + 10 + 12 * i])
        code = _SIZES.get(kind, "B")
        size = struct.calcsize(code) * count
        raw = data[at + 10 + 12 * i : at + 14 + 12 * i]
        if size > 4:
            (where,) = struct.unpack(order + "I", raw)
            raw = data[where : where + size]
        tags[tag] = struct.unpack(f"{order}{count}{code}", raw[:size]) if code != "s" else (raw[:size],)
    return order, tags


def unpack_lzw(data: bytes) -> bytes:
    """Undo TIFF's LZW: codes of 9 to 12 bits, high bits first; 256 starts the table anew, 257 ends."""
    out, table, width, held, bits, before = bytearray(), {}, 9, 0, 0, b""
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == 257:
            break
        if code == 256:
            table, width, before = {}, 9, b""
            continue
        now = bytes([code]) if code < 256 else table.get(code, before + before[:1])
        out += now
        if before:
            table[258 + len(table)] = before + now[:1]
        before = now
        # The width grows one code early.
        width = min(12, max(9, (258 + len(table) + 1).bit_length()))
    return bytes(out)


def decode_tiff(data: bytes) -> tuple[np.ndarray, dict[int, tuple]]:
    """Height x width x bands and the tags of a chunky TIFF with 8 or 16 bits a sample, in strips or tiles, plain, deflated
    or LZW, with or without horizontal differencing; any other is refused."""
    order, tags = tiff_tags(data)
    width, height, bands = tags[256][0], tags[257][0], tags.get(277, (1,))[0]
    packed, predictor = tags.get(259, (1,))[0], tags.get(317, (1,))[0]
    unpack = {1: bytes, 5: unpack_lzw, 8: zlib.decompress, 32946: zlib.decompress}.get(packed)
    depths = set(tags.get(258, (1,)))
    if unpack is None or tags.get(284, (1,))[0] != 1 or predictor not in (1, 2) or depths not in ({8}, {16}):
        raise ValueError("only chunky TIFF of 8 or 16 bits, plain, deflated or LZW, can be read")
    kind = np.dtype({8: "u1", 16: order + "u2"}[depths.pop()])
    out = np.zeros((height, width, bands), kind)
    tiled = 322 in tags
    across, down = (tags[322][0], tags[323][0]) if tiled else (width, min(height, tags.get(278, (height,))[0]))
    places = [(x, y) for y in range(0, height, down) for x in range(0, width, across)]
    for (x, y), at, size in zip(places, tags[324 if tiled else 273], tags[325 if tiled else 279]):
        rows = down if tiled else min(down, height - y)
        part = np.frombuffer(unpack(data[at : at + size]), kind, rows * across * bands).reshape(rows, across, bands)
        if predictor == 2:
            part = np.cumsum(part, axis=1, dtype=kind.newbyteorder("="))
        out[y : y + rows, x : x + across] = part[: height - y, : width - x]
    return out, tags


def read_headers(spark: SparkSession, folder: str, pattern: str = "*.tif") -> DataFrame:
    """(path, width, height, bands, a, c0, e, f) of all tiles below a folder from their tags: x = c0 + a * column and
    y = f + e * row; null where a file has no place."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path", "content")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                _, tags = tiff_tags(content)
                scale, tie = tags.get(33550), tags.get(33922)
                affine = (scale[0], tie[3] - tie[0] * scale[0], -scale[1], tie[4] + tie[1] * scale[1]) if scale and tie else (None,) * 4
                rows.append((path, tags[256][0], tags[257][0], tags.get(277, (1,))[0], *affine))
            yield pd.DataFrame(rows, columns=["path", "width", "height", "bands", "a", "c0", "e", "f"])

    return files.mapInPandas(read, "path string, width int, height int, bands int, a double, c0 double, e double, f double")


def encode_tiff(a: np.ndarray, scale: float | None = None, origin: tuple[float, float] | None = None) -> bytes:
    """A byte array as an uncompressed TIFF, with pixel scale and upper left corner if they are given."""
    height, width, bands = a.shape
    body = np.ascontiguousarray(a, np.uint8).tobytes()
    entries = [(256, 4, [width]), (257, 4, [height]), (258, 3, [8] * bands), (259, 3, [1]), (262, 3, [2 if bands >= 3 else 1]), (273, 4, [8]), (277, 3, [bands]), (278, 4, [height]), (279, 4, [len(body)])]
    if scale is not None and origin is not None:
        entries += [(33550, 12, [scale, scale, 0.0]), (33922, 12, [0.0, 0.0, 0.0, *origin, 0.0])]
    directory, extra = b"", b""
    base = 8 + len(body)
    after = base + 2 + 12 * len(entries) + 4
    for tag, kind, values in entries:
        raw = struct.pack(f"<{len(values)}{_SIZES[kind]}", *values)
        if len(raw) > 4:
            where, extra = after + len(extra), extra + raw
            raw = struct.pack("<I", where)
        directory += struct.pack("<HHI", tag, kind, len(values)) + raw.ljust(4, b"\0")
    return b"II*\0" + struct.pack("<I", base) + body + struct.pack("<H", len(entries)) + directory + b"\0" * 4 + extra


def encode_png(rgba: np.ndarray) -> bytes:
    """A height x width x 4 byte array as PNG."""
    height, width, _ = rgba.shape
    lines = np.concatenate([np.zeros((height, 1), np.uint8), rgba.reshape(height, -1)], axis=1).tobytes()
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def clip_to_byte(a: np.ndarray) -> np.ndarray:
    return a if a.dtype == np.uint8 else np.clip(a, 0, 255).astype(np.uint8)


def read_pixels(spark: SparkSession, folder: str, pattern: str = "*.tif") -> DataFrame:
    """(path, x, y, r, g, b) of all tiles below a folder, read through Spark's own file source, a tile at a time."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path", "content")

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                a = clip_to_byte(decode_tiff(content)[0])
                for top in range(0, a.shape[0], 256):
                    part = a[top : top + 256]
                    ys, xs = np.mgrid[top : top + part.shape[0], 0 : part.shape[1]]
                    bands = [part[:, :, min(k, part.shape[2] - 1)].ravel() for k in range(3)]
                    yield pd.DataFrame({"path": path, "x": xs.ravel(), "y": ys.ravel(), **dict(zip("rgb", bands))})

    return files.mapInPandas(decode, PIXELS)


def pyramid_tiles(sources: DataFrame, z: int, span: float, half: float) -> DataFrame:
    """(src, z, tx, ty): the map tiles that each source box (src, x0, y0, x1, y1 in EPSG:3857) overlaps by more than an
    edge."""
    index = lambda v: F.floor(v / span).cast("int")
    low_x, high_x = index(F.col("x0") + half), F.ceil((F.col("x1") + half) / span).cast("int") - 1
    low_y, high_y = index(F.lit(half) - F.col("y1")), F.ceil((F.lit(half) - F.col("y0")) / span).cast("int") - 1
    across = sources.select("src", F.explode(F.sequence(low_x, high_x)).alias("tx"), low_y.alias("_a"), high_y.alias("_b"))
    return across.select("src", F.lit(z).alias("z"), "tx", F.explode(F.sequence("_a", "_b")).alias("ty"))


def paint(pixels: DataFrame, side: int = 256) -> DataFrame:
    """(z, tx, ty, png) from pixels (z, tx, ty, px, py, r, g, b, path): the last path in order paints over the others;
    black is no data, and a tile of nothing else is not made."""
    lit = pixels.filter(F.col("r") + F.col("g") + F.col("b") > 0)
    top = lit.groupBy("z", "tx", "ty", "px", "py").agg(F.max(F.struct("path", "r", "g", "b")).alias("m")).select("z", "tx", "ty", "px", "py", "m.r", "m.g", "m.b")

    def draw(group: pd.DataFrame) -> pd.DataFrame:
        a = np.zeros((side, side, 4), np.uint8)
        a[group["py"], group["px"]] = np.stack([group["r"], group["g"], group["b"], np.full(len(group), 255)], axis=1)
        first = group.iloc[0]
        return pd.DataFrame([[int(first["z"]), int(first["tx"]), int(first["ty"]), encode_png(a)]], columns=["z", "tx", "ty", "png"])

    return top.groupBy("z", "tx", "ty").applyInPandas(draw, "z int, tx int, ty int, png binary")


def write_files(files: DataFrame, folder: str) -> int:
    """Write (path, content) below a folder that all machines see, each file under its own name in the end, and return
    their number. A task that is run again writes the same files once more."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                whole = os.path.join(folder, path)
                os.makedirs(os.path.dirname(whole), exist_ok=True)
                part = f"{whole}.{uuid.uuid4().hex}"
                with open(part, "wb") as file:
                    file.write(content)
                os.replace(part, whole)
            yield pd.DataFrame({"n": [len(batch)]})

    return files.select("path", "content").mapInPandas(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_pyramid(pixels: DataFrame, folder: str, zooms: range, pixel: float, side: int = 256) -> int:
    """Map tiles z/x/y.png from pixels (path, mx, my, r, g, b) at their places in EPSG:3857, `pixel` wide each; returns the
    number of files. At each zoom a target takes the last pixel of its source in the order of path, then of place."""
    half = math.pi * 6378137.0
    count = 0
    for z in zooms:
        span = 2 * half / 2**z
        step = span / side
        # A source pixel covers all targets whose centres it holds; where it is smaller than a target, the one it lies in.
        first = lambda v: F.ceil((v - pixel / 2) / step - 0.5).cast("long")  # noqa: E731, B023
        last = lambda v: F.greatest(F.ceil((v + pixel / 2) / step - 0.5).cast("long") - 1, F.floor(v / step).cast("long") if pixel < step else first(v))  # noqa: E731, B023
        low = lambda v: F.least(first(v), F.floor(v / step).cast("long"))  # noqa: E731, B023
        u, v = F.col("mx") + half, F.lit(half) - F.col("my")
        dealt = pixels.select("path", "r", "g", "b", F.explode(F.sequence(low(u), last(u))).alias("gx"), F.sequence(low(v), last(v)).alias("_gy")).select("path", "r", "g", "b", "gx", F.explode("_gy").alias("gy"))
        div = lambda c: F.floor(F.col(c) / side).cast("int")
        placed = dealt.select(F.lit(z).alias("z"), div("gx").alias("tx"), div("gy").alias("ty"), F.pmod("gx", F.lit(side)).cast("int").alias("px"), F.pmod("gy", F.lit(side)).cast("int").alias("py"), "r", "g", "b", "path")
        painted = paint(placed, side)
        count += write_files(painted.select(F.format_string("%d/%d/%d.png", "z", "tx", "ty").alias("path"), F.col("png").alias("content")), folder)
    return count


def annotate(pixels: DataFrame, marks: DataFrame, width: int, height: int) -> DataFrame:
    """(tile, tiff): each tile with marked pixels (tile, x, y, r, g, b) drawn over its own."""
    every = pixels.select("tile", "x", "y", "r", "g", "b", F.lit(0).alias("over")).unionAll(marks.select("tile", "x", "y", "r", "g", "b", F.lit(1).alias("over")))

    def draw(group: pd.DataFrame) -> pd.DataFrame:
        a = np.zeros((height, width, 3), np.uint8)
        for over in (0, 1):
            g = group[group["over"] == over]
            a[g["y"], g["x"]] = g[["r", "g", "b"]].to_numpy()
        return pd.DataFrame({"tile": [group["tile"].iloc[0]], "tiff": [encode_tiff(a)]})

    kind = pixels.schema["tile"].dataType.simpleString()
    return every.groupBy("tile").applyInPandas(draw, f"tile {kind}, tiff binary")
