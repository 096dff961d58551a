"""GeoJSON layers, routes, route targets and navigation graphs as JSON."""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom import session
from fieldloom.functions import geometry as g
from fieldloom.sources import documents

PROPERTIES = "vineyard_id STRING, row_id STRING, row_structure STRING, interrow_cover STRING, tile STRING, id STRING, kind STRING, name STRING, length_m DOUBLE"
#: Coordinates nest to another depth for each geometry type, so they are kept as text and parsed by type.
COLLECTION = f"features ARRAY<STRUCT<type: STRING, geometry: STRUCT<type: STRING, coordinates: STRING>, properties: STRUCT<{PROPERTIES.replace(' STRING', ': STRING').replace(' DOUBLE', ': DOUBLE')}>>>"
DEPTHS = {"Point": 0, "LineString": 1, "MultiLineString": 2, "Polygon": 2, "MultiPolygon": 3}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store Spark can read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


FEATURE = COLLECTION.removeprefix("features ARRAY<STRUCT<").removesuffix(">>").replace("type: STRING, geometry", "type STRING, geometry", 1).replace("geometry: STRUCT", "geometry STRUCT", 1).replace(", properties: ", ", properties ", 1)


def read(spark: SparkSession, path: str, whole: int = documents.WHOLE, ordered: bool = False) -> DataFrame:
    """(geom_type, coordinates, properties...) of a collection's features; a missing file has none. With `ordered` there is
    a column place, by which the features of a file stand as in the file.

    Files of over `whole` bytes are read feature by feature: each split looks for what seems to be the start of a feature and
    reads on from there, and the driver reads what lies between the splits. Where it gets from one split to the next all
    through the file, the starts were right; otherwise the files are read whole. Coordinates are the same JSON either way, but
    for spaces."""
    found = exists(spark, path)
    if found and documents.size(spark, path) > whole:
        parts = session.written(documents.pieces(spark, path, "{").mapInArrow(_features, ROW), "collection")
        between = _joined(documents.ends(parts))
        if between is not None:
            rows = parts.filter("edge IS NULL").select(*ROW_COLUMNS[:-1]).unionAll(spark.createDataFrame(between, ROW).select(*ROW_COLUMNS[:-1]))
            features = rows.select(F.struct("file", "block", "n").alias("place"), F.from_json("feature", FEATURE).alias("f"))
            return _flat(features, ordered)
    empty = spark.read.schema(COLLECTION).option("multiLine", "true").json(path) if found else spark.createDataFrame([], COLLECTION)
    if not ordered:
        return _flat(empty.select(F.explode("features").alias("f")), False)
    features = empty.select(F.monotonically_increasing_id().alias("file"), F.posexplode("features").alias("n", "f"))
    return _flat(features.select(F.struct("file", F.lit(0).cast("long").alias("block"), F.col("n").cast("long").alias("n")).alias("place"), "f"), True)


def _flat(features: DataFrame, ordered: bool) -> DataFrame:
    return features.select(*["place"] * ordered, F.col("f.geometry.type").alias("geom_type"), F.col("f.geometry.coordinates").alias("coordinates"), "f.properties.*")


ROW_COLUMNS = ("file", "block", "n", "feature", "edge")
ROW = "file long, block long, n long, feature string, edge string"
#: How a feature may begin; what lies between the splits shows whether it was one.
_BEGINS = re.compile(r'\{\s*"(?:type"\s*:\s*"Feature"|geometry"|properties"|id"|bbox")')
_DECODE = json.JSONDecoder().raw_decode
#: Characters of a feature, or of what stands around the features, that are read at most; beyond that, files are read whole.
LONGEST = 1 << 22


class _Wrong(Exception):
    """The text is not what was taken for granted, or is too long."""


def _space(text: str, at: int) -> int:
    return json.decoder.WHITESPACE.match(text, at).end()


def _members(text: str, at: int) -> int | None:
    """From within the root object, before a member or its end, to behind the [ of its features; None where it ends."""
    while True:
        at = _space(text, at)
        if text[at] == "}":
            if _space(text, at + 1) != len(text):
                raise _Wrong
            return None
        if text[at] != '"':
            raise _Wrong
        key, at = json.decoder.scanstring(text, at + 1)
        at = _space(text, at)
        if text[at] != ":":
            raise _Wrong
        at = _space(text, at + 1)
        if key == "features":
            if text[at] != "[":
                raise _Wrong
            return at + 1
        at = _space(text, _DECODE(text, at)[1])
        if text[at] == ",":
            at = _space(text, at + 1)
            if text[at] == "}":
                raise _Wrong
        elif text[at] != "}":
            raise _Wrong


def _advance(text: str, at: int, state: str, found: list[str]) -> tuple[int, str]:
    """Read on as far as the text goes. States: root (before the document), first (behind the [), next (behind a comma),
    after (behind a feature), rest (behind the ])."""
    if state == "root":
        try:
            begin = _space(text, 1 if text[0] == "\ufeff" else 0)
            if text[begin] != "{":
                raise _Wrong
            at, state = _members(text, begin + 1), "first"
        except (IndexError, ValueError):
            return 0, "root"
        if at is None:
            raise _Wrong
    while state != "rest":
        p = _space(text, at)
        if p == len(text):
            break
        if state == "after":
            if text[p] not in ",]":
                raise _Wrong
            at, state = p + 1, "next" if text[p] == "," else "rest"
        elif text[p] == "]" and state == "first":
            at, state = p + 1, "rest"
        else:
            if text[p] != "{":
                raise _Wrong
            try:
                end = _DECODE(text, p)[1]
            except ValueError:
                return p, state
            found.append(text[p:end])
            at, state = end, "after"
    return at, state


def _begin(text: str, at: int) -> tuple[int, bool]:
    """The next place from `at` on that begins a feature, or may do so once there is more text; whether it does."""
    while m := _BEGINS.search(text, at):
        at = m.start()
        try:
            value, end = _DECODE(text, at)
        except ValueError:
            return at, False
        end = _space(text, end)
        if end == len(text):
            return at, False
        if value.get("type") == "Feature" and text[end] in ",]":
            return at, True
        at += 1
    return at, False


def _split_features(file: int, block: int, lists) -> Iterator[tuple]:
    """Rows of ROW for the features of a split, whose pieces come without the { before them; at last its ends."""
    text, at, state, head, n, need, wrong = "", 0, "root" if block == 0 else "seek", None, 0, 0, False
    try:
        for k, pieces in enumerate(itertools.chain(lists, [None])):
            if pieces is not None:
                more = "{".join(pieces) if k == 0 and block == 0 else "{" + "{".join(pieces)
                text, at = (text + more, at) if state == "seek" else (text[at:] + more, 0)
                if len(text) < need:
                    continue
            if state == "seek":
                at, begun = _begin(text, at)
                if begun:
                    head, text, at, state = text[:at], text[at:], 0, "next"
            found: list[str] = []
            if state != "seek":
                at, state = _advance(text, at, state, found)
            for feature in found:
                yield file, block, n, feature, None
                n += 1
            rest = len(text) if state == "seek" else len(text) - at
            if rest > LONGEST:
                raise _Wrong
            # What is not whole yet is tried again when there is twice as much of it.
            need = 0 if found else 2 * rest
    except (_Wrong, RecursionError):
        wrong = True
    edge = {"wrong": True} if wrong else {"head": text, "begun": False} if state == "seek" else {"head": head, "begun": True, "tail": text[at:], "state": state}
    yield file, block, n, None, json.dumps(edge)


def _features(batches):
    import pyarrow as pa

    rows = itertools.chain.from_iterable(_split_features(*split) for split in documents.splits(batches))
    schema = pa.schema([(c, pa.string() if c in ("feature", "edge") else pa.int64()) for c in ROW_COLUMNS])
    while some := list(itertools.islice(rows, 5_000)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), schema.types)], schema=schema)


def _joined(files: dict[int, list[tuple[int, dict]]] | None) -> list[tuple] | None:
    """The features between the splits, as rows; None where a split did not begin with a feature."""
    if files is None:
        return None
    rows = []
    try:
        for file, ((start, first), *others) in files.items():
            if start != 0:
                return None
            block, text, state, n = start, first["tail"], first["state"], 1 << 40
            for here, e in others:
                found: list[str] = []
                text += e["head"]
                at, state = _advance(text, 0, state, found)
                rows += [(file, block, n + k, feature, None) for k, feature in enumerate(found)]
                text, n = text[at:], n + len(found)
                if e["begun"]:
                    if state not in ("first", "next") or text.strip(" \t\r\n"):
                        return None
                    block, text, state, n = here, e["tail"], e["state"], 1 << 40
            if state != "rest":
                return None
            at = _space(text, 0)
            if text[at : at + 1] == ",":
                if text[_space(text, at + 1)] == "}" or _members(text, at + 1) is not None:
                    return None
            elif text[at : at + 1] != "}" or text[at + 1 :].strip(" \t\r\n"):
                return None
    except (_Wrong, IndexError, ValueError, RecursionError):
        return None
    return rows


def _point(p: Column) -> Column:
    return F.struct(p[0].alias("x"), p[1].alias("y"))


def geometry(kind: Column, coordinates: Column) -> Column:
    """Coordinates of any type as a multipolygon-shaped array: points in rings in parts. Null geometries stay null."""
    parse = lambda depth: F.from_json(coordinates, "array<" * depth + "array<double>" + ">" * depth)
    line = lambda points: F.transform(points, _point)
    rings = lambda many: F.transform(many, line)
    return (
        F.when(coordinates.isNull(), F.lit(None))
        .when(kind == "Point", F.array(F.array(F.array(_point(parse(0))))))
        .when(kind == "LineString", F.array(F.array(line(parse(1)))))
        .when(kind.isin("Polygon", "MultiLineString"), F.array(rings(parse(2))))
        .when(kind == "MultiPolygon", F.transform(parse(3), rings))
    )


def reproject(parts: Column) -> Column:
    """A multipolygon-shaped array from EPSG:32635 to longitude and latitude."""
    return F.transform(parts, lambda rings: F.transform(rings, g.points_to_lonlat))


def _xy(p: Column, digits: int) -> Column:
    return F.array(F.round(p["x"], digits), F.round(p["y"], digits))


def coordinates_json(kind: Column, parts: Column, digits: int = 7) -> Column:
    """Back to GeoJSON coordinates of a type."""
    ring = lambda points: F.transform(points, lambda p: _xy(p, digits))
    rings = lambda many: F.transform(many, ring)
    return (
        F.when(kind == "Point", F.to_json(_xy(parts[0][0][0], digits)))
        .when(kind == "LineString", F.to_json(ring(parts[0][0])))
        .when(kind.isin("Polygon", "MultiLineString"), F.to_json(rings(parts[0])))
        .when(kind == "MultiPolygon", F.to_json(F.transform(parts, rings)))
    )


def feature(kind: Column, parts: Column, properties: dict[str, Column], digits: int = 7) -> Column:
    """One feature as JSON text; a null geometry stays null."""
    body = F.to_json(F.struct(*[v.alias(k) for k, v in properties.items()]), {"ignoreNullFields": "false"})
    shape = F.coalesce(F.concat(F.lit('{"type":"'), kind, F.lit('","coordinates":'), coordinates_json(kind, parts, digits), F.lit("}")), F.lit("null"))
    return F.concat(F.lit('{"type":"Feature","geometry":'), shape, F.lit(',"properties":'), body, F.lit("}"))


def write_collection(features: DataFrame, path: str, order: list[str], crs: str | None = None) -> None:
    """A layer as one collection: a single ordered text file of its features (column feature)."""
    head = '{"type":"FeatureCollection",' + (f'"crs":{{"type":"name","properties":{{"name":"{crs}"}}}},' if crs else "") + '"features":['
    # A comma stands before every feature but the first.
    documents.write(features.select(*order, F.concat(F.lit(","), "feature").alias("line")), order, path, head, "]}", 1)


def route_feature(points: Column, name: Column, length: Column, digits: int = 3) -> Column:
    """A route as a LineString with its name and length in centimetres' precision; degrees want more digits than metres."""
    return feature(F.lit("LineString"), F.array(F.array(points)), {"name": name, "length_m": F.round(length, 2)}, digits)


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """(id, kind, vineyard_id, row_id, x, y) of a target file's points; a missing kind is waste."""
    found = read(spark, path).filter("geom_type = 'Point'")
    p = geometry(F.col("geom_type"), F.col("coordinates"))[0][0][0]
    return found.select("id", F.coalesce("kind", F.lit("waste")).alias("kind"), "vineyard_id", "row_id", p["x"].alias("x"), p["y"].alias("y"))


GRAPH = "crs STRING, start STRUCT<lng: DOUBLE, lat: DOUBLE>, start_node BIGINT, nodes ARRAY<ARRAY<DOUBLE>>, edges ARRAY<ARRAY<DOUBLE>>"


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, x, y) and edges (src, dst, w) of a navigation graph, edges once each."""
    doc = spark.read.schema(GRAPH).option("multiLine", "true").json(path)
    nodes = doc.select(F.posexplode("nodes").alias("node", "p")).select(F.col("node").cast("long").alias("node"), F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))
    edges = doc.select(F.explode("edges").alias("e")).select(F.col("e")[0].cast("long").alias("src"), F.col("e")[1].cast("long").alias("dst"), F.col("e")[2].alias("w"))
    return nodes, edges


def adjacency(edges: DataFrame) -> DataFrame:
    """(src, neighbours) with each edge in both directions; a lattice node has eight at most."""
    both = edges.select("src", "dst", "w").unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    return both.groupBy("src").agg(F.array_sort(F.collect_list(F.struct("dst", "w"))).alias("neighbours"))


def write_graph(nodes: DataFrame, edges: DataFrame, start: tuple[float, float], start_node: int, path: str, crs: str = "EPSG:4326") -> None:
    """A compact graph (idx, x, y; i, j, w) as one JSON document, in lines that are written in order."""
    spark = nodes.sparkSession
    from pyspark.sql import Window

    comma = lambda first, c: F.when(first == 1, c).otherwise(F.concat(F.lit(","), c))
    n = nodes.select((F.col("idx") + 1).cast("long").alias("place"), comma(F.col("idx") + 1, F.to_json(F.array("x", "y"))).alias("line"))
    k = F.row_number().over(Window.partitionBy().orderBy("i", "j"))
    edge = F.concat(F.lit("["), F.col("i").cast("string"), F.lit(","), F.col("j").cast("string"), F.lit(","), F.col("w").cast("string"), F.lit("]"))
    e = edges.select(k.alias("k"), edge.alias("line")).select((F.col("k") + (1 << 50)).cast("long").alias("place"), comma(F.col("k"), F.col("line")).alias("line"))
    fixed = [
        (0, f'{{"crs":"{crs}","start":{{"lng":{start[0]},"lat":{start[1]}}},"start_node":{start_node},"nodes":['),
        (1 << 50, '],"edges":['),
        (1 << 60, "]}"),
    ]
    spark.createDataFrame(fixed, "place long, line string").unionAll(n).unionAll(e).coalesce(1).sortWithinPartitions("place").select("line").write.mode("overwrite").text(path)
