"""CVAT 1.1 annotation files: reading to flat objects and writing back."""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldloom import session
from fieldloom.functions.text import escape_xml, fixed, format_points, parse_points
from fieldloom.sources import documents

_ATTRIBUTE = "attribute: ARRAY<STRUCT<_name: STRING, _VALUE: STRING>>"
#: Inference would take a single attribute for a struct, so the schema is declared.
SCHEMA = f"""_id INT, _name STRING, _width INT, _height INT,
polygon ARRAY<STRUCT<_label: STRING, _points: STRING, {_ATTRIBUTE}>>, polyline ARRAY<STRUCT<_label: STRING, _points: STRING, {_ATTRIBUTE}>>,
box ARRAY<STRUCT<_label: STRING, _xtl: DOUBLE, _ytl: DOUBLE, _xbr: DOUBLE, _ybr: DOUBLE, {_ATTRIBUTE}>>"""
#: The labels, their shapes and attributes with the defaults of missing ones.
LABELS = {
    "vineyard": ("polygon", {"vineyard_id": ""}),
    "interrow_area": ("polygon", {"vineyard_id": "", "interrow_cover": "bare_soil"}),
    "row": ("polyline", {"vineyard_id": "", "row_id": "", "row_structure": "regular"}),
    "waste": ("box", {"vineyard_id": ""}),
}
HEADER_ORDER = ("vineyard", "waste", "row", "interrow_area")
ATTRIBUTES = ("vineyard_id", "row_id", "row_structure", "interrow_cover")


def read(spark: SparkSession, path: str, whole: int = documents.WHOLE) -> DataFrame:
    """(tile, width, height, label, place, points, vineyard_id, row_id, row_structure, interrow_cover) of all objects with
    one of the four labels; a box is its two corners. Missing ids are '', other missing attributes null.

    Files of over `whole` bytes are read tag by tag, so that an image may hold any number of objects: each split takes for
    granted that it begins outside of comments, and objects that reach over its ends are put together by the driver.
    Where the ends don't fit one another, the files are read by the image."""
    if documents.size(spark, path) <= whole:
        return _whole(spark, path)
    parts = session.written(documents.pieces(spark, path, "<").mapInArrow(_objects, ROW), "annotations")
    joined = _joined(documents.ends(parts))
    if joined is None:
        return _whole(spark, path)
    cut, images = joined
    names = ROW_COLUMNS[:-1]
    found = parts.filter("edge IS NULL").select(*names).unionAll(spark.createDataFrame(cut, ROW).select(*names))
    # What stands before a split's first image tag belongs to an image that begins in an earlier split.
    kept = spark.createDataFrame(images, "file long, block long, _block long, _img int, _tile string, _width string, _height string")
    earlier = F.col("img") == 0
    of = lambda c: F.when(earlier, F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
    placed = found.join(F.broadcast(kept), ["file", "block"], "left").filter(~earlier | F.col("_img").isNotNull())
    placed = placed.select("file", "block", "n", "kind", "label", "points", *ATTRIBUTES, F.when(earlier, F.col("_block")).otherwise(F.col("block")).alias("_from"), *[of(c) for c in ("img", "tile", "width", "height")])
    order = F.row_number().over(Window.partitionBy("file", "_from", "img").orderBy("kind", "block", "n")) - 1
    out = placed.withColumn("place", order).filter(F.col("label").isin(*LABELS))
    corner = F.split("points", "[,;]")
    number = lambda k: F.nullif(corner[k], F.lit("")).cast("double")
    two = F.array(*[F.struct(number(k).alias("x"), number(k + 1).alias("y")) for k in (0, 2)])
    points = F.when(F.col("kind") == SHAPES["box"], two).otherwise(parse_points(F.col("points")))
    value = lambda n: F.coalesce(n, F.lit("")).alias(n) if n.endswith("_id") else F.col(n)
    return out.select("tile", *[F.col(c).cast("int").alias(c) for c in ("width", "height")], "label", "place", points.alias("points"), *[value(n) for n in ATTRIBUTES])


#: Shapes in the order in which places are counted.
SHAPES = {"polygon": 0, "polyline": 1, "box": 2}
#: img: the number of the image tag within the split, 0 before the first.
ROW_COLUMNS = ("file", "block", "img", "n", "kind", "tile", "width", "height", "label", "points", *ATTRIBUTES, "edge")
ROW = ", ".join(f"{c} {'long' if c in ('file', 'block', 'n') else 'int' if c in ('img', 'kind') else 'string'}" for c in ROW_COLUMNS)
_TAG = re.compile(r"""([^\s/>]+)((?:\s+[^\s=>]+\s*=\s*(?:"[^"]*"|'[^']*'))*)\s*(/?)>""")
_PAIR = re.compile(r"""([^\s=]+)\s*=\s*(?:"([^"]*)"|'([^']*)')""")
_ENTITY = re.compile(r"&(?:#x([0-9a-fA-F]+)|#([0-9]+)|(amp|lt|gt|quot|apos));")
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


def _plain(value: str) -> str:
    if "&" in value:
        value = _ENTITY.sub(lambda m: _NAMED[m[3]] if m[3] else chr(int(m[1], 16) if m[1] else int(m[2])), value)
    return value


def _pairs(written: str) -> dict[str, str]:
    if "\n" in written or "\t" in written or "\r" in written:
        written = re.sub(r"[\t\r\n]", " ", written)
    return {k: _plain(a or b).strip() for k, a, b in _PAIR.findall(written)}


def _split_objects(file: int, block: int, lists, start: dict | None = None) -> Iterator[tuple]:
    """Rows of ROW for the tags of a split, each without its '<'; at last what is known of the split's ends. A split that
    is not a file's first may begin in an image and in an object; `start` gives the place of an object that stands alone."""
    img, n, tile, width, height = (start or {}).get("at", (0, 0, None, None, None))
    inside = block > 0 or bool(start)  # False: outside of any image; in a later split it may be the earlier image
    head, done, closes, now = [], block == 0 or bool(start), False, "same"
    obj = raw = key = text = skip = None
    wrong = False
    for tag in itertools.chain.from_iterable(lists) if block or start else itertools.islice(itertools.chain.from_iterable(lists), 1, None):
        if raw is not None:
            raw.append(tag)
        if skip:
            end = tag.find(skip)
            if skip == "]]>" and key is not None:
                text += "<" + (tag if end < 0 else tag[:end] + _plain(tag[end + 3 :]))
            skip = skip if end < 0 else None
            if not done:
                head.append(tag)
            continue
        first = tag[:1]
        if not done:
            # The rest of an object that began in the split before.
            if first in "!?" or tag.startswith(("attribute", "/attribute")):
                head.append(tag)
            else:
                done = True
                if first == "/" and tag[1:].split(">")[0].strip() in SHAPES:
                    head.append(tag)
                    closes = True
                    continue
        if first == "/":
            name = tag[1:].split(">")[0].strip()
            if name == "attribute":
                if key is not None:
                    obj[key] = text.strip() or None
                    key = None
            elif name in SHAPES:
                if obj is None or obj[""] != name:
                    wrong = True
                    break
                if inside:
                    yield (file, block, img, n, SHAPES[name], tile, width, height, obj["label"], obj["points"], *[obj.get(a) for a in ATTRIBUTES], None)
                obj = raw = None
                n += 1
            elif name == "image":
                inside, now = False, "out"
        elif first == "!":
            if tag.startswith("!--"):
                skip = "-->" if tag.find("-->", 3) < 0 else None
            elif tag.startswith("![CDATA["):
                end = tag.find("]]>")
                skip = "]]>" if end < 0 else None
                if key is not None:
                    text += tag[8:] if end < 0 else tag[8:end] + _plain(tag[end + 3 :])
        elif first != "?":
            m = _TAG.match(tag)
            if m is None:
                wrong = True
                break
            name = m[1]
            if name == "attribute":
                if obj is not None:
                    key, text = _pairs(m[2]).get("name"), _plain(tag[m.end() :])
                    key = key if key in ATTRIBUTES else "-"
                    if m[3]:
                        obj[key], key = None, None
            elif name in SHAPES:
                if obj is not None:
                    wrong = True
                    break
                pairs = _pairs(m[2])
                points = ",".join(pairs.get(c, "") for c in ("xtl", "ytl", "xbr", "ybr")) if name == "box" else pairs.get("points")
                if not m[3]:
                    obj, raw = {"": name, "label": pairs.get("label"), "points": points}, [tag]
                else:
                    if inside:
                        yield (file, block, img, n, SHAPES[name], tile, width, height, pairs.get("label"), points, *[None] * len(ATTRIBUTES), None)
                    n += 1
            elif name == "image":
                pairs = _pairs(m[2])
                img, inside, now = img + 1, not m[3], "out" if m[3] else "in"
                tile, width, height = (pairs.get(c) for c in ("name", "width", "height"))
    edge = {"head": "<".join(head), "any": bool(head), "done": done, "closes": closes, "now": now, "image": (img, tile, width, height), "skip": bool(skip), "wrong": wrong}
    edge |= {"tail": None if raw is None else "<".join(raw), "at": (img, n, tile, width, height), "inside": inside}
    yield (file, block, *[None] * (len(ROW_COLUMNS) - 3), json.dumps(edge))


def _objects(batches):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    schema = pa.schema([(c, kinds[k]) for c, k in (x.split(" ") for x in ROW.split(", "))])
    rows = itertools.chain.from_iterable(_split_objects(*split) for split in documents.splits(batches))
    while some := list(itertools.islice(rows, 10_000)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), schema.types)], schema=schema)


def _joined(files: dict[int, list[tuple[int, dict]]] | None) -> tuple[list[tuple], list[tuple]] | None:
    """The objects that reach over the ends of splits, as rows, and the image that each split begins in; None where the
    ends don't fit."""
    if files is None:
        return None
    cut, images = [], []
    for file, several in files.items():
        image = open_at = None
        if several[0][0] != 0:
            return None
        for k, (block, e) in enumerate(several):
            if image:
                images.append((file, block, *image))
            if open_at:
                if e["any"]:
                    open_at[1].append(e["head"])
                if e["done"]:
                    if not e["closes"]:
                        return None
                    begun, tags = open_at
                    found = list(_split_objects(file, begun[0], ["<".join(tags).split("<")], {"at": begun[1]}))
                    if json.loads(found[-1][-1])["wrong"] or len(found) > 2:
                        return None
                    # One that stands in no image is no object.
                    cut += found[:-1] if begun[2] else []
                    open_at = None
            elif e["closes"]:
                return None
            if e["tail"] is not None:
                if open_at:
                    return None
                open_at = ((block, e["at"], e["inside"]), [e["tail"]])
            if e["skip"] and k + 1 < len(several):
                return None
            image = image if e["now"] == "same" else (block, *e["image"]) if e["now"] == "in" else None
        if open_at:
            return None
    return cut, images


def _whole(spark: SparkSession, path: str) -> DataFrame:
    """Files of few objects: an image is one record."""
    images = spark.read.format("xml").option("rowTag", "image").schema(SCHEMA).load(path)
    corners = lambda b: F.array(F.struct(b["_xtl"].alias("x"), b["_ytl"].alias("y")), F.struct(b["_xbr"].alias("x"), b["_ybr"].alias("y")))
    flat = lambda o, points: F.struct(o["_label"].alias("label"), points.alias("points"), o["attribute"].alias("attribute"))
    empty = lambda c: F.coalesce(c, F.array().cast("array<struct<label:string,points:array<struct<x:double,y:double>>,attribute:array<struct<_name:string,_VALUE:string>>>>"))
    shapes = F.concat(
        empty(F.transform("polygon", lambda o: flat(o, parse_points(o["_points"])))),
        empty(F.transform("polyline", lambda o: flat(o, parse_points(o["_points"])))),
        empty(F.transform("box", lambda o: flat(o, corners(o)))),
    )
    objects = images.select(F.col("_name").alias("tile"), F.col("_width").alias("width"), F.col("_height").alias("height"), F.posexplode(shapes).alias("place", "o"))
    named = F.map_from_entries(F.transform(F.coalesce("o.attribute", F.array().cast("array<struct<_name:string,_VALUE:string>>")), lambda a: F.struct(a["_name"], a["_VALUE"])))
    out = objects.withColumn("_m", named).filter(F.col("o.label").isin(*LABELS))
    value = lambda n: F.coalesce(F.element_at("_m", n), F.lit("")) if n.endswith("_id") else F.element_at("_m", n)
    return out.select("tile", "width", "height", F.col("o.label").alias("label"), "place", F.col("o.points").alias("points"), *[value(n).alias(n) for n in ATTRIBUTES])


def image_lines(objects: DataFrame) -> DataFrame:
    """(tile, o, place, line): an image's tag, its objects in the order of LABELS and its end, one a line. Images are numbered
    from 0 by name."""
    number = lambda v: fixed(v.cast("double"), 2)
    attributes = F.concat(
        *[
            F.when(F.col("label").isin(*[k for k, (_, a) in LABELS.items() if n in a]), F.concat(F.lit(f'<attribute name="{n}">'), escape_xml(F.coalesce(F.col(n), F.lit(next(a[n] for _, a in LABELS.values() if n in a)))), F.lit("</attribute>"))).otherwise("")
            for n in ATTRIBUTES
        ]
    )
    p0, p1 = F.get("points", F.lit(0)), F.get("points", F.lit(1))
    box = F.concat(F.lit('<box label="waste" occluded="0" source="auto" xtl="'), number(p0["x"]), F.lit('" ytl="'), number(p0["y"]), F.lit('" xbr="'), number(p1["x"]), F.lit('" ybr="'), number(p1["y"]), F.lit('" z_order="0">'), attributes, F.lit("</box>"))
    shape = F.when(F.col("label") == "row", "polyline").otherwise("polygon")
    other = F.concat(F.lit("<"), shape, F.lit(' label="'), F.col("label"), F.lit('" occluded="0" source="auto" points="'), format_points(F.col("points")), F.lit('" z_order="0">'), attributes, F.lit("</"), shape, F.lit(">"))
    order = F.array_position(F.array(*[F.lit(k) for k in LABELS]), F.col("label"))
    line = F.when(F.col("label") == "waste", box).otherwise(other)
    drawn = session.written(objects.filter("tile IS NOT NULL").select("tile", order.cast("int").alias("o"), "place", line.alias("line"), "width", "height"), "drawn")
    # Only names are numbered in one task; a survey has few tiles beside its objects.
    tiles = drawn.groupBy("tile").agg(F.max("width").alias("w"), F.max("height").alias("h")).withColumn("k", F.row_number().over(Window.partitionBy().orderBy("tile")) - 1)
    begins = F.concat(F.format_string('<image id="%d" name="', "k"), escape_xml(F.col("tile")), F.format_string('" width="%d" height="%d">', "w", "h"))
    both = F.inline(F.array(*[F.struct(F.lit(o).alias("o"), x.alias("line")) for o, x in ((-1, begins), (len(LABELS) + 1, F.lit("</image>")))]))
    nothing = F.lit(None).cast(drawn.schema["place"].dataType).alias("place")
    return drawn.select("tile", "o", "place", "line").unionAll(tiles.select("tile", both).select("tile", "o", nothing, "line"))


def header() -> str:
    values = {"row_structure": "regular\ndisrupted\nunassessable", "interrow_cover": "bare_soil\nvegetation\nmixed\nunassessable"}
    # A box is declared as a rectangle, and nothing may change along a track.
    attribute = "<attribute><name>{}</name><input_type>{}</input_type><mutable>false</mutable><default_value>{}</default_value><values>{}</values></attribute>"
    labels = "".join(
        f"<label><name>{name}</name><type>{'rectangle' if shape == 'box' else shape}</type><attributes>"
        + "".join(attribute.format(a, "select" if a in values else "text", default, values.get(a, "")) for a, default in attributes.items())
        + "</attributes></label>"
        for name, (shape, attributes) in sorted(LABELS.items(), key=lambda item: HEADER_ORDER.index(item[0]))
    )
    return f"<version>1.1</version><meta><task><name>survey</name><labels>{labels}</labels></task></meta>"


def write(objects: DataFrame, path: str) -> None:
    """All images as one XML document in a folder: a single ordered text file."""
    documents.write(image_lines(objects), ["tile", "o", "place", "line"], path, f'<?xml version="1.0" encoding="utf-8"?>\n<annotations>{header()}', "</annotations>")


def nested(objects: DataFrame) -> DataFrame:
    """One row per tile with its objects as four arrays."""
    of = lambda label, *columns: F.array_sort(F.collect_list(F.when(F.col("label") == label, F.struct("place", "points", *columns)))).alias(label)
    return objects.groupBy("tile").agg(
        F.max("width").alias("width"), F.max("height").alias("height"), of("vineyard", "vineyard_id"), of("row", "vineyard_id", "row_id", "row_structure"), of("interrow_area", "vineyard_id", "interrow_cover"), of("waste", "vineyard_id")
    )
