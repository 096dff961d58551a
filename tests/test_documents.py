"""Documents that are one file, with more in them than one task should hold."""

import json
import random
import xml.etree.ElementTree as tree

import pytest
from pyspark.sql import functions as F

from fieldloom.functions import geometry as g
from fieldloom.sources import cvat, geojson

ODD = """<?xml version="1.0"?>
<annotations><meta><task><labels><label><attributes><attribute><name>v</name></attribute></attributes></label></labels></task></meta>
<image id="0" name=" a&amp;b.tif " width="10" height="7">
 <!-- c <polygon label="row" points="1,1"/> -->
 <polygon points='1,2;3,4' label="vineyard"><attribute name="vineyard_id"> V1 &lt;x&gt; </attribute><attribute name="interrow_cover"></attribute></polygon>
 <box label="waste" xtl="1" ytl="2" xbr="3" ybr="4"/>
 <tag label="q"><attribute name="vineyard_id">T</attribute></tag>
 <polyline label="row" points=""
   ><attribute
 name="row_id"><![CDATA[a<b]]></attribute><attribute name="row_structure"/></polyline>
 <polygon label="interrow_area" points="1,2"><attribute name="interrow_cover">  </attribute></polygon>
</image>
<image id="1" name="b" width="10" height="20"><polygon label="other" points="5,5"/><polygon label="vineyard" points="5,5"/></image><image id="2" name="c" width="1" height="1"/>
<track><box label="waste" xtl="1" ytl="2" xbr="3" ybr="4"/></track>
</annotations>"""


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def short_splits(spark):
    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)

    yield cut
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", [150, 260, 10**7])
def test_annotations_read_tag_by_tag(spark, tmp_path, monkeypatch, short_splits, size):
    (tmp_path / "odd.xml").write_text(ODD)
    want = rows(cvat.read(spark, str(tmp_path / "odd.xml")))
    assert len(want) == 5
    # At these sizes no split begins in the comment, so nothing is read by the image.
    monkeypatch.setattr(cvat, "_whole", None)
    short_splits(size)
    assert rows(cvat.read(spark, str(tmp_path / "odd.xml"), 0)) == want


def test_annotations_that_do_not_fit_are_read_by_the_image(spark, tmp_path, short_splits):
    comment = "<!-- " + "<polygon label='row' points='1,1'/> " * 40 + "-->"
    (tmp_path / "c.xml").write_text(ODD.replace("<track>", comment + "<track>"))
    short_splits(300)
    assert rows(cvat.read(spark, str(tmp_path / "c.xml"), 0)) == rows(cvat.read(spark, str(tmp_path / "c.xml")))


def test_one_tile_of_many_objects(spark, tmp_path, monkeypatch, short_splits):
    n = 3000
    label = F.when(F.col("id") % 3 == 0, "row").when(F.col("id") % 3 == 1, "waste").otherwise("vineyard")
    points = F.array(*[F.struct((F.col("id") + k).cast("double").alias("x"), F.lit(1.5).alias("y")) for k in range(2)])
    nothing = F.lit(None).cast("string")
    objects = spark.range(n, numPartitions=3).select(
        F.when(F.col("id") < n - 2, "a.tif").otherwise("b.tif").alias("tile"), F.lit(9).alias("width"), F.lit(8).alias("height"), label.alias("label"), F.col("id").cast("int").alias("place"), points.alias("points"), F.lit("V<1>").alias("vineyard_id"), F.lit("").alias("row_id"), nothing.alias("row_structure"), nothing.alias("interrow_cover")
    )
    # No task gathers a tile's objects on the way into the file.
    monkeypatch.setattr(F, "collect_list", None)
    cvat.write(objects, str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*")
    images = tree.parse(part).getroot().findall("image")
    assert [(i.get("id"), i.get("name"), len(i)) for i in images] == [("0", "a.tif", n - 2), ("1", "b.tif", 2)]
    order = [(list(cvat.LABELS).index(o.get("label")), float((o.get("points") or o.get("xtl")).split(",")[0])) for o in images[0]]
    assert order == sorted(order)
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    monkeypatch.setattr(cvat, "_whole", None)
    short_splits(20_000)
    back = cvat.read(spark, str(tmp_path / "out"), 0)
    assert back.groupBy("tile").agg(F.count("*"), F.count_distinct("place"), F.max("place")).orderBy("tile").collect() == [("a.tif", n - 2, n - 2, n - 3), ("b.tif", 2, 2, 1)]
    compared = ["tile", "label", "points", "vineyard_id"]
    assert rows(back.select(compared)) == rows(objects.select(compared))


def spaceless(features):
    return features.withColumn("coordinates", F.regexp_replace("coordinates", r"\s", ""))


def collection(n, first, around, indent):
    rng = random.Random(n)
    kinds = [("Point", [1.5, 2.25]), ("LineString", [[1, 2.5], [3e2, -4.125]]), ("Polygon", [[[0.1, 0.2], [1, 0], [1, 1], [0.1, 0.2]]]), None]
    out = []
    for k in range(n):
        kind = rng.choice(kinds)
        # Texts that look like marks, and objects that look like features.
        name = rng.choice(['a "}],{', '{"type":"Feature"', "x\\", "é{", None, "]}"])
        f = {"type": "Feature", "geometry": kind and {"type": kind[0], "coordinates": kind[1]}, "properties": {"id": str(k), "name": name, "length_m": k / 4, "more": rng.choice([1, {"id": "q"}, {"type": "Feature"}, [{"bbox": 1}]])}}
        out.append({c: f[c] for c in first} | f)
    doc = {"type": "FeatureCollection", "features": out}
    return json.dumps({"name": "{", **doc, "crs": {"features": [{"type": "Feature"}]}} if around else doc, indent=indent)


@pytest.mark.parametrize("size", [300, 1100, 10**7])
@pytest.mark.parametrize("first, around, indent", [((), False, None), (("properties",), True, None), (("geometry",), True, 2)])
def test_collection_read_feature_by_feature(spark, tmp_path, short_splits, size, first, around, indent):
    for n in (0, 1, 40):
        (tmp_path / f"{n}.geojson").write_text(collection(n, first, around, indent))
    path = str(tmp_path / "*.geojson")
    want = rows(spaceless(spark.read.schema(geojson.COLLECTION).option("multiLine", "true").json(path).selectExpr("inline(features)").selectExpr("geometry.type AS geom_type", "geometry.coordinates", "properties.*")))
    assert len(want) == 41
    short_splits(size)
    got = geojson.read(spark, str(tmp_path), 0, ordered=True)
    assert rows(spaceless(got.drop("place"))) == want
    assert [r.id for r in got.orderBy("place").collect() if int(r.id) > 0] == [str(k) for k in range(1, 40)]


@pytest.mark.parametrize("size", [200, 700])
def test_features_of_splits_make_up_the_collection(tmp_path, size):
    (tmp_path / "a.geojson").write_text(collection(40, (), False, None))
    splits = splits_of(tmp_path / "a.geojson", size)
    between = geojson._joined({1: [(b, json.loads(several[-1][-1])) for b, several in splits]})
    inner = [r for _, several in splits for r in several if r[-1] is None]
    assert len(inner) > 0 and len(between) > 0
    assert [json.loads(r[3])["properties"]["id"] for r in sorted(inner + between)] == [str(k) for k in range(40)]


def splits_of(path, size):
    """The rows of each split as the reader deals out the pieces of a file: by where they begin."""
    text, out, at = path.read_text(), {}, 0
    for piece in text.split("{"):
        out.setdefault(max(0, at - 1) // size * size, []).append(piece)
        at += len(piece.encode()) + 1
    return [(block, list(geojson._split_features(1, block, filter(None, [pieces[:2], pieces[2:]])))) for block, pieces in out.items()]


def test_collection_of_another_form_is_read_whole(spark, tmp_path, short_splits):
    odd = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": None, "properties": {"id": str(k)}} for k in range(30)]}
    text = json.dumps(odd)
    short_splits(400)
    for k, written in enumerate((text.replace('"properties": {"id": "7"}', "'properties': {'id': '7'}"), text[:-1] + ', "features": []}', text[:-9])):
        (tmp_path / f"{k}.geojson").write_text(written)
        assert rows(geojson.read(spark, str(tmp_path / f"{k}.geojson"), 0)) == rows(geojson.read(spark, str(tmp_path / f"{k}.geojson")))


def test_collection_is_sorted_by_many_tasks(spark, tmp_path):
    features = spark.range(2000, numPartitions=4).select((1999 - F.col("id")).alias("place"), geojson.feature(F.lit("Point"), F.array(F.array(F.array(F.struct(F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y"))))), {"id": F.col("id").cast("string")}).alias("feature"))
    for n, kept in ((2000, features), (1, features.filter("place = 0")), (0, features.filter("place < 0"))):
        geojson.write_collection(kept, str(tmp_path / "out"), ["place"], "urn:x")
        (part,) = (tmp_path / "out").glob("part-*")
        doc = json.loads(part.read_text())
        assert doc["crs"]["properties"]["name"] == "urn:x" and [int(f["properties"]["id"]) for f in doc["features"]] == list(range(1999, 1999 - n, -1))
    # The window that numbered a layer in one task is gone.
    assert not hasattr(geojson, "Window") and "Window" not in geojson.write_collection.__code__.co_names


def test_steps_of_the_projection_are_shared(spark):
    points = spark.createDataFrame([([(629145.5, 5221222.25), (400000.0, 10.5)],)], "p array<struct<x:double,y:double>>")
    one = F.transform("p", lambda p: F.struct(*[c.alias(n) for c, n in zip(g.utm35_to_lonlat(p["x"], p["y"]), "xy")]))
    many = g.points_to_lonlat(F.col("p"))
    assert points.select((one == many).alias("same")).first().same
    # Written out in one step, the series is worked out anew at each use.
    sines = lambda c: points.select(c.alias("c"))._jdf.queryExecution().optimizedPlan().toString().upper().count("SIN(")
    assert sines(many) < 25 < sines(one)
