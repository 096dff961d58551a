"""Scores of predictions against references."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.operators.spatial import box_pairs


def box_ious(preds: DataFrame, refs: DataFrame, keys: list[str], cell: float = 64.0) -> DataFrame:
    """(keys, pred, ref, iou) of all boxes that overlap."""
    met = box_pairs(preds, refs, cell, touching=False, keys=keys)
    w = F.least("a_x1", "b_x1") - F.greatest("a_x0", "b_x0")
    h = F.least("a_y1", "b_y1") - F.greatest("a_y0", "b_y0")
    both = w * h
    area = lambda p: (F.col(f"{p}_x1") - F.col(f"{p}_x0")) * (F.col(f"{p}_y1") - F.col(f"{p}_y0"))
    return met.select(*keys, F.col("a_id").alias("pred"), F.col("b_id").alias("ref"), (both / (area("a") + area("b") - both)).alias("iou"))


def mask_ious(preds: DataFrame, refs: DataFrame, tile: str = "tile") -> DataFrame:
    """(tile, pred, ref, iou) of all masks, given as pixels (tile, id, x, y), that share a pixel. Pixels meet by equality and
    only counts of pairs of masks are left, so nothing is gathered; a pixel repeated within a mask counts once."""
    a, b = (df.select(tile, F.col("id").alias(n), "x", "y").distinct() for df, n in ((preds, "pred"), (refs, "ref")))
    sizes = lambda df, n: df.groupBy(tile, n).agg(F.count("*").alias(f"_{n}"))
    both = a.join(b, [tile, "x", "y"]).groupBy(tile, "pred", "ref").agg(F.count("*").alias("_both"))
    met = both.join(sizes(a, "pred"), [tile, "pred"]).join(sizes(b, "ref"), [tile, "ref"])
    return met.select(tile, "pred", "ref", (F.col("_both") / (F.col("_pred") + F.col("_ref") - F.col("_both"))).alias("iou"))


def greedy_matches(pairs: DataFrame, key: str, least: float = 0.5) -> DataFrame:
    """(key, pred, ref, iou): predictions in order each take the best free reference, the later of equals. A tile's
    pairs are a bounded group."""

    def match(group: pd.DataFrame) -> pd.DataFrame:
        taken, out = set(), []
        for pred, rows in group[group["iou"] >= least].sort_values(["pred", "ref"]).groupby("pred", sort=True):
            free = rows[~rows["ref"].isin(taken)]
            if len(free):
                best = free[free["iou"] == free["iou"].max()].iloc[-1]
                taken.add(best["ref"])
                out.append((group[key].iloc[0], int(pred), int(best["ref"]), float(best["iou"])))
        return pd.DataFrame(out, columns=[key, "pred", "ref", "iou"])

    kind = pairs.schema[key].dataType.simpleString()
    return pairs.groupBy(key).applyInPandas(match, f"{key} {kind}, pred long, ref long, iou double")


def greedy_box_matches(preds: DataFrame, refs: DataFrame, key: str, least: float = 0.5) -> DataFrame:
    """greedy_matches of the boxes (id, x0, y0, x1, y1) of each key, without their pairs: references of one box are one class, of
    which the last free one is taken, so a prediction looks through the distinct boxes about it alone. Gathers a key's boxes."""
    box = ["x0", "y0", "x1", "y1"]

    def match(pred: pd.DataFrame, ref: pd.DataFrame) -> pd.DataFrame:
        pred, ref = pred.sort_values("id", kind="stable"), ref.sort_values("id", kind="stable")
        shapes, of = np.unique(ref[box].to_numpy(np.float64), axis=0, return_inverse=True)
        order = np.argsort(of.ravel(), kind="stable")
        ids, starts = ref["id"].to_numpy(np.int64)[order], np.searchsorted(of.ravel()[order], np.arange(len(shapes) + 1))
        none = np.iinfo(np.int64).min
        last = starts[1:] - 1
        top = ids[last] if len(ids) else np.zeros(0, np.int64)
        x0, y0, x1, y1 = shapes.T if len(shapes) else np.zeros((4, 0))
        area, out = (x1 - x0) * (y1 - y0), []
        for i, (a, b, c, d) in zip(pred["id"].to_numpy(np.int64), pred[box].to_numpy(np.float64)):
            # A box whose share is at least this cannot be wider than that.
            near = slice(np.searchsorted(x0, a - (c - a) / least * (1 + 1e-9), "left"), np.searchsorted(x0, c, "left"))
            w, h = np.minimum(c, x1[near]) - np.maximum(a, x0[near]), np.minimum(d, y1[near]) - np.maximum(b, y0[near])
            at = np.flatnonzero((w > 0) & (h > 0) & (top[near] != none))
            both = w[at] * h[at]
            share = both / ((c - a) * (d - b) + area[near][at] - both)
            if len(share) and (best := share.max()) >= least:
                tied = at[share == best] + near.start
                k = tied[np.argmax(top[tied])]
                out.append((i, top[k], best))
                last[k] -= 1
                top[k] = ids[last[k]] if last[k] >= starts[k] else none
        found = pd.DataFrame(out, columns=["pred", "ref", "iou"])
        found.insert(0, key, ref[key].iloc[0] if len(found) else None)
        return found

    side = lambda df: df.filter(F.col(key).isNotNull()).select(key, "id", *[F.col(c).cast("double").alias(c) for c in box]).groupBy(key)
    kind = preds.schema[key].dataType.simpleString()
    return side(preds).cogroup(side(refs)).applyInPandas(match, f"{key} {kind}, pred long, ref long, iou double")


def f1_scores(matches: DataFrame, preds: DataFrame, refs: DataFrame, key: str) -> DataFrame:
    """Per key: true and false positives, misses, precision, recall and F1; 0 where one is undefined."""
    n = lambda df, name: df.groupBy(key).agg(F.count("*").alias(name))
    every = n(preds, "p").join(n(refs, "r"), key, "full").join(n(matches, "m"), key, "left").na.fill(0)
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    precision, recall = ratio(F.col("m"), F.col("p")), ratio(F.col("m"), F.col("r"))
    return every.select(
        key,
        F.col("m").alias("tp"),
        (F.col("p") - F.col("m")).alias("fp"),
        (F.col("r") - F.col("m")).alias("fn"),
        precision.alias("precision"),
        recall.alias("recall"),
        ratio(2 * precision * recall, precision + recall).alias("f1"),
    )


def class_iou(preds: DataFrame, refs: DataFrame, key: str) -> DataFrame:
    """Per key the IoU of two sets of pixels (key, x, y)."""
    p = preds.select(key, "x", "y").distinct().withColumn("p", F.lit(1))
    r = refs.select(key, "x", "y").distinct().withColumn("r", F.lit(1))
    return p.join(r, [key, "x", "y"], "full").groupBy(key).agg((F.count_if(F.col("p").isNotNull() & F.col("r").isNotNull()) / F.count("*")).alias("iou"))


def annotation_stats(objects: DataFrame, attributes: list[str]) -> DataFrame:
    """Per label: objects, distinct ids, and counts of each attribute's values as (label, what, value, n)."""
    parts = [
        objects.groupBy("label").agg(F.count("*").alias("n")).select("label", F.lit("objects").alias("what"), F.lit("").alias("value"), "n"),
        objects.groupBy("label").agg(F.count_distinct(F.nullif("vineyard_id", F.lit(""))).alias("n")).select("label", F.lit("blocks").alias("what"), F.lit("").alias("value"), "n"),
    ]
    for a in attributes:
        some = objects.filter(F.col(a).isNotNull() & (F.col(a) != ""))
        parts.append(some.groupBy("label", F.col(a).alias("value")).agg(F.count("*").alias("n")).select("label", F.lit(a).alias("what"), "value", "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
