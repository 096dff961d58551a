"""MinHash near-dedup by an LSH forest.

Every distinct shingle set gets a MinHash signature for each of TREES trees. A tree is its documents sorted by
signature: documents whose signatures have a common prefix of ROOT values lie in one region, and the further values
order them within it, so that a document's neighbours are those of the longest common prefix.

The depth adapts to the region. One of up to REGION classes is compared whole, by sketches, at the root's depth, and
its classes that agree well enough are candidates of one another. A denser one is a family of candidates as it is.
Candidates over all trees make families, which are named by stars and never as pairs; every link lies within one.

Links are confirmed on full sets. A family whose sets fill less than a block is searched whole, in breadth: a class that
is reached once is not compared again. The classes of a larger family are first held against their neighbours of
the longest common prefix in CHAINS sorted trees. That joins large groups at little cost; what still lies in two
components is then compared exactly, block by block, and blocks of one component are not compared at all.

A class is known by a 64-bit hash of its set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.operators.components import connected_components

from . import common

#: Trees, the values of a region's key and those that order a region; trees that are read for neighbours in large families.
TREES, ROOT, FURTHER, CHAINS = 24, 4, 4, 3
#: Classes of a region that are compared by sketches.
REGION = 1024
#: Bytes of full sets that a block of a family holds; a task compares two at a time.
BLOCK_BYTES = 8 << 20
#: Rows of a class's shared keys that are broadcast at most.
WIDE_ROWS = 200_000
#: Rows from which on a class counts as hot in the last join.
HOT_ROWS = 100_000
#: Values of each tree in the sketch, and the agreement from which on a pair is a candidate: below the threshold
#: of 0.8 by 4.4 standard deviations of the estimate (one pair in 200,000 at the threshold is taken for less).
SKETCHED, LEAST_AGREEMENT = 4, 0.62
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Shingles that are hashed at once.
BLOCK = 1 << 14

_seeds = np.random.default_rng(1).integers(1, 1 << 63, (TREES * (ROOT + FURTHER), 2), dtype=np.uint64)
# Trees that are not read for neighbours need no values beyond their root's.
_used = np.array([t < CHAINS or d < ROOT for t in range(TREES) for d in range(ROOT + FURTHER)])
MULTIPLIERS, ADDENDS = _seeds[_used, 0] | np.uint64(1), _seeds[_used, 1]
_hasher = common.owned("near_dedup", common.WordHasher())


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of size words; a shorter text is one run, an empty one has none."""
    if not words:
        return np.empty(0, np.uint64)
    hashed = _hasher.hashes(words)
    width = min(size, len(hashed))
    runs = len(hashed) - width + 1
    out = np.full(runs, width, np.uint64)
    for k in range(width):
        out = (out ^ hashed[k : k + runs]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (uint32), a row for each nonempty set and a place for each tree and depth; unused ones are 0."""
    least = np.empty((len(sets), len(MULTIPLIERS)), np.uint32)
    at = 0
    while at < len(sets):
        end, total = at, 0
        while end < len(sets) and (end == at or total + len(sets[end]) <= BLOCK):
            total += len(sets[end])
            end += 1
        flat = np.concatenate(sets[at:end])
        begin = np.cumsum([0, *map(len, sets[at : end - 1])])
        for low in range(0, len(flat), 1 << 20) if end == at + 1 else (0,):
            part = flat[low : low + (1 << 20)] if end == at + 1 else flat
            for f, (a, b) in enumerate(zip(MULTIPLIERS, ADDENDS)):
                values = (np.minimum.reduceat(part * a + b, begin) >> np.uint64(32)).astype(np.uint32)
                least[at:end, f] = values if not low else np.minimum(least[at:end, f], values)
        at = end
    out = np.zeros((len(sets), len(_used)), np.uint32)
    out[:, _used] = least
    return out.reshape(len(sets), TREES, ROOT + FURTHER)


SIGNED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("cls", T.LongType()),
        T.StructField("keys", T.ArrayType(T.LongType(), False)),
        T.StructField("deeps", T.ArrayType(T.LongType(), False)),
        T.StructField("sketch", T.BinaryType()),
    ]
)


def class_of(shingle_set: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingle_set.tobytes())).astype(np.int64))


def sign(df: DataFrame, size: int) -> DataFrame:
    """Set size, class and signature of each (doc_id, text); cls and what follows are null for an empty set.

    keys names the region of each tree, deeps orders the first CHAINS trees' regions."""

    def signed(batches):
        common.claim("near_dedup")
        for whole in batches:
            for batch in common.slices(whole, 512):
                sets = [shingles(common.ascii_lower_words(t.as_py()), size) for t in batch.column("text")]
                full = [s for s in sets if len(s)]
                values = signatures(full)
                keys = np.repeat(np.arange(TREES, dtype=np.uint64)[None], len(full), axis=0)
                for d in range(ROOT):
                    keys = (keys ^ values[:, :, d]) * np.uint64(0x9E3779B97F4A7C15)
                    keys ^= keys >> np.uint64(29)
                deeps = np.zeros((len(full), CHAINS), np.int64)
                for d in range(ROOT, ROOT + FURTHER):
                    deeps = deeps << 15 | (values[:, :CHAINS, d] & np.uint32(0x7FFF)).astype(np.int64)
                sketch = (values[:, :, :SKETCHED].reshape(len(full), TREES * SKETCHED) & np.uint32(0xFF)).astype(np.uint8)
                at, rows = 0, []
                for s in sets:
                    if len(s):
                        rows.append((class_of(s), keys[at].view(np.int64), deeps[at], sketch[at].tobytes()))
                        at += 1
                    else:
                        rows.append((None,) * 4)
                cls, k, d, b = zip(*rows)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(cls, pa.int64()), pa.array(k, longs), pa.array(d, longs), pa.array(b, pa.binary())],
                    names=SIGNED.names,
                )

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(signed, SIGNED)


def in_breadth(n: int, near, labels: np.ndarray | None = None) -> np.ndarray:
    """For each of n things the first one that it is reached from, by near(i, left): which of the things `left` are near i.

    Things of one label count as connected. What is reached is not compared again, so a connected group costs little
    more than one comparison with each of its members."""
    head = np.arange(n)
    left = np.arange(n)
    while len(left):
        first, left = left[0], left[1:]
        todo = [int(first)]
        if labels is not None:
            same = labels[left] == labels[first]
            head[left[same]] = first
            todo += left[same].tolist()
            left = left[~same]
        while todo and len(left):
            i = todo.pop()
            hit = near(i, left)
            if hit.any():
                if labels is not None:
                    hit = np.isin(labels[left], labels[left[hit]])
                head[left[hit]] = first
                todo += left[hit].tolist()
                left = left[~hit]
    return head


def regions(classes: DataFrame) -> DataFrame:
    """(key, size, least: its smallest class) of every region with two classes or more; only sums are shuffled."""
    keys = classes.select("cls", F.explode("keys").alias("key"))
    return keys.groupBy("key").agg(F.count("*").alias("size"), F.min("cls").alias("least")).filter("size > 1")


def candidate_stars(classes: DataFrame, shared: DataFrame) -> DataFrame:
    """Edges (a, b) that tie the classes of each region which agree well enough, each to the first that reaches it."""
    keys = classes.select("cls", F.explode("keys").alias("key")).join(common.small_side(shared), "key")
    wide = keys.filter(F.col("size") > REGION).select(F.col("cls").alias("a"), F.col("least").alias("b")).filter("a <> b")
    narrow = common.written(keys.filter(F.col("size") <= REGION).groupBy("cls").agg(F.collect_list("key").alias("key")), "shared-keys")
    # Only classes that share a region send their sketches, and only to those that they share.
    dealt = classes.select("cls", "n", "sketch").join(common.small_side(narrow, WIDE_ROWS), "cls").withColumn("key", F.explode("key"))
    ordered = dealt.repartition("key").sortWithinPartitions("key", "cls")
    width = TREES * SKETCHED

    def tied(parts):
        cls, n, sketch = (np.concatenate(x) for x in zip(*parts))

        def near(i, left):
            fit = 100 * np.minimum(n[left], n[i]) >= PERCENT * np.maximum(n[left], n[i])
            fit[fit] = (sketch[left[fit]] == sketch[i]).sum(axis=1) >= LEAST_AGREEMENT * width
            return fit

        head = in_breadth(len(cls), near)
        tail = np.flatnonzero(head != np.arange(len(cls)))
        return cls[tail], cls[head[tail]]

    def compared(batches):
        before, parts = None, []
        for batch in batches:
            key, cls, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "cls", "n"))
            sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, width)
            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            found = []
            for x, y in zip(cuts, cuts[1:]):
                if x == y:
                    continue
                if key[x] != before and parts:
                    found.append(tied(parts))
                    parts = []
                before = key[x]
                parts.append((cls[x:y], n[x:y], sketch[x:y]))
            if found:
                yield edges_of(found)
        if parts:
            yield edges_of([tied(parts)])

    return wide.unionAll(ordered.mapInArrow(compared, "a long, b long"))


def edges_of(found) -> pa.RecordBatch:
    """A batch of edges (a, b) from pairs of arrays."""
    a, b = (np.concatenate(x).astype(np.int64) for x in zip(*found))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough, in whole numbers."""
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    place = np.searchsorted(b, a)
    place[place == len(b)] = 0
    both = int((b[place] == a).sum())
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def exact_heads(sets: list[np.ndarray], labels: np.ndarray | None = None) -> np.ndarray:
    """For each set the first one that it is reached from over links, exactly.

    Shingles that over half of the sets hold are compared as bits, the others by lists of the sets that hold them, from
    which follows which sets can be similar enough at all."""
    n = np.array([len(s) for s in sets], np.int64)
    _, number, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), n)
    many = 2 * held > len(sets)
    column = np.cumsum(many) - 1
    bits = np.zeros((len(sets), int(many.sum())), bool)
    common_ones = many[number]
    bits[owner[common_ones], column[number[common_ones]]] = True
    bits = np.packbits(bits, axis=1)
    shared_bits = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    # The others, but for those of one set alone.
    few = ~common_ones & (held[number] > 1)
    number, owner = number[few], owner[few]
    begin = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sets)))])
    order = np.argsort(number, kind="stable")
    holders = owner[order]
    start = np.concatenate([[0], np.cumsum(np.bincount(number, minlength=len(held)))])

    def near(i, left):
        mine = number[begin[i] : begin[i + 1]]
        both = np.zeros(len(left), np.int64)
        if len(mine):
            lists = np.concatenate([holders[start[x] : start[x + 1]] for x in mine.tolist()])
            both = np.bincount(lists, minlength=len(sets))[left]
        least = (PERCENT * (n[left] + n[i]) + 99 + PERCENT) // (100 + PERCENT)
        maybe = np.flatnonzero(both + np.minimum(shared_bits[left], shared_bits[i]) >= least)
        hit = np.zeros(len(left), bool)
        for low in range(0, len(maybe), 4096):
            some = maybe[low : low + 4096]
            total = both[some] + np.bitwise_count(bits[left[some]] & bits[i]).sum(axis=1, dtype=np.int64)
            hit[some] = (100 + PERCENT) * total >= PERCENT * (n[left[some]] + n[i])
        return hit

    return in_breadth(len(sets), near, labels)


def sets_of(df: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(cls, family, shingles: bytes of the set) of the wanted classes (cls, doc_id, family), from one document of each.
    Repeated rows give a class once a task."""

    def made(batches):
        common.claim("near_dedup")
        made_before: set[int] = set()
        for whole in batches:
            for batch in common.slices(whole, 512):
                cls, families, sets = [], [], []
                for t, c, f in zip(batch.column("text"), batch.column("cls").to_pylist(), batch.column("family").to_pylist()):
                    if c in made_before:
                        continue
                    s = shingles(common.ascii_lower_words(t.as_py()), size)
                    # A doc_id may stand for several texts; only one of them is this class.
                    if len(s) and class_of(s) == c:
                        made_before.add(c)
                        cls.append(c)
                        families.append(f)
                        sets.append(s.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(families, pa.int64()), pa.array(sets, pa.binary())], names=["cls", "family", "shingles"])

    texts = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(common.small_side(wanted.select("doc_id", "cls", "family")), "doc_id")
    return texts.mapInArrow(made, "cls long, family long, shingles binary")


def chain_links(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Confirmed links between neighbours of the longest common prefix in the first trees, each set sent once a tree.

    The order is dealt out in ranges, so that a region of any size is spread over tasks."""
    trees = classes.select("cls", F.posexplode(F.slice("keys", 1, CHAINS)).alias("tree", "key"), "deeps")
    trees = trees.select("cls", "tree", "key", F.element_at("deeps", F.col("tree") + 1).alias("deep"))
    place = ["tree", "key", "deep", "cls"]
    ordered = sets.join(trees, "cls").repartitionByRange(*place).sortWithinPartitions(*place)

    def confirmed(batches):
        before, head = None, None
        for batch in batches:
            a, b = [], []
            for tree, key, cls, raw in zip(*(batch.column(c).to_pylist() for c in ("tree", "key", "cls", "shingles"))):
                now = (tree, key, cls, np.frombuffer(raw, np.uint64))
                # A run of links is reported as a star around its first class: the same component, sooner found.
                if not (before and before[:2] == now[:2] and linked(before[3], now[3])):
                    head = cls
                elif head != cls:
                    a.append(cls)
                    b.append(head)
                before = now
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return ordered.select(*place, "shingles").mapInArrow(confirmed, "a long, b long")


def blocks_of(sets: DataFrame) -> DataFrame:
    """(task, cls, family, label, shingles) for every pair of blocks of a family that may hold a link.

    sets carry label, the component that is confirmed so far. A label that fills a block has blocks of its own, and
    the others share theirs; two blocks of one and the same label are never met."""
    bytes_of = F.sum(F.length("shingles") + 64)
    by_label = common.written(sets.groupBy("family", "label").agg(bytes_of.alias("bytes")), "labels")
    cut = F.ceil(F.col("bytes") / BLOCK_BYTES).cast("int")
    own = by_label.filter(F.col("bytes") >= BLOCK_BYTES).select("family", "label", cut.alias("own"))
    small = by_label.filter(F.col("bytes") < BLOCK_BYTES).groupBy("family").agg(F.sum("bytes").alias("bytes")).select("family", cut.alias("shared"))
    labels = by_label.select("family", "label").join(own, ["family", "label"], "left").join(small, "family", "left")
    # A block is (label it belongs to, or none; number).
    listed = labels.select("family", "label", "own", "shared", F.when(F.col("own").isNull(), F.pmod(F.xxhash64("label"), F.col("shared"))).cast("int").alias("bin"))
    block = F.when(F.col("own").isNull(), F.struct(F.lit(None).cast("long").alias("label"), F.col("bin").alias("number")))
    every = listed.select("family", F.explode(F.when(F.col("own").isNull(), F.array(block)).otherwise(F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda i: F.struct(F.col("label").alias("label"), i.alias("number"))))).alias("block")).distinct()
    one, two = every.toDF("family", "x"), every.toDF("family", "y")
    several = every.groupBy("family").agg(F.count("*").alias("blocks"))
    met = one.join(two, "family").join(several, "family").filter("x < y AND NOT (x.label IS NOT NULL AND x.label <=> y.label) OR x = y AND blocks = 1 AND x.label IS NULL")
    tasks = met.select("family", "x", "y", F.xxhash64("family", "x", "y").alias("task"))
    ends = common.written(tasks.select("family", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"), "task"), "block-pairs")
    # blocks of a family's own labels are dealt by class, shared ones by label
    dealt = sets.join(common.small_side(listed), ["family", "label"])
    number = F.when(F.col("own").isNull(), F.col("bin")).otherwise(F.pmod(F.xxhash64("cls"), F.col("own"))).cast("int")
    of = F.struct(F.when(F.col("own").isNotNull(), F.col("label")).alias("label"), number.alias("number"))
    keyed = dealt.select("cls", "family", "label", "shingles", F.xxhash64("family", of["label"], of["number"]).alias("at"))
    ends = ends.select(F.xxhash64("family", F.col("block.label"), F.col("block.number")).alias("at"), "task")
    return keyed.join(common.small_side(ends), "at").select("task", "cls", "family", "label", "shingles")


def exact_links(dealt: DataFrame) -> DataFrame:
    """Links (a, b) over which the classes of each task hang together, from (task, cls, label, shingles)."""
    ordered = dealt.select("task", "cls", "label", "shingles").repartition("task").sortWithinPartitions("task", "cls")

    def of_task(cls, label, raw):
        # A class may come twice, from repeated rows of two tasks.
        keep = np.flatnonzero(np.concatenate([[True], np.diff(cls) != 0]))
        cls, label = cls[keep], label[keep]
        if len(cls) < 2 or (label == label[0]).all():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        head = exact_heads([np.frombuffer(raw[k], np.uint64) for k in keep], label)
        tail = np.flatnonzero(head != np.arange(len(cls)))
        return cls[tail], cls[head[tail]]

    def compared(batches):
        before, parts = None, []

        def closed():
            return of_task(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), [r for p in parts for r in p[2]])

        for batch in batches:
            task, cls, label = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("task", "cls", "label"))
            cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(task)]
            found = []
            for x, y in zip(cuts, cuts[1:]):
                if x == y:
                    continue
                if task[x] != before and parts:
                    found.append(closed())
                    parts = []
                before = task[x]
                parts.append((cls[x:y].copy(), label[x:y].copy(), batch.column("shingles").slice(x, y - x).to_pylist()))
            if found:
                yield edges_of(found)
        if parts:
            yield edges_of([closed()])

    return ordered.mapInArrow(compared, "a long, b long")


def class_links(df: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """Edges (a, b) over which linked classes hang together, written."""
    shared = common.written(regions(classes), "regions")
    stars = candidate_stars(classes, shared)
    families = common.written(connected_components(stars).toDF("cls", "family"), "families")
    wanted = classes.select("cls", "doc_id").join(common.small_side(families), "cls")
    sets = common.written(sets_of(df, wanted, size), "sets")
    large = common.written(sets.groupBy("family").agg(F.sum(F.length("shingles") + 64).alias("bytes")).filter(F.col("bytes") >= BLOCK_BYTES).select("family"), "large")
    whole = sets.join(common.small_side(large), "family", "left_anti").withColumn("label", F.col("cls"))
    links = exact_links(whole.withColumn("task", F.col("family")))
    if large.isEmpty():
        return common.written(links, "links")
    in_large = common.written(sets.join(common.small_side(large), "family", "left_semi"), "large-sets")
    chained = common.written(chain_links(in_large.select("cls", "shingles"), classes), "chained")
    labels = common.written(connected_components(chained).toDF("cls", "label"), "chained-components")
    labelled = in_large.join(common.small_side(labels), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    return common.written(links.unionAll(chained).unionAll(exact_links(blocks_of(labelled))), "links")


def near_duplicates(df: DataFrame, size: int = 5) -> DataFrame:
    """Components of near-equal texts among (doc_id, text), by shingles of size words.

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable), kept (doc_id = component_id) and cls,
    the class of equal sets, one row per row. Null, empty and blank texts have no shingles and are linked with
    nothing. Rows with a null doc_id are linked like others, but are never kept and never name a component.
    Repeated rows fall into one component. A text that only rows without a doc_id have is linked with its own copies
    alone. An empty df gives an empty result. Other columns are not read.
    """
    signed = common.written(sign(df, size), "signed")
    of_class = signed.filter("cls IS NOT NULL").groupBy("cls")
    first = [F.first(c).alias(c) for c in ("n", "keys", "deeps", "sketch")]
    classes = common.written(of_class.agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows"), *first), "classes")
    links = class_links(df, classes.filter("doc_id IS NOT NULL"), size)
    final = common.written(connected_components(links).toDF("cls", "label"), "components")
    # The least doc_id of each class, then of each component: documents only ever meet their class.
    members = final.join(classes.select("cls", "doc_id"), "cls")
    least = members.groupBy("label").agg(F.min("doc_id").alias("least"))
    joined = members.join(common.small_side(least), "label").select("cls", "least")
    # A class of one row, linked with nothing, needs no join; one of very many rows, of which there are few, is sent to all.
    named = classes.select("cls", "doc_id", "rows").join(common.small_side(joined), "cls", "left")
    named = common.written(named.filter("least IS NOT NULL OR rows > 1").select("cls", "rows", F.coalesce("least", "doc_id").alias("least")), "named")
    hot = named.filter(F.col("rows") > HOT_ROWS).select(F.col("cls").alias("hot"), F.col("least").alias("hot_least"))
    cold = named.filter(F.col("rows") <= HOT_ROWS).select(F.col("cls").alias("cold"), "least")
    rows = signed.select("doc_id", "n", "cls").join(common.small_side(hot), F.col("cls") == F.col("hot"), "left")
    # Rows that have their answer, or no class, are spread by their own id.
    asks = F.col("cls").isNotNull() & F.col("hot").isNull()
    rows = rows.withColumn("asks", asks).withColumn("at", F.when(asks, F.col("cls")).otherwise(F.xxhash64("doc_id", "n")))
    rows = rows.join(common.small_side(cold), F.col("asks") & (F.col("at") == F.col("cold")), "left")
    known = F.when(F.col("hot").isNotNull(), F.col("hot_least")).when(F.col("cold").isNotNull(), F.col("least"))
    component = F.when(F.col("hot").isNull() & F.col("cold").isNull(), F.col("doc_id")).otherwise(known)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"), "cls")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by 2-word shingles."""
    return near_duplicates(common.table(spark, sf_dir, "documents"), 2).drop("cls")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's second stage: of each component of near-equal texts the smallest doc_id stays.

    Of rows that repeat a doc_id and text one stays; rows without a doc_id stay."""
    found = common.written(near_duplicates(docs, 5), "near")
    gone = found.filter("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    twice = found.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select("doc_id")
    left = docs.join(common.small_side(gone), "doc_id", "left_anti")
    twice = common.small_side(twice)
    once, repeated = left.join(twice, "doc_id", "left_anti"), left.join(twice, "doc_id", "left_semi")
    return once.unionByName(repeated.dropDuplicates(["doc_id", "text"])).select(*docs.columns)


QUERIES = {"op1_near_dedup": op1_near_dedup}
ORACLES = {
    "op1_near_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
sized AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n, s FROM sets),
items AS (SELECT doc_id, n, unnest(s) AS x FROM sized),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS node, doc_id AS seen FROM sized UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sized JOIN least ON node = doc_id
"""
}
