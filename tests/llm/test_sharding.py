import zlib


from fieldloom.llm import sharding

from .conftest import ODD


def laws(rows, n, shards):
    counts = [sum(r.shard == s for r in rows) for s in range(shards)]
    assert len(rows) == n and max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def test_counts_slots_and_records(documents, odd):
    rows = sharding.external_shuffle(odd, 3).collect()
    laws(rows, len(ODD), 3)
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted([(r.record.doc_id, r.record.text) for r in rows], key=key) == sorted(ODD, key=key)
    assert rows[0].record.label == "x" and rows[0].record.batch == "z"
    laws(sharding.external_shuffle(odd, 40).collect(), len(ODD), 40)
    assert sharding.external_shuffle(odd.limit(0), 4).count() == 0
    same = documents([(1, "same")] * 500)
    laws(sharding.external_shuffle(same, 7, bucket_bytes=1000).collect(), 500, 7)


def test_order_is_shuffled_evenly(documents):
    rows = sharding.external_shuffle(documents([(i, "t") for i in range(4000)]), 4).collect()
    for s in range(4):
        mean = sum(r.record.doc_id for r in rows if r.shard == s) / 1000
        assert abs(mean - 2000) < 150
    ids = [r.record.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert sum(b == a + 1 for a, b in zip(ids, ids[1:])) < 10
    other = sharding.external_shuffle(documents([(i, "t") for i in range(4000)]), 4, seed=99).collect()
    assert ids != [r.record.doc_id for r in sorted(other, key=lambda r: (r.shard, r.slot))]


def test_plan_is_native(odd):
    plan = sharding.external_shuffle(odd, 3)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_written_shards(spark, odd, tmp_path):
    sharding.write_shards(odd, str(tmp_path / "shards"), 3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == len(ODD) and back.select("shard").distinct().count() == 3
    laws(back.collect(), len(ODD), 3)
    for one in (tmp_path / "shards").rglob("*.parquet"):
        slots = [r.slot for r in spark.read.parquet(str(one)).collect()]
        assert slots == sorted(slots)


def test_query_columns(spark):
    data = "/root/testdata/sf0.001"
    rows = sharding.op10_sharding(spark, data).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    laws(rows, len(docs), 40)
    for r in rows:
        raw = docs[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
