import random

import corpus_pipeline
from fieldloom.llm import bpe, decontamination, near_dedup, quality, secrets

from .test_quality import text


def test_stages_against_one_another(spark, tmp_path):
    """The whole pipeline over planted cases: what has to go goes, what is clean stays, and the rest is encoded."""
    rng = random.Random(9)
    leak = " ".join(f"leak{k}" for k in range(30))
    rows = [(i, text(rng, 2)) for i in range(200)]
    rows += [(1000 + i, text(rng, i % 2)) for i in range(100)]
    base = text(rng, 2)
    rows += [(2000 + i, base) for i in range(20)] + [(3000, None), (3001, "")]
    rows += [(4000, text(rng, 2) + " " + leak + " " + text(rng, 2)), (4001, text(rng, 2) + " password=b7db7aa4a5fcc78305 " + text(rng, 2))]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, 0) for i in range(150)] + [(1000 + i, i % 2 and 0, 1 - i % 2) for i in range(80)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert sum(i in out for i in range(200)) >= 198
    assert sum(i in out for i in range(1000, 1100)) <= 4
    assert [i for i in out if 2000 <= i < 2020] == [2000]
    assert 4000 not in out and 4001 in out
    masked = rows[-1][1].replace("b7db7aa4a5fcc78305", secrets.MASK)
    assert out[4001].n_tokens == len(bpe.word_tokenizer(bpe.vocabulary_path("word_bpe_49k.json")).encode(masked))


def test_stage_names_and_columns():
    assert [f.__module__.rsplit(".", 1)[-1] for _, f in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "secrets", "corpus_pipeline"]
    assert len({quality, near_dedup, decontamination, secrets}) == 4


def tables(spark, folder, docs, labels=(), items=()):
    docs.write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder)


def test_odd_documents_through_all_stages(spark, odd, tmp_path):
    """Nulls, empty and very long texts, repeated rows and clashing extra columns; without labels and items nothing is
    rejected, so what goes are copies."""
    folder = tables(spark, tmp_path, odd)
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == odd.columns, name
        docs = kept
    out = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_id for r in out if r.doc_id is not None) == [1, 2, 3, 4, 5, 7, 8] and len(out) == 8
    assert {r.doc_id: r.n_tokens for r in out}[1] == 0 and {r.doc_id: r.n_tokens for r in out}[7] == 30000


def test_nulls_in_every_column_and_empty_tables(spark, documents, tmp_path):
    bare = spark.createDataFrame([(None, None, None, None, None), (1, "some words of a text that stays", None, None, None)], "doc_id int, text string, lang string, source string, n_chars long")
    nothing = [(None, None, None), (1, None, 1), (None, 0, 0)]
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    out = corpus_pipeline.run(spark, tables(spark, tmp_path / "a", bare, nothing, [(None, "some words of a text"), (1, None), (2, "")])).collect()
    assert sorted((r.doc_id is None, r.n_tokens > 0) for r in out) == [(False, True), (True, False)]
    assert corpus_pipeline.run(spark, tables(spark, tmp_path / "b", bare.limit(0))).count() == 0
