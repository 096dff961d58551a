import importlib

import __spark_entry__


def test_flagship_and_registries(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_only_the_corpus_part_may_be_missing(monkeypatch):
    import builtins

    real = builtins.__import__

    def without(name, *a, **k):
        if name == "corpus_pipeline":
            raise ModuleNotFoundError("No module named 'corpus_pipeline'", name="corpus_pipeline")
        return real(name, *a, **k)

    monkeypatch.setattr(builtins, "__import__", without)
    bare = importlib.reload(__spark_entry__)
    names = set(bare.queries())
    monkeypatch.undo()
    importlib.reload(__spark_entry__)
    assert names and not any(n.startswith("op") or n == "pipeline" for n in names)
