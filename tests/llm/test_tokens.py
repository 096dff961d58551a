import hashlib
import random

from tokenizers import Tokenizer

from fieldloom.llm import bpe, token_counts

LETTERS = "abcXYZ rveslltmd 's'S't'l'r'v '\t\n\x0b\x1c\x1f\x85\xa0​09²½ⅣǅİΣΑΣ ßé é가가😀_--=\u0000﻿漢字ًا"
FIXED = ["", "a" * 3000, "=" * 2000, " " * 3000, "<|endoftext|>x <|endoftext|> y<|startoftext|>", "it's <|ENDOFTEXT|>", "ab" * 200 + " " + "thequick" * 40, "don't we'll they're I've 'sure 'r 'l", "a  b\n\n c \r\n"]


def texts(n, seed):
    rng = random.Random(seed)
    return [*FIXED, *("".join(rng.choices(LETTERS, k=rng.randint(0, 60))) for _ in range(n)), *("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(0, 50))) for _ in range(n // 4))]


def test_counts_equal_the_library():
    library = Tokenizer.from_file(bpe.vocabulary_path("byte_bpe_50k.json"))
    machine = token_counts.CountTransducer(bpe.vocabulary_path("byte_bpe_50k.json"))
    some = texts(3000, 1)
    assert machine.count_texts(some) == [len(library.encode(t, add_special_tokens=False).ids) for t in some]
    machine.clear()
    assert machine.count_texts(some[:50]) == [len(library.encode(t, add_special_tokens=False).ids) for t in some[:50]]


def test_counts_survive_flushes_and_sections(monkeypatch):
    library = Tokenizer.from_file(bpe.vocabulary_path("byte_bpe_50k.json"))
    monkeypatch.setattr(token_counts, "MAX_STATES", 40)
    monkeypatch.setattr(token_counts, "SECTION", 97)
    monkeypatch.setattr(token_counts, "CHUNK", 8)
    machine = token_counts.CountTransducer(bpe.vocabulary_path("byte_bpe_50k.json"))
    some = texts(400, 2)
    assert machine.count_texts(some) == [len(library.encode(t, add_special_tokens=False).ids) for t in some]


def test_word_bpe_equals_the_library():
    library = Tokenizer.from_file(bpe.vocabulary_path("word_bpe_49k.json"))
    own = bpe.WordTokenizer(bpe.vocabulary_path("word_bpe_49k.json"))
    for t in texts(3000, 3):
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_words_merge_alike():
    own = bpe.RankArrayBPE(bpe.vocabulary_path("word_bpe_49k.json"))
    rng = random.Random(4)
    for _ in range(60):
        word = bytes(rng.choices(b"abcdething", k=rng.randint(1, 150)))
        parts = [own.inner[b] for b in word[:-1]] + [own.last[word[-1]]]
        assert own._short(list(parts)) == own._long(list(parts))


def test_odd_documents(odd, spark):
    got = token_counts.count_tokens(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert by[1].n_tokens == by[2].n_tokens == 0 and by[1].n_bytes == 0 and by[3].n_tokens > 0
    assert by[7].n_bytes == 60000 and by[7].over_limit and not by[4].over_limit
    assert token_counts.count_tokens(odd.limit(0)).count() == 0
    coded = {r.doc_id: r for r in bpe.encode_documents(odd).collect()}
    assert coded[1].ids == coded[2].ids == coded[3].ids == "" and coded[4].decoded == "one</w>"
    digests = {r.doc_id: r for r in bpe.encode_documents(odd, digests=True).collect()}
    assert digests[1].ids_sha256 == hashlib.sha256(b"").hexdigest() and digests[5].ids_sha256 == digests[6].ids_sha256
    assert bpe.encode_documents(odd.limit(0)).count() == 0
