import itertools
import random

from fieldloom.llm import substring_dedup as sd

from .conftest import ODD


def brute(rows):
    """Cleaned texts by scanning all runs in order."""
    seen, gone = {}, {}
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, sd_mark(r[1])))
    for doc in order:
        units = sd.sentences(doc[1])
        for i in range(len(units)):
            ends = [e for e in range(i + 3, len(units) + 1) if sum(len(u[2].split()) for u in units[i:e]) >= 24]
            if not ends:
                continue
            key = tuple(u[2] for u in units[i : ends[0]])
            if key in seen:
                gone.setdefault(doc, set()).update(range(i, ends[0]))
            else:
                seen[key] = doc
    return {doc: "".join(doc[1][a:b] for i, (a, b, *_) in enumerate(sd.sentences(doc[1])) if i not in gone[doc]) for doc in gone}


def sd_mark(_):
    return 0


def sentence(rng):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randint(3, 30))) + rng.choice([". ", "! ", "?\n", "\n"])


def test_against_plain_loops(documents):
    rng = random.Random(3)
    passages = ["".join(sentence(rng) for _ in range(rng.randint(4, 7))) for _ in range(5)]
    rows = []
    for i in range(60):
        body = [sentence(rng) for _ in range(rng.randint(0, 6))]
        if rng.random() < 0.5:
            body.insert(rng.randrange(len(body) + 1), rng.choice(passages))
        rows.append((i, "".join(body)))
    want = brute(rows)
    got = {(r.doc_id): r for r in sd.dedup_substrings(documents(rows), changed_only=True).collect()}
    assert {d[0]: t for d, t in want.items()} == {i: r.text for i, r in got.items()} and want
    whole = sd.dedup_substrings(documents(rows)).collect()
    assert len(whole) == 60 and all(r.text == dict(rows)[r.doc_id] for r in whole if not r.n_removed)


def test_long_passages_go_wherever_they_stand(documents):
    rng = random.Random(5)
    words = lambda n: " ".join(f"u{rng.randrange(10**6)}" for _ in range(n))
    passage = words(60)  # one sentence without an end
    rows = [(1, f"{words(20)}.\n{passage}\n{words(9)}."), (2, f"{words(5)}.\n{passage}.\n{words(30)}."), (3, f"{words(50)}. {words(30)}.")]
    got = {r.doc_id: r for r in sd.dedup_substrings(documents(rows)).collect()}
    assert got[1].n_removed == 0 and got[3].n_removed == 0
    assert passage[:40] not in got[2].text and got[2].sources == [1] and got[2].text.startswith(rows[1][1][:20])


def test_slices_cover_the_text():
    rng = random.Random(6)
    for _ in range(300):
        t = "".join(rng.choices("aB .!?\n\tİß", k=rng.randint(0, 80))) + " word" * rng.randint(0, 40)
        units = sd.sentences(t)
        if units:
            assert units[0][0] >= 0 and units[-1][1] == len(t)
            assert all(a[1] == b[0] for a, b in zip(units, units[1:]))


def test_odd_documents(odd):
    got = sd.dedup_substrings(odd).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    left = {r.doc_id: r for r in got}
    assert len(got) == len(ODD) and left[1].text is None and left[2].text == "" and left[3].n_sentences == 0
    assert left[7].n_removed > 0 and left[5].n_removed == 0
    assert sorted([(r.doc_id, r.text) for r in got if not r.n_removed], key=key) == sorted([r for r in ODD if r[0] != 7], key=key)
    assert sd.dedup_substrings(odd.limit(0)).count() == 0


def test_all_white_space_parts_words():
    for space in (" ", "\u00a0", "\u3000", "\u2003"):
        for text in (space.join(f"w{k}" for k in range(70)), " ".join(f"w{k}" for k in range(32)) + "".join(f"{space}x{k}" for k in range(4))):
            units = sd.sentences(text)
            assert [t[2].split() for t in units] == [text[a:b].split() for a, b, *_ in units]
            assert sum((t[2].split() for t in units), []) == text.split() and len(units) > 1


def shared(a, b):
    """Whether two texts share a run."""
    return set(sd.span_hashes(a)[1].tolist()) & set(sd.span_hashes(b)[1].tolist())


def test_passages_inside_sentences_at_every_offset(documents):
    rng = random.Random(8)
    words = lambda n: " ".join(f"u{rng.randrange(10**6)}" for _ in range(n))
    for trial in range(300):
        passage = words(51)
        if trial % 3:
            # Breaks inside: sentences of one word to twenty.
            broken, at = [], 0
            for n in iter(lambda: rng.randint(1, 20 if trial % 3 == 1 else 3), None):
                if at >= 51:
                    break
                broken.append(" ".join(passage.split()[at : at + n]))
                at += n
            passage = ". ".join(broken)
        assert shared(f"{words(7)} {passage} {words(5)}.", f"{words(trial % 40)} {passage} {words(trial % 23)}".strip()), trial
    passage = words(60)
    rows = [(1, f"{words(30)} {passage} {words(30)}"), *[(2 + k, f"{words(k)} {passage} {words(9)}") for k in range(34)]]
    got = {r.doc_id: r for r in sd.dedup_substrings(documents(rows)).collect()}
    middle = " ".join(passage.split()[20:40])
    assert got[1].n_removed == 0 and all(got[2 + k].sources[0] == 1 and middle not in got[2 + k].text for k in range(34))


def test_short_sentences_in_a_row():
    passage = " ".join(f"s{k}." for k in range(55))
    assert shared(f"before it. {passage} behind", f"other {passage} words")
    for a, b in (("a b " * 40, "b a " * 40), ("a " * 70, "c " + "a " * 70)):
        assert shared(a, b)


def test_short_phrases_and_one_passage_in_every_text(documents, monkeypatch):
    monkeypatch.setattr(sd, "HOT_ROWS", 50)
    rng = random.Random(9)
    words = lambda n: " ".join(f"p{rng.randrange(10**6)}" for _ in range(n))
    phrase, passage = "one two three. four five six. seven eight nine. ten eleven. ", words(70) + ". "
    rows = [(k, f"{words(30)}. {phrase}{words(20)}. {passage if k % 2 else ''}{words(12)}.") for k in range(200)]
    got = {r.doc_id: r for r in sd.dedup_substrings(documents(rows)).collect()}
    assert all(r.n_removed == 0 and r.text == dict(rows)[i] for i, r in got.items() if i % 2 == 0 or i == 1)
    assert all(r.sources == [1] and phrase in r.text and passage[20:300] not in r.text for i, r in got.items() if i % 2 and i > 1)


def test_units_and_hashes_are_the_same_both_ways():
    rng = random.Random(10)
    seen = {}
    for _ in range(400):
        t = " ".join(rng.choices(["İx", "a", "b.", "c!\n", "dd", "\u00a0e", "word", "ẞs", "\n"], k=rng.randint(0, 120)))
        units = sd.sentences(t)
        hashed, edges = sd.unit_edges(t)
        assert edges.tolist() == ([0, *itertools.accumulate(u[3] for u in units)] if units else [])
        ends = sd.run_ends(edges)
        for p, h in zip(*sd.span_hashes(t)):
            run = " ".join(u[2] for u in units[p : ends[p]])
            assert len(run.split()) >= 24 and ends[p] - p >= 3
            assert seen.setdefault(int(h), run) == run
    assert len(set(seen.values())) == len(seen)
