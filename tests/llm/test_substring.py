import random

import numpy as np
import pytest

from retainspark.llm import substring


def plain(rows, window):
    """(id, text) to removed flags; rows in order of id, rows of one id are one document."""
    seen, out = {}, {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            if g in seen:
                gone[k:k + window] = [True] * window
            seen.setdefault(g, True)
        out[i, text] = gone
    return out


def check(docs, rows, window):
    want = plain(rows, window)
    got = substring.remove_repeats(docs, window=window).collect()
    assert len(got) == len(rows)
    for r in got:
        gone = want[r.doc_id, r.text]
        words = (r.text or "").encode().split()
        assert (r.n_words, r.n_removed) == (len(gone), sum(gone)), r.doc_id
        assert r.kept_text == b" ".join(w for w, g in zip(words, gone) if not g).decode()
        flags = [False] * len(gone)
        for s in r.spans:
            flags[s.start:s.end] = [True] * (s.end - s.start)
        assert flags == gone
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


@pytest.mark.parametrize("window", [1, 3, 6, 20, 50])
def test_matches_brute_force(documents, window):
    rng = random.Random(window)
    base = [f"w{rng.randrange(60)}" for _ in range(400)]
    rows = []
    for i in range(40):
        a, n = rng.randrange(300), rng.randrange(5, 160)
        mixed = base[a:a + n] + [f"u{i}_{k}" for k in range(rng.randrange(30))] + base[(a + 50) % 300:(a + 50) % 300 + 70]
        rows.append((i * 3, rng.choice([" ", "\n", " \t"]).join(mixed)))
    check(documents(rows), rows, window)


def test_special_rows(documents, words):
    rows = [(1, None), (2, ""), (3, " \n"), (4, words(19)), (5, words(20)), (6, words(20)), (6, words(20)), (None, words(30)),
            (7, "x " * 5000), (8, "é a " * 50), (9, words(40_000, 10**6)), (10, words(60, 10**6 + 500))]
    check(documents(rows, extra=("spans", "__id", "c1", "runs", "tie")), rows, 20)


def test_a_hot_passage_over_many_batches(spark, documents, words, monkeypatch):
    rows = [(i, f"a{i} {words(45)} b{i}") for i in range(300)]
    check(documents(rows).repartition(20), rows, 20)


@pytest.mark.parametrize("parts", [1, 7])
def test_equal_rows_are_one_and_keep_a_first_passage(documents, words, parts):
    rows = [*[(50, words(30))] * 2, (60, words(25)), *[(70, words(25, 500))] * 3, *[(80, "x " * 60)] * 2, *[(None, words(40, 900))] * 2]
    docs = documents(rows).repartition(parts)
    check(docs, rows, 20)
    first = [r for r in substring.remove_repeats(docs).collect() if r.doc_id == 50]
    assert [(r.n_removed, r.kept_text) for r in first] == [(0, words(30))] * 2


def test_empty_table(documents):
    assert substring.remove_repeats(documents([])).count() == 0


def test_rolling_hash_and_minimum():
    v = np.arange(50, dtype=np.uint64) * np.uint64(2654435761) % np.uint64(97)
    assert len(substring.rolling(v[:3], 4, substring.BASE)) == 0
    h = substring.rolling(np.tile(v[:10], 3), 5, substring.BASE)
    assert h[0] == h[10] == h[20] and len(np.unique(h[:10])) == 10
    for size in (1, 2, 3, 7, 15):
        got = substring._sliding_argmin(v, size)
        assert got.tolist() == [i + int(np.argmin(v[i:i + size])) for i in range(len(v) - size + 1)]
