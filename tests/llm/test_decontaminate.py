import random
import re

import pytest

from retainspark.llm import decontaminate


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", low) if w]


def plain(text, items, n):
    w, hit, names = words_of(text), set(), set()
    for item, body in items:
        b = words_of(body)
        grams = [b] if 0 < len(b) < n else [b[i:i + n] for i in range(len(b) - n + 1)]
        for g in grams:
            for i in range(len(w) - len(g) + 1):
                if w[i:i + len(g)] == g:
                    hit.update(range(i, i + len(g)))
                    names.add(str(item) if item is not None else "null")
    return len(w), hit, sorted(names)


def check(docs, rows, bench, items, n=10):
    got = decontaminate.find_contamination(docs, bench, n=n).collect()
    assert len(got) == len(rows)
    for r in got:
        n_words, hit, names = plain(r.text, items, n)
        assert (r.n_words, r.n_hit, r.items, r.contaminated) == (n_words, len(hit), names, bool(hit)), r.doc_id
        assert {p for s in r.spans for p in range(s.start, s.end)} == hit
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
    clean = decontaminate.clean_documents(docs, bench, n=n)
    assert clean.columns == docs.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    assert (sorted([(r.doc_id, r.text) for r in clean.collect()], key=key)
            == sorted([(i, t) for i, t in rows if not plain(t, items, n)[1]], key=key))


@pytest.fixture
def items(words):
    return [(1, words(12)), (2, words(30, 5)), (3, "Short Ästhetik item"), (4, None), (5, "..."), (None, words(11, 900)),
            (7, words(12)), (8, "ÉCOLE école " * 6)]


def test_special_rows(spark, documents, words, items):
    rows = [(1, None), (2, ""), (3, "!!"), (4, words(9)), (5, words(10)), (5, words(10)), (6, words(200, 300)),
            (7, words(3000, 5000) + " " + words(40)), (8, "x short ästhetik item y"), (9, "x SHORT Ästhetik, ITEM y"),
            (None, words(20, 895)), (None, words(3)), (10, words(10).upper().replace(" ", "--")),
            (11, "ÉCOLE éCOLE " * 6), (12, "école école " * 6), (13, f"{words(12)} a {words(12)} {words(12)}")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    check(documents(rows, extra=("spans", "words", "hash", "item")), rows, bench, items)


def test_random_texts_and_the_join_beyond_the_broadcast(spark, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 3)
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(i, text(rng.choice([2, 5, 6, 9]))) for i in range(5)]
    rows = [(i, text(rng.randrange(60))) for i in range(25)]
    check(documents(rows), rows, spark.createDataFrame(items, "item_id long, text string"), items, n=5)


def test_empty_tables(spark, documents, words):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert not decontaminate.find_contamination(documents([(1, words(30))]), bench).first().contaminated
    some = spark.createDataFrame([(1, words(30))], "item_id long, text string")
    assert decontaminate.find_contamination(documents([]), some).count() == 0
    assert decontaminate.clean_documents(documents([]), some).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 5, 7, 10, 13, 16])
def test_window_hashes_depend_on_the_words_alone(spark, size):
    words = [f"w{i % 4}" for i in range(40)]
    df = spark.createDataFrame([(words,), (words[3:],), (words[:size],), (words[:size - 1],), ([],)], "w array<string>")
    rows = [r.h for r in df.select(decontaminate._window_hashes(decontaminate.F.col("w"), size).alias("h")).collect()]
    assert [len(h) for h in rows] == [max(n - size + 1, 0) for n in (40, 37, size, size - 1, 0)]
    by_words = {}
    for h, start in ((rows[0], 0), (rows[1], 3), (rows[2], 0)):
        for i, x in enumerate(h):
            assert by_words.setdefault(tuple(words[start + i:start + i + size]), x) == x
    assert len(set(by_words.values())) == len(by_words)


def test_several_scans_find_what_one_does(spark, documents, words, monkeypatch):
    docs = documents([(i, words(60, 7 * i)) for i in range(12)])
    bench = spark.createDataFrame([(f"t{i}", words(30, 11 * i)) for i in range(6)] + [("short", "w5 w6")], "item_id string, text string")
    one = sorted(map(str, decontaminate.find_contamination(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 10)
    monkeypatch.setattr(decontaminate, "CHUNK", 3)
    assert sorted(map(str, decontaminate.find_contamination(docs, bench).collect())) == one
    assert any("contaminated=True" in r for r in one)


def test_a_long_text_is_scanned_whole(spark, documents):
    text = " ".join(f"w{i % 9973}" for i in range(300_000)) + " a b c d e f g h i j k"
    bench = spark.createDataFrame([("x", "a b c d e f g h i j"), ("y", "zz yy")], "item_id string, text string")
    r = decontaminate.find_contamination(documents([(1, text)]), bench).first()
    assert (r.n_words, r.n_hit, r["items"], [tuple(s) for s in r.spans]) == (300_011, 10, ["x"], [(300_000, 300_010)])
