import random

import pytest
import xxhash

from retainspark.llm import simhash


def plain_fingerprint(text, k=3):
    w = [x for x in __import__("re").split(rb"[\x20\x09-\x0d]+", text.lower()) if x]
    grams = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "One", "one TWO", "a b c", "a b c a b c a", "É é   x", "w " * 500])
def test_fingerprint(text):
    assert simhash.simhash(text.encode()) == plain_fingerprint(text.encode())


def plain_components(values, bits):
    label = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for a in values:
            for b in values:
                if ((a ^ b) & (2**64 - 1)).bit_count() <= bits and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


@pytest.mark.parametrize(("bits", "bucket"), [(2, 64), (2, 2), (1, 2), (3, 2), (1, 64)])
def test_pairs_join_exactly_the_components(spark, monkeypatch, bits, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(bits)
    values = set()
    for _ in range(12):  # families that chain within and just beyond the bound
        x = rng.getrandbits(64)
        for _ in range(9):
            values.add(x)
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
                x ^= 1 << b
    values = [simhash._signed(v) for v in values] + [0, 1, -1]
    classes = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = [(r.a, r.b) for r in simhash.near_pairs(classes, bits).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= bits for a, b in edges)
    from retainspark.llm.components import components
    got = {r.node: r.label for r in components(simhash.near_pairs(classes, bits)).collect()}
    want = plain_components(values, bits)
    assert {v: got.get(v, v) for v in values} == want


def test_special_rows(documents, words):
    long = words(30_000)
    rows = [(9, words(60)), (4, words(60)), (4, words(60)), (7, None), (8, " "), (3, ""), (None, words(60)), (11, long),
            (12, long), (13, words(60, 1000))]
    docs = documents(rows, extra=("fp", "label"))
    got = sorted((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect() if r.doc_id is not None)
    assert got == [(3, 3), (4, 4), (4, 4), (7, 3), (8, 3), (9, 4), (11, 11), (12, 11), (13, 13)]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    # of the first family the null id comes first
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 3), (False, 11), (False, 13), (True, 0)]


def test_null_ids_of_different_texts_stay(documents, words):
    rows = [(None, words(60)), (None, words(60, 500)), (None, words(60))]
    assert simhash.keep_one(documents(rows)).count() == 2


def test_empty_table(documents):
    assert simhash.near_duplicates(documents([])).count() == 0
    assert simhash.keep_one(documents([])).count() == 0
