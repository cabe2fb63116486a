import random

import numpy as np
import pytest

from retainspark.llm import negatives

SCHEMA = "id long, label int, vector array<long>"


def brute(rows, anchors, positives=5, negatives=3):
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    good = [r for r in rows if None not in r and None not in r[2]]
    for i, label, v in anchors:
        scored = sorted((-dot(v, w), j, other) for j, other, w in good)
        own = [(-s, j) for s, j, other in scored if other == label and j != i][:positives]
        for p, j in own:
            fits = [(-s, k) for s, k, other in scored if other != label and 50 * p <= -100 * s <= 95 * p]
            out += [(i, j, n + 1, k, p, s) for n, (s, k) in enumerate(fits[:negatives])]
    return sorted(out)


def vectors(rnd, n, width, spread, classes=4):
    centres = [[rnd.gauss(0, spread) for _ in range(width)] for _ in range(classes)]
    return [(i, c := rnd.randrange(classes), [int(round(m + rnd.gauss(0, 20))) for m in centres[(c + (i % 5 == 0)) % classes]]) for i in range(n)]


@pytest.mark.parametrize("width,spread,block", [(24, 60, 64), (8, 5, 1000), (3, 200, 7), (1, 1, 50)])
def test_against_all_pairs(spark, monkeypatch, width, spread, block):
    rnd = random.Random(width)
    rows = vectors(rnd, 300, width, spread)
    anchors = [r for r in rows if r[0] % 11 == 0]
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "BATCH", 9)
    got = negatives.mine(spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(anchors, SCHEMA))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, anchors)


def test_special_rows(spark):
    big = 3_000_000
    rows = [(0, 1, [3, 4]), (1, 1, [3, 4]), (2, 1, [30, 40]), (3, 2, [2, 2]), (4, 2, [2, 2]), (5, 2, []), (6, None, [1, 1]), (7, 2, None),
            (8, 2, [1, None]), (9, 2, [3, 3, 9]), (10, 1, [0, 0]), (11, 1, [-5, -5]), (12, 3, [big, -big]), (13, 3, [big, 0]), (14, 1, [big, 1]), (None, 1, [9, 9])]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", score int, anchor_id int")
    anchors = [r for r in rows if r[0] in (0, 5, 10, 12, 14)]
    got = negatives.mine(frame, spark.createDataFrame([*anchors, *anchors, (None, 1, [1]), (99, None, [1]), (98, 77, [1])], SCHEMA))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, anchors)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, 1, [1, 2])], SCHEMA)
    assert negatives.mine(none, none).collect() == negatives.mine(some, none).collect() == negatives.mine(none, some).collect() == []
    assert negatives.mine(some, some).collect() == []


@pytest.mark.parametrize("least", [0.0, 50.0, 300.0, 1e9, float("-inf")])
def test_index_misses_nothing_above_the_threshold(least):
    rng = np.random.default_rng(2)
    y = rng.integers(-90, 90, (200, 40)) * (rng.random(40) < 0.6)
    x = rng.integers(-90, 90, (13, 40))
    norm = np.sqrt((x.astype(float) ** 2).sum(axis=1))
    thresholds = norm * max(least, -1e6)
    index = negatives.Index(y, least)
    a, r, s = index.search(x, thresholds)
    whole = x @ y.T
    assert sorted(zip(a.tolist(), r.tolist(), s.tolist())) == sorted(
        (i, j, int(whole[i, j])) for i, j in np.argwhere(whole >= thresholds[:, None]).tolist())
    if least == 300.0:  # leading dimensions really stay out of the index
        assert index.postings[0] < 200
