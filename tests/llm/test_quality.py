import collections
import itertools

import numpy as np
import pytest

from retainspark.llm import crf, quality


@pytest.fixture
def chain():
    rng = np.random.default_rng(3)
    lengths = np.array([4, 0, 1, 5, 2])
    return rng.normal(size=(lengths.sum(), 3)), lengths, rng.normal(size=3), rng.normal(size=(3, 3))


def brute(scores, start, t):
    """Every label sequence with its score."""
    for y in itertools.product(range(scores.shape[1]), repeat=len(scores)):
        yield y, start[y[0]] + sum(scores[i, k] for i, k in enumerate(y)) + sum(t[a, b] for a, b in zip(y, y[1:]))


def test_marginals_and_viterbi_match_enumeration(chain):
    scores, lengths, start, t = chain
    prob, pairs, log_z = crf.marginals(scores, lengths, start, t)
    best = crf.viterbi(scores, lengths, start, t)
    at, total, seen = 0, 0.0, np.zeros((3, 3))
    for n in lengths[lengths > 0]:
        paths = list(brute(scores[at:at + n], start, t))
        z = sum(np.exp(s) for _, s in paths)
        want = np.zeros((n, 3))
        for y, s in paths:
            want[np.arange(n), list(y)] += np.exp(s) / z
            for a, b in zip(y, y[1:]):
                seen[a, b] += np.exp(s) / z
        assert np.allclose(prob[at:at + n], want)
        assert tuple(best[at:at + n]) == max(paths, key=lambda p: p[1])[0]
        total += np.log(z)
        at += n
    assert np.allclose(pairs, seen) and np.isclose(log_z, total)


def plain_counts(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(grams)
    again = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(again),
            "base_failed": len(words) < 50 or 100 * len(again) > 50 * len(words)}


@pytest.mark.parametrize("text", ["", " \n\t", "a", "a a a a a", "x y z\x1fq", "é | ü <b> 日本", "l1 a\nl1 a\n\n l1 a\nl2",
                                  "a b c " * 40, " ".join(f"w{i % 37}" for i in range(200)), "a\n" * 3000])
def test_base_counts_match_a_plain_count(text):
    assert quality.base_counts(text.encode()) == plain_counts(text)


GOOD = "\n".join(f"The river{i} runs slow{i} through vale{i}, and folk{i} walk near bank{i} at dawn{i}." for i in range(12))
BAD = "\n".join(f"BUY | NOW!!! | $$$ | item{i} | ### | {i}{i} | %%%" for i in range(30))


@pytest.fixture
def model(spark, documents):
    rows = [(i, GOOD.replace("river", f"river{i}x")) for i in range(30)] + [(100 + i, BAD.replace("item", f"it{i}x")) for i in range(30)]
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows] + [(None, 1), (5000, 0)], "doc_id long, quality int")
    return quality.fit(documents(rows), labels, per_class=20)


def test_verdicts_and_special_texts(documents, model):
    rows = [(1, GOOD), (2, BAD), (3, None), (4, ""), (5, GOOD), (5, GOOD), (6, GOOD + "\n" + BAD[:100]), (None, GOOD), (7, GOOD * 500)]
    out = quality.label_lines(documents(rows, extra=("kept", "c0", "__t")), model).collect()
    by = collections.defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    assert len(out) == len(rows)
    assert by[1][0].kept and not by[2][0].kept and by[6][0].kept and by[None][0].kept
    assert by[6][0].content_share < 1 and not all(by[6][0].line_content)
    for i in (3, 4):
        assert (by[i][0].n_words, by[i][0].content_share, by[i][0].kept, by[i][0].line_content) == (0, 0.0, False, [])
    assert by[5][0] == by[5][1] and by[5][0].kept == by[1][0].kept
    assert by[7][0].base_failed and not by[7][0].kept  # repeats itself
    assert by[1][0].c0 == 0 and by[1][0]["__t"] == 0


def test_empty_table_and_missing_class(spark, documents):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    model = quality.fit(documents([(1, GOOD)]), labels)
    assert quality.label_lines(documents([(1, GOOD), (2, BAD)]), model).filter("line_content[0]").count() == 2
    assert quality.label_lines(documents([]), model).count() == 0
    assert quality.fit(documents([]), labels.limit(0)).weights.shape[1] == 2
