import random

import numpy as np
import pytest

from retainspark.llm import crf, langid

SOUNDS = {"aa": ["ka", "mo", "ti", "ra", "no", "su"], "bb": ["sch", "ein", "ung", "ver", "tz", "keit"],
          "cc": ["eux", "ment", "que", "ou", "lle", "oi"]}


def speak(lang, n, rng):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    return [(i, speak(lang, rng.randint(5, 60), rng), lang) for i, lang in enumerate(rng.choices(list(SOUNDS), [6, 2, 1], k=400))]


@pytest.fixture(scope="module")
def model(spark, corpus):
    rows = spark.createDataFrame([*corpus, (None, "x", "aa"), (900, None, "aa"), (901, "x", None)], "doc_id long, text string, lang string")
    return langid.fit(rows, per_language=60)


def test_held_out_accuracy(spark, model):
    rng = random.Random(2)
    rows = [(i, speak(lang, 30, rng), lang) for i, lang in enumerate(list(SOUNDS) * 30)]
    out = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.98 * len(out)
    assert all(0 <= r.score <= 1 for r in out)


def test_words_of_switched_text(spark, model):
    rng = random.Random(3)
    text = " ".join([speak("bb", 12, rng), "42", speak("cc", 20, rng), "--"])
    r = langid.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    lang = {p: s.lang for s in r.segments for p in range(s.start, s.end)}
    assert r.lang_pred == "cc"
    assert sum(lang[p] == ("bb" if p < 12 else "cc") for p in lang if p != 12) >= 30


def test_labels_match_plain_forward_backward(model):
    rng = random.Random(4)
    texts = [speak("aa", 7, rng).encode(), b"", b"12 !!", (speak("bb", 4, rng) + " 7 " + speak("cc", 9, rng)).encode()]
    got = list(langid.label(texts, langid._Scores(model)))
    assert got[1] == got[2] == ("und", 0.0, [])
    for k in (0, 3):
        words = [x for w in texts[k].split() if (x := langid.letters(w))]
        scores = np.array([model.weights[langid.features([w], model.lexicons)[1]].sum(axis=0) for w in words])
        prob, _, _ = crf.marginals(scores, np.array([len(words)]), model.start, model.transition)
        mean = prob.mean(axis=0)
        assert got[k][0] == model.languages[int(mean.argmax())] and abs(got[k][1] - mean.max()) < 1e-4


def test_special_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "1234 !? \n"), (4, "ka mo " * 30_000), (5, "tz keit"), (5, "tz keit"), (None, "漢字 ñ")]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, text string, score int, c0 int")
    out = langid.identify(df, model).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == 7 and by[1].c0 == 0
    assert all((by[i].lang_pred, by[i].score, by[i].segments) == ("und", 0.0, []) for i in (1, 2, 3))
    assert by[4].lang_pred == "aa" and by[4].segments[0].end == 60_000
    assert len([r for r in out if r.doc_id == 5 and r == by[5]]) == 2
    assert by[None].lang_pred in model.languages


def test_the_prediction_sees_the_text_only(spark, model, corpus):
    a = spark.createDataFrame(corpus[:50], "doc_id long, text string, lang string")
    b = spark.createDataFrame([(i + 7, t, "zz") for i, t, _ in corpus[:50]], "doc_id long, text string, lang string")
    key = lambda df: sorted((r.text, r.lang_pred, r.score) for r in langid.identify(df, model).collect())
    assert key(a) == key(b)


def test_empty_tables(spark, model):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.identify(none, model).count() == 0
    nothing = langid.fit(none)
    assert langid.identify(spark.createDataFrame([(1, "ka")], "doc_id long, text string"), nothing).first().lang_pred == "und"
