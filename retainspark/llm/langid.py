"""Language of each word in code-switched text: a linear-chain conditional
random field.

Words are observed through affixes (3 and 4 bytes), bigrams and trigrams and
lexicon features (which languages' sample lexicons hold the word); label
transitions are learned.  Forward-backward gives each word's language
probabilities, their mean over a document its language.

The sample documents are monolingual as far as their label says, so training
sequences are made of pieces of documents of different languages: that is what
the transitions learn switching from.
"""

from __future__ import annotations

import dataclasses
import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from retainspark.llm import crf
from retainspark.llm.common import binary_values, by_bytes, require, text_bytes

UNKNOWN = "und"
#: Hashed features; the bias and one lexicon feature per language come after them.
HASHED = 1 << 17
#: Words whose scores one Python worker remembers.
MEMO = 1_000_000
#: Words of a training piece (at most), pieces of a training sequence (at most).
PIECE, PIECES = 12, 4


@dataclasses.dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    lexicons: tuple[frozenset, ...]
    weights: np.ndarray
    start: np.ndarray
    transition: np.ndarray


def letters(word: bytes) -> str:
    """The word in lower case from its first to its last letter; empty if it has
    none."""
    text = word.decode("utf-8", "replace").lower()
    if text.isalpha():
        return text
    at = [i for i, c in enumerate(text) if c.isalpha()]
    return text[at[0]:at[-1] + 1] if at else ""


def features(words: list[str], lexicons: tuple[frozenset, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Active features of all words at once: the word's place and the feature's
    number, in the order of the words.  Grams and affixes are of UTF-8 bytes, with
    a mark before and after the word."""
    marked = [b"^%b$" % w.encode("utf-8", "replace") for w in words]
    size = np.array([len(w) for w in marked], dtype=np.int64)
    start = np.cumsum(size) - size
    chars = np.frombuffer(b"".join(marked), dtype=np.uint8).astype(np.uint64)
    own = np.repeat(np.arange(len(words)), size)
    left = np.repeat(start + size, size) - np.arange(len(chars))
    places, found = [np.arange(len(words))], [np.full(len(words), HASHED)]
    h = chars
    for k in range(2, 6):
        h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + chars[k - 1:]
        if k <= 3:  # grams anywhere
            at = np.flatnonzero(left[:len(h)] >= k)
            kinds = [(at, own[at], k)]
        else:  # prefixes and suffixes
            long = np.flatnonzero(size > k)
            kinds = [(start[long], long, k), (start[long] + size[long] - k, long, k + 2)]
        for at, word, tag in kinds:
            x = (h[at] + np.uint64(tag)) * np.uint64(0xBF58476D1CE4E5B9)
            places.append(word)
            found.append((x >> np.uint64(64 - HASHED.bit_length() + 1)).astype(np.int64))
    for j, lexicon in enumerate(lexicons):
        known = [i for i, w in enumerate(words) if w in lexicon]
        places.append(np.array(known, dtype=np.int64))
        found.append(np.full(len(known), HASHED + 1 + j))
    place, feature = np.concatenate(places), np.concatenate(found)
    order = np.argsort(place, kind="stable")
    return place[order], feature[order]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = 400, words: int = 60_000, seed: int = 23) -> LanguageModel:
    """A model from at most ``per_language`` documents of each language, chosen
    by a hash of their ids, and at most ``words`` training words, chosen evenly
    from all of their texts.  Half the documents make the lexicons, the other
    half the training sequences, so that lexicon features are as good in
    training as they are later.  Rows without id, text or language teach
    nothing; without any, nothing is known and every text is ``und``."""
    known = (require(docs, [id_col, text_col, lang_col]).toDF("id", "text", "lang")
             .filter("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL"))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row per language
    languages = tuple(sorted(counts))
    if not languages:
        return LanguageModel((), (), np.zeros((HASHED + 1, 0)), np.zeros(0), np.zeros((0, 0)))
    draw = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for k, v in counts.items() for x in (k, min(1.0, per_language / v))])
    sample = (known.filter(draw < F.element_at(share, F.col("lang"))).orderBy(draw, "id", "text")
              .limit(per_language * len(languages)).select(F.col("text").cast("binary").alias("text"), "lang").collect())
    own: list[Counter] = [Counter() for _ in languages]
    pieces = []
    for i, r in enumerate(sample):
        y = languages.index(r["lang"])
        text = [x for w in bytes(r["text"]).split() if (x := letters(w))]
        if i % 2 == 0 and len(sample) > 1:
            own[y].update(text)
        else:
            pieces += [(y, text[k:k + PIECE]) for k in range(0, len(text), PIECE)]
    lexicons = tuple(frozenset(w for w, c in o.items() if c > 1 and c >= 0.8 * sum(p[w] for p in own)) for o in own)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(pieces))
    # languages take turns, so that a frequent one does not crowd the others out
    turn = {y: 0 for y in range(len(languages))}
    rank = {int(k): (turn.__setitem__(pieces[k][0], turn[pieces[k][0]] + 1) or turn[pieces[k][0]]) for k in order}
    chosen, total = [], 0
    for k in sorted(rank, key=lambda k: rank[k]):
        if total >= words:
            break
        chosen.append(pieces[k])
        total += len(pieces[k][1])
    items, gold, lengths, at = [], [], [], 0
    chosen = [chosen[k] for k in rng.permutation(len(chosen))]
    vocabulary = sorted({w for _, text in chosen for w in text})
    place, feature = features(vocabulary, lexicons)
    cache = dict(zip(vocabulary, np.split(feature, np.flatnonzero(np.diff(place)) + 1), strict=True)) if vocabulary else {}
    while at < len(chosen):
        group = chosen[at:at + int(rng.integers(1, PIECES + 1))]
        at += len(group)
        for y, text in group:
            cut = int(rng.integers(1, len(text) + 1))
            for w in text[:cut] if len(group) > 1 else text:
                items.append(cache[w])
                gold.append(y)
        lengths.append(len(items) - sum(lengths))
    w, s, t = crf.train(items, np.array(gold, dtype=np.int64), np.array(lengths), HASHED + 1 + len(languages),
                        len(languages), epochs=6)
    return LanguageModel(languages, lexicons, w.astype(np.float32), s, t)


class _Scores(dict):
    """Row numbers of words' label scores; row 0 is for words without a letter."""

    def __init__(self, model: LanguageModel):
        super().__init__()
        self.model, self.table = model, np.zeros((1, len(model.languages)), dtype=np.float32)

    def add(self, words: set[bytes]) -> None:
        if len(self) + len(words) > MEMO:
            self.clear()
            self.table = self.table[:1]
        new = [(w, letters(w)) for w in words if w not in self]
        self.update((w, 0) for w, text in new if not text)
        new = [x for x in new if x[1]]
        if new:
            place, feature = features([text for _, text in new], self.model.lexicons)
            weights = self.model.weights
            scores = np.stack([np.bincount(place, weights=weights[feature, y], minlength=len(new))
                               for y in range(weights.shape[1])], axis=1).astype(np.float32)
            first = len(self.table)
            self.table = np.concatenate([self.table, scores])
            self.update(zip((w for w, _ in new), range(first, first + len(new)), strict=True))


def label(texts: list[bytes], scores: _Scores) -> Iterator[tuple[str, float, list[dict]]]:
    """Per text its language, the score and the runs of words of one language."""
    model = scores.model
    split = [t.split() for t in texts]
    scores.add(set(itertools.chain.from_iterable(split)))
    count = np.array([len(ws) for ws in split], dtype=np.int64)
    rows = np.fromiter(map(scores.__getitem__, itertools.chain.from_iterable(split)), dtype=np.int64, count=int(count.sum()))
    owner = np.repeat(np.arange(len(texts)), count)
    place = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
    real = rows > 0
    owner, place = owner[real], place[real]
    lengths = np.bincount(owner, minlength=len(texts))
    prob, _, _ = crf.marginals(scores.table[rows[real]].astype(np.float64), lengths, model.start, model.transition)
    best = prob.argmax(axis=1)
    new = np.ones(len(best), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (best[1:] != best[:-1])
    heads = np.flatnonzero(new)
    tails = np.append(heads, len(best))[1:] - 1
    runs: list[list[dict]] = [[] for _ in texts]
    for o, y, a, b in zip(owner[heads].tolist(), best[heads].tolist(), place[heads].tolist(), place[tails].tolist(), strict=True):
        runs[o].append({"lang": model.languages[y], "start": a, "end": b + 1})
    starts = np.cumsum(lengths) - lengths
    filled = np.flatnonzero(lengths)
    means = np.zeros((len(texts), len(model.languages)))
    if len(filled):
        means[filled] = np.add.reduceat(prob, starts[filled], axis=0) / lengths[filled][:, None]
    for k in range(len(texts)):
        y = int(means[k].argmax())
        yield (model.languages[y], min(1.0, float(means[k, y])), runs[k]) if lengths[k] else (UNKNOWN, 0.0, [])


ADDED = {"lang_pred": pa.string(), "score": pa.float64(),
         "segments": pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))}


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``lang_pred``, ``score`` (mean
    probability of that language over words with a letter, 0 to 1) and
    ``segments`` (runs of words of one language, word positions [start, end); a
    word without a letter belongs to none).  Input columns of these names are
    replaced.

    Only the text is looked at.  Null texts and texts without a letter are
    ``und`` with score 0 and no segment; of equally probable languages the first
    by name wins.  Repeated rows get equal results, an empty table an empty one."""
    require(docs, [text_col])
    rest = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _Scores(held.value)
        for b in by_bytes(batches, len(rest)):
            texts = binary_values(b.column(len(rest)))
            found = list(label(texts, scores)) if held.value.languages else [(UNKNOWN, 0.0, [])] * len(texts)
            cells = list(zip(*found, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(len(rest))],
                 *[pa.array(c, k) for c, k in zip(cells, ADDED.values(), strict=True)]],
                names=[*[f"c{i}" for i in range(len(rest))], *ADDED])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*[f"c{i} {kinds[c]}" for i, c in enumerate(rest)], "lang_pred string, score double, "
                        "segments array<struct<lang: string, start: long, end: long>>"])
    out = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], text_bytes(f"`{text_col}`").alias("__t"))
    return out.mapInArrow(run, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], *ADDED)
