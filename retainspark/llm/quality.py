"""Quality rules by line sequence labelling.

A linear-chain conditional random field labels each line of a document content
or boilerplate (Viterbi decoding); the share of word characters in content
lines decides whether the document is kept.  The model is trained on a bounded
sample of labelled documents: their lines start with the document's label, a
first model then tells which lines of the bad documents read like good ones, and
the final model is trained on the corrected lines.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from retainspark.llm import crf
from retainspark.llm.common import BLANKS, binary_values, by_bytes, require, text_bytes

SYMBOLS = b"#*$%&|<>"
SPARE_SYMBOLS = bytes(set(range(256)) - set(SYMBOLS))
MIN_WORDS = 50
CONTENT, BOILERPLATE = 0, 1

#: Upper bounds of the bins of each line measure; a measure has one bin more.
BINS = (
    (1, 3, 7, 15, 40),  # words
    (2.5, 4, 6, 8, 11),  # bytes per word
    (0.02, 0.1, 0.3, 0.6),  # A-Z per byte of words
    (0.001, 0.05, 0.3, 0.8),  # symbols per word
    (0.001, 0.1, 0.5, 1.0),  # exclamation and question marks per word
    (0.001, 0.1, 0.3),  # digits per byte of words
    (0.2, 0.4, 0.6, 0.8, 0.95),  # distinct words per word
    (0.001, 0.1, 0.3, 0.6),  # words equal to the one before, per word
    (0.001, 0.05, 0.3),  # commas and full stops per word
)
OFFSETS = np.cumsum([1, *[len(b) + 1 for b in BINS]])
#: After the bins: repeated line, ends a sentence, starts in upper case, first line, last line.
FLAGS = int(OFFSETS[-1])
FEATURES = FLAGS + 5
UPPER_BYTES, DIGITS, MARKS, STOPS = (bytes(set(range(256)) - set(x)) for x in (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?", b",."))


@dataclasses.dataclass(frozen=True)
class LineModel:
    weights: np.ndarray
    start: np.ndarray
    transition: np.ndarray
    content_share: float = 0.5


def _lines(text: bytes) -> list[tuple[bytes, list[bytes]]]:
    """Lines that hold a word, with their words."""
    return [(line, words) for line in text.split(b"\n") if (words := line.split())]


def _line_features(lines: list[tuple[bytes, list[bytes]]]) -> np.ndarray:
    """One row of active feature numbers per line."""
    seen: set[bytes] = set()
    rows = np.empty((len(lines), len(BINS)))
    flags = np.zeros((len(lines), 5), dtype=bool)
    for i, (line, words) in enumerate(lines):
        n = len(words)
        size = sum(map(len, words))
        same = sum(map(bytes.__eq__, words, words[1:])) if n > 1 else 0
        rows[i] = (n, size / n, len(line.translate(None, UPPER_BYTES)) / size,
                   len(line.translate(None, SPARE_SYMBOLS)) / n, len(line.translate(None, MARKS)) / n,
                   len(line.translate(None, DIGITS)) / size, len(set(words)) / n, same / n,
                   len(line.translate(None, STOPS)) / n)
        flags[i] = (line in seen, words[-1][-1:] in b".!?:", b"A" <= words[0][:1] <= b"Z", i == 0, i + 1 == len(lines))
        seen.add(line)
    bins = [np.searchsorted(b, rows[:, j], side="left") + OFFSETS[j] for j, b in enumerate(BINS)]
    return np.column_stack([np.zeros(len(lines), dtype=np.int64), *bins,
                            *[np.where(flags[:, j], FLAGS + j, 0) for j in range(5)]])


def base_counts(text: bytes) -> dict:
    """Counts that any rule on words can use: see the query's contract."""
    words = text.split()
    points = sum(1 for b in text if b & 0xC0 != 0x80) if not text.isascii() else len(text)
    lines = [line for line, _ in _lines(text)]
    out = {"n_words": len(words), "word_chars": points - (len(text) - len(text.translate(None, BLANKS))),
           "n_symbols": len(text.translate(None, SPARE_SYMBOLS)), "n_dup_lines": len(lines) - len(set(lines)),
           "n_repeat_words": _repeat_words(words)}
    out["base_failed"] = out["n_words"] < MIN_WORDS or 100 * out["n_repeat_words"] > 50 * out["n_words"]
    return out


def _repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=n)
    pair = ids[:-1] * len(number) + ids[1:]
    if len(number) > 2_000_000:  # three numbers would not fit in 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, where, count = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = count[where] > 1
    cover = np.zeros(n, dtype=bool)
    for k in range(3):
        cover[k:n - 2 + k] |= again
    return int(cover.sum())


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        quality_col: str = "quality", per_class: int = 1500, content_share: float = 0.5) -> LineModel:
    """A line model from at most ``per_class`` labelled documents of each
    quality (1 good, 0 bad), chosen by a hash of their ids; their whole texts
    are used.  Rows without label, id or text teach nothing.  With a class
    missing, every line counts as content."""
    marked = (require(labels, [id_col, quality_col]).toDF("id", "quality").filter("id IS NOT NULL")
              .groupBy("id").agg(F.min("quality").alias("quality")))
    sample = None
    for q in (0, 1):  # two bounded look-ups; only ids and labels come in order
        part = marked.filter(F.col("quality") == q).orderBy(F.xxhash64(F.col("id"), F.lit(17)), "id").limit(per_class)
        sample = part if sample is None else sample.union(part)
    texts = (require(docs, [id_col, text_col]).toDF("id", "text").filter("text IS NOT NULL")
             .join(F.broadcast(sample), "id")  # at most 2 * per_class rows
             .select(F.col("text").cast("binary").alias("text"), "quality")
             .orderBy(F.xxhash64("text"), "quality").limit(2 * per_class).collect())
    parsed = [(lines, r["quality"]) for r in texts if (lines := _lines(bytes(r["text"])))]
    if len({q for _, q in parsed}) < 2:
        return LineModel(np.zeros((FEATURES, 2)), np.array([0.0, -30.0]), np.zeros((2, 2)), content_share)
    features = [_line_features(lines) for lines, _ in parsed]
    lengths = np.array([len(f) for f in features])
    items = list(np.concatenate(features))
    bad = np.repeat([q == 0 for _, q in parsed], lengths)
    gold = np.where(bad, BOILERPLATE, CONTENT)
    for _ in range(2):
        w, s, t = crf.train(items, gold, lengths, FEATURES, 2)
        prob, _, _ = crf.marginals(w[np.stack(items)].sum(axis=1), lengths, s, t)
        gold = np.where(bad & (prob[:, BOILERPLATE] >= 0.5), BOILERPLATE, CONTENT)
    return LineModel(w, s, t, content_share)


def judge(texts: list[bytes], model: LineModel) -> dict[str, list]:
    """Columns of ``label_lines`` for some texts."""
    lines = [_lines(t) for t in texts]
    lengths = np.array([len(x) for x in lines])
    features = np.concatenate([_line_features(x) for x in lines]) if lengths.sum() else np.zeros((0, 1), np.int64)
    scores = model.weights[features].sum(axis=1) if len(features) else np.zeros((0, 2))
    labels = crf.viterbi(scores, lengths, model.start, model.transition)
    out: dict[str, list] = {c: [] for c in COLUMNS}
    at = 0
    for text, own in zip(texts, lines, strict=True):
        counts = base_counts(text)
        content = (labels[at:at + len(own)] == CONTENT).tolist()
        at += len(own)
        sizes = [sum(map(len, words)) for _, words in own]
        share = sum(s for s, c in zip(sizes, content, strict=True) if c) / sum(sizes) if sizes else 0.0
        for k, v in counts.items():
            out[k].append(v)
        out["line_content"].append(content)
        out["content_share"].append(share)
        out["kept"].append(not counts["base_failed"] and share >= model.content_share)
    return out


COLUMNS = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
           "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "line_content": pa.list_(pa.bool_()),
           "content_share": pa.float64(), "kept": pa.bool_()}
SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, line_content array<boolean>, content_share double, kept boolean")


def label_lines(docs: DataFrame, model: LineModel, text_col: str = "text",
                keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the added columns of ``COLUMNS``: word and symbol counts,
    ``line_content`` (per line with a word: content or not), ``content_share``
    (bytes of words in content lines) and ``kept``.  Input columns of these
    names are replaced.

    Null and blank texts have no word: all counts 0, share 0, not kept.  Each row
    is judged alone, so repeated rows get equal results and order has no
    influence; an empty table gives an empty result."""
    require(docs, [text_col])
    rest = [c for c in (docs.columns if keep is None else keep) if c not in COLUMNS]
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches, len(rest)):
            found = judge(binary_values(b.column(len(rest))), held.value)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(len(rest))], *[pa.array(found[c], k) for c, k in COLUMNS.items()]],
                names=[*[f"c{i}" for i in range(len(rest))], *COLUMNS])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    out = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], text_bytes(f"`{text_col}`").alias("__t"))
    out = out.mapInArrow(run, ", ".join([*[f"c{i} {kinds[c]}" for i, c in enumerate(rest)], SCHEMA]))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], *COLUMNS)
