"""SentencePiece segmentations sampled without replacement, and decoding.

A text's segmentations are the paths of its piece lattice.  Gumbel top-k: every
path's log probability gets Gumbel noise and the k highest paths are k distinct
samples.  The search is A* over the lattice with exact bounds: backward sums
give, for any set of paths, its total probability, and the maximum of the set's
noisy scores can be drawn directly (a Gumbel variable at the set's log total,
truncated at the score of the set it was split from).  A popped set is followed
to a complete path, step by step, each step splitting off the paths that leave it
there; these sets go on the agenda under their own maxima.

The supplied model has merge ranks, no log probabilities; a piece of rank r gets
probability in proportion to 1 / (r + ``RANK_SHIFT``).  A character that no piece
holds falls back to its UTF-8 bytes, ``UNKNOWN`` below the rarest piece.

Pieces hold blanks at their start only, so a text falls into words (blanks and
what follows up to the next blank), and a word into units, cut wherever no piece
found in it reaches over: every path comes through there.  The lattices of the
distinct words are built and walked for a whole batch of texts at once in numpy;
noise is a hash of (row key, seed, sample, position), so a row's samples depend on
nothing but the row.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from retainspark.llm.common import binary_values, by_bytes, require, text_bytes

RANK_SHIFT = 10
UNKNOWN = 10.0
#: Bytes of texts that are walked together (a few hundred bytes of memory each).
SLICE = 1 << 17
SPACE = "▁"
WORD = re.compile(" *[^ ]+| +")


class Vocabulary:
    """The model's pieces as a trie in sorted arrays, with log probabilities."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        kinds = [(sp.is_control(i) or sp.is_unknown(i), sp.is_byte(i)) for i in range(sp.get_piece_size())]
        self.bytes = [b""] * len(kinds)
        self.first_byte = kinds.index((False, True)) if (False, True) in kinds else -1
        ranked = [i for i, (special, byte) in enumerate(kinds) if not special and not byte]
        states: dict[tuple[int, int], int] = {}
        final: dict[int, int] = {}
        self.longest = 1
        for i in ranked:
            piece = sp.id_to_piece(i).replace(SPACE, " ")
            self.bytes[i] = piece.encode()
            self.longest = max(self.longest, len(piece))
            at = 0
            for c in piece:
                at = states.setdefault((at, ord(c)), len(states) + 1)
            final[at] = i
        for b in range(256 if self.first_byte >= 0 else 0):
            self.bytes[self.first_byte + b] = bytes([b])
        keys = np.array([(s << 21) | c for s, c in states], dtype=np.int64)
        self.pieces = pa.array(self.bytes, pa.large_binary())
        # an open hash table, two thirds empty or more; a free place has key -1
        self.shift = np.uint64(64 - max(4, (3 * len(keys)).bit_length()))
        self.keys = np.full(1 << (64 - int(self.shift)), -1, dtype=np.int64)
        self.next = np.full(len(self.keys), -1, dtype=np.int64)
        at, todo = self._place(keys), np.arange(len(keys))
        to = np.array(list(states.values()), dtype=np.int64)
        while len(todo):
            _, one = np.unique(at[todo], return_index=True)  # one key a place and round
            one = one[self.keys[at[todo[one]]] < 0]
            self.keys[at[todo[one]]], self.next[at[todo[one]]] = keys[todo[one]], to[todo[one]]
            todo = np.delete(todo, one)
            at[todo] = (at[todo] + 1) % len(self.keys)
        self.inner = np.zeros(len(states) + 1, dtype=bool)  # states that some piece goes on from
        self.inner[[s for s, _ in states]] = True
        self.root = np.full(0x110000, -1, dtype=np.int64)  # by first character
        for (s, c), to in states.items():
            if s == 0:
                self.root[c] = to
        self.piece = np.full(len(states) + 1, -1, dtype=np.int32)
        self.piece[list(final)] = list(final.values())
        rank = np.zeros(len(kinds))
        rank[ranked] = np.arange(len(ranked))
        weight = 1.0 / (rank[ranked] + RANK_SHIFT)
        self.score = np.full(len(kinds) + 1, -np.inf)
        self.score[ranked] = np.log(weight / weight.sum())
        self.score[-1] = self.score[ranked].min() - UNKNOWN  # of piece -1, the byte fallback

    def _place(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Trie states after one more character; -1 where no piece goes on."""
        key = (state << 21) | char
        at = self._place(key)
        held = self.keys[at]
        out = np.where(held == key, self.next[at], -1)
        far = np.flatnonzero((held != key) & (held >= 0))
        while len(far):
            at[far] = (at[far] + 1) % len(self.keys)
            held = self.keys[at[far]]
            out[far] = np.where(held == key[far], self.next[at[far]], -1)
            far = far[(held != key[far]) & (held >= 0)]
        return out


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _edge_order(left: np.ndarray, node: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Edges by ``left``, ``node`` and ``span``: by one packed key where it fits
    63 bits (a batch has far fewer than 2^32 nodes)."""
    if len(left) and left.max() >= 1 << 23:
        return np.lexsort((span, node, left))
    return np.argsort((left << 40) + (node << 8) + span)


class Lattices:
    """Lattices of distinct words: a node per character, an edge per piece that
    starts there.  A node's edges are ``start`` to ``start + degree``, with
    ``log_prob`` and ``prob`` given that a path comes to the node.  Unit i begins at
    node ``first[i]``; ``parts`` are the units of each word, which follow each other."""

    def __init__(self, words: list[str], vocab: Vocabulary, alpha: float):
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        begin = np.cumsum(sizes) - sizes
        self.chars = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        n = len(self.chars)
        left = np.repeat(begin + sizes, sizes) - np.arange(n)  # characters up to the word's end
        alive, state = np.arange(n), vocab.root[self.chars]
        nodes, spans, pieces = [], [], []
        for k in range(vocab.longest):
            if k:
                go = vocab.inner[state] & (left[alive] > k)
                alive, state = alive[go], state[go]
                state = vocab.step(state, self.chars[alive + k])
            alive, state = alive[state >= 0], state[state >= 0]
            found = vocab.piece[state]
            at = alive[found >= 0]
            if not k:  # a character without a piece
                lone = np.ones(n, dtype=bool)
                lone[at] = False
                at, found = np.append(at, np.flatnonzero(lone)), np.append(found, np.full(lone.sum(), -1))
            nodes.append(at)
            spans.append(np.full(len(at), k + 1))
            pieces.append(found[found >= 0] if k else found[(found >= 0) | (np.arange(len(found)) >= len(alive))])
        node, span, piece = map(np.concatenate, (nodes, spans, pieces))
        over = np.cumsum(np.bincount(node + 1, minlength=n + 1) - np.bincount(node + span, minlength=n + 1))
        self.first = np.flatnonzero(over[:n] == 0)  # no piece reaches over these nodes
        self.parts = np.diff(np.searchsorted(self.first, np.append(begin, n)))
        ends = np.append(self.first[1:], n)
        self.left = np.repeat(ends, ends - self.first) - np.arange(n)  # characters up to the unit's end
        order = _edge_order(self.left[node], node, span)
        node, self.span, self.piece = node[order], span[order], piece[order]
        self.degree = np.bincount(node, minlength=n)
        heads = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if n else np.empty(0, np.int64)
        self.start = np.empty(n, dtype=np.int64)
        self.start[node[heads]] = heads
        score = alpha * vocab.score[self.piece]
        to = np.where(self.span == self.left[node], n, node + self.span)
        beta = np.zeros(n + 1)
        self.log_prob = np.empty(len(node))
        far = self.left[node]
        bounds = np.searchsorted(far, np.arange(1, (int(self.left.max()) if n else 0) + 2))
        inner = np.searchsorted(heads, bounds)
        for r in range(len(bounds) - 1):  # nodes r + 1 characters before their unit's end
            a, b = bounds[r], bounds[r + 1]
            first = heads[inner[r]:inner[r + 1]] - a
            if b == a:
                continue
            total = score[a:b] + beta[to[a:b]]
            many = np.diff(np.append(first, b - a))
            peak = np.maximum.reduceat(total, first)
            z = peak + np.log(np.add.reduceat(np.exp(total - np.repeat(peak, many)), first))
            beta[node[a + first]] = z
            self.log_prob[a:b] = total - np.repeat(z, many)
        self.prob = np.exp(self.log_prob)
        running = np.cumsum(self.prob)
        self.cum = running - np.repeat((running - self.prob)[heads], self.degree[node[heads]]) if n else running
        self.node = node

    def pick(self, at: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each node, drawn by ``u``."""
        edge = self.start[at]
        last = edge + self.degree[at] - 1
        open_ = np.flatnonzero((edge < last) & (self.cum[edge] <= u))
        while len(open_):
            edge[open_] += 1
            e = edge[open_]
            open_ = open_[(e < last[open_]) & (self.cum[e] <= u[open_])]
        return edge

    def rest(self, edge: np.ndarray) -> np.ndarray:
        """Probability of the other edges of the same node; exactly 0 if there are none."""
        return np.where(self.degree[self.node[edge]] > 1, 1.0 - self.prob[edge], 0.0)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(key: np.ndarray, sample: int, position: np.ndarray, purpose: int) -> np.ndarray:
    """Uniform in (0, 1), by row key, sample, position in the text and purpose."""
    with np.errstate(over="ignore"):
        x = _mix(key + np.uint64(0x9E3779B97F4A7C15) * np.uint64(4 * sample + purpose + 1))
        x = _mix(x ^ (position.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(1)))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


class Paths(NamedTuple):
    """A set of paths on the agenda: they follow the sample ``parent`` up to
    ``step``, whose node (in the unit occurrence ``occ``) they leave by any edge
    not in ``gone``; ``prefix`` is the log probability up to there."""

    key: float  # minus the set's highest noisy score
    sample: int
    step: int
    occ: int
    gone: tuple[int, ...]
    prefix: float
    parent: int


class Sampler:
    """Samples of one batch of texts."""

    def __init__(self, texts: list[str], keys: np.ndarray, vocab: Vocabulary, alpha: float):
        self.vocab, self.keys, self.n = vocab, keys, len(texts)
        number: dict[str, int] = defaultdict(itertools.count().__next__)
        split = [WORD.findall(" " + t) if t else [] for t in texts]
        last = np.cumsum([0, *map(len, split)])  # words up to each text's end
        word = np.fromiter(map(number.__getitem__, itertools.chain.from_iterable(split)), dtype=np.int64, count=int(last[-1]))
        self.lattice = lat = Lattices(list(number), vocab, alpha)
        parts = lat.parts[word]
        begin = np.append(0, np.cumsum(parts))
        self.unit = np.repeat((np.cumsum(lat.parts) - lat.parts)[word] - begin[:-1], parts) + np.arange(begin[-1])
        count = np.diff(begin[last])
        self.doc = np.repeat(np.arange(self.n), count)
        self.doc_end = np.cumsum(count)
        sizes = np.diff(np.append(lat.first, len(lat.chars)))[self.unit]
        ends = np.cumsum(sizes)
        self.char = ends - sizes - np.repeat(np.append(0, ends)[np.cumsum(count) - count], count)

    def follow(self, unit_at: np.ndarray, node: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
        """Complete paths from ``node`` to the end of each occurrence of a unit;
        the occurrence and the edge of every step, in text order."""
        lat, base = self.lattice, self.lattice.first[self.unit]
        cur, act = node.copy(), np.arange(len(unit_at))
        who, edges = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while len(act):
            at, occ = cur[act], unit_at[act]
            edge = lat.pick(at, _uniform(self.keys[self.doc[occ]], sample, self.char[occ] + at - base[occ], 0))
            who.append(act)
            edges.append(edge)
            cur[act] = at + lat.span[edge]
            act = act[lat.left[at] > lat.span[edge]]
        act = np.concatenate(who)
        order = np.argsort(act, kind="stable")
        return unit_at[act[order]], np.concatenate(edges)[order]

    def run(self, k: int) -> list[list[dict]]:
        """Up to ``k`` distinct segmentations of each text, best noisy score first."""
        out: list[list[dict]] = [[] for _ in range(self.n)]
        agenda: list[list[tuple]] = [[] for _ in range(self.n)]
        with np.errstate(divide="ignore"):
            top = -np.log(-np.log(_uniform(self.keys, 0, np.full(self.n, -1), 2)))
            occ = np.arange(len(self.unit))
            found = self.follow(occ, self.lattice.first[self.unit], 0)
            self._take(found, 0, np.arange(self.n), top, np.zeros(self.n), [None] * self.n, out, agenda, k)
            lat = self.lattice
            for sample in range(1, k):
                popped = [(d, heapq.heappop(agenda[d])) for d in range(self.n) if agenda[d]]
                if not popped:
                    break
                docs = np.array([d for d, _ in popped])
                value = np.array([-p[0] for _, p in popped])
                base = np.array([p.prefix for _, p in popped])
                here = np.array([p.occ for _, p in popped])
                at = np.array([lat.node[p.gone[0]] for _, p in popped])
                pos = self.char[here] + at - lat.first[self.unit[here]]
                edge, rest = self._other(popped, _uniform(self.keys[docs], sample, pos, 0))
                # what is left of the popped set goes back, under a maximum below the popped one
                self._push(docs, base + np.log(rest), value, sample, pos,
                           [p._replace(gone=(*p.gone, int(e))) for (_, p), e in zip(popped, edge, strict=True)], agenda)
                more = lat.left[at] > lat.span[edge]
                tails = [np.arange(h + (not m), self.doc_end[d]) for h, m, d in zip(here, more, docs, strict=True)]
                occ = np.concatenate(tails)
                start = lat.first[self.unit[occ]]
                size = np.array([len(x) for x in tails])
                start[(np.cumsum(size) - size)[more]] = (at + lat.span[edge])[more]
                heads = [(p.parent, p.step, int(e)) for (_, p), e in zip(popped, edge, strict=True)]
                self._take(self.follow(occ, start, sample), sample, docs, value, base + lat.log_prob[edge], heads, out, agenda, k)
            bound = [-a[0][0] if len(s) == k and a else -np.inf for a, s in zip(agenda, out, strict=True)]
        for samples, kappa in zip(out, bound, strict=True):
            for s in samples:
                x = -np.exp(min(s["log_prob"] - kappa, 700.0))
                # log(1 - exp(x)), and its limit where exp(x) is 1 to machine precision
                s["log_inclusion"] = 0.0 if kappa == -np.inf else float(s["log_prob"] - kappa if x > -1e-12 else np.log(-np.expm1(x)))
        return out

    def _other(self, popped: list, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each popped set an edge that was not taken before, and the
        probability of the edges that then remain."""
        edges, rests = [], []
        lat = self.lattice
        for (_, p), x in zip(popped, u.tolist(), strict=True):
            a = int(lat.start[lat.node[p.gone[0]]])
            free = [e for e in range(a, a + int(lat.degree[lat.node[a]])) if e not in p.gone]
            prob = lat.prob[free]
            i = min(int(np.searchsorted(np.cumsum(prob), x * prob.sum(), "right")), len(free) - 1)
            edges.append(free[i])
            rests.append(float(prob.sum() - prob[i]) if len(free) > 1 else 0.0)
        return np.array(edges), np.array(rests)

    def _take(self, found, sample, docs, value, base, heads, out, agenda, k) -> None:
        """Book complete paths and push the sets that leave them."""
        occ, edge = found
        lat = self.lattice
        owner = self.doc[occ]
        lo, hi = np.searchsorted(owner, docs), np.searchsorted(owner, docs, side="right")
        lp = lat.log_prob[edge]
        before = np.append(0.0, np.cumsum(lp))
        row = np.searchsorted(docs, owner)
        prefix = before[:-1] - before[lo][row] + base[row]
        pos = self.char[occ] + lat.node[edge] - lat.first[self.unit[occ]]
        rest = lat.rest(edge)
        g = prefix + np.log(rest) - np.log(-np.log(_uniform(self.keys[owner], sample, pos, 1)))
        score = np.where(rest > 0, -np.logaddexp(-value[row], -g), -np.inf)
        total = base + before[hi] - before[lo]
        for r, d in enumerate(docs.tolist()):
            a, b, skip, path = int(lo[r]), int(hi[r]), 0, edge[lo[r]:hi[r]]
            if heads[r] is not None:
                parent, step, one = heads[r]
                path, skip = np.concatenate((out[d][parent]["path"][:step], [one], path)), step + 1
            out[d].append({"path": path, "perturbed": float(value[r]), "log_prob": float(total[r])})
            own = score[a:b]
            want = min(k - len(out[d]) + 1, b - a)  # more than that are never popped
            best = np.argpartition(own, b - a - want)[b - a - want:] if want < b - a else np.arange(b - a)
            for i in best.tolist():
                if own[i] > -np.inf:
                    j = a + i
                    heapq.heappush(agenda[d], Paths(-float(own[i]), sample, skip + i, int(occ[j]), (int(edge[j]),),
                                                    float(prefix[j]), len(out[d]) - 1))

    def _push(self, docs, location, value, sample, pos, sets, agenda) -> None:
        g = location - np.log(-np.log(_uniform(self.keys[docs], sample, pos, 3)))
        score = -np.logaddexp(-value, -g)
        for d, s, loc, p in zip(docs.tolist(), score.tolist(), location.tolist(), sets, strict=True):
            if loc > -np.inf:
                heapq.heappush(agenda[d], p._replace(key=-s, sample=sample))


def ids_of(path: np.ndarray, lattice: Lattices, first_byte: int) -> np.ndarray:
    """Piece ids of a path, every fallback (-1) spelled out in byte pieces."""
    piece = lattice.piece[path]
    lone = np.flatnonzero(piece < 0)
    if not len(lone):
        return piece.astype("<u4")
    chars = lattice.chars[lattice.node[path[lone]]]
    piece[lone] = first_byte + chars  # right for ASCII, one byte each
    ids = piece.astype("<u4")
    wide = chars > 127
    if not wide.any():
        return ids
    spelled = [list(chr(c).encode()) for c in chars[wide].tolist()]
    ids[lone[wide]] = [first_byte + x[0] for x in spelled]
    after = np.repeat(lone[wide] + 1, [len(x) - 1 for x in spelled])
    return np.insert(ids, after, [first_byte + b for x in spelled for b in x[1:]])


def decode(ids: np.ndarray, vocab: Vocabulary) -> bytes:
    """UTF-8 text of the ids: pieces joined, without the blank put before them."""
    return b"".join(map(vocab.bytes.__getitem__, ids.tolist()))[1:]


def decode_all(ids: list[np.ndarray], vocab: Vocabulary) -> list[bytes]:
    """``decode`` of every list, the pieces of all fetched in one go."""
    if not ids:
        return []
    found = vocab.pieces.take(pa.array(np.concatenate(ids)))
    offsets = np.frombuffer(found.buffers()[1], dtype=np.int64)[found.offset:]
    ends = offsets[np.cumsum([0, *map(len, ids)])].tolist()
    data = memoryview(found.buffers()[2] or b"")
    return [bytes(data[a + 1:b]) for a, b in itertools.pairwise(ends)]


ADDED = {"sample": pa.int32(), "ids": pa.binary(), "n_pieces": pa.int64(), "log_prob": pa.float64(),
         "perturbed": pa.float64(), "log_inclusion": pa.float64()}


def sample_segmentations(docs: DataFrame, model: str, k: int = 2, alpha: float = 0.5, seed: int = 0,
                         id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
                         decoded: bool = False) -> DataFrame:
    """For each row up to ``k`` rows: ``docs`` (or its columns ``keep``) with
    ``sample`` (from 0, best noisy score first), ``ids`` (little-endian unsigned
    32-bit piece ids, without begin and end), ``n_pieces``, ``log_prob`` and
    ``perturbed`` (without and with noise) and ``log_inclusion``: the log
    probability that the sample is among the k, given the best score outside
    (0 if nothing is outside); with ``decoded`` also ``decoded``, the text that
    the ids give.  Input columns of these names are replaced.
    ``alpha`` flattens (below 1) or sharpens the distribution.

    Null and empty texts have one, empty, segmentation.  A text of fewer than k
    segmentations gives all of them.  Noise comes from the id (null counts as a
    value of its own) and the seed: rows equal in id and text give equal samples.
    The blank that the model expects before a text is added here and dropped by
    decoding.  A null byte or any other character without a piece falls back to
    bytes, so decoding gives back every text.  An empty table gives an empty one.
    Time and memory follow the length of a text; only a stretch that pieces cover
    without a gap, such as one letter a million times, is walked a character a step."""
    require(docs, [id_col, text_col])
    added = [*ADDED, *["decoded"] * decoded]
    rest = [c for c in (docs.columns if keep is None else keep) if c not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model)
        for b in by_bytes(batches, len(rest), SLICE):
            texts = [t.decode("utf-8", "replace") for t in binary_values(b.column(len(rest)))]
            keys = b.column(len(rest) + 1).to_numpy(zero_copy_only=False).view(np.uint64)
            sampler = Sampler(texts, keys, vocab, alpha)
            found = sampler.run(k)
            rows = pa.array([d for d, s in enumerate(found) for _ in s], pa.int32())
            flat = [s for samples in found for s in samples]
            ids = [ids_of(s["path"], sampler.lattice, vocab.first_byte) for s in flat]
            yield pa.RecordBatch.from_arrays([
                *[b.column(i).take(rows) for i in range(len(rest))],
                pa.array([i for s in found for i in range(len(s))], pa.int32()),
                pa.array([i.tobytes() for i in ids], pa.binary()), pa.array([len(i) for i in ids], pa.int64()),
                *[pa.array([s[c] for s in flat], pa.float64()) for c in ("log_prob", "perturbed", "log_inclusion")],
                *[pa.array(decode_all(ids, vocab), pa.binary()).cast(pa.string()) for _ in range(decoded)],
            ], names=[*[f"c{i}" for i in range(len(rest))], *added])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*[f"c{i} {kinds[c]}" for i, c in enumerate(rest)], "sample int, ids binary, n_pieces long, "
                        "log_prob double, perturbed double, log_inclusion double" + ", decoded string" * decoded])
    out = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], text_bytes(f"`{text_col}`").alias("__t"),
                      F.xxhash64(F.col(f"`{id_col}`"), F.lit(seed)).alias("__key"))
    return out.mapInArrow(run, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], *added)


def decode_ids(df: DataFrame, model: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col``, the text of ``ids_col``; null ids give null."""
    @F.pandas_udf("string")
    def text(ids):
        vocab = vocabulary(model)
        return ids.map(lambda x: None if x is None else decode(np.frombuffer(x, dtype="<u4"), vocab).decode("utf-8", "replace"))

    return df.withColumn(out_col, text(F.col(f"`{ids_col}`")))
