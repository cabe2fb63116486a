import itertools
import math
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from retainspark.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocab():
    return pieces.vocabulary(MODEL)


def samples(texts, k, vocab, keys=None, alpha=0.5):
    keys = np.arange(1, len(texts) + 1, dtype=np.uint64) * np.uint64(7919) if keys is None else keys
    s = pieces.Sampler(texts, keys, vocab, alpha)
    out = s.run(k)
    for d in out:
        for x in d:
            x["ids"] = tuple(pieces.ids_of(x["path"], s.lattice, vocab.first_byte).tolist())
    return out


def distribution(text, vocab, alpha=0.5):
    """All segmentations with their log probabilities, from piece scores alone."""
    number = {b: i for i, b in enumerate(vocab.bytes) if vocab.score[i] > -np.inf}
    chars = " " + text

    def paths(i):
        if i == len(chars):
            yield (), 0.0
        ends = [j for j in range(i + 1, len(chars) + 1) if chars[i:j].encode() in number]
        for j in ends:
            one = number[chars[i:j].encode()]
            for rest, s in paths(j):
                yield (one, *rest), alpha * vocab.score[one] + s
        if i < len(chars) and i + 1 not in ends:
            for rest, s in paths(i + 1):
                yield (*[vocab.first_byte + b for b in chars[i].encode()], *rest), alpha * vocab.score[-1] + s

    all_ = dict(paths(0))
    z = math.log(sum(math.exp(s) for s in all_.values()))
    return {p: s - z for p, s in all_.items()}


def test_log_probabilities_and_completeness(vocab):
    for text in ["the ab", "a  b", "né\n漢x", "in on"]:
        want = distribution(text, vocab)
        got = samples([text], len(want) + 5, vocab)[0]
        assert {x["ids"] for x in got} == set(want)  # without replacement: each one once, all of them
        assert all(math.isclose(x["log_prob"], want[x["ids"]], abs_tol=1e-9) for x in got)
        assert [x["perturbed"] for x in got] == sorted((x["perturbed"] for x in got), reverse=True)
        assert all(x["log_inclusion"] == 0 for x in got)


def test_samples_follow_the_distribution_without_replacement(vocab):
    n, text = 30_000, "the ab"
    p = {k: math.exp(v) for k, v in distribution(text, vocab).items()}
    got = samples([text] * n, 3, vocab)
    triples = Counter(tuple(x["ids"] for x in s) for s in got)
    for a, b, c in itertools.islice(sorted(itertools.permutations(p, 3), key=lambda t: -p[t[0]] * p[t[1]] * p[t[2]]), 40):
        e = p[a] * p[b] / (1 - p[a]) * p[c] / (1 - p[a] - p[b])
        assert abs(triples[a, b, c] / n - e) < 5 * math.sqrt(e / n)
    # the inclusion scores make sums over the sample unbiased
    weights = [sum(math.exp(x["log_prob"] - x["log_inclusion"]) for x in s) for s in got]
    assert abs(np.mean(weights) - 1) < 5 * np.std(weights) / math.sqrt(n)


TEXTS = ["", " ", "\n", "a▁b  c ", "\x00é漢😀", "Hello  world\n ça va", "x" * 3000, "word " * 2000, None, "�\t;\r\n"]


def test_round_trip_and_special_rows(documents):
    rows = [*enumerate(TEXTS), (5, TEXTS[5]), (None, "null id")]
    out = pieces.sample_segmentations(documents(rows, extra=("ids", "sample", "__t")), MODEL, k=3, decoded=True)
    got = pieces.decode_ids(out, MODEL, out_col="again").collect()
    assert all(r.again == r.decoded for r in got)
    want = Counter((i, t) for i, t in rows)
    assert {(r.doc_id, r.text) for r in got} == set(want)
    for r in got:
        assert r.decoded == (r.text or "") and r.n_pieces * 4 == len(r.ids) and 0 <= r.sample < 3 and r["__t"] == 0
    for (i, t), times in want.items():
        own = [r for r in got if (r.doc_id, r.text) == (i, t)]
        assert len({r.ids for r in own}) * times == len(own)  # equal rows, equal samples
    assert [(r.n_pieces, r.log_inclusion) for r in got if r.doc_id == 0] == [(0, 0.0)]


def test_samples_depend_on_the_row_alone(documents):
    rows = [(i, f"some text number {i} here " * (1 + i % 7)) for i in range(40)]
    run = lambda n: {(r.doc_id, r.sample): (r.ids, r.perturbed) for r in pieces.sample_segmentations(
        documents(rows).repartition(n), MODEL, seed=4).collect()}
    one = run(1)
    assert one.keys() == run(7).keys()
    assert all(run_[0] == one[k][0] and math.isclose(run_[1], one[k][1], rel_tol=1e-9) for k, run_ in run(7).items())
    assert any(one[k][0] != v[0] for k, v in {(r.doc_id, r.sample): (r.ids,) for r in pieces.sample_segmentations(
        documents(rows), MODEL, seed=5).collect()}.items())


def test_decoding_agrees_with_the_library(vocab):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for x in samples(["Hello world, ça va 漢", "two  blanks"], 4, vocab):
        for s in x:
            assert sp.decode(list(s["ids"])) == pieces.decode(np.array(s["ids"]), vocab).decode()


def test_empty_table(documents):
    assert pieces.sample_segmentations(documents([]), MODEL).count() == 0


@pytest.mark.parametrize("far", [100, (1 << 23) - 1, 1 << 23, 1 << 24, 1 << 31])
def test_edges_far_from_their_units_end_stay_in_order(far):
    rng = np.random.default_rng(far)
    left, node = far - rng.integers(0, 5, 300), rng.integers(0, 10, 300)
    span = rng.permutation(300) % 16 + 1
    order = pieces._edge_order(left, node, span)
    got = list(zip(left[order].tolist(), node[order].tolist(), span[order].tolist()))
    assert got == sorted(zip(left.tolist(), node.tolist(), span.tolist()))


def test_words_are_cut_where_no_piece_reaches_over(vocab):
    words = [" the", " don't\n\nstop", "汉字\t漢字", "   ", " aaaa", "x"]
    lat = pieces.Lattices(words, vocab, 0.5)
    text = "".join(words)
    held = set()
    number = {b.decode() for i, b in enumerate(vocab.bytes) if vocab.score[i] > -np.inf}
    begin = 0
    for w in words:
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if w[i:j] in number:
                    held |= set(range(begin + i + 1, begin + j))
        begin += len(w)
    assert lat.first.tolist() == [i for i in range(len(text)) if i not in held]
    starts = np.cumsum([0, *map(len, words)])
    assert lat.parts.tolist() == [sum(a <= x < b for x in lat.first.tolist()) for a, b in itertools.pairwise(starts)]


@pytest.mark.parametrize("text", ["word\n" * 200_000, "12.5\tabc\r\n" * 100_000, "汉字没有空格的文本" * 110_000, "http://a.b/c?d=e&f=" * 50_000])
def test_a_million_characters_without_a_blank(text, vocab):
    begin = time.process_time()
    (found,) = samples([text], 2, vocab)
    assert time.process_time() - begin < 10
    assert len({s["ids"] for s in found}) == len(found)
    for s in found:
        assert pieces.decode(np.array(s["ids"]), vocab).decode() == text


def test_decoding_together_equals_one_by_one(vocab):
    found = [np.array(s["ids"], dtype="<u4") for d in samples(["Hello world", "", "ça va 漢\n", " ", "two  blanks"], 3, vocab) for s in d]
    assert pieces.decode_all(found, vocab) == [pieces.decode(i, vocab) for i in found]
    assert pieces.decode_all([], vocab) == [] and pieces.decode_all([found[0][:0]], vocab) == [b""]


def test_a_slice_of_texts_takes_little_memory(vocab):
    # a worker's share of an executor that earlier stages have filled; 45 MB at slices of 512 KB
    import tracemalloc
    rng = np.random.default_rng(0)
    words = ["".join(map(chr, rng.integers(97, 123, rng.integers(3, 9)))) for _ in range(4000)]
    texts, size = [], 0
    while size < pieces.SLICE:
        texts.append(" ".join(words[i] for i in rng.integers(0, 4000, 300)))
        size += len(texts[-1])
    tracemalloc.start()
    samples(texts, 2, vocab)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20
