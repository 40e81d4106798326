"""The suffix tree against a slow model that holds everything in dictionaries."""

import collections
import math
import random
import types

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weirline.llm import _packed, suffix_tree_lm


def slow_scores(train, asked, depth, least=2, discount=0.5, whole=True):
    """(n_tokens, n_known, base, score) of each text asked for."""
    lists = [[None, *suffix_tree_lm.words_of(t), None] for t in train]
    grams = collections.Counter(tuple(x[i : i + k]) for x in lists for k in range(2, depth + 2) for i in range(len(x) - k + 1))
    contexts = collections.Counter(tuple(x[i : i + k]) for x in lists for k in range(1, depth + 1) for i in range(len(x) - k))
    unigrams = collections.Counter(w for x in lists for w in x[1:])
    n, v = sum(unigrams.values()), len(unigrams)
    kept = collections.defaultdict(dict)
    for g, c in grams.items():
        if c >= least:
            kept[g[:-1]][g[-1]] = (c - discount) / contexts[g[:-1]]
    weight = {c: 1 - sum(k.values()) for c, k in kept.items()}

    def p(c, w):
        if not c:
            return (unigrams[w] + 1) / (n + v + 1)
        return kept[c].get(w, 0) + weight[c] * p(c[1:], w) if c in weight else p(c[1:], w)

    stays = set()
    for c in sorted(weight, key=len):
        here, low = {w: p(c, w) for w in kept[c]}, {w: p(c[1:], w) for w in kept[c]}
        if whole:
            assert abs(sum(p(c, w) for w in [*unigrams, b" unseen"]) - 1) < 1e-9, "a distribution"
        gain = sum(q * math.log(q / low[w]) for w, q in here.items()) + weight[c] * (1 - sum(low.values())) * math.log(weight[c])
        if gain >= suffix_tree_lm.MIN_DIVERGENCE:
            stays |= {c[i:] for i in range(len(c))}
    out = []
    for t in asked:
        x, score, base = [None, *suffix_tree_lm.words_of(t), None], 0.0, 0.0
        for i in range(1, len(x)):
            state = next((s for k in range(min(i, depth), 0, -1) if (s := tuple(x[i - k : i])) in stays), ())
            score += math.log10(p(state, x[i]))
            base += math.log10(p((), x[i]))
        out.append((len(x) - 1, sum(unigrams[w] > 0 for w in x[1:]), base, score))
    return out, len(stays)


def corpus():
    r = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(r.choices(words, k=r.randint(0, 9))) for _ in range(60)] + ["a rare phrase of words"] * 2 + ["", None, "a rare end", "  Ünder \x0b straße\x1cx   İ  "]
    asked = [*texts, "a rare phrase unseen", "of words rare phrase of words", " ".join(words), "A RARE Phrase OF words", "straße\x1cx"]
    return texts, asked


@pytest.mark.parametrize("most", [suffix_tree_lm.MOST, 40])
def test_tree_scores_as_the_slow_model(spark, monkeypatch, most):
    """Broadcast or asked for, the result is the same."""
    monkeypatch.setattr(suffix_tree_lm, "MOST", most)
    texts, asked = corpus()
    want, nodes = slow_scores(texts, asked, 3)
    assert 20 < nodes < 60, "some contexts stay and some go"
    train = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    model = suffix_tree_lm.train(train, depth=3)
    got = {r.doc_id: r for r in suffix_tree_lm.score(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), model).collect()}
    for i, (n, known, base, score) in enumerate(want):
        assert (got[i].n_tokens, got[i].n_known) == (n, known)
        assert (got[i].base_score, got[i].score) == pytest.approx((base, score))


def test_a_phrase_seen_twice_is_kept_however_many_tokens(spark):
    train = spark.createDataFrame(list(enumerate(["a rare phrase of words"] * 2)), "doc_id long, text string")
    more = train.unionByName(spark.range(500).select((F.col("id") + 1000).alias("doc_id"), F.concat_ws(" ", *[F.concat(F.lit(f"x{j}y"), F.col("id")) for j in range(700)]).alias("text")))
    model = suffix_tree_lm.train(more)
    assert model.total > 300_000
    got = suffix_tree_lm.score(train, model).collect()
    assert len(got) == 2 and all(r.score > 0.3 * r.base_score for r in got)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, score string")
    model = suffix_tree_lm.train(empty)
    assert (model.total, model.vocabulary, model.length) == (0, 0, 0) and suffix_tree_lm.score(empty, model).count() == 0
    some = spark.createDataFrame([(None, "one", "s"), (None, "one", "s"), (3, None, None), (3, "", "x"), (4, "b " * 50_000, "y")], empty.schema)
    blind = suffix_tree_lm.score(some, model).collect()
    assert len(blind) == 5 and all(r.score == 0 and r.base_score == 0 and r.n_known == 0 for r in blind)
    got = suffix_tree_lm.score(some, suffix_tree_lm.train(some)).collect()
    assert sorted((r.doc_id is None, r.n_tokens) for r in got) == [(False, 1), (False, 1), (False, 50_001), (True, 2), (True, 2)]
    want, _ = slow_scores([r.text for r in some.collect()], [r.text for r in some.collect()], suffix_tree_lm.DEPTH)
    assert sorted(r.score for r in got) == pytest.approx(sorted(w[3] for w in want))


def test_words_of_one_hash_are_told_apart():
    keys, checks = np.array([3, 5, 5, 5, 9], np.uint64), np.array([1, 2, 4, 6, 1], np.uint64)
    at, hit = suffix_tree_lm._look_up(keys, checks, np.array([5, 5, 5, 9, 4, 3], np.uint64), np.array([4, 6, 3, 1, 1, 1], np.uint64))
    assert hit.tolist() == [True, True, False, True, False, True] and at[hit].tolist() == [2, 3, 4, 0]


def test_packed_columns_round_trip():
    columns = [np.arange(1000, dtype=np.uint64) ** 3, np.linspace(-1, 1, 1000), np.zeros(1000, np.uint32), np.zeros(0, np.int64)]
    back = _packed.unpack(_packed.pack(*columns))
    assert all(a.dtype == b.dtype and (a == b).all() for a, b in zip(columns, back, strict=True))
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2))
    rows = list(_packed.addressed("k", 7, 13, keys, keys + np.uint64(1)))
    assert [r[0] for r in rows] == sorted({int(x) for x in _packed.owner(keys, 13)}) and max(r[0] for r in rows) < 13
    assert (_packed.joined(r[3] for r in rows)[0] == keys).all()


def test_windows_and_chunks_lose_nothing(monkeypatch):
    texts, _ = corpus()
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    held = types.SimpleNamespace(value=np.full(1 << suffix_tree_lm.FILTER_BITS - 3, 255, np.uint8))

    def counts(length):
        rows = [_packed.unpack(r[3]) for r in suffix_tree_lm._count_grams(held, length, 5)([batch])]
        return collections.Counter({(k, c, s): 0 for r in rows for k, c, s, _ in zip(*r, strict=True)}) + sum((collections.Counter({(k, c, s): int(n)}) for r in rows for k, c, s, n in zip(*r, strict=True)), collections.Counter())

    whole = {length: counts(length) for length in (2, 3, 4)}
    assert sum(whole[2].values()) == sum(len(suffix_tree_lm.words_of(t)) + 1 for t in texts)
    for k, x in {"CHUNK_BYTES": 40, "WINDOW": 7, "GATHER": 9}.items():
        monkeypatch.setattr(suffix_tree_lm, k, x)
    assert {length: counts(length) for length in (2, 3, 4)} == whole
