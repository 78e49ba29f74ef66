"""Word vectors in shares against plain loops, and their Huffman tree."""

import heapq

import numpy as np
import pytest
from pyspark.ml.feature import Word2Vec

from cauce.operators import word_vectors as WV
from cauce.plans import mlops


def tree_of(counts):
    weights, run = np.unique(counts, return_inverse=True)
    sizes, order = np.bincount(run), np.argsort(run, kind="stable")
    node = np.empty(len(counts), np.int64)
    node[order] = np.arange(len(counts)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return WV.Tree(weights, sizes).paths(run, node)


@pytest.mark.parametrize("seed", range(20))
def test_tree_over_runs_is_a_huffman_tree(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(1, rng.integers(2, 50), rng.integers(1, 60))
    nodes, codes, depth = tree_of(counts)
    heap, cost = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        heapq.heappush(heap, both)
        cost += both
    assert (counts * depth).sum() == cost
    # a node is the place after one code, and no word's code begins another's
    before = {}
    for n, c, d in zip(nodes, codes, depth):
        assert all(before.setdefault(n[i], tuple(c[:i])) == tuple(c[:i]) for i in range(d)) and (n[d:] == -1).all()
    assert len(set(before.values())) == len(before) == len(counts) - 1
    assert len({tuple(c[:d]) for c, d in zip(codes, depth)}) == len(counts)


def plain(words, sizes, nodes, codes, depth, vectors, rate=WV.RATE):
    """Spark's loops with a window of one word, a word's pairs at a time."""
    inner, text, n = np.zeros((nodes.max() + 1, vectors.shape[1])), np.repeat(np.arange(len(sizes)), sizes), len(words)
    for i in range(n):
        alpha = rate * max(1 - i / n, WV.LEAST_RATE)
        for j in (i - 1, i + 1):
            if 0 <= j < n and text[i] == text[j]:
                back = 0
                for node, code in zip(nodes[words[i], :depth[words[i]]], codes[words[i]]):
                    f = vectors[words[j]] @ inner[node]
                    if abs(f) < WV.MAX_EXP:
                        g = alpha * (1 - code - 1 / (1 + np.exp(-f)))
                        back = back + g * inner[node]
                        inner[node] += g * vectors[words[j]]
                vectors[words[j]] += back


def corpus(seed, n, vocabulary=30):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(0, 12, n)
    words = np.minimum(rng.geometric(0.15, sizes.sum()) - 1, vocabulary - 1)
    words = np.unique(words, return_inverse=True)[1]
    nodes, codes, depth = tree_of(np.bincount(words))
    order = np.lexsort(codes.T[::-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    return number[words], sizes, nodes[order], codes[order], depth[order]


def test_small_steps_are_those_of_plain_loops(monkeypatch):
    monkeypatch.setattr(WV, "STEP", 1)
    args = corpus(3, 2000)
    want, got = (np.random.default_rng(1).normal(size=(len(args[4]), 8)).astype(t) / 4 for t in (float, np.float32))
    start = want.copy()
    plain(*args, want)
    assert WV.train(*args, got, 1, 0).all()
    assert np.abs(want - start).max() > 0.2 and np.abs(want - got).max() < 0.1 * np.abs(want - start).max()


def test_large_steps_stay_finite_and_tell_the_topics():
    rng = np.random.default_rng(5)
    words, sizes = [], rng.integers(20, 60, 600)
    for i, n in enumerate(sizes):
        words += [*((rng.geometric(0.1, n) % 20) * 2 + i % 2)]
    words = np.array(words)
    nodes, codes, depth = tree_of(np.bincount(words))
    order = np.lexsort(codes.T[::-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    v = WV.start_vectors(np.arange(len(order)), 32, 42)
    assert len(np.unique(v)) > 1000 and np.abs(v).max() <= 0.5 / 32
    assert WV.train(np.tile(number[words], 5), np.tile(sizes, 5), nodes[order], codes[order], depth[order], v, 5, 0).all()
    v = v[number] / np.sqrt((v[number] ** 2).sum(axis=1))[:, None]
    cos, same = v @ v.T, np.arange(40)[:, None] % 2 == np.arange(40) % 2
    assert np.isfinite(cos).all() and cos[same].mean() > cos[~same].mean() + 0.3


def test_words_of_no_pair_keep_their_vectors_and_no_model_lies_on_the_driver(spark, monkeypatch, tmp_table_dir):
    monkeypatch.setattr(mlops, "WORD2VEC_SHARE", 400)
    rows = [(i, f"Red{i % 3} green blue{i % 5}, green red{i % 3}") for i in range(150)] + [(900, "alone"), (901, None), (902, ""), (None, "ñandú_1 ñandú_1")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_table_dir}/documents.parquet")

    def no_fit(*a, **k):
        raise AssertionError("the words would lie on the driver")
    monkeypatch.setattr(Word2Vec, "fit", no_fit)
    got = {r.word: r.vector.toArray() for r in mlops.t22(spark, tmp_table_dir).collect()}
    words = {"green", "alone", "ñandú_1", *(f"red{i}" for i in range(3)), *(f"blue{i}" for i in range(5))}
    assert set(got) == words and mlops.t22(spark, tmp_table_dir).count() == len(words)
    assert 0 < np.abs(got["alone"]).max() <= 0.5 / 32 and np.isfinite(list(got.values())).all()
    near = {r.word: r for r in mlops.t23(spark, tmp_table_dir).collect()}
    assert set(near) == {"green", "red0", "red1", "red2", "blue0"}
    assert all(len(r.near_w2) == len(r.near_w5) == 5 and r.word not in r.near_w2 and 0 <= r.jaccard <= 1 for r in near.values())


def test_a_share_without_words_and_shares_of_equal_words(spark):
    d = spark.createDataFrame([(None,), ("",), ("!",)], "text string")
    assert WV.WordShares(d, 2).vectors(2).collect() == []
    d = spark.createDataFrame([("one",), ("one",), ("one",)], "text string")
    got = WV.WordShares(d, 3).vectors(2).collect()
    assert [r.word for r in got] == ["one"] and len(got[0].vector) == 32
    d = spark.createDataFrame([("a b",)] * 8, "text string")
    shares = WV.WordShares(d, 2)
    assert shares.counted.filter("block < 0").count() >= 1 and {r.word for r in shares.vectors(2).collect()} == {"a", "b"}
    # nearest words by cosine; ties by word
    v = spark.createDataFrame([("p", [1.0, 0.0]), ("q", [2.0, 0.1]), ("s", [0.0, 3.0]), ("r", [0.0, 1.0]), ("z", [0.0, 0.0])], "word string, vector array<float>")
    assert WV.nearest_words(v, ["p", "r"], 2) == {"p": ["q", "r"], "r": ["s", "q"]}
