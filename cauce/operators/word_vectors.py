"""Word2Vec on any number of words (T22, T23): skip-gram with hierarchical softmax, as in Spark.

Spark's own trainer keeps every word with its Huffman path on the driver and sends all
vectors to every task.  Here the texts are dealt into shares of bounded size.  A
share numbers its own words; what concerns a word leaves the share once, in
arrays of one of the ``buckets`` that the words' hashes give.  Buckets add up the
counts and number their words among those of the same count.  The Huffman tree
is built over runs of equal weights, so the driver holds a few numbers for each
*distinct* count of a bucket, not for a word, and a share finds the paths of its
words by these runs.  A share trains its words' vectors and the inner nodes on
their paths, which start alike in all shares; a bucket averages each word's
vectors over the shares that trained it, as Spark does over its partitions.

A share is read once, in steps of ``STEP`` words, whose gradients are taken at the
same point.  A vector that takes part in many pairs of a step would be
moved too far by their sum, so its rate r becomes r / (1 + r * h), where h bounds the
curvature of those pairs: a step of any size stays stable, and for
vectors of few pairs it is the plain one.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cauce.functions import strings as S
from cauce.operators.term_blocks import arrow_rows, buckets_of, flat, from_planes, joined_terms, list_sizes, planes, saved, split_terms

#: Words of a step, of a row of a share, and of one kind that are multiplied together; the rate falls to this part of it at the end of a share.
STEP, PIECE, CHUNKS = 1 << 14, 1 << 18, (1, 4, 16)
RATE, LEAST_RATE, MAX_EXP = 0.025, 1e-4, 6.0

#: Rows with a bucket: ``joined`` words and ``counts``; others: ``codes`` (see ``planes``) of the words of texts of these ``sizes``.
SHARES = "block int, bucket int, piece int, sizes array<int>, codes binary, joined string, counts array<long>"
#: Each word's count in all shares, and its rank among its bucket's words of that count; block -1: words of each count.
COUNTED = "block int, bucket int, counts array<long>, ranks array<int>"
#: ``codes``: the vectors' bytes, packed.
VECTORS = "block int, bucket int, trained array<int>, codes binary"


class Tree:
    """A Huffman tree over runs of leaves of equal weight.

    A run's nodes 2i and 2i + 1 are the children of node i of the run ``up``, its last
    one or two may have other parents (``odd``: node, run, code)."""

    def __init__(self, weights: np.ndarray, sizes: np.ndarray):
        self.pairs, self.up, self.odd, self.sizes = [], [], [], []
        heap = [(int(w), self._run(int(n)), int(n)) for w, n in zip(weights, sizes)]
        heapq.heapify(heap)
        while heap:
            w, a, n = heapq.heappop(heap)
            if n > 1:
                self.pairs[a], self.up[a] = n // 2, self._run(n // 2)
                heapq.heappush(heap, (2 * w, self.up[a], n // 2))
            if n % 2 and heap:
                v, b, m = heapq.heappop(heap)
                top = self._run(1)
                self.odd[a].append((n - 1, top, 0))
                self.odd[b].append((m - 1, top, 1))
                if m > 1:
                    heapq.heappush(heap, (v, b, m - 1))
                heapq.heappush(heap, (v + w, top, 1))
        #: a run's first inner node; runs of leaves have none
        leaves = len(weights)
        inner = np.r_[np.zeros(leaves, np.int64), self.sizes[leaves:]].astype(np.int64)
        self.first = np.cumsum(inner) - inner
        self.table = np.full((len(self.sizes), 8), -1, np.int64)
        for r, (p, u, odd) in enumerate(zip(self.pairs, self.up, self.odd)):
            self.table[r, :2] = p, u
            for i, o in enumerate(odd):
                self.table[r, 2 + 3 * i:5 + 3 * i] = o

    def _run(self, n: int) -> int:
        self.pairs.append(0)
        self.up.append(-1)
        self.odd.append([])
        self.sizes.append(n)
        return len(self.sizes) - 1

    def paths(self, run: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each leaf, from the root: its inner nodes, the codes, and how many they are."""
        run, node, at, nodes, codes = run.astype(np.int64), node.astype(np.int64), np.arange(len(run)), [], []
        depth = np.zeros(len(run), np.int64)
        while len(at):
            t = self.table[run[at]]
            i = node[at]
            pair = i < 2 * t[:, 0]
            first, second = ~pair & (i == t[:, 2]), ~pair & (i == t[:, 5])
            up = np.where(pair, t[:, 1], np.where(first, t[:, 3], np.where(second, t[:, 6], -1)))
            code = np.where(pair, i % 2, np.where(first, t[:, 4], t[:, 7]))
            to = np.where(pair, i // 2, 0)
            going = up >= 0
            at, up, code, to = at[going], up[going], code[going], to[going]
            if not len(at):
                break
            run[at], node[at] = up, to
            one, other = np.full(len(run), -1, np.int64), np.full(len(run), -1, np.int8)
            one[at], other[at] = self.first[up] + to, code
            nodes.append(one)
            codes.append(other)
            depth[at] += 1
        if not nodes:
            return np.empty((len(run), 0), np.int64), np.empty((len(run), 0), np.int8), depth
        # from the leaf to the root so far
        back = depth[:, None] - 1 - np.arange(len(nodes))
        turn = lambda x: np.where(back >= 0, np.take_along_axis(np.stack(x, axis=1), np.maximum(back, 0), axis=1), -1)
        return turn(nodes), turn(codes), depth


def _sums(rows: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of neighbouring stretches of the rows in this order; ``first``: where each stretch begins.  Pairs are added, then pairs of those."""
    size = np.diff(np.r_[first, len(order)])
    rows = np.take(rows, order, axis=0)
    while len(rows) > len(size):
        at = np.arange(len(rows)) - np.repeat(np.cumsum(size) - size, size)
        odd = np.flatnonzero(at & 1)
        kept = np.flatnonzero(~at & 1)
        added = np.take(rows, odd, axis=0)
        rows = np.take(rows, kept, axis=0)
        # an odd row's partner is the one before it
        rows[odd - 1 - np.cumsum(at & 1)[odd - 1]] += added
        size = (size + 1) // 2
    return rows


def _moved(vectors: np.ndarray, at: np.ndarray, bend: np.ndarray, moves: np.ndarray, rate: np.float32) -> None:
    """Each vector goes along the sum of its moves, the less the more they bend."""
    order = np.argsort(at, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0])
    bound = np.add.reduceat(bend[order], first)
    vectors[at[order[first]]] += _sums(moves, order, first) * (rate / (1 + rate * bound)).astype(np.float32)[:, None]


def _chunks(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted words the size of the chunk of equal ones each is in, and its place there: as many large chunks as are
    full, then smaller ones, of which a word's last may not be."""
    one, some, many = CHUNKS
    first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
    size = np.diff(np.r_[first, len(words)])
    rank, size = np.arange(len(words)) - np.repeat(first, size), np.repeat(size, size)
    full = size // many * many
    chunk = np.where(rank < full, many, np.where(size - full == 1, one, some))
    return chunk, np.where(rank < full, rank, rank - full) % chunk


def train(words: np.ndarray, sizes: np.ndarray, nodes: np.ndarray, codes: np.ndarray, depth: np.ndarray, vectors: np.ndarray,
          window: int, seed) -> np.ndarray:
    """Trains ``vectors`` of words in place over texts of ``sizes`` words; tells which took part in a pair.

    The words are numbered in the order of their codes, so that those below a node are neighbours."""
    rng, n, k = np.random.default_rng(seed), len(words), vectors.shape[1]
    # paths end in a node that stays zero and asks for nothing, up to a multiple of four
    level = -(-depth // 4) * 4
    wide = int(level.max(initial=0))
    rest = np.zeros((len(nodes), max(wide - nodes.shape[1], 0)), np.int64) - 1
    count, path = int(nodes.max(initial=-1)) + 1, np.concatenate([nodes, rest], axis=1)
    path = np.where(path < 0, count, path).astype(np.int64)
    want = np.where(path < count, 1.0 - np.concatenate([codes, rest], axis=1), 0.5).astype(np.float32)
    inner = np.zeros((count + 1, k), np.float32)
    trained, offsets = np.zeros(len(vectors), bool), np.r_[-window:0, 1:window + 1]
    edge = np.zeros(window, np.int64)
    words = np.concatenate([edge, words, edge])
    text = np.concatenate([edge - 1, np.repeat(np.arange(len(sizes)), sizes), edge - 1])
    for lo in range(0, n, STEP):
        hi = min(lo + STEP, n)
        rate = np.float32(RATE * max(1 - lo / n, LEAST_RATE))
        own, doc, near = words[lo:hi + 2 * window], text[lo:hi + 2 * window], window - rng.integers(0, window, hi - lo)
        x = vectors[own]
        square, move, curve, met, told = (x * x).sum(axis=1), np.zeros_like(x), np.zeros(len(x), np.float32), np.zeros(len(x), bool), []
        order = np.argsort(own[window:window + hi - lo], kind="stable")
        levels, chunk, slot = level[own[window + order]], *_chunks(own[window + order])
        for deep, wide in sorted({*zip(levels.tolist(), chunk.tolist())} - {(0, k) for k in CHUNKS}):
            some = np.flatnonzero((levels == deep) & (chunk == wide))
            row = np.cumsum(slot[some] == 0) - 1
            held, centre = np.zeros((row[-1] + 1, wide), bool), np.zeros((row[-1] + 1, wide), np.int64)
            held[row, slot[some]], centre[row, slot[some]] = True, order[some]
            at = centre[:, :, None] + window + offsets
            ok = (doc[at] == doc[centre + window][:, :, None]) & (np.abs(offsets) <= near[centre][:, :, None]) & held[:, :, None]
            mine = own[centre[:, 0] + window]
            p_at = path[mine, :deep]
            near_x, p = np.take(x, at.reshape(len(at), -1), axis=0), np.take(inner, p_at, axis=0)
            f = near_x @ p.transpose(0, 2, 1)
            g = want[mine, :deep][:, None, :] - 1 / (1 + np.exp(-f))
            g *= (np.abs(f) < MAX_EXP) & ok.reshape(len(ok), -1, 1)
            moved, moves = (g @ p).reshape(*at.shape, k), (g.transpose(0, 2, 1) @ near_x).reshape(-1, k)
            bend = 0.25 * np.einsum("ijk,ijk->i", p, p)[row]
            # an offset's places are distinct
            for j in range(2 * window):
                to, has = at[:, :, j][held], ok[:, :, j][held]
                move[to] += moved[:, :, j][held]
                curve[to] += bend * has
                met[to] |= has
            line = p_at.T.ravel()
            first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
            told.append((line[first], np.add.reduceat(np.tile(0.25 * (square[at] * ok).sum(axis=(1, 2)), deep), first),
                         _sums(moves, np.arange(len(moves)).reshape(-1, deep).T.ravel(), first)))
        if not told:
            continue
        _moved(inner, *map(np.concatenate, zip(*told)), rate)
        _moved(vectors, own, curve, move, rate)
        trained[own[met]] = True
    return trained


def _packed(vectors: np.ndarray) -> bytes:
    """Floats by their lowest bytes, then the next ones and so on: the exponents take little room."""
    return pa.compress(planes(vectors.ravel().view(np.int32)), codec="zstd", asbytes=True)


def _unpacked(x: pa.Scalar, n: int, size: int) -> np.ndarray:
    return from_planes(pa.scalar(pa.decompress(x.as_buffer(), n * size * 4, codec="zstd").to_pybytes())).view(np.float32).reshape(n, size)


def start_vectors(numbers: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Starting vectors of words by their numbers, between -0.5 and 0.5 over ``size``."""
    with np.errstate(over="ignore"):
        z = numbers.astype(np.uint64)[:, None] * np.uint64(size) + np.arange(size, dtype=np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(by)
        z ^= z >> np.uint64(31)
    return (((z >> np.uint64(40)).astype(np.float64) / (1 << 24) - 0.5) / size).astype(np.float32)


class WordShares:
    """The words of ``texts`` (text) in ``shares``, counted, with the paths' tree."""

    def __init__(self, texts: DataFrame, shares: int):
        self.shares = shares
        toks = texts.select("text").repartition(shares).select(F.spark_partition_id().alias("block"), S.words(F.col("text"), min_len=1).alias("words"))

        def run(batches):
            held = [b for b in batches if b.num_rows]
            if not held:
                return
            t = pa.Table.from_batches(held)
            sizes, named = list_sizes(t.column("words")), flat(t.column("words")).dictionary_encode()
            bucket = buckets_of(named.dictionary, shares).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            number = np.empty(len(order), np.int64)
            number[order] = np.arange(len(order))
            codes = number[named.indices.to_numpy()]
            terms, counts = named.dictionary.take(pa.array(order)), np.bincount(codes, minlength=len(order))
            block, out, ends, lo = t.column("block")[0].as_py(), [], np.cumsum(sizes), 0
            while lo < len(sizes):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PIECE, side="right")))
                out.append({"block": block, "piece": len(out), "sizes": sizes[lo:hi], "codes": planes(codes[ends[lo] - sizes[lo]:ends[hi - 1]])})
                lo = hi
            cuts = np.searchsorted(bucket[order], np.arange(shares + 1))
            out += [{"block": block, "bucket": i, "joined": joined_terms(terms.slice(a, b - a)), "counts": counts[a:b]}
                    for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            yield from arrow_rows(SHARES, out).to_batches()

        rows = saved(toks.mapInArrow(run, SHARES), "word-shares")
        self.texts = rows.filter("bucket is null").select("block", "piece", "sizes", "codes")
        self.terms = rows.filter("bucket is not null").select("block", "bucket", "joined", "counts")
        self.counted = saved(self.terms.repartition(shares, "bucket").groupBy("bucket").applyInArrow(_counted, COUNTED), "word-counts")
        #: for each bucket: its distinct counts and how many words come before its own among those of the count
        got = sorted((r["bucket"], list(r["counts"]), list(r["ranks"])) for r in self.counted.filter("block < 0").collect())
        of = np.repeat([b for b, _, _ in got], [len(c) for _, c, _ in got]).astype(np.int64)
        count, size = (np.array([x for r in got for x in r[i]], np.int64) for i in (1, 2))
        weights, run = np.unique(count, return_inverse=True)
        order = np.lexsort((of, run))
        before = np.cumsum(size[order]) - size[order]
        sizes = np.bincount(run, size, len(weights)).astype(np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.before = np.empty(len(of), np.int64)
        self.before[order] = before - self.starts[run[order]]
        self.of, self.run, self.weights = of, run, weights
        self.tree = Tree(weights, sizes) if len(weights) else None

    def vectors(self, window: int, size: int = 32, seed: int = 42) -> DataFrame:
        """word, vector (array of floats); trained whenever they are read."""
        tree, of, runs, weights, before, starts = self.tree, self.of, self.run, self.weights, self.before, self.starts
        if tree is None:
            return self.terms.select(F.lit("").alias("word"), F.array().cast("array<float>").alias("vector")).limit(0)

        def one_share(t: pa.Table) -> pa.Table:
            kind = t.column("bucket").is_valid()
            own, rows = t.filter(kind).sort_by("bucket"), t.filter(pc.invert(kind)).sort_by("piece")
            held, block = list_sizes(own.column("counts")), t.column("block")[0].as_py()
            buckets = own.column("bucket").to_numpy()
            run, rank, bucket = np.searchsorted(weights, flat(own.column("counts")).to_numpy()), flat(own.column("ranks")).to_numpy(), np.repeat(buckets, held)
            # the place of (bucket, count), which are sorted
            at = np.searchsorted(of * len(weights) + runs, bucket.astype(np.int64) * len(weights) + run)
            leaf = before[at] + rank
            nodes, codes, depth = tree.paths(run, leaf)
            order = np.lexsort(codes.T[::-1]) if codes.shape[1] else np.arange(len(run))
            number = np.empty(len(order), np.int64)
            number[order] = np.arange(len(order))
            inner = np.unique(nodes[nodes >= 0])
            local = np.where(nodes >= 0, np.searchsorted(inner, nodes), -1)[order]
            vectors = start_vectors(starts[run] + leaf, size, seed)[order]
            sizes = flat(rows.column("sizes")).to_numpy()
            words = np.concatenate([np.empty(0, np.int32), *[from_planes(x) for x in rows.column("codes")]])
            trained = train(number[words], sizes, local, codes[order], depth[order], vectors, window, [seed, block])
            vectors, trained, ends = vectors[number], trained[number], np.cumsum(held)
            return arrow_rows(VECTORS, [{"block": block, "bucket": b, "trained": trained[e - n:e].astype(np.int32), "codes": _packed(vectors[e - n:e])}
                                        for b, e, n in zip(buckets, ends, held)])

        null = lambda *cs: [F.lit(None).cast(ty).alias(c) for c, ty in cs]
        texts = self.texts.select("block", "piece", "sizes", "codes", *null(("bucket", "int"), ("counts", "array<long>"), ("ranks", "array<int>")))
        counted = self.counted.filter("block >= 0").select("block", *null(("piece", "int"), ("sizes", "array<int>"), ("codes", "binary")), "bucket", "counts", "ranks")
        got = texts.unionByName(counted).repartition(self.shares, "block").groupBy("block").applyInArrow(one_share, VECTORS)

        def average(terms: pa.Table, found: pa.Table) -> pa.Table:
            terms = split_terms(terms.sort_by("block"))
            found = found.sort_by("block")
            named, ends, lo = flat(terms.column("terms")).dictionary_encode(), np.cumsum(list_sizes(terms.column("terms"))), 0
            code, n = named.indices.to_numpy(), len(named.dictionary)
            total, times, first = np.zeros((n, size)), np.zeros(n, np.int64), np.zeros((n, size), np.float32)
            for i, e in enumerate(ends):
                at, v = code[lo:e], _unpacked(found.column("codes")[i], e - lo, size)
                took = found.column("trained")[i].values.to_numpy() > 0
                total[at[took]] += v[took]
                times[at[took]] += 1
                first[at[~took]] = v[~took]
                lo = e
            mean = np.where(times[:, None] > 0, total / np.maximum(times, 1)[:, None], first).astype(np.float32)
            return pa.table({"word": named.dictionary, "vector": pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * size, pa.int32()), pa.array(mean.ravel()))})

        return self.terms.drop("counts").repartition(self.shares, "bucket").groupBy("bucket").cogroup(
            got.repartition(self.shares, "bucket").groupBy("bucket")).applyInArrow(average, "word string, vector array<float>")


def _counted(t: pa.Table) -> pa.Table:
    t = split_terms(t.sort_by("block"))
    size, named = list_sizes(t.column("terms")), flat(t.column("terms")).dictionary_encode()
    code, own = named.indices.to_numpy(), flat(t.column("counts")).to_numpy()
    total = np.zeros(len(named.dictionary), np.int64)
    ends = np.cumsum(size)
    for e, n in zip(ends, size):
        total[code[e - n:e]] += own[e - n:e]  # a block's words are distinct
    order = np.argsort(total, kind="stable")
    counts, first, held = np.unique(total[order], return_index=True, return_counts=True)
    rank = np.empty(len(total), np.int64)
    rank[order] = np.arange(len(total)) - np.repeat(first, held)
    bucket = t.column("bucket")[0].as_py()
    return arrow_rows(COUNTED, [{"block": -1, "bucket": bucket, "counts": counts, "ranks": held}, *[
        {"block": b, "bucket": bucket, "counts": total[code[e - n:e]], "ranks": rank[code[e - n:e]]}
        for b, e, n in zip(t.column("block").to_pylist(), ends, size)]])


def nearest_words(vectors: DataFrame, words: list[str], n: int) -> dict[str, list[str]]:
    """The ``n`` words whose vectors have the largest cosine with each word's (ties by word), the word itself left out."""
    vectors = saved(vectors, "word-vectors")
    asked = {r["word"]: np.array(r["vector"], float) for r in vectors.filter(F.col("word").isin(words)).collect()}
    if not asked:
        return {}
    unit = np.stack([v / (np.sqrt(v @ v) or 1.0) for v in asked.values()])
    names = list(asked)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, word = b.column("vector").flatten().to_numpy().reshape(b.num_rows, -1).astype(float), b.column("word")
            size = np.sqrt((x * x).sum(axis=1))
            cos = np.divide(x @ unit.T, size[:, None], out=np.zeros((len(x), len(names))), where=size[:, None] > 0)
            for j, name in enumerate(names):
                score = np.where(pc.equal(word, name).to_numpy(zero_copy_only=False), -np.inf, cos[:, j])
                # the batch's n best, with all that tie with the last
                least = np.partition(score, -n)[-n] if len(score) > n else -np.inf
                at = np.flatnonzero((score >= least) & (score > -np.inf))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), word.take(pa.array(at)), pa.array(score[at])],
                                                 names=["asked", "word", "cos"])

    best = Window.partitionBy("asked").orderBy(F.desc("cos"), "word")
    rows = vectors.select("word", "vector").mapInArrow(run, "asked string, word string, cos double") \
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n).collect()
    out = {w: [] for w in names}
    for r in sorted(rows, key=lambda r: r["rank"]):
        out[r["asked"]].append(r["word"])
    return out
