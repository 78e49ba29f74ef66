"""Benchmark decontamination by latent semantic retrieval.

1. Benchmark texts are cut into passages; document frequencies over all
   passages give the term weights of a TF-IDF matrix (passages x terms).
2. Per block of BLOCK passages a randomised SVD finds the latent space: each
   power step sends a basis to the tasks, sums A'(A Q) by partition and by
   slice of terms, and orthonormalises the sum (terms x rank, bounded by the
   block's size, whatever the size of the benchmark).
3. Every window of every document (WINDOW words, half overlapping) is folded
   in and compared with the block's passages by cosine.  A window can only
   come near a passage if the block's terms carry some of its weight, so
   windows below MIN_MASS are passed over before they are projected.
4. Candidates are verified on words: the longest common subsequence of passage
   and window must cover VERBATIM of the passage, or PARAPHRASE of it if the
   answer (the passage's last words) is there too.

Documents are scanned once a block and never shuffled.

Cases: null and empty texts and passages without words match nothing; ties do
not matter, as all passages above the limits count; a document and item give
one row, also when the document is repeated; an empty benchmark matches nothing.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cauce.llm.common import map_rows, prepare, saved

#: Words of a passage, and the step of longer benchmark texts.
PASSAGE, PASSAGE_STEP = 64, 32
#: Passages of one latent space.  Its rank is their number, so that no passage loses a part and cosines do not
#: fall as the benchmark grows; an index holds about BLOCK * PASSAGE terms x BLOCK floats (16 MB).
BLOCK, POWER_STEPS = 256, 2
STEP = 16
WINDOW = 2 * STEP
MIN_MASS, MIN_COSINE = 0.2, 0.35
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.6, 0.6
ANSWER_WORDS = 8
SLICE = 1024
#: Blocks of words of one text that are projected at once.
BLOCKS = 1024

#: Everything in ASCII that is no letter or digit ends a word.
_BLANK = bytes(32 if c < 128 and not chr(c).isalnum() else c for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_BLANK).split()


def passages(benchmark: DataFrame) -> DataFrame:
    """pid, item_id, terms: the passages of all items, numbered once they are written."""

    def run(parts):
        for p in parts:
            out = {"item_id": [], "terms": []}
            for item, text in zip(p["item_id"], p["text"]):
                words = terms_of(text)
                last = max(0, -(-(len(words) - PASSAGE) // PASSAGE_STEP))
                for k in range(last + 1 if words else 0):
                    out["item_id"].append(item)
                    out["terms"].append(words[k * PASSAGE_STEP:k * PASSAGE_STEP + PASSAGE])
            yield out

    rows = map_rows(benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")), run, "item_id long, terms array<binary>")
    numbered = rows.withColumn("pid", F.monotonically_increasing_id())
    return saved(numbered, "passages")


class Index:
    """What a task needs to search one block: terms, weights, latent space, passages."""

    def __init__(self, items, texts, weight, unseen):
        names = sorted(weight)
        self.terms = {t: i for i, t in enumerate(names)}
        self.weights = np.array([weight[t] for t in names] + [unseen])  # the last is for terms outside
        self.items, self.texts, self.unseen = items, texts, unseen
        self.weighted = self.latent = None

    def vector(self, terms) -> tuple[np.ndarray, np.ndarray]:
        """Columns and unit-length TF-IDF weights of a passage."""
        count = Counter(self.terms[t] for t in terms)
        columns = np.fromiter(count, np.int64, len(count))
        values = np.fromiter(count.values(), float, len(count)) * self.weights[columns]
        return columns, values / np.linalg.norm(values)

    def windows(self, terms: list[bytes]) -> list[tuple[int, int, np.ndarray]]:
        """(start, end, passages) of the windows with candidates.  A window is two neighbouring blocks of STEP words."""
        get, out = self.terms.get, len(self.terms)
        ids = np.array([get(t, out) for t in terms], np.int64)
        known = ids < out
        squares = self.weights[ids] ** 2
        starts = np.arange(0, len(ids), STEP)
        norm, mass = (np.add.reduceat(x, starts) for x in (squares, squares * known))
        if len(starts) > 1:
            norm, mass = norm[:-1] + norm[1:], mass[:-1] + mass[1:]
        some = mass >= MIN_MASS * norm
        if not some.any():
            return []
        own = np.flatnonzero(known)
        least = MIN_COSINE * np.sqrt(norm)
        found = []
        for k in range(0, len(norm), BLOCKS):
            end = min(k + BLOCKS, len(norm))
            edges = np.searchsorted(own, starts[k:end + 1])
            stop = np.searchsorted(own, min(len(ids), (end + 1) * STEP))
            rows = self.weighted[ids[own[edges[0]:stop]]]
            sums = np.zeros((len(edges), rows.shape[1]), np.float32)
            filled = np.diff(np.append(edges, stop)) > 0
            sums[filled] = np.add.reduceat(rows, edges[filled] - edges[0], axis=0) if filled.any() else 0
            points = sums[:-1] + sums[1:] if len(norm) < len(starts) else sums
            near = (points @ self.latent.T >= least[k:end, None]) & some[k:end, None]
            for i in np.flatnonzero(near.any(axis=1)):
                s = int(starts[k + i])
                found.append((s, min(s + WINDOW, len(ids)), np.flatnonzero(near[i])))
        return found

    def hits(self, text: str | None) -> dict[int, tuple[int, int]]:
        """item -> (common words, passage words) of its best verified passage."""
        terms, best = terms_of(text), {}
        for s, e, near in self.windows(terms) if terms else ():
            for k in near:
                passage = self.texts[k]
                region = terms[max(0, s - len(passage)):e + len(passage)]
                item, n = self.items[k], len(passage)
                there = set(region)
                if sum(t in there for t in passage) < PARAPHRASE * n:
                    continue  # too few of its words for any common subsequence
                common = common_words(passage, region)
                if common >= VERBATIM * n or common >= PARAPHRASE * n and answered(passage, region):
                    if item not in best or common * best[item][1] > best[item][0] * n:
                        best[item] = common, n
        return best


def common_words(a: list, b: list) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``."""
    at: dict = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        m = at.get(x)
        if m is not None:
            u = row & m
            row = (row + u | row - u) & full
    return len(a) - row.bit_count()


def answered(passage: list, region: list) -> bool:
    """Enough of the passage's last words are in the region."""
    answer = Counter(passage[-ANSWER_WORDS:])
    return sum((answer & Counter(region)).values()) >= ANSWER * sum(answer.values())


def indexes(benchmark: DataFrame):
    """One Index a block of passages.  Weights come from all passages."""
    found = passages(benchmark)
    n = found.count()
    if not n:
        return
    counts = saved(found.select("pid", F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")), "terms")
    for k in range(-(-n // BLOCK)):
        block = found if n <= BLOCK else found.where(F.pmod(F.xxhash64("pid"), F.lit(-(-n // BLOCK))) == k)
        block = saved(block, "block")
        own = block.select(F.explode("terms").alias("term")).distinct().join(counts, "term").collect()
        rows = block.orderBy("pid").collect()  # BLOCK passages of PASSAGE words or so
        weight = {bytes(r["term"]): math.log(1 + n / r["n"]) for r in own}
        index = Index([r["item_id"] for r in rows], [list(map(bytes, r["terms"])) for r in rows], weight, math.log(1 + 2 * n))
        basis = latent_basis(block, index).astype(np.float32)
        index.latent = np.stack([v.astype(np.float32) @ basis[c] for c, v in map(index.vector, index.texts)])
        index.weighted = basis * index.weights[:-1, None].astype(np.float32)
        yield index


def latent_basis(block: DataFrame, index: Index) -> np.ndarray:
    """terms x rank: leading right singular vectors of the block's matrix."""
    size = len(index.terms)
    k = min(size, len(index.texts))
    basis = np.linalg.qr(np.random.default_rng(5).standard_normal((size, k)))[0]
    for _ in range(POWER_STEPS):
        basis = np.linalg.qr(gram_times(block, index, basis))[0]
    values, turn = np.linalg.eigh(basis.T @ gram_times(block, index, basis))
    return basis @ turn[:, np.argsort(-values)]


def gram_times(block: DataFrame, index: Index, basis: np.ndarray) -> np.ndarray:
    """A'(A Q), summed by partition and then by slice of terms."""
    spark = block.sparkSession
    sent = spark.sparkContext.broadcast((index.terms, index.weights, basis))

    def run(parts):
        terms, weights, q = sent.value
        own = Index.__new__(Index)
        own.terms, own.weights = terms, weights
        total = np.zeros_like(q)
        for p in parts:
            for t in p["terms"]:
                c, v = own.vector(t)
                total[c] += v[:, None] * (v @ q[c])
        for at in range(0, len(total), SLICE):
            if (piece := total[at:at + SLICE]).any():
                yield {"slice": [at], "part": [piece.tobytes()]}

    def add(pdf):
        total = sum(np.frombuffer(b) for b in pdf["part"])
        return pd.DataFrame({"slice": [pdf["slice"].iloc[0]], "part": [total.tobytes()]})

    out = np.zeros_like(basis)
    for r in map_rows(block.select("terms"), run, "slice int, part binary").groupBy("slice").applyInPandas(add, "slice int, part binary").toLocalIterator():
        piece = np.frombuffer(r["part"]).reshape(-1, basis.shape[1])
        out[r["slice"]:r["slice"] + len(piece)] = piece
    sent.unpersist()
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, common_words, item_words for every document and item found in it."""
    spark = docs.sparkSession
    prepare(spark)
    out = spark.createDataFrame([], "doc_id long, item_id long, common_words long, item_words long")
    for index in indexes(benchmark):
        sent = spark.sparkContext.broadcast(index)

        def run(parts, sent=sent):
            for p in parts:
                found = [(d, item, c, n) for d, t in zip(p["doc_id"], p["text"]) for item, (c, n) in sorted(sent.value.hits(t).items(), key=str)]
                yield dict(zip(("doc_id", "item_id", "common_words", "item_words"), zip(*found) if found else [()] * 4))

        out = out.unionByName(map_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, out.schema.simpleString()))
    best = F.max(F.struct((F.col("common_words") / F.col("item_words")).alias("share"), "common_words", "item_words"))
    return out.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.common_words", "best.item_words")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    spark = docs.sparkSession
    prepare(spark)
    for index in indexes(benchmark):
        docs = docs.where(clean(spark.sparkContext.broadcast(index))(F.col("text").cast("string")))
    return docs


def clean(sent):
    @F.pandas_udf("boolean")
    def without_hits(text: pd.Series) -> pd.Series:
        return pd.Series([not sent.value.hits(t) for t in text], dtype=bool)

    return without_hits
