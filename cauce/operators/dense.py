"""Exact nearest neighbours with a pruning index.

Items are indexed by k-means cells: centres fitted on a bounded sample of the
items (at most ``SAMPLE`` rows, those of smallest id hash), then every item is
given to its nearest centre, and a cell knows its size and the least and the
greatest distance of its items to the centre.  By the triangle inequality
these bound the score of any item of the cell for a query:

* Euclidean: the distance is at least ``|q - c| - r_max`` and ``r_min - |q - c|``;
* dot product: the score is at most ``<q, c> + |q| * r_max``.

A query first searches its most promising cell, which gives a floor for its
k-th score, and then the cells whose bound reaches the floor.  (query, cell)
pairs are dealt as rows, and cells in parts of about ``PART`` items, so that a
cell with a third of all items is many tasks; nothing that grows with queries
or items passes through the driver, which only sees the centres and one row a
cell.  Bounds decide what is scored and never the result: scores of the
survivors are summed component by component in one fixed order, equal vectors
have equal scores, and ranks are by (score desc, item id asc) of those.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.operators.relational import top_n_per_group
from cauce.session import scratch_path

SAMPLE, CENTRES, ROUNDS = 4096, 64, 8
PART, SLOT = 4096, 4096
#: Scores (queries x items) held at once by a task.
BLOCK = 1 << 21
LOWEST = float("-inf")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of doubles as rows; shorter ones are filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _apart(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances of rows to centres, one centre at a time (exact to the last digits, unlike |x|² + |c|² - 2xc)."""
    return np.stack([np.sqrt(((x - c) ** 2).sum(axis=1)) for c in centres], axis=1)


def fit_centres(sample: np.ndarray, n: int = CENTRES, rounds: int = ROUNDS) -> np.ndarray:
    """k-means centres of a sample: far apart to start with, then a few rounds of means."""
    if not len(sample):
        return sample
    picked = [0]
    near = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(picked) < n and near.max() > 0:
        picked.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[picked[-1]]) ** 2).sum(axis=1))
    centres = sample[picked]
    for _ in range(rounds):
        cell = _apart(sample, centres).argmin(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, cell, sample)
        size = np.bincount(cell, minlength=len(centres))[:, None]
        centres = np.where(size > 0, total / np.maximum(size, 1), centres)
    return centres


class CellIndex:
    """Items with their cells (a written table), the centres, and one row of bounds a cell."""

    def __init__(self, items: DataFrame, width: int, centres: np.ndarray, cells: list):
        self.items, self.width, self.centres = items, width, centres
        self.numbers = np.array([c["cell"] for c in cells], np.int32)
        self.sizes = {c["cell"]: c["n"] for c in cells}
        self.near, self.far = (np.array([c[k] for c in cells]) for k in ("near", "far"))

    def parts(self):
        """The number of parts of a cell, by the column ``cell``."""
        return F.element_at(F.create_map(*[F.lit(int(v)) for c, n in self.sizes.items() for v in (c, -(-n // PART))]), F.col("cell"))

    def upper(self, q: np.ndarray, metric: str) -> np.ndarray:
        """(query, cell): most score that an item of the cell can have; rounding never puts it below one."""
        apart = _apart(q, self.centres[self.numbers])
        if metric == "euclidean":
            least = np.maximum(np.maximum(apart - self.far, self.near - apart), 0)
            least = np.maximum(least - 1e-9 * (apart + self.far), 0)
            return -least * least
        size = np.sqrt((q * q).sum(axis=1))[:, None]
        bound = q @ self.centres[self.numbers].T + size * self.far
        return bound + 1e-9 * (1 + np.abs(bound) + size * (self.far + np.abs(self.centres[self.numbers]).max(initial=0)))


def _clean(df: DataFrame, key: str, vec: str) -> DataFrame:
    """(id, v) of rows with an id and a vector without nulls."""
    out = df.select(F.col(key).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v"))
    return out.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x)))


def build_index(spark: SparkSession, items: DataFrame, item_id: str, item_vec: str) -> CellIndex | None:
    """Index of all items with a vector; None if there are none."""
    rows = _clean(items, item_id, item_vec)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow().column("v")
    width = rows.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return None
    centres = fit_centres(matrix(sample, width))
    schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("apart", T.DoubleType())])

    def assign(batches):
        for b in batches:
            d = _apart(matrix(b.column("v"), width), centres)
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])],
                                             names=["id", "v", "cell", "apart"])

    path = scratch_path(spark, f"cells-{uuid.uuid4().hex}")
    rows.mapInArrow(assign, schema).write.parquet(path)
    table = spark.read.schema(schema).parquet(path)
    cells = table.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("apart").alias("near"), F.max("apart").alias("far")).collect()
    return CellIndex(table, width, centres, cells)


def _reached(index: CellIndex, queries: DataFrame, metric: str, first: bool) -> DataFrame:
    """qid, v, floor, cell: the best cell of every query, or the others whose bound reaches its floor."""
    width = index.width
    schema = T.StructType([T.StructField("qid", T.LongType()), T.StructField("v", T.ArrayType(T.DoubleType())),
                           T.StructField("floor", T.DoubleType()), T.StructField("cells", T.ArrayType(T.IntegerType()))])
    bounds = CellIndex.__new__(CellIndex)      # without the table, which stays on the driver
    bounds.centres, bounds.numbers, bounds.near, bounds.far = index.centres, index.numbers, index.near, index.far

    def run(batches):
        for b in batches:
            upper = bounds.upper(matrix(b.column("v"), width), metric)
            best = upper.argmax(axis=1) if len(upper) else []
            floor = b.column("floor").to_numpy(zero_copy_only=False)
            if first:
                cells = [bounds.numbers[[k]] for k in best]
            else:
                cells = [bounds.numbers[(u >= f) & (np.arange(len(u)) != k)] for u, f, k in zip(upper, floor, best)]
            yield pa.RecordBatch.from_arrays([b.column("qid"), b.column("v"), b.column("floor"), pa.array(cells, pa.list_(pa.int32()))],
                                             names=["qid", "v", "floor", "cells"])

    return queries.select("qid", "v", "floor").mapInArrow(run, schema).select("qid", "v", "floor", F.explode("cells").alias("cell"))


def _scores(x: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    """Scores of rows for one query, each summed in the same order."""
    return -((x - q) ** 2).sum(axis=1) if metric == "euclidean" else (x * q).sum(axis=1)


def _best_rows(ids, x, q, floor, k, metric, rough):
    """The k best of a part by (score desc, id asc); ``rough`` are scores to a few digits less."""
    slack = 1e-9 * (1 + np.abs(rough).max(initial=0))
    some = np.flatnonzero(rough >= floor - slack)
    if len(some) > k:
        kth = np.partition(rough[some], len(some) - k)[len(some) - k]
        some = some[rough[some] >= kth - 2 * slack]
    score = _scores(x[some], q, metric)
    order = np.lexsort((ids[some], -score))[:k]
    order = order[score[order] >= floor]
    return ids[some[order]], score[order]


CANDIDATES = "qid long, item_id long, score double"


def _search(index: CellIndex, dealt: DataFrame, k: int, metric: str, slots: int) -> DataFrame:
    """Candidates for ``dealt`` (qid, v, floor, cell): the k best of each (query, part of a cell) at the floor or above."""
    parts, width = index.parts(), index.width
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    items = index.items.select("cell", F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"), each(F.lit(slots)).alias("slot"),
                               F.lit(0).alias("kind"), "id", "v", F.lit(LOWEST).alias("floor"))
    asking = dealt.select("cell", each(parts.cast("int")).alias("part"), F.pmod(F.xxhash64("qid"), F.lit(slots)).cast("int").alias("slot"),
                          F.lit(1).alias("kind"), F.col("qid").alias("id"), "v", "floor")
    key = ["cell", "part", "slot"]
    rows = items.unionByName(asking).repartition(*key).sortWithinPartitions(*key, "kind")
    schema = T._parse_datatype_string(CANDIDATES)

    def run(batches):
        current, held, ids, x, square = None, [], None, None, None
        for b in batches:
            keys = np.stack([b.column(c).to_numpy() for c in (*key, "kind")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if current != tuple(keys[lo, :3]):
                    current, held, ids = tuple(keys[lo, :3]), [], None
                part = b.slice(lo, hi - lo)
                own, v = part.column("id").to_numpy(), matrix(part.column("v"), width)
                if keys[lo, 3] == 0:
                    held.append((own, v))
                    continue
                if ids is None and held:
                    ids, x = (np.concatenate(c) for c in zip(*held))
                    square, held = (x * x).sum(axis=1), []
                if ids is not None:
                    yield from answers(own, v, part.column("floor").to_numpy(), ids, x, square)

    def answers(qids, q, floors, ids, x, square):
        step = max(1, BLOCK // len(ids))
        for at in range(0, len(qids), step):
            some = q[at:at + step]
            rough = some @ x.T
            if metric == "euclidean":
                rough = 2 * rough - square - (some * some).sum(axis=1)[:, None]
            found = [_best_rows(ids, x, v, f, k, metric, r) for v, f, r in zip(some, floors[at:at + step], rough)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(qids[at:at + step], [len(i) for i, _ in found])),
                pa.array(np.concatenate([i for i, _ in found])), pa.array(np.concatenate([s for _, s in found]))], names=["qid", "item_id", "score"])

    return rows.mapInArrow(run, schema)


def nearest(spark: SparkSession, items: DataFrame, item_id: str, item_vec: str, queries: DataFrame, qid: str, qvec: str,
            k: int, metric: str = "dot", report: dict | None = None) -> DataFrame:
    """``(qid, item_id, score, rank)``, the exact k best items of every query by dot product or by
    negative squared Euclidean distance.

    Rows without an id, and vectors that are null or hold null or NaN, take no part; query ids must be unique.
    ``report`` receives the numbers of (query, cell) pairs and of those searched."""
    empty = spark.createDataFrame([], "qid long, item_id long, score double, rank int")
    index = build_index(spark, items, item_id, item_vec)
    if index is None:
        return empty
    path = scratch_path(spark, f"queries-{uuid.uuid4().hex}")
    _clean(queries, qid, qvec).select(F.col("id").alias("qid"), "v", F.lit(LOWEST).alias("floor")).write.parquet(path)
    asking = spark.read.parquet(path)
    n = asking.count()                                            # from the files' footers
    if not n:
        return empty
    slots = -(-n // SLOT)
    first_path = scratch_path(spark, f"first-{uuid.uuid4().hex}")
    _search(index, _reached(index, asking, metric, True), k, metric, slots).write.parquet(first_path)
    first = spark.read.schema(CANDIDATES).parquet(first_path)
    best = top_n_per_group(first, "qid", [F.desc("score"), F.asc("item_id")], k)
    floors = best.groupBy("qid").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("_f"))
    asking = asking.join(floors, "qid", "left").select("qid", "v", F.coalesce("_f", F.lit(LOWEST)).alias("floor"))
    dealt = _reached(index, asking, metric, False)
    if report is not None:
        report.update(pairs=n * len(index.sizes), searched=n + dealt.count())
    found = first.unionByName(_search(index, dealt, k, metric, slots))
    return top_n_per_group(found, "qid", [F.desc("score"), F.asc("item_id")], k, rank_col="rank")
