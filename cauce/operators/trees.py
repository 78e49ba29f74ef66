"""Tree ensembles that Spark ML lacks: gradient boosting for several classes (M15) and extremely randomised trees.

Rows are binned once (edges from a bounded sample, those of smallest id hash)
and written; all trees read that table.  Trees grow level by level: one
aggregate a level sums, for every tree, open node, feature and bin, how many
rows there are and what their targets add up to.  Tasks add their rows into
one array and emit its cells, which are combined by key, so what reaches the
driver is the size of the model (trees x nodes x features x bins) and never of
the data.  The driver picks the splits; a row's way through the trees grown so
far is computed where the row is, so nothing but the model moves between levels.

* Boosting: each round grows one regression tree a class on the residuals of
  the softmax, all classes of a round at once; leaves take the usual one-step
  estimate (k - 1) / k * sum(r) / sum(|r| (1 - |r|)).
* Extremely randomised trees: every node draws one threshold a feature, evenly
  between the node's least and greatest value (to the next bin edge), and takes
  the best of them; no bootstrap; predictions are means over the trees.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.session import scratch_path

SAMPLE = 10_000
CELLS = "tree int, node int, feature int, bin int, n double, s double, h double"


class Tree:
    """A complete binary tree of ``depth`` levels: feature (-1 a leaf), last bin that goes left, value."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1) - 1
        self.feature, self.cut, self.value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)

    def node(self, bins: np.ndarray) -> np.ndarray:
        """The node where each row ends."""
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                return at
            at = np.where(inner, 2 * at + 1 + (bins[rows, np.maximum(f, 0)] > self.cut[at]), at)

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.node(bins)]


class Binned:
    """The written table (id, bins, y) and the bin edges of every feature."""

    def __init__(self, df: DataFrame, id_col: str, features: str, label: str, bins: int = 32):
        rows = df.select(F.col(id_col).alias("id"), F.col(features).cast("array<double>").alias("x"), F.col(label).cast("double").alias("y"))
        sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("x").collect()
        x = np.array([r["x"] for r in sample], float)
        levels = np.linspace(0, 1, bins + 1)[1:-1]
        self.bins, self.width = bins, x.shape[1] if len(x) else 0
        self.edges = [np.unique(np.quantile(x[:, j], levels)) for j in range(self.width)]
        path = scratch_path(df.sparkSession, f"binned-{uuid.uuid4().hex}")
        self.transform(rows, "x").select("id", "bins", "y").write.parquet(path)
        self.table = df.sparkSession.read.parquet(path)

    def transform(self, df: DataFrame, features: str) -> DataFrame:
        """``df`` with ``bins`` (one byte a feature)."""
        edges, schema = self.edges, T.StructType([*df.schema.fields, T.StructField("bins", T.BinaryType())])
        at = df.columns.index(features)

        def run(batches):
            for b in batches:
                x = _matrix(b.column(at), len(edges))
                binned = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], axis=1).astype(np.uint8) if len(x) else x
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r.tobytes() for r in binned], pa.binary())], names=[*b.schema.names, "bins"])

        return df.mapInArrow(run, schema)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _bins(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _histogram(data: Binned, trees: list[Tree], level: int, targets) -> dict:
    """(tree, node) -> (feature, bin, 3) sums of the nodes of a level: rows, targets, second moments.

    ``targets(bins, y)`` gives (rows, trees) targets and their ``h``."""
    width, bins, first, n_nodes = data.width, data.bins, 2 ** level - 1, 2 ** level

    def run(batches):
        total = np.zeros((len(trees), n_nodes, width, bins, 3))
        for b in batches:
            if not b.num_rows:
                continue
            x, y = _bins(b.column("bins"), width), b.column("y").to_numpy()
            s, h = targets(x, y)
            for t, tree in enumerate(trees):
                node = tree.node(x) - first
                open_ = np.flatnonzero((node >= 0) & (node < n_nodes))
                for f in range(width):
                    cell = node[open_] * bins + x[open_, f]
                    for i, w in enumerate((None, s[open_, t], h[open_, t])):
                        total[t, :, f, :, i] += np.bincount(cell, w, n_nodes * bins).reshape(n_nodes, bins)
        t, node, f, b_ = np.nonzero(total[..., 0])
        cells = total[t, node, f, b_]
        yield pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int32)) for c in (t, node, f, b_)], *[pa.array(cells[:, i]) for i in range(3)]],
                                         names=["tree", "node", "feature", "bin", "n", "s", "h"])

    cells = data.table.select("bins", "y").mapInArrow(run, T._parse_datatype_string(CELLS))
    rows = cells.groupBy("tree", "node", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("h").alias("h")).collect()
    out: dict = {}
    for r in rows:
        out.setdefault((r["tree"], r["node"] + first), np.zeros((width, bins, 3)))[r["feature"], r["bin"]] = (r["n"], r["s"], r["h"])
    return out


def _grow(data: Binned, n_trees: int, depth: int, targets, choose, leaf) -> list[Tree]:
    """Trees grown together, a level a job.  ``choose(cells)`` gives (feature, cut) or None; ``leaf(sums)`` a value."""
    trees = [Tree(depth) for _ in range(n_trees)]
    for level in range(depth):
        for (t, node), cells in sorted(_histogram(data, trees, level, targets).items()):
            tree = trees[t]
            tree.value[node] = leaf(cells[0].sum(axis=0))
            split = choose(cells)
            if split is not None:
                f, cut = split
                tree.feature[node], tree.cut[node] = f, cut
                tree.value[2 * node + 1], tree.value[2 * node + 2] = leaf(cells[f, :cut + 1].sum(axis=0)), leaf(cells[f, cut + 1:].sum(axis=0))
    return trees


def _gains(cells: np.ndarray) -> np.ndarray:
    """(feature, cut): how much a split lowers the squared error; -inf where a side is empty."""
    left = np.cumsum(cells, axis=1)[:, :-1]
    right = cells.sum(axis=1)[:, None] - left
    n, m = left[..., 0], right[..., 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[..., 1] ** 2 / n + right[..., 1] ** 2 / m
    whole = cells[0].sum(axis=0)
    return np.where((n > 0) & (m > 0), gain - whole[1] ** 2 / max(whole[0], 1), -np.inf)


def best_split(cells: np.ndarray):
    gain = _gains(cells)
    f, cut = np.unravel_index(gain.argmax(), gain.shape)
    return (int(f), int(cut)) if gain[f, cut] > 1e-12 else None


def random_split(rng: np.random.Generator, edges: list[np.ndarray]):
    """One evenly drawn threshold a feature; the best of them."""

    def choose(cells):
        gain, best, split = _gains(cells), 1e-12, None
        for f, e in enumerate(edges):
            held = np.flatnonzero(cells[f, :, 0])
            if len(held) < 2:
                continue
            low, high = held[0], held[-1]                       # cuts low .. high - 1 leave rows on both sides
            at = rng.uniform(e[low], e[high - 1]) if high - 1 > low else e[low]
            cut = int(np.clip(np.searchsorted(e, at), low, high - 1))
            if gain[f, cut] > best:
                best, split = gain[f, cut], (f, cut)
        return split

    return choose


# ------------------------------------------------------------------ models
class ExtraTrees:
    """Mean of extremely randomised regression trees."""

    def __init__(self, n_trees: int = 20, depth: int = 8, bins: int = 64, seed: int = 42):
        self.n_trees, self.depth, self.bins, self.seed = n_trees, depth, bins, seed

    def fit(self, df: DataFrame, id_col: str, features: str, label: str) -> "ExtraTrees":
        self.data, n = Binned(df, id_col, features, label, self.bins), self.n_trees

        def targets(x, y):
            each = np.repeat(y[:, None], n, axis=1)
            return each, np.zeros_like(each)

        choose = random_split(np.random.default_rng(self.seed), self.data.edges)
        self.trees = _grow(self.data, n, self.depth, targets, choose, lambda s: s[1] / s[0] if s[0] else 0.0)
        return self

    def predict(self, df: DataFrame, features: str) -> DataFrame:
        """``df`` with ``prediction``."""
        trees, width = self.trees, self.data.width
        return _scored(self.data.transform(df, features), width, lambda x: np.mean([t.predict(x) for t in trees], axis=0), T.DoubleType())


class SoftmaxBoosting:
    """Gradient boosting for labels 0 .. k - 1; ``deviance`` holds the training loss after each round."""

    def __init__(self, rounds: int = 10, depth: int = 3, rate: float = 0.3, bins: int = 32):
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins

    def fit(self, df: DataFrame, id_col: str, features: str, label: str) -> "SoftmaxBoosting":
        self.data = Binned(df, id_col, features, label, self.bins)
        counts = {int(r["y"]): r["n"] for r in self.data.table.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        k, total = max(counts) + 1, sum(counts.values())
        self.prior = np.log(np.array([max(counts.get(c, 0), 1e-9) for c in range(k)]) / total)
        self.stages, self.deviance = [], []
        scale = (k - 1) / k
        for _ in range(self.rounds):
            scores = self._scores()

            def targets(x, y, scores=scores):
                r = (y[:, None] == np.arange(k)) - softmax(scores(x))
                return r, np.abs(r) * (1 - np.abs(r))

            self.stages.append(_grow(self.data, k, self.depth, targets, best_split, lambda s: scale * s[1] / s[2] if s[2] > 1e-12 else 0.0))
            self.deviance.append(self._loss())
        return self

    def _scores(self):
        prior, stages, rate = self.prior, list(self.stages), self.rate
        return lambda x: prior + rate * sum((np.stack([t.predict(x) for t in trees], axis=1) for trees in stages), np.zeros((len(x), len(prior))))

    def _loss(self) -> float:
        scores, width = self._scores(), self.data.width

        def run(batches):
            for b in batches:
                x, y = _bins(b.column("bins"), width), b.column("y").to_numpy().astype(int)
                p = softmax(scores(x))[np.arange(len(y)), y]
                yield pa.RecordBatch.from_arrays([pa.array([float(-np.log(np.maximum(p, 1e-300)).sum())]), pa.array([float(len(y))])], names=["loss", "n"])

        row = self.data.table.mapInArrow(run, "loss double, n double").agg(F.sum("loss") / F.sum("n")).first()
        return float(row[0])

    def predict(self, df: DataFrame, features: str) -> DataFrame:
        """``df`` with ``probability`` (a class) and ``prediction``."""
        scores, width = self._scores(), self.data.width
        out = _scored(self.data.transform(df, features), width, lambda x: softmax(scores(x)), T.ArrayType(T.DoubleType()), "probability")
        best = F.array_max(F.transform("probability", lambda p, i: F.struct(p.alias("p"), (-i).alias("i"))))
        return out.withColumn("prediction", (-best["i"]).cast("int"))


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _scored(binned: DataFrame, width: int, fn, kind, name: str = "prediction") -> DataFrame:
    schema = T.StructType([*[f for f in binned.schema.fields if f.name != "bins"], T.StructField(name, kind)])

    def run(batches):
        for b in batches:
            value = fn(_bins(b.column("bins"), width))
            value = pa.array(value) if value.ndim == 1 else pa.array(value.tolist(), pa.list_(pa.float64()))
            names = [n for n in b.schema.names if n != "bins"]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], value], names=[*names, name])

    return binned.mapInArrow(run, schema)
