"""Naive Bayes and logistic regression of TF-IDF rows whose models never lie on the driver.

The rows lie in blocks of documents (:mod:`cauce.operators.term_blocks`), whatever
belongs to a term in buckets, as in :mod:`cauce.operators.nmf`.  Naive Bayes
needs one exchange of sums.  Logistic regression is Spark's: L-BFGS (ten steps
remembered, strong Wolfe line search, the same tests of convergence) on columns
that are centred and of deviation one, without penalty.  Every gradient is a sum of the
rows, so points and directions are combinations of the gradients so far, and of
each gradient only its product with every training document's row is kept.  The
driver holds these combinations and the gradients' inner products, at most
``rounds`` + 1 numbers each.  A step sends one number for a block and term to
the term's bucket and one back, and writes one more number a document.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.operators import nmf
from cauce.operators.term_blocks import BLOCK, BUCKET, TermBlocks, arrow_rows, flat, list_sizes, postings, saved, term_blocks

TERMS = "block int, bucket int, joined string, dfs array<int>"
#: Rows of documents: of ``piece`` < 0 those to predict, with their sums for naive Bayes in ``hs``.
ROWS = "block int, piece int, ids array<long>, sizes array<int>, codes array<int>, ws array<double>, at array<int>, dfs array<int>, hs array<double>"
#: at: labels; hs: a row a gradient, its products with the documents' rows; gram: the newest one's products with all.
POINTS = "block int, piece int, at array<int>, hs array<double>, gram array<double>"
#: Steps that L-BFGS remembers, and function values that its test of convergence looks at.
MEMORY, VALUES = 10, 20


def _flags(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whether a document is of the training rows, and its label."""
    x = ids.to_numpy()
    return (x & 2) > 0, x & 1


def _train_terms(tb: TermBlocks) -> DataFrame:
    """The blocks' terms with the number of training documents that hold them."""
    def run(t: pa.Table) -> pa.Table:
        kind = t.column("bucket").is_valid()
        terms, ps = t.filter(kind).sort_by("bucket"), t.filter(pc.invert(kind))
        size = list_sizes(terms.column("dfs"))
        df, ends = np.zeros(int(size.sum()), np.int64), np.cumsum(size)
        for i in range(ps.num_rows):
            ids, sizes, codes, _ = postings(ps, i)
            df += np.bincount(codes[np.repeat(_flags(ids)[0], sizes)], minlength=len(df))
        return terms.select(["block", "bucket", "joined"]).append_column(
            "dfs", arrow_rows("dfs array<int>", [{"dfs": df[e - n:e]} for e, n in zip(ends, size)]).column("dfs"))

    null = lambda *cs: [F.lit(None).cast(ty).alias(c) for c, ty in cs]
    own = tb.postings.select("block", "ids", "sizes", "codes", "tfs", *null(("bucket", "int"), ("joined", "string"), ("dfs", "array<int>")))
    terms = tb.terms.select("block", *null(("ids", "array<long>"), ("sizes", "array<int>"), ("codes", "binary"), ("tfs", "binary")), "bucket", "joined", "dfs")
    return saved(tb.by_block(own.unionByName(terms), run, TERMS), "text-terms")


def _moments(cells: pa.Table) -> pa.Table:
    """For each term of a block: training rows that hold it, their mean and squared deviations, and the sum of either label."""
    cells = cells.sort_by("piece")
    buckets, size = (cells.column(c)[0].values.to_numpy() for c in ("at", "dfs"))
    n = int(size.sum())

    def rows():
        for i in range(cells.num_rows):
            sizes, code, x = (cells.column(c)[i].values.to_numpy() for c in ("sizes", "codes", "ws"))
            train, label = (np.repeat(f, sizes) for f in _flags(cells.column("ids")[i].values))
            yield code[train], x[train], label[train]
    # a row of the block at a time
    held, total, spread, own = np.zeros(n, np.int64), np.zeros(n), np.zeros(n), np.zeros((n, 2))
    for code, x, label in rows():
        held += np.bincount(code, minlength=n)
        total += np.bincount(code, x, n)
        for y in (0, 1):
            own[:, y] += np.bincount(code, x * (label == y), n)
    mean = total / np.maximum(held, 1)
    for code, x, _ in rows():
        spread += np.bincount(code, (x - mean[code]) ** 2, n)
    got = np.c_[held, mean, spread, own]
    ends, block = np.cumsum(size), cells.column("block")[0].as_py()
    return arrow_rows(nmf.STATE, [{"block": block, "bucket": b, "hs": got[e - m:e].ravel()} for b, e, m in zip(buckets, ends, size) if m])


def _bucket_size(names: pa.Table) -> int:
    return int(list_sizes(names.filter(pc.less(names.column("block"), 0)).column("terms")).sum())


def _terms_model(n_train: int):
    """A bucket's terms: their scaled means (block -1), and for each block 1 / deviation and the logarithms for naive Bayes."""
    def run(names: pa.Table, state: pa.Table) -> pa.Table:
        n, at, bucket = _bucket_size(names), nmf._places(names), names.column("bucket")[0].as_py()
        held, mean, m2, own = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros((n, 2))
        state = state.sort_by("block")
        for i, b in enumerate(state.column("block").to_pylist()):
            v, to = nmf._values(state, i, 5), at[b]
            h = held[to]
            total, step = np.maximum(h + v[:, 0], 1), v[:, 1] - mean[to]
            m2[to] += v[:, 2] + step ** 2 * h * v[:, 0] / total
            mean[to] += step * v[:, 0] / total
            held[to] += v[:, 0]
            own[to] += v[:, 3:]
        var = (m2 + mean ** 2 * held * (n_train - held) / n_train) / max(n_train - 1, 1)
        scale = np.divide(1.0, np.sqrt(var), out=np.zeros(n), where=var > 0)
        sent = np.c_[scale, np.log(own + 1.0)]
        return arrow_rows(nmf.STATE, [{"block": -1, "bucket": bucket, "hs": mean * held / n_train * scale, "gram": np.r_[own.sum(axis=0), n]},
                                      *[{"block": b, "bucket": bucket, "hs": sent[a].ravel()} for b, a in at.items()]])
    return run


def _scaled(cells: pa.Table, model: pa.Table) -> pa.Table:
    """A block's training rows with columns of deviation one, and the rows to predict with their sums for naive Bayes."""
    by = flat(model.sort_by("bucket").column("hs")).to_numpy().reshape(-1, 3)
    out, cells = [], cells.sort_by("piece")
    for i in range(cells.num_rows):
        sizes, code, x = (cells.column(c)[i].values.to_numpy() for c in ("sizes", "codes", "ws"))
        ids = cells.column("ids")[i].values
        train, row = _flags(ids)[0], np.repeat(np.arange(len(sizes)), sizes)
        sums = np.stack([np.bincount(row, x * f, len(sizes)) for f in (by[code, 1], by[code, 2], np.ones(len(x)))], axis=1)
        for own, piece in ((train, i), (~train, -1 - i)):
            cut = own[row]
            out.append({"block": cells.column("block")[0].as_py(), "piece": piece, "ids": ids.filter(pa.array(own)), "sizes": sizes[own], "codes": code[cut],
                        "ws": x[cut] * by[code[cut], 0], "at": cells.column("at")[i].values, "dfs": cells.column("dfs")[i].values,
                        "hs": sums[own].ravel() if piece < 0 else None})
    return arrow_rows(ROWS, out)


def _margins(state: pa.Table, i: int, along: np.ndarray) -> np.ndarray:
    """What a combination of the gradients gives the documents of a row, without the first intercept."""
    n = len(state.column("at")[i].values)
    return along @ state.column("hs")[i].values.to_numpy().reshape(-1, n)[:len(along)] if len(along) and n else np.zeros(n)


def _rest(state: pa.Table, i: int, x: np.ndarray, start: float) -> np.ndarray:
    """The documents' parts in the gradient at ``x``."""
    return np.exp(-np.logaddexp(0, -_margins(state, i, x) - start)) - state.column("at")[i].values.to_numpy()


class _Fit:
    """The training rows' loss along combinations of gradients, and new gradients."""

    def __init__(self, rows: DataFrame, names: DataFrame, means: DataFrame, blocks: int, buckets: int, counts: tuple[int, int]):
        self.blocks, self.buckets, self.n = blocks, buckets, sum(counts)
        self.start = math.log(counts[1] / counts[0])
        self.rows = rows.filter("piece >= 0").drop("hs").repartition(blocks, "block").persist(StorageLevel.DISK_ONLY)
        self.others = rows.filter("piece < 0")
        self.names = names.drop("dfs").repartition(buckets, "bucket").persist(StorageLevel.DISK_ONLY)
        #: where each gradient was taken, its part for the intercept, and their inner products
        self.means, self.points, self.sums, self.gram = means, [], np.empty(0), np.empty((0, 0))

        def run(batches):
            for b in batches:
                yield from arrow_rows(POINTS, [{"block": x.as_py(), "piece": p.as_py(), "at": _flags(d.values)[1], "hs": np.empty(0)}
                                               for x, p, d in zip(b.column("block"), b.column("piece"), b.column("ids"))]).to_batches()
        self.state = saved(self.rows.select("block", "piece", "ids").mapInArrow(run, POINTS), "text-points")

    def _met(self, left: DataFrame, right: DataFrame, key: str, run, schema: str = nmf.STATE) -> DataFrame:
        parts = self.blocks if key == "block" else self.buckets
        return left.groupBy(key).cogroup(right.repartition(parts, key).groupBy(key)).applyInArrow(run, schema)

    def loss(self, x: np.ndarray, d: np.ndarray) -> tuple[float, float, float]:
        """At ``x``: the loss, its slope along ``d``, and the gradient's part for the intercept."""
        n, start = self.n, self.start

        def run(batches):
            for b in batches:
                got = np.zeros(3)
                for i in range(b.num_rows):
                    y, m = b.column("at")[i].values.to_numpy(), _margins(b, i, x) + start
                    r = _rest(b, i, x, start)
                    got += (np.logaddexp(0, -m) + m * (1 - y)).sum(), (r * _margins(b, i, d)).sum(), r.sum()
                yield from arrow_rows("gram array<double>", [{"gram": got}]).to_batches()
        rows = self.state.select("at", "hs").mapInArrow(run, "gram array<double>").collect()
        return tuple(math.fsum(r["gram"][j] for r in rows) / n for j in range(3))

    def _products(self, given: DataFrame, total: float) -> DataFrame:
        """For each block what the sum of its rows, each times a document's number in ``hs``, is at the block's terms; ``total``: of the numbers."""
        blocks = self.blocks

        def run(names: pa.Table, state: pa.Table) -> pa.Table:
            block, at = state.column("block").to_numpy(), nmf._places(names)
            mean = nmf._values(state, np.flatnonzero(block < 0)[0], 1)[:, 0]
            p = np.zeros(len(mean))
            for i in sorted(np.flatnonzero(block >= 0), key=lambda i: block[i]):
                p[at[block[i]]] += nmf._values(state, i, 1)[:, 0]
            p -= mean * total
            none = np.empty(0, np.int64)
            return arrow_rows(nmf.STATE, [{"block": b, "bucket": names.column("bucket")[0].as_py(), "hs": p[at.get(b, none)], "gram": np.array([mean @ p])}
                                          for b in range(blocks)])
        sums = self._met(self.rows, given, "block", nmf._term_sums(1))
        return self._met(self.names, self.means.unionByName(sums), "bucket", run)

    def _documents(self, one) -> DataFrame:
        """(block, bucket, piece, hs, gram) with a number for each training document, which ``one`` makes of a state's row."""
        def run(batches):
            for b in batches:
                yield from arrow_rows(nmf.STATE, [{"block": b.column("block")[i].as_py(), "piece": b.column("piece")[i].as_py(), "hs": one(b, i)}
                                                  for i in range(b.num_rows)]).to_batches()
        return self.state.mapInArrow(run, nmf.STATE)

    def add(self, x: np.ndarray, total: float) -> None:
        """The gradient at ``x`` joins the others."""
        n, start = self.n, self.start
        one = lambda b, i: _rest(b, i, x, start) / n
        sent = self._products(self._documents(one), total)

        def run(rows: pa.Table, both: pa.Table) -> pa.Table:
            kind, out = both.column("piece").is_valid(), []
            own = both.filter(pc.invert(kind)).sort_by("bucket")
            h = flat(own.column("hs")).to_numpy()
            shift = total - sum(v[0] for v in own.column("gram").to_pylist())
            state, rows = both.filter(kind).sort_by("piece"), rows.sort_by("piece")
            for i in range(rows.num_rows):
                sizes, code, w = (rows.column(c)[i].values.to_numpy() for c in ("sizes", "codes", "ws"))
                r = one(state, i)
                got = np.bincount(np.repeat(np.arange(len(sizes)), sizes), w * h[code], len(sizes)) + shift
                hs = np.r_[state.column("hs")[i].values.to_numpy(), got]
                out.append({"block": rows.column("block")[0].as_py(), "piece": rows.column("piece")[i].as_py(), "at": state.column("at")[i].values,
                            "hs": hs, "gram": hs.reshape(len(x) + 1, len(r)) @ r})
            return arrow_rows(POINTS, out)
        both = self.state.withColumn("bucket", F.lit(None).cast("int")).unionByName(sent.withColumn("at", F.lit(None).cast("array<int>")))
        self.state = saved(self._met(self.rows, both, "block", run, POINTS), "text-points")
        row = np.sum([r["gram"] for r in self.state.select("gram").collect()], axis=0)
        k = len(x)
        gram = np.zeros((k + 1, k + 1))
        gram[:k, :k], gram[k], gram[:, k] = self.gram, row, row
        self.gram, self.sums, self.points = gram, np.r_[self.sums, total], [*self.points, x]

    def predictions(self, x: np.ndarray, bayes) -> DataFrame:
        """id, naive_bayes, logistic of the rows to predict; ``bayes`` makes predictions of their sums."""
        n, start, points, total = self.n, self.start, self.points, float(x @ self.sums)
        sent = self._products(self._documents(lambda b, i: sum(f * _rest(b, i, at, start) for f, at in zip(x, points)) / n), total)

        def run(rows: pa.Table, model: pa.Table) -> pa.Table:
            model = model.sort_by("bucket")
            h, out = flat(model.column("hs")).to_numpy(), []
            base = start + total - sum(v[0] for v in model.column("gram").to_pylist())
            for i in range(rows.num_rows):
                sizes, code, w = (rows.column(c)[i].values.to_numpy() for c in ("sizes", "codes", "ws"))
                margin = np.bincount(np.repeat(np.arange(len(sizes)), sizes), w * h[code], len(sizes)) + base
                out.append(_predicted(rows.column("ids")[i].values, bayes(rows.column("hs")[i].values.to_numpy().reshape(-1, 3)), margin > 0))
            return pa.concat_tables(out) if out else _predicted(pa.array([], pa.int64()), np.empty(0), np.empty(0))
        others = self.others.repartition(self.blocks, "block")
        return saved(self._met(others, sent, "block", run, PREDICTED), "text-predictions")

    def close(self) -> None:
        self.rows.unpersist()
        self.names.unpersist()


PREDICTED = "id long, naive_bayes double, logistic double"


def _predicted(ids: pa.Array, bayes: np.ndarray, logistic: np.ndarray) -> pa.Table:
    return pa.table({"id": ids, "naive_bayes": pa.array(bayes.astype(float)), "logistic": pa.array(logistic.astype(float))})


class SearchFailed(ArithmeticError):
    pass


def _between(a, b) -> float:
    """The least point of the cubic through two points (t, value, slope), away from both."""
    (lt, lv, ls), (rt, rv, rs) = sorted((a, b))
    d1 = ls + rs - 3 * (lv - rv) / (lt - rt)
    with np.errstate(all="ignore"):
        d2 = np.sqrt(d1 * d1 - ls * rs)
        t = rt - (rt - lt) * (rs + d2 - d1) / np.float64(rs - ls + 2 * d2)
    low, high = lt + 0.1 * (rt - lt), lt + 0.9 * (rt - lt)
    return low if t < low else high if t > high else float(t)


def wolfe(phi, value: float, slope: float, t: float) -> float:
    """A step that meets the strong Wolfe conditions; ``phi(t)`` gives value and slope."""
    if slope > 0:
        raise SearchFailed
    at = lambda t: (t, *phi(t))

    def zoom(low, high) -> float:
        for _ in range(10):
            c = at(_between(low, high))
            if c[1] > value + 1e-4 * c[0] * slope or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= 0.9 * abs(slope):
                return c[0]
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise SearchFailed

    low = (0.0, value, slope)
    for i in range(10):
        c = at(t)
        if not math.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + 1e-4 * t * slope or (c[1] >= low[1] and i > 0):
            return zoom(low, c)
        if abs(c[2]) <= 0.9 * abs(slope):
            return t
        if c[2] >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise SearchFailed


def _direction(gram: np.ndarray, steps: list, g: np.ndarray) -> np.ndarray:
    """L-BFGS: the descent direction from the last (step, change of the gradient), newest first."""
    k = len(g)
    pad = lambda v: np.r_[v, np.zeros(k - len(v))]
    pairs, d, scale, left = [(pad(s), pad(y)) for s, y in steps], g.copy(), 1.0, []
    if pairs:
        s, y = pairs[0]
        if not s @ gram @ y >= 0:
            raise SearchFailed
        scale = (s @ gram @ y) / (y @ gram @ y)
    for s, y in pairs:
        rho = s @ gram @ y
        a = (s @ gram @ d) / rho if rho else math.nan
        if math.isnan(a):
            raise SearchFailed
        left.append((s, y, rho, a))
        d = d - a * y
    d = d * scale
    for s, y, rho, a in reversed(left):
        d = d + (a - (y @ gram @ d) / rho) * s
    return -d


def minimise(fit: _Fit, rounds: int, tolerance: float) -> np.ndarray:
    """The point, as a combination of the gradients, that L-BFGS reaches."""
    x = np.empty(0)
    value, _, total = fit.loss(x, x)
    fit.add(x, total)
    x, g, steps, seen, first, failed, done = np.zeros(1), np.ones(1), [], [math.inf], value, False, 0
    while done < rounds:
        norm = math.sqrt(max(g @ fit.gram @ g, 0.0))
        if norm <= max(tolerance * value, 1e-8) or (len(seen) > 1 and abs(value - max(seen)) <= tolerance * first):
            break
        try:
            d, last = _direction(fit.gram, steps, g), {}

            def phi(t):
                last[t] = fit.loss(x + t * d, d)
                return last[t][:2]
            t = wolfe(phi, value, g @ fit.gram @ d, 1.0 if done else 1.0 / math.sqrt(d @ fit.gram @ d))
            if t * norm < 1e-10:
                raise SearchFailed
        except SearchFailed:
            if failed:
                break
            failed, steps = True, []
            continue
        value, _, total = last[t]
        fit.add(x + t * d, total)
        new = np.r_[np.zeros(len(g)), 1.0]
        steps = [(t * d, new - np.r_[g, 0.0]), *steps][:MEMORY]
        x, g, failed, done = np.r_[x + t * d, 0.0], new, False, done + 1
        seen = [*seen, value][-VALUES:]
    return x


def classify(docs: DataFrame, rounds: int = 50, tolerance: float = 1e-6) -> DataFrame:
    """(doc_id, split, label, prediction, model) of the rows of ``docs`` (doc_id, text, label 0 or 1, split) outside
    ``train``, by both models, which learn from the rows of ``train``.  A text of null has no terms."""
    # numbers of their own, as ids may repeat; their last bits tell training rows and labels
    number = F.monotonically_increasing_id() * 4 + F.when(F.col("split") == "train", 2).otherwise(0) + F.col("label").cast("long")
    docs = saved(docs.select("doc_id", "split", F.col("label").cast("double").alias("label"), "text", number.alias("id")), "text-rows")
    seen = docs.agg(F.sum((F.expr("id & 3 = 2")).cast("long")), F.sum((F.expr("id & 3 = 3")).cast("long")), F.sum((~F.col("label").isin(0.0, 1.0)).cast("long"))).first()
    counts = (seen[0] or 0, seen[1] or 0)
    if seen[2]:
        raise ValueError("labels must be 0 or 1")
    if not sum(counts):
        raise ValueError("no training rows")
    tb = term_blocks(docs, "id", "text", block=2 * BLOCK, bucket=8 * BUCKET)
    tb.terms = _train_terms(tb)
    cells, names, blocks, buckets = nmf.tfidf_blocks(tb, sum(counts), 1, math.inf, bare=True)
    # kept, not written: Spark's Parquet reader would hold all rows of a file, arrays and all, in one batch
    cells = cells.repartition(blocks, "block").persist(StorageLevel.DISK_ONLY)
    met = lambda left, right, key, run, schema=nmf.STATE: left.groupBy(key).cogroup(
        right.groupBy(key)).applyInArrow(run, schema)
    moments = cells.groupBy("block").applyInArrow(_moments, nmf.STATE)
    terms = saved(met(names.repartition(buckets, "bucket"), moments.repartition(buckets, "bucket"), "bucket", _terms_model(sum(counts))), "text-moments")
    means = terms.filter("block < 0")
    rows = met(cells, terms.filter("block >= 0").repartition(blocks, "block"), "block", _scaled, ROWS)
    size = np.sum([[0.0] * 3, *[r["gram"] for r in means.select("gram").collect()]], axis=0)
    if not size[2]:
        raise ValueError("no terms in the training rows")
    n = np.array(counts, float)
    prior, under = np.log(n + 1) - math.log(n.sum() + 2), np.log(size[:2] + size[2])

    def bayes(sums: np.ndarray) -> np.ndarray:
        score = prior + sums[:, :2] - sums[:, 2:] * under
        # one label alone has the index 0
        return (score[:, 1] > score[:, 0]) & bool(n.all())

    if all(counts):
        fit = _Fit(rows, names, means, blocks, buckets, counts)
        got = fit.predictions(minimise(fit, rounds, tolerance), bayes)
        fit.close()
    else:
        only = float(counts[1] > 0)
        got = docs.filter("id & 2 = 0").select("id", F.lit(0.0).alias("naive_bayes"), F.lit(only).alias("logistic"))
    cells.unpersist()
    named = docs.drop("text").join(got, "id")
    return named.select("doc_id", "split", "label", F.explode(F.array(*[
        F.struct(F.col(m).alias("prediction"), F.lit(m).alias("model")) for m in ("naive_bayes", "logistic")])).alias("p")).select("doc_id", "split", "label", "p.*")
