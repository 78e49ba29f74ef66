"""Non-negative matrix factorisation of (id, term, weight) tables.

The weights V are approximated by W H with ``k`` factors a document (W) and a
term (H), none negative, by alternating multiplicative updates.  The weights
lie in blocks of documents that number their own terms
(:mod:`cauce.operators.term_blocks`); they are dealt once by block and stay
there.  A block keeps its documents' factors, a bucket those of its terms: in
an update a bucket sends each block the factors of the block's terms, and the
block sends back, for each of its terms, ``k`` sums of products over its
documents.  So a round shuffles one row of ``k`` numbers for a block and term,
not for each weight.  Only the two Gram matrices and the loss, a few numbers,
pass through the driver; neither the vocabulary nor any document does.  The
factors are written after every update, so a lost executor costs at most one of
them.

The squared error never rises from one update to the next; it is the sum of
squares of V, less twice the product with W H on V's cells, plus the product of
the Gram matrices.  Rows without weights take no part.  Starting values come
from hashes of the keys, so a run repeats itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cauce.operators.term_blocks import (TermBlocks, arrow_rows, buckets_of, flat, list_sizes, postings, saved,
                                         smoothed_idf, split_terms, square_sums)

TINY = 1e-12
#: Weights of a block, and of a row of it; weights for each bucket of terms.
BLOCK, PIECE, BUCKET = 1 << 21, 1 << 18, 1 << 23

#: n, s, q: number, sum and sum of squares of all weights, also of those whose id is null.  The first row of a block
#: has in ``at`` the buckets of its terms and in ``dfs`` how many are in each.
CELLS = ("block int, piece int, ids array<{0}>, sizes array<int>, codes array<int>, ws array<double>, n long, s double, q double, "
         "at array<int>, dfs array<int>")
TERMS = "block int, bucket int, terms array<string>, dfs array<int>"
NAMES = "block int, bucket int, terms array<string>, dfs array<int>, at array<int>"
STATE = "block int, bucket int, piece int, hs array<double>, gram array<double>"


def _start(key: Column, j: int, scale: float) -> Column:
    # between 0.1 and 1.1 times the scale
    return (F.pmod(F.xxhash64(F.lit(j), key), F.lit(1_000_003)) / 1_000_003.0 + 0.1) * scale


def _starts(keys: str, first: int, k: int, scale: float) -> Column:
    return F.flatten(F.transform(keys, lambda x: F.array(*[_start(x, first + j, scale) for j in range(k)])))


def _sums(rows: DataFrame, n: int) -> list[float]:
    """The sums of the ``n`` numbers in ``gram``."""
    got = rows.agg(*[F.sum(F.col("gram")[i]).alias(f"g{i}") for i in range(n)]).first()
    return [x or 0.0 for x in got]


class Factors:
    """documents (id, f0 ..), terms (term, f0 ..), and ``loss`` after each round."""

    def __init__(self, documents: DataFrame, terms: DataFrame, loss: list[float], k: int):
        self.documents, self.terms, self.loss, self.k = documents, terms, loss, k

    def top_terms(self, n: int = 6) -> DataFrame:
        """topic, rank, term, weight: the ``n`` terms with the largest factors of each topic (ties by term)."""
        rows = self.terms.select("term", F.posexplode(F.array(*[f"f{j}" for j in range(self.k)])).alias("topic", "weight"))
        # reduced on every mapper before the final order of a topic
        best = rows.groupBy("topic", F.pmod(F.xxhash64("term"), F.lit(64)).alias("_s")).agg(
            F.slice(F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("w"), "term"))), 1, n).alias("b"))
        order = Window.partitionBy("topic").orderBy("w", "term")
        return best.select("topic", F.inline("b")).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n) \
            .select("topic", "rank", "term", (-F.col("w")).alias("weight"))


def _pieces(block: int, ids: pa.Array, sizes: np.ndarray, codes: np.ndarray, ws: np.ndarray, first: int = 0,
            bare: bool = False) -> list[dict]:
    """Rows of some documents (neighbouring weights); those without id or (unless ``bare``) without weights are only counted."""
    out, ends, lo = [], np.cumsum(sizes), 0
    named = ids.is_valid().to_numpy(zero_copy_only=False) & ((sizes > 0) | bare)
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PIECE, side="right")))
        a, b, own = ends[lo] - sizes[lo], ends[hi - 1], named[lo:hi]
        cells = np.repeat(own, sizes[lo:hi])
        out.append({"block": block, "piece": first + len(out), "ids": ids.slice(lo, hi - lo).filter(pa.array(own)), "sizes": sizes[lo:hi][own],
                    "codes": codes[a:b][cells], "ws": ws[a:b][cells], "n": int(b - a), "s": float(ws[a:b].sum()), "q": float((ws[a:b] ** 2).sum())})
        lo = hi
    return out


def _numbered(terms: DataFrame, buckets: int, least: float = 0, most: float = float("inf")) -> DataFrame:
    """For every (block, bucket) the documents of the corpus that hold each of its terms, and each one's place ``at`` among
    the bucket's terms that ``least`` to ``most`` documents hold, or -1; rows of block -1 have these terms."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        t = split_terms(t) if "joined" in t.column_names else t
        block, size = t.column("block").to_numpy(), list_sizes(t.column("terms"))
        named = flat(t.column("terms")).dictionary_encode()
        code, dfs = named.indices.to_numpy(), flat(t.column("dfs")).to_numpy()
        counts = np.bincount(code, dfs, len(named.dictionary)).astype(np.int64)
        kept = (counts >= least) & (counts <= most)
        place = np.where(kept, np.cumsum(kept) - 1, -1)
        bucket, ends = t.column("bucket")[0].as_py(), np.cumsum(size)
        out = [{"block": b, "bucket": bucket, "dfs": counts[code[e - n:e]], "at": place[code[e - n:e]]} for b, e, n in zip(block, ends, size)]
        return arrow_rows(NAMES, [*out, {"block": -1, "bucket": bucket, "terms": named.dictionary.filter(pa.array(kept))}])

    return saved(terms.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(run, NAMES), "nmf-names")


def weight_blocks(weights: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
    """Cells and names of a table (id, term, weight), with the numbers of blocks and of buckets."""
    v = weights.filter("weight > 0").select("id", F.col("term").cast("string").alias("term"), F.col("weight").cast("double").alias("weight"))
    n, cores = weights.count(), weights.sparkSession.sparkContext.defaultParallelism
    blocks, buckets = max(cores, -(-n // BLOCK)), max(cores, -(-n // BUCKET))
    cells = CELLS.format(v.schema["id"].dataType.simpleString())
    both = f"{cells}, bucket int, terms array<string>"

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        t = t.filter(t.column("term").is_valid())
        ids = t.column("id").combine_chunks().dictionary_encode(null_encoding="encode")
        named = t.column("term").combine_chunks().dictionary_encode()
        doc, code, block = ids.indices.to_numpy(), named.indices.to_numpy(), t.column("block")[0].as_py()
        bucket = buckets_of(named.dictionary, buckets).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        by_doc = np.argsort(doc, kind="stable")
        out = _pieces(block, ids.dictionary, np.bincount(doc, minlength=len(ids.dictionary)), number[code][by_doc], t.column("weight").to_numpy()[by_doc])
        terms, dfs = named.dictionary.take(pa.array(order)), np.bincount(number[code], minlength=len(order))
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        out[:1] = [{**p, "at": np.arange(buckets), "dfs": np.diff(cuts)} for p in out[:1]]
        out += [{"block": block, "bucket": i, "terms": terms.slice(a, b - a), "dfs": dfs[a:b]} for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        yield from arrow_rows(both, out, ids=t.column("id").type).to_batches()

    dealt = v.repartition(blocks, "id").withColumn("block", F.spark_partition_id())
    rows = saved(dealt.mapInArrow(run, both), "nmf-weights")
    names = _numbered(rows.filter("bucket is not null").select("block", "bucket", "terms", "dfs"), buckets)
    return rows.filter("bucket is null").drop("bucket", "terms"), names, blocks, buckets


def tfidf_blocks(tb: TermBlocks, n_docs: int, least: float, most: float, bare: bool = False) -> tuple[DataFrame, DataFrame, int, int]:
    """Cells and names of the unit TF-IDF rows over the terms that ``least`` to ``most`` documents hold; with ``bare`` also empty rows."""
    names = _numbered(tb.terms, tb.buckets, least, most)

    def run(t: pa.Table) -> pa.Table:
        kind = t.column("bucket").is_valid()
        learnt = t.filter(kind).sort_by("bucket")
        df, size = flat(learnt.column("dfs")).to_numpy(), list_sizes(learnt.column("dfs"))
        kept = (df >= least) & (df <= most)
        idf, place = smoothed_idf(n_docs, df.astype(np.float64)), (np.cumsum(kept) - 1).astype(np.int32)
        out, ps = [], t.filter(pc.invert(kind))
        for i in range(ps.num_rows):
            ids, sizes, codes, tfs = postings(ps, i)
            has = kept[codes]
            sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[has], minlength=len(sizes))
            w = (tfs * idf[codes])[has]
            norm = np.repeat(np.sqrt(square_sums(w, sizes)), sizes)
            out += _pieces(t.column("block")[0].as_py(), ids, sizes, place[codes[has]], w / norm, len(out), bare)
        held = np.bincount(np.repeat(np.arange(len(size)), size)[kept], minlength=len(size))
        out[:1] = [{**p, "at": learnt.column("bucket").to_numpy(), "dfs": held} for p in out[:1]]
        return arrow_rows(cells, out)

    cells = CELLS.format("long")
    null = lambda *cs: [F.lit(None).cast(ty).alias(c) for c, ty in cs]
    own = tb.postings.select("block", "ids", "sizes", "codes", "tfs", *null(("bucket", "int"), ("dfs", "array<int>")))
    learnt = names.filter("block >= 0").select("block", *null(("ids", "array<long>"), ("sizes", "array<int>"), ("codes", "binary"), ("tfs", "binary")),
                                               "bucket", "dfs")
    return tb.by_block(own.unionByName(learnt), run, cells), names, tb.blocks, tb.buckets


def factorise(weights: DataFrame, k: int = 4, rounds: int = 10) -> Factors:
    """``k`` non-negative factors of ``weights`` (id, term, weight; unique, weights over 0)."""
    return factorise_blocks(*weight_blocks(weights), k, rounds)


def _values(state: pa.Table, i: int, k: int) -> np.ndarray:
    return state.column("hs")[int(i)].values.to_numpy().reshape(-1, k)


def _places(names: pa.Table) -> dict[int, np.ndarray]:
    """For every block the places of its terms in the bucket."""
    own = names.filter(pc.greater_equal(names.column("block"), 0)).sort_by("block")
    return {b.as_py(): (a := x.values.to_numpy())[a >= 0] for b, x in zip(own.column("block"), own.column("at"))}


def _sent(k: int):
    """What a bucket sends each block: the factors of the block's terms."""
    def run(names: pa.Table, state: pa.Table) -> pa.Table:
        h, bucket = _values(state, 0, k), state.column("bucket")[0].as_py()
        return arrow_rows(STATE, [{"block": b, "bucket": bucket, "hs": h[a].ravel()} for b, a in _places(names).items()])
    return run


def _by_terms(k: int, gram: list[float]):
    """Update of a bucket's factors from the blocks' sums."""
    def run(names: pa.Table, state: pa.Table) -> pa.Table:
        block, at = state.column("block").to_numpy(), _places(names)
        h = _values(state, np.flatnonzero(block < 0)[0], k)
        p = np.zeros_like(h)
        for i in sorted(np.flatnonzero(block >= 0), key=lambda i: block[i]):
            p[at[block[i]]] += _values(state, i, k)
        h = h * p / (h @ np.reshape(gram, (k, k)) + TINY)
        return arrow_rows(STATE, [{"block": -1, "bucket": state.column("bucket")[0].as_py(), "hs": h.ravel(), "gram": (h.T @ h).ravel()}])
    return run


def _cells(cells: pa.Table, state: pa.Table, k: int):
    """Each row of a block: its number, document and term of each weight, the weights, and the documents' factors."""
    for i in range(cells.num_rows):
        sizes, code, x = (cells.column(c)[i].values.to_numpy() for c in ("sizes", "codes", "ws"))
        yield cells.column("piece")[i].as_py(), np.repeat(np.arange(len(sizes)), sizes), code, x, _values(state, i, k)


def _by_documents(k: int, gram: list[float] | None):
    """Update of a block's factors from its terms' ones (none without ``gram``); ``gram`` of a row ends with the product
    of W H with V."""
    def run(cells: pa.Table, state: pa.Table) -> pa.Table:
        kind, out = state.column("piece").is_valid(), []
        h = flat(state.filter(pc.invert(kind)).sort_by("bucket").column("hs")).to_numpy().reshape(-1, k)
        for piece, row, code, x, w in _cells(cells.sort_by("piece"), state.filter(kind).sort_by("piece"), k):
            cross = 0.0
            if gram is not None:
                p = np.stack([np.bincount(row, x * h[code, j], len(w)) for j in range(k)], axis=1)
                w = w * p / (w @ np.reshape(gram, (k, k)) + TINY)
                cross = (w * p).sum()
            out.append({"block": cells.column("block")[0].as_py(), "piece": piece, "hs": w.ravel(), "gram": np.r_[(w.T @ w).ravel(), cross]})
        return arrow_rows(STATE, out)
    return run


def _term_sums(k: int):
    """What a block sends each bucket: for each of its terms the sums of the weights times the documents' factors."""
    def run(cells: pa.Table, state: pa.Table) -> pa.Table:
        cells = cells.sort_by("piece")
        buckets, size = (cells.column(c)[0].values.to_numpy() for c in ("at", "dfs"))
        ends, block = np.cumsum(size), cells.column("block")[0].as_py()
        s = np.zeros((int(size.sum()), k))
        for _, row, code, x, w in _cells(cells, state.sort_by("piece"), k):
            s += np.stack([np.bincount(code, x * w[row, j], len(s)) for j in range(k)], axis=1)
        return arrow_rows(STATE, [{"block": block, "bucket": b, "hs": s[e - n:e].ravel()} for b, e, n in zip(buckets, ends, size) if n])
    return run


def _factor_rows(keys: str, name: str, k: int):
    def run(named: pa.Table, state: pa.Table) -> pa.Table:
        order = "piece" if keys == "ids" else "block"
        f = flat(state.sort_by(order).column("hs")).to_numpy().reshape(-1, k)
        return pa.table({name: flat(named.sort_by(order).column(keys)), **{f"f{j}": pa.array(f[:, j]) for j in range(k)}})
    return run


def factorise_blocks(cells: DataFrame, names: DataFrame, blocks: int, buckets: int, k: int = 4, rounds: int = 10) -> Factors:
    """``k`` non-negative factors of the weights in blocks, of :func:`weight_blocks` or :func:`tfidf_blocks`."""
    # dealt once, so that an update shuffles the other side only; on disk, as in memory they would fill the executors' heaps
    dealt = cells.repartition(blocks, "block").persist(StorageLevel.DISK_ONLY)
    terms = names.drop("dfs").repartition(buckets, "bucket").persist(StorageLevel.DISK_ONLY)
    seen = dealt.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).first()
    scale = ((seen["s"] or 0.0) / max(seen["n"] or 0, 1) / k) ** 0.5 or 1.0

    def met(left: DataFrame, right: DataFrame, key: str, parts: int, run, schema: str = STATE) -> DataFrame:
        return left.groupBy(key).cogroup(right.repartition(parts, key).groupBy(key)).applyInArrow(run, schema)

    none = lambda *cs: [F.lit(None).cast(ty).alias(c) for c, ty in cs]
    w = dealt.select("block", *none(("bucket", "int")), "piece", _starts("ids", 0, k, scale).alias("hs"), *none(("gram", "array<double>")))
    h = terms.filter("block = -1").select("block", "bucket", *none(("piece", "int")), _starts("terms", k, k, scale).alias("hs"), *none(("gram", "array<double>")))
    h = saved(h, "nmf-terms")
    w = saved(met(dealt, w, "block", blocks, _by_documents(k, None)), "nmf-documents")
    gram_w, loss = _sums(w, k * k), []
    for _ in range(rounds):
        # what blocks and buckets send each other is shuffled, not written
        sums = met(dealt, w, "block", blocks, _term_sums(k))
        h = saved(met(terms, h.unionByName(sums), "bucket", buckets, _by_terms(k, gram_w)), "nmf-terms")
        gram_h = _sums(h, k * k)
        sent = met(terms, h, "bucket", buckets, _sent(k))
        w = saved(met(dealt, w.unionByName(sent), "block", blocks, _by_documents(k, gram_h)), "nmf-documents")
        # the products belong to this round's terms, so they give the loss of this round's pair
        *gram_w, cross = _sums(w, k * k + 1)
        loss.append((seen["q"] or 0.0) - 2 * cross + sum(a * b for a, b in zip(gram_w, gram_h)))
    factors = ", ".join(f"f{j} double" for j in range(k))
    id_type = cells.schema["ids"].dataType.elementType.simpleString()
    documents = met(dealt, w, "block", blocks,
                    _factor_rows("ids", "id", k), f"id {id_type}, {factors}")
    named = met(terms.filter("block = -1"), h, "bucket", buckets, _factor_rows("terms", "term", k), f"term string, {factors}")
    out = Factors(saved(documents, "nmf-documents"), saved(named, "nmf-terms"), loss, k)
    dealt.unpersist()
    terms.unpersist()
    return out
