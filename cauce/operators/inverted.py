"""Lexical search on a distributed inverted index.

Documents are unit TF-IDF vectors.  They are ordered by their length before
scaling (short texts have few, heavy terms; long ones many light terms), and
cut into shards of about ``SHARD`` documents of similar length.  The postings
of a term within a shard are a block with its greatest weight, so a term that
nearly every document holds is as many blocks as there are shards, and never
one row or one task.  The blocks' maxima are a table of (shard, term).

A query is answered in two phases.  Its weights times the maxima bound the
score of any document of a shard.  (1) The query goes to its most promising
shard, which gives a floor for its k-th score.  (2) It goes to the other shards
whose bound reaches the floor.  Within a shard terms are taken in the order of
their greatest contributions, and once those that are left can't lift a
document that has none of the terms taken to the floor, only documents met so
far go on (max-score).  Nothing is collected: queries, maxima and shards meet in
joins, and (query, shard) pairs are dealt as rows.

Scores are added up in the order of the terms and lengths are exact sums, so
equal texts have equal scores to the last digit; ranks are by (score desc, item
id asc) of the scores as they are.  Documents that share no term with a query
score 0.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.operators.relational import top_n_per_group
from cauce.session import scratch_path

SHARD, SLOT = 4096, 4096
#: Bounds are compared with a floor lowered by more than sums of doubles can err.
SLACK = 1 - 1e-9


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def square_sum(w: Column) -> Column:
    """Sum of squares that is the same for the same values in any order: whole parts and two limbs of 2^-40 are
    added as integers."""
    square, limb = w * w, float(1 << 40)
    whole = F.floor(square)
    first = F.floor((square - whole) * limb)
    second = F.floor(((square - whole) * limb - first) * limb)
    return F.sum(whole) + (F.sum(first) + F.sum(second) / limb) / limb


def query_terms(queries_w: DataFrame, unit: bool = True) -> DataFrame:
    """qid, term, qw, written once, from (id, term, weight)."""
    q = queries_w.select(F.col("id").cast("long").alias("qid"), "term", F.col("weight").cast("double").alias("qw"))
    if unit:
        length = q.groupBy("qid").agg(F.sqrt(square_sum(F.col("qw"))).alias("_n"))
        q = q.join(length, "qid").select("qid", "term", F.when(F.col("_n") > 0, F.col("qw") / F.col("_n")).otherwise(0.0).alias("qw"))
    return _saved(q, "queries")


def shards(weighted: DataFrame, unit: bool = True, size: int = SHARD) -> DataFrame:
    """shard, id, terms, ws of the asked terms, written, from (id, term, weight, asked) of all terms.

    The weights are written once, terms only where asked for: the lengths need no others.  A shard is a class
    of lengths (half powers of two) and one of its parts."""
    rows = _saved(weighted.select(F.col("id").cast("long").alias("id"), F.when(F.col("asked"), F.col("term")).alias("term"),
                                  F.col("weight").cast("double").alias("w")), "weights")
    length = rows.groupBy("id").agg(F.sqrt(square_sum(F.col("w"))).alias("length"), F.count("term").alias("_k")).filter("_k > 0")
    per_doc = rows.filter("term is not null").join(length, "id").groupBy("id").agg(
        F.any_value("length").alias("length"), F.collect_list(F.struct("term", "w")).alias("p"))
    return cut_shards(_saved(per_doc.select("id", "length", F.col("p.term").alias("terms"), F.col("p.w").alias("ws")), "asked-weights"), unit, size)


def cut_shards(docs: DataFrame, unit: bool = True, size: int = SHARD) -> DataFrame:
    """shard, id, terms, ws, from written documents (id, length, terms, ws) with the length over all their terms."""
    docs = docs.withColumn("_class", F.when(F.col("length") > 0, F.floor(2 * F.log2("length"))).otherwise(-10000).cast("int"))
    # one row a class: lengths of doubles have about 4000 at most
    classes = docs.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).collect()
    parts = F.create_map(*[F.lit(v) for c in classes for v in (c["_class"], -(-c["n"] // size))]) if classes else F.create_map(F.lit(0), F.lit(1))
    part = F.pmod(F.xxhash64("id"), F.element_at(parts, F.col("_class"))).cast("int")
    scale = F.when(F.lit(unit) & (F.col("length") > 0), F.col("length")).otherwise(F.lit(1.0))
    return docs.withColumn("_s", scale).select(F.concat_ws(":", "_class", part).alias("shard"), "id", "terms",
                                               F.transform("ws", lambda w: w / F.col("_s")).alias("ws"))


CANDIDATES = "qid long, item_id long, score double"


def topk(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``(qid, item_id, score, rank)`` of the k best documents of every query.

    ``index`` (of :func:`shards`) holds every term of ``queries`` (qid, term, qw; unique, weights not negative)."""
    postings = index.select("shard", F.explode(F.arrays_zip("terms", "ws")).alias("p"))
    tops = _saved(postings.groupBy("shard", F.col("p.terms").alias("term")).agg(F.max("p.ws").alias("most")), "maxima")
    bounds = _saved(queries.join(tops, "term").groupBy("qid", "shard").agg(F.sum(F.col("qw") * F.col("most")).alias("bound")), "bounds")
    vectors = queries.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("term", "qw"))).alias("q")) \
        .select("qid", F.col("q.term").alias("terms"), F.col("q.qw").alias("ws"))
    vectors = _saved(vectors, "vectors")
    slots = max(1, -(-vectors.count() // SLOT))
    first = bounds.groupBy("qid").agg(F.max_by("shard", F.struct("bound", "shard")).alias("shard"))
    first = _saved(first, "first-shards")
    found = _saved(_score(index, first.withColumn("floor", F.lit(0.0)), vectors, k, slots), "first-found")
    best = top_n_per_group(found, "qid", [F.desc("score"), F.asc("item_id")], k)
    floors = best.groupBy("qid").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("floor"))
    others = bounds.join(first, ["qid", "shard"], "left_anti").join(floors, "qid", "left") \
        .withColumn("floor", F.coalesce("floor", F.lit(0.0))).filter(F.col("bound") >= F.col("floor") * SLACK)
    others = _saved(others.select("qid", "shard", "floor"), "other-shards")
    found = found.unionByName(_score(index, others, vectors, k, slots))
    return top_n_per_group(found, "qid", [F.desc("score"), F.asc("item_id")], k, rank_col="rank").select("qid", "item_id", "score", "rank")


def _score(index: DataFrame, dealt: DataFrame, vectors: DataFrame, k: int, slots: int) -> DataFrame:
    """Candidates of ``dealt`` (qid, shard, floor) for ``vectors`` (qid, terms, ws): the k best of a shard at the floor or
    above, score over 0."""
    # written, as Spark then knows that it is small (one row a shard): only documents of shards that are asked move
    asked = _saved(dealt.select("shard").distinct(), "asked-shards")
    items = index.join(asked, "shard", "left_semi").select("shard", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"), F.lit(0).alias("kind"), "id",
                         F.lit(0.0).alias("floor"), "terms", "ws")
    asking = dealt.join(vectors, "qid").select("shard", F.pmod(F.xxhash64("qid"), F.lit(slots)).cast("int").alias("slot"), F.lit(1).alias("kind"),
                          F.col("qid").alias("id"), "floor", "terms", "ws")
    rows = items.unionByName(asking).repartition("shard", "slot").sortWithinPartitions("shard", "slot", "kind")

    def run(batches):
        cell, held, shard = None, [], None
        for b in batches:
            place = list(zip(b.column("shard").to_pylist(), b.column("slot").to_pylist(), b.column("kind").to_pylist()))
            cuts = [0, *(i for i in range(1, len(place)) if place[i] != place[i - 1]), len(place)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if cell != place[lo][:2]:
                    cell, held, shard = place[lo][:2], [], None
                part = b.slice(lo, hi - lo)
                if place[lo][2] == 0:
                    held.append(part)
                    continue
                if shard is None and held:
                    shard, held = Shard(pa.Table.from_batches(held)), []
                if shard is not None:
                    found = [shard.best(t, w, f, k) for t, w, f in zip(part.column("terms").to_pylist(), part.column("ws").to_pylist(),
                                                                       part.column("floor").to_pylist())]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(part.column("id").to_numpy(), [len(i) for i, _ in found])),
                        pa.array(np.concatenate([i for i, _ in found])), pa.array(np.concatenate([s for _, s in found]))],
                        names=["qid", "item_id", "score"])

    return rows.mapInArrow(run, T._parse_datatype_string(CANDIDATES))


class Shard:
    """Posting blocks of one shard: for every term the documents' places and weights, and the greatest weight."""

    def __init__(self, docs: pa.Table):
        docs = docs.combine_chunks()
        self.ids = docs.column("id").to_numpy()
        terms, ws = (docs.column(c).combine_chunks() for c in ("terms", "ws"))
        doc = np.repeat(np.arange(len(self.ids)), np.diff(terms.offsets.to_numpy()))
        named = terms.flatten().dictionary_encode()
        code = named.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        self.docs, self.ws = doc[order], ws.flatten().to_numpy()[order]
        self.at = {t: i for i, t in enumerate(named.dictionary.to_pylist())}
        self.edges = np.searchsorted(code[order], np.arange(len(self.at) + 1))
        self.tops = np.maximum.reduceat(self.ws, self.edges[:-1]) if len(self.at) else np.empty(0)

    def best(self, terms: list, weights: list, floor: float, k: int):
        """(ids, scores) of the k best at ``floor`` or above, by (score desc, id asc)."""
        known = [(self.at[t], w) for t, w in zip(terms, weights) if t in self.at]
        if not known:
            return self.ids[:0], np.empty(0)
        code, w = np.array([c for c, _ in known]), np.array([x for _, x in known])
        most = w * self.tops[code]
        order = np.argsort(-most, kind="stable")
        left = most.sum() - np.cumsum(most[order])
        # terms after the first one that leaves less than the floor open no document
        opening = order[:1 + int(np.argmax(left < floor * SLACK))] if left[-1] < floor * SLACK else order
        met = np.zeros(len(self.ids), bool)
        for c in code[opening]:
            met[self.docs[self.edges[c]:self.edges[c + 1]]] = True
        # contributions in the order of the terms
        at = np.concatenate([np.arange(self.edges[c], self.edges[c + 1]) for c in code])
        size = self.edges[code + 1] - self.edges[code]
        score = np.bincount(self.docs[at], self.ws[at] * np.repeat(w, size), len(self.ids))
        some = np.flatnonzero(met & (score >= floor) & (score > 0))
        if len(some) > k:
            kth = np.partition(score[some], len(some) - k)[len(some) - k]
            some = some[score[some] >= kth]
        some = some[np.lexsort((self.ids[some], -score[some]))[:k]]
        return self.ids[some], score[some]


def with_zero_scores(found: DataFrame, item_ids: DataFrame, query_ids: DataFrame, k: int) -> DataFrame:
    """Fill queries with fewer than ``k`` scored documents with those that share no term: score 0, smallest ids first.

    Only the 2k smallest ids can be needed, since a query that lacks documents has fewer than k others."""
    least = item_ids.orderBy("item_id").limit(2 * k).agg(F.sort_array(F.collect_list("item_id")).alias("ids")).scalar()
    had = found.groupBy("qid").agg(F.collect_list("item_id").alias("had"))
    short = query_ids.join(had, "qid", "left").withColumn("had", F.coalesce("had", F.array().cast("array<long>"))) \
        .filter(F.size("had") < k).withColumn("ids", least)
    rest = F.slice(F.array_except("ids", "had"), F.lit(1), F.lit(k) - F.size("had"))
    more = short.select("qid", F.size("had").alias("_n"), F.posexplode(rest).alias("_i", "item_id")) \
        .select("qid", "item_id", F.lit(0.0).alias("score"), (F.col("_n") + F.col("_i") + 1).cast("int").alias("rank"))
    return found.unionByName(more)


def search(weighted: DataFrame, queries: DataFrame, k: int, item_ids: DataFrame | None = None, unit: bool = True,
           size: int = SHARD) -> DataFrame:
    """Exact top-k of documents (id, term, weight, asked) for ``queries`` (of :func:`query_terms`).

    ``asked`` marks terms that some query has.  ``item_ids`` (item_id) names all documents, also those without any
    term; by default those of ``weighted``."""
    ids = weighted.select(F.col("id").alias("item_id")).distinct() if item_ids is None else item_ids
    return search_index(shards(weighted, unit, size), queries, k, ids)


def search_index(index: DataFrame, queries: DataFrame, k: int, ids: DataFrame) -> DataFrame:
    """T13 on an index of :func:`shards` or :func:`cut_shards`; ``ids`` (item_id) names all documents."""
    found = _saved(topk(index, queries, k), "found")
    return with_zero_scores(found, ids.select(F.col("item_id").cast("long").alias("item_id")), queries.select("qid").distinct(), k)
