"""Exact search, containment and quantiles against brute force, with their plans."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cauce.operators import aggregates as A
from cauce.operators import containment, dense, inverted, ml, stats
from cauce.operators import term_blocks as TB


def plan(df):
    return df._jdf.queryExecution().toString()


# ----------------------------------------------------------------- dense
def brute(items, queries, k, metric):
    out = {}
    for qid, q in queries:
        score = lambda v: -float(((v - q) ** 2).sum()) if metric == "euclidean" else float((v * q).sum())
        out[qid] = [i for _, i in sorted((-score(v), i) for i, v in items)[:k]]
    return out


@pytest.mark.parametrize("metric", ["dot", "euclidean"])
@pytest.mark.parametrize("part, slot", [(4096, 4096), (32, 16)])
def test_nearest_equals_brute_force(spark, monkeypatch, metric, part, slot):
    monkeypatch.setattr(dense, "PART", part)
    monkeypatch.setattr(dense, "SLOT", slot)
    monkeypatch.setattr(dense, "CENTRES", 12)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 6)) * 3
    items = [(i, centres[i % 8] + rng.normal(size=6) * 0.2) for i in range(400)]
    items += [(1000 + i, np.full(6, 0.25)) for i in range(200)]                 # a third of the items are equal
    queries = [(i, v + 0.01) for i, v in items[:60]] + [(900, np.full(6, 0.25)), (901, np.zeros(6))]
    frame = lambda rows: spark.createDataFrame([(i, v.tolist()) for i, v in rows] + [(None, [1.0] * 6), (5000, None), (5001, [None] * 6)],
                                               "id long, v array<double>").repartition(4)
    report = {}
    got = dense.nearest(spark, frame(items), "id", "v", frame(queries), "id", "v", 7, metric, report)
    rows = got.collect()
    want = brute(items, queries, 7, metric)
    found = {}
    for r in sorted(rows, key=lambda r: (r.qid, r.rank)):
        found.setdefault(r.qid, []).append(r.item_id)
    assert found == want
    assert all(r.rank == 1 + want[r.qid].index(r.item_id) for r in rows)
    assert report["searched"] < report["pairs"]


def test_nearest_prunes_cells_and_collects_no_query(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 8)) * 5
    df = spark.createDataFrame([(i, (centres[i % 30] + rng.normal(size=8) * 0.1).tolist()) for i in range(3000)], "id long, v array<double>")
    report = {}
    dense.nearest(spark, df, "id", "v", df, "id", "v", 5, "euclidean", report)
    assert report["searched"] < 0.2 * report["pairs"]
    source = open(dense.__file__).read()
    assert source.count(".collect()") == 1      # the cells' bounds, one row a cell


def test_nearest_of_nothing(spark):
    some = spark.createDataFrame([(1, [1.0])], "id long, v array<double>")
    none = some.where("1 = 0")
    assert dense.nearest(spark, none, "id", "v", some, "id", "v", 3).count() == 0
    assert dense.nearest(spark, some, "id", "v", none, "id", "v", 3).count() == 0
    assert [tuple(r) for r in dense.nearest(spark, some, "id", "v", some, "id", "v", 3).collect()] == [(1, 1, 1.0, 1)]


def test_knn_vote(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(i % 2 * 4, 1), rng.gauss(0, 1)], i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y int")
    out = ml.knn_predict(spark, df.where("id < 150"), df.where("id >= 150"), "id", "v", "y").collect()
    assert len(out) == 50
    for r in out:
        q = np.array(rows[r.qid][1])
        near = sorted((float(((np.array(v) - q) ** 2).sum()), i, y) for i, v, y in rows[:150])[:5]
        votes = Counter()
        for d, _, y in near:
            votes[y] += 1 / (d ** 0.5 + 1e-12)
        assert r.prediction == max(votes, key=lambda y: (votes[y], -y))


# --------------------------------------------------------------- lexical
@pytest.mark.parametrize("size, slot", [(16, 8), (4096, 4096)])
def test_lexical_search_equals_brute_force(spark, monkeypatch, size, slot):
    monkeypatch.setattr(inverted, "SLOT", slot)
    rng = random.Random(size)
    terms = [f"t{i}" for i in range(60)]
    items = {i: {t: rng.random() for t in terms if t == "t0" or rng.random() < 0.08} for i in range(300)}     # t0 is in every item
    items |= {1000 + i: dict(items[7]) for i in range(100)}                                                    # copies tie to the last digit
    queries = {i: {t: rng.random() for t in rng.sample(terms, 8)} for i in range(40)}
    queries[90], queries[91] = {"t0": 1.0}, {"nowhere": 1.0, "t3": 0.5}
    queries[92] = {"nowhere": 1.0}
    frame = lambda d: spark.createDataFrame([(i, t, w) for i, ws in d.items() for t, w in ws.items()], "id long, term string, weight double").repartition(5)
    q = inverted.query_terms(frame(queries))
    asked = q.select("term").distinct().withColumn("asked", F.lit(True))
    ids = spark.createDataFrame([(i,) for i in [*items, 2000, 2001]], "item_id long")       # two items without terms
    got = inverted.search(frame(items).join(asked, "term", "left"), q, 5, ids, size=size)
    found = {}
    for r in sorted(got.collect(), key=lambda r: (r.qid, r.rank)):
        found.setdefault(r.qid, []).append((r.item_id, r.score))
    unit = lambda ws: {t: w / sum(sorted(x * x for x in ws.values())) ** 0.5 for t, w in ws.items()}
    units = {i: unit(ws) for i, ws in items.items()} | {2000: {}, 2001: {}}
    assert set(found) == set(queries)
    for qid, ws in queries.items():
        u = unit(ws)
        score = {i: sum(sorted(w * u[t] for t, w in d.items() if t in u)) for i, d in units.items()}
        want = sorted(score, key=lambda i: (-score[i], i))[:5]
        assert [i for i, _ in found[qid]] == want
        assert all(abs(s - score[i]) < 1e-11 for i, s in found[qid])


def test_a_hot_term_is_many_blocks(spark):
    rows = [(i, "the", 0.1 + i % 90 / 100, True) for i in range(1000)] + [(i, f"t{i % 5}", 0.5, None) for i in range(1000)]
    index = inverted.shards(spark.createDataFrame(rows, "id long, term string, weight double, asked boolean").repartition(6), size=64)
    docs = index.collect()
    assert len(docs) == 1000 and all(d.terms == ["the"] for d in docs)
    per_shard = Counter(d.shard for d in docs)
    assert len(per_shard) >= 16 and max(per_shard.values()) < 2 * 64
    assert all(abs(d.ws[0] - w / (w * w + 0.25) ** 0.5) < 1e-12 for d in docs for w in [0.1 + d.id % 90 / 100])


def test_pruned_terms_open_no_document_and_lose_none():
    import pyarrow as pa
    rng = random.Random(4)
    docs = [(i, {f"t{j}": rng.random() ** 3 for j in rng.sample(range(30), 6)}) for i in range(500)]
    shard = inverted.Shard(pa.table({"id": [i for i, _ in docs], "terms": [list(d) for _, d in docs], "ws": [list(d.values()) for _, d in docs]}))
    for _ in range(60):
        q = {f"t{j}": rng.random() for j in sorted(rng.sample(range(35), 8))}
        score = {i: sum(q[t] * d[t] for t in q if t in d) for i, d in docs}
        floor = sorted(score.values())[-rng.choice([1, 4, 50])] * 0.999
        ids, scores = shard.best(list(q), list(q.values()), floor, 10)
        want = [i for i in sorted(score, key=lambda i: (-score[i], i)) if score[i] >= floor][:10]
        assert ids.tolist() == want


def test_nothing_of_lexical_search_is_collected():
    source = open(inverted.__file__).read()
    assert source.count(".collect()") == 1 and "broadcast" not in source      # one row a class of lengths


# ------------------------------------------------------------ containment
@pytest.mark.parametrize("block, share", [(1 << 20, 1 << 20), (20, 200)])
def test_containment_equals_brute_force(spark, block, share):
    rng = random.Random(share)
    docs = [(i, "".join(rng.choice("ab ñ🙂") for _ in range(rng.randint(0, 60)))) for i in range(150)]
    docs += [(200 + i, docs[3][1]) for i in range(100)] + [(400, None), (401, "")]
    passages = [(i, "".join(rng.choice("ab ñ🙂") for _ in range(rng.randint(1, 5)))) for i in range(80)]
    passages += [(100 + i, passages[i][1]) for i in range(10)] + [(300, None), (301, ""), (302, docs[5][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    p = spark.createDataFrame(passages, "item_id long, text string").repartition(2)
    out = containment.containment_pairs(d, "doc_id", "text", p, "item_id", "text", block, share)
    want = Counter((i, j) for i, t in passages if t is not None for j, x in docs if x is not None and t in x)
    assert Counter(map(tuple, out.collect())) == want
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)
    # copies are one class: pairs between classes don't grow with them
    classes = containment.class_pairs(d, "text", p, "text", block, share)
    texts, pats = {x for _, x in docs if x is not None}, {t for _, t in passages if t is not None}
    assert classes.count() == classes.distinct().count() == sum(t in x for t in pats for x in texts)
    assert containment.containment_pairs(d.where("1 = 0"), "doc_id", "text", p, "item_id", "text").count() == 0


# -------------------------------------------------------------- quantiles
def test_quantiles_equal_numpy(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1.5, 2.0, rng.gauss(0, 10)])) for _ in range(3000)]
    rows += [("hot", 7.0)] * 3000 + [("one", 3.25), ("none", None), ("none", None), ("a", None), ("a", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double").repartition(6)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    out = A.quantiles(df, "x", probs, ["g"])
    assert "percentile" not in plan(out).lower()
    got = {r.g: list(r)[1:] for r in out.collect()}
    for g in {g for g, _ in rows}:
        xs = [x for h, x in rows if h == g and x is not None and x == x]
        assert got[g] == ([None] * len(probs) if not xs else pytest.approx(np.quantile(xs, probs).tolist(), abs=1e-12))
    whole = [x for _, x in rows if x is not None and x == x]
    assert list(A.quantiles(df, "x", probs).first()) == pytest.approx(np.quantile(whole, probs).tolist(), abs=1e-12)
    assert list(A.quantiles(df.where("g = 'none'"), "x", [0.5]).first()) == [None]


def test_median_and_iqr_use_no_value_map(spark):
    df = spark.createDataFrame([(float(i), None if i % 3 else float(i * i)) for i in range(100)] + [(1000.0, 5.0)], "a double, b double")
    out = stats.iqr_outliers(df, ["a", "b"])
    assert "percentile" not in plan(out).lower()
    got = {r.column: r for r in out.collect()}
    for c, xs in (("a", [*range(100), 1000.0]), ("b", [i * i for i in range(0, 100, 3)] + [5.0])):
        q1, q3 = np.quantile(xs, [0.25, 0.75])
        assert (got[c].q1, got[c].q3) == pytest.approx((q1, q3))
        assert got[c].n_outliers == sum(x < q1 - 1.5 * (q3 - q1) or x > q3 + 1.5 * (q3 - q1) for x in xs)
    filled = ml.impute(df, "b", "median")
    assert "percentile" not in plan(filled).lower()
    assert filled.where("a = 1").first().b == pytest.approx(np.median([i * i for i in range(0, 100, 3)] + [5.0]))


def test_postings_are_packed_by_bytes_and_come_back():
    sizes, codes, tfs = np.array([3, 0, 2, 1, 0]), np.array([4, 70000, 70001, 0, 9, 5]), np.array([1, 300, 1, 2, 1, 1])
    rows = TB.arrow_rows(TB.ROWS, [{"block": 0, "ids": np.arange(5), "sizes": sizes, "codes": TB.planes(TB._steps(codes, sizes)), "tfs": TB.planes(tfs)}])
    ids, got_sizes, got_codes, got_tfs = TB.postings(rows, 0)
    assert [list(x) for x in (got_sizes, got_codes, got_tfs)] == [list(x) for x in (sizes, codes, tfs)] and ids.to_pylist() == [0, 1, 2, 3, 4]
    named = TB.arrow_rows(TB.ROWS, [{"bucket": 0, "joined": TB.joined_terms(pa.array(["a b", "c"]))}])
    assert TB.split_terms(named).column("terms").to_pylist() == [["a b", "c"]]


def test_only_documents_of_asked_shards_move(spark):
    rows = [(f"s{i % 4}", i, ["x"], [float(i)]) for i in range(40)]
    index = spark.createDataFrame(rows, "shard string, id long, terms array<string>, ws array<double>")
    dealt = spark.createDataFrame([(7, "s1", 0.0)], "qid long, shard string, floor double")
    vectors = spark.createDataFrame([(7, ["x"], [1.0])], "qid long, terms array<string>, ws array<double>")
    found = inverted._score(index, dealt, vectors, 2, 1)
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.item_id, r.score) for r in found.collect()) == [(33, 33.0), (37, 37.0)]
