"""Non-negative factors: planted topics, falling loss, equality with numpy."""

import numpy as np
import pytest

from cauce.operators import corpus as C, nmf, term_blocks as TB


def table(spark, v):
    rows = [(i, f"t{j:02d}", float(v[i, j])) for i in range(v.shape[0]) for j in range(v.shape[1]) if v[i, j] > 0]
    return spark.createDataFrame(rows, "id long, term string, weight double").repartition(3)


def test_planted_topics_come_back_and_the_loss_falls(spark):
    rng = np.random.default_rng(0)
    h0 = np.zeros((3, 18))
    for k in range(3):
        h0[k, 6 * k:6 * k + 6] = rng.uniform(1, 2, 6)
    w0 = np.zeros((60, 3))
    w0[np.arange(60), np.arange(60) % 3] = rng.uniform(0.5, 1.5, 60)
    out = nmf.factorise(table(spark, w0 @ h0), 3, rounds=12)
    assert all(b <= a * (1 + 1e-9) for a, b in zip(out.loss, out.loss[1:])) and out.loss[-1] < 0.02 * out.loss[0]
    topics = {}
    for r in out.top_terms(6).collect():
        topics.setdefault(r.topic, set()).add(r.term)
    assert {frozenset(t) for t in topics.values()} == {frozenset(f"t{j:02d}" for j in range(6 * k, 6 * k + 6)) for k in range(3)}


def test_one_round_equals_numpy(spark):
    rng = np.random.default_rng(1)
    v = rng.uniform(0, 1, size=(12, 9)) * (rng.uniform(size=(12, 9)) < 0.6)
    v[:, 0] += 0.1
    v[0, :] += 0.1
    df = table(spark, v)
    first, second = nmf.factorise(df, 2, rounds=1), nmf.factorise(df, 2, rounds=2)
    w = np.array([[r.f0, r.f1] for r in sorted(first.documents.collect(), key=lambda r: r.id)])
    h = np.array([[r.f0, r.f1] for r in sorted(first.terms.collect(), key=lambda r: r.term)]).T
    assert first.loss[0] == pytest.approx(((v - w @ h) ** 2).sum())
    h2 = h * (w.T @ v) / (w.T @ w @ h + nmf.TINY)
    w2 = w * (v @ h2.T) / (w @ h2 @ h2.T + nmf.TINY)
    assert np.array([[r.f0, r.f1] for r in sorted(second.documents.collect(), key=lambda r: r.id)]) == pytest.approx(w2)
    assert np.array([[r.f0, r.f1] for r in sorted(second.terms.collect(), key=lambda r: r.term)]).T == pytest.approx(h2)
    assert second.loss[1] == pytest.approx(((v - w2 @ h2) ** 2).sum()) and second.loss[1] <= second.loss[0]


def test_nothing_to_factorise(spark):
    out = nmf.factorise(spark.createDataFrame([], "id long, term string, weight double"), 2, rounds=1)
    assert out.documents.count() == 0 and out.top_terms().count() == 0


def test_many_blocks_and_buckets_give_the_same_factors(spark, monkeypatch):
    rng = np.random.default_rng(2)
    v = rng.uniform(0, 1, size=(40, 25)) * (rng.uniform(size=(40, 25)) < 0.4)
    v[:, 0] += 0.1
    df = table(spark, v).union(spark.createDataFrame([(None, "t00", 0.5)], "id long, term string, weight double"))
    whole = nmf.factorise(df, 3, rounds=3)
    for name, size in (("BLOCK", 40), ("BUCKET", 30), ("PIECE", 5)):
        monkeypatch.setattr(nmf, name, size)
    *_, blocks, buckets = nmf.weight_blocks(df)
    assert blocks > 4 and buckets > 4
    cut = nmf.factorise(df, 3, rounds=3)
    assert cut.loss == pytest.approx(whole.loss)
    for a, b, key in ((cut.documents, whole.documents, "id"), (cut.terms, whole.terms, "term")):
        a, b = ({r[key]: list(r)[1:] for r in d.collect()} for d in (a, b))
        assert set(a) == set(b) and None not in a and all(a[x] == pytest.approx(b[x]) for x in b)
    assert set(range(40)) == {r.id for r in cut.documents.select("id").collect()}


def test_blocks_of_texts_have_the_tfidf_weights(spark):
    texts = [(1, "the cat sat on the mat"), (2, "the cat ran"), (2, "a cat again, ran ran"), (3, None), (4, ""), (None, "the mat ran"), (5, "only once here"),
             (6, "mat mat cat")]
    docs = spark.createDataFrame(texts, "id long, text string").repartition(3)
    post = C.term_counts(docs, "id", "text").filter("term != 'on'")
    idf = C.fit_idf(post, 8).filter("df >= 2 AND df <= 4")
    old = {(r.id, r.term): r.weight for r in C.tfidf(post, idf).collect()}
    cells, names, blocks, buckets = nmf.tfidf_blocks(TB.term_blocks(docs, "id", "text", stop_words=["on"], block=10, bucket=10), 8, 2, 4)
    place = {(r.block, r.bucket): r["at"] for r in names.filter("block >= 0").collect()}
    kept = {r.bucket: r.terms for r in names.filter("block = -1").collect()}
    got, rows = {}, cells.collect()
    for r in rows:
        terms = [kept[u][i] for b, u in sorted(place) if b == r.block for i in place[b, u] if i >= 0]
        ends = np.cumsum(r.sizes)
        got |= {(d, terms[c]): w for d, n, e in zip(r.ids, r.sizes, ends) for c, w in zip(r.codes[e - n:e], r.ws[e - n:e])}
    assert got == pytest.approx({k: w for k, w in old.items() if k[0] is not None}) and len(got) == 8
    assert sum(r.n for r in rows) == len(old) and sum(r.s for r in rows) == pytest.approx(sum(old.values()))
    left = nmf.factorise_blocks(cells, names, blocks, buckets, 2, rounds=2)
    assert {r.id for r in left.documents.collect()} == {1, 2, 6}
    assert left.loss == pytest.approx(nmf.factorise(C.tfidf(post, idf), 2, rounds=2).loss)
