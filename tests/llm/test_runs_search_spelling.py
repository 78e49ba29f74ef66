"""Periodic runs, exact search and spelling variants against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cauce.llm import periodic_runs, pivot_search, spelling
from cauce.llm.periodic_runs import SquareCatcher, runs_of


# ------------------------------------------------------------------ runs
def plain_runs(w, exponent, shortest):
    out = {}
    for p in range(1, len(w) // exponent + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j > i and j - i + p >= max(shortest, exponent * p):
                out.setdefault((i, j - i + p), p)   # the smallest period of a stretch comes first
            i = max(j, i + 1)
    return sorted((a, n, p) for (a, n), p in out.items())


def random_words(rng, n):
    if rng.random() < 0.5:
        return [rng.randrange(rng.choice([1, 2, 3])) for _ in range(n)]
    w = []
    while len(w) < n:
        u = [rng.randrange(3) for _ in range(rng.randint(1, 9))]
        w += (u * rng.randint(1, 6))[:rng.randint(1, 50)]
    return w


@pytest.mark.parametrize("exponent, shortest", [(2, 0), (3, 0), (4, 6)])
def test_runs_equal_brute_force_for_any_division_into_appends(exponent, shortest):
    rng = random.Random(exponent)
    for _ in range(400):
        w = random_words(rng, rng.randint(0, 60))
        want = plain_runs(w, exponent, shortest)
        assert runs_of([w], exponent, shortest)[0] == want
        catcher, at, squares = SquareCatcher(exponent, shortest), 0, set()
        while at < len(w):
            m = rng.choice([1, 1, 2, 5, 17])
            for p, first, last in catcher.append(np.array(w[at:at + m], np.int64)):
                for z in range(first, last + 1):
                    assert z + 2 * p <= at + m and w[z:z + p] == w[z + p:z + 2 * p]
                    assert (z, p) not in squares     # a square is reported once, when its last word comes
                    squares.add((z, p))
            at += m
        assert catcher.runs() == want
        if exponent == 2:
            for p in range(1, len(w) // 2 + 1):
                for z in range(len(w) - 2 * p + 1):
                    if w[z:z + p] == w[z + p:z + 2 * p] and not any(p % q == 0 and w[z:z + 2 * p - q] == w[z + q:z + 2 * p] for q in range(1, p)):
                        assert (z, p) in squares


def test_state_of_a_catcher_stays_small():
    catcher = SquareCatcher(4, 6)
    for at in range(0, 20000, 100):
        catcher.append(np.arange(at, at + 100) * 7919 % 1009)
    assert sum(len(h) for _, h in catcher._windows) < 40 * 20000 and not catcher._open or len(catcher._open) < 100


def test_long_periodic_texts_are_quick():
    w = [0] * 100000 + [0, 1] * 50000 + list(range(1000)) * 5
    assert runs_of([w], 4, 6)[0] == [(0, 100001, 1), (100000, 100002, 2), (200000, 5000, 1000)]


def plain_runs_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w, 4, 6)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2], sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_of_documents(spark, small, empty):
    rng = random.Random(4)
    rows = [(i, " ".join(f"é{x}" for x in random_words(rng, rng.randint(0, 80)))) for i in range(300)]
    rows += [(r.doc_id, r.text) for r in small.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("collapsed", F.lit(2))
    out = periodic_runs.digest(periodic_runs.periodic_runs(docs.repartition(5), alter=periodic_runs.looped))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert Counter(map(tuple, out.collect())) == Counter(plain_runs_row(*r) for r in rows)
    assert periodic_runs.digest(periodic_runs.periodic_runs(empty)).count() == 0


# ---------------------------------------------------------------- search
def plain_nearest(rows, k, asked):
    part = [(i, v) for i, v in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max((len(v) for _, v in part), default=0)
    x = [[int(np.floor(64 * float(c))) for c in v] + [0] * (width - len(v)) for _, v in part]
    out = []
    for a, (i, _) in enumerate(part):
        if asked(i):
            found = sorted((-sum(p * q for p, q in zip(x[a], x[b])), j) for b, (j, _) in enumerate(part) if b != a)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return Counter(out)


@pytest.mark.parametrize("cell, slot", [(4096, 4096), (16, 8)])
def test_search_equals_brute_force(spark, monkeypatch, cell, slot):
    monkeypatch.setattr(pivot_search, "CELL", cell)
    monkeypatch.setattr(pivot_search, "SLOT", slot)
    rng = random.Random(7)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in centres[i % 5]]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 8) for i in range(150)]                                       # a third of the rows are equal
    rows += [(20, [0.5] * 8), (20, [0.5] * 8), (40, rows[40][1])]                              # repeated ids and rows
    rows += [(None, [1.0] * 8), (2000, None), (2020, [1.0, None]), (2040, [float("nan")]), (2060, [float("inf")] * 8), (2080, []), (2100, [3.0])]
    rows += [(2120, [1e9] * 8), (2140, [-1e9] * 8)]                                           # beyond what doubles add up exactly
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, d string").repartition(4)
    got = pivot_search.nearest(df, F.col("vec_id") % 20 == 0, 20).drop("n_scored")
    assert Counter(map(tuple, got.collect())) == plain_nearest(rows, 20, lambda i: i % 20 == 0)
    assert pivot_search.nearest(df.where("1 = 0"), F.col("vec_id") % 20 == 0).count() == 0
    assert pivot_search.nearest(df.where("vec_id is null or vec_id = 2000"), F.col("vec_id") % 20 == 0).count() == 0


def test_pivots_spare_most_scores(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16)) * 2
    x = centres[np.arange(4000) % 20] + rng.normal(size=(4000, 16)) * 0.1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    out = pivot_search.nearest(df, F.col("vec_id") % 20 == 0, 10)
    per_query = out.groupBy("query_id").agg(F.max("n_scored").alias("n"), F.count(F.lit(1)).alias("k"))
    assert per_query.where("k <> 10").count() == 0
    assert per_query.agg(F.avg("n")).first()[0] < 1000      # of 4000


# -------------------------------------------------------------- spelling
def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


@pytest.mark.parametrize("alphabet", ["ab", "abc", "abéÿ×"])
def test_near_words_equal_brute_force(alphabet):
    rng = random.Random(len(alphabet))
    for _ in range(40):
        words = list({"".join(rng.choice(alphabet) for _ in range(rng.randint(7, 10))) for _ in range(rng.randint(1, 120))})
        got = [(words[a], words[w]) for left in (True, False) for at, found in spelling.searched(words, words, np.full(len(words), left))
               for a, w in zip(at.tolist(), found.tolist())]
        assert len(got) == len(set(got))
        assert set(got) == {(a, b) for a in words for b in words if is_near(a, b)}


def plain_variants(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{doc_id}:{w}".encode()) if doc_id is not None else 1
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if c >= 2 and len(w) >= 7}
    near = {w: [v for v in n if is_near(w, v)] for w in n}
    form = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs and max(n[v] for v in vs) >= 10 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return Counter((w, form.get(w), root(w), c, len(near[w]), n[form[w]] if w in form else None) for w, c in n.items())


@pytest.mark.parametrize("shard, half", [(8192, 4096), (20, 4)])
def test_variants_of_documents(spark, small, empty, monkeypatch, shard, half):
    monkeypatch.setattr(spelling, "SHARD", shard)
    monkeypatch.setattr(spelling, "HALF", half)
    monkeypatch.setattr(spelling, "CELLS", 300)
    rng = random.Random(9)
    base = ["stadtgarten", "Häuserzeile", "regenbogen", "regenwetter", "regenmantel", "sonnenschein", "abababab", "ababababa", "aaaaaaa", "aaaaaaaa", "z" * 300]

    def word():
        w = rng.choice(base)
        if rng.random() < 0.3:
            at = rng.randrange(len(w))
            w = w[:at] + rng.choice(["", "e", "ß", w[at] * 2]) + w[at + 1:]
        return w.upper() if rng.random() < 0.2 else w
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 60))) + rng.choice([".", "7", "×÷"])) for i in range(120)]
    rows += [(500 + i, " ".join(["stadtgarten"] * 200 + ["stadtgarden"] * 4)) for i in range(5)] + [(505, "stattgarden stattgarden"), (505, "stattgarden stattgarden")]
    rows += [(r.doc_id, r.text) for r in small.collect()]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(5)
    out = spelling.variants(docs)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert Counter(map(tuple, out.collect())) == plain_variants(rows)
    assert spelling.variants(empty).count() == 0
