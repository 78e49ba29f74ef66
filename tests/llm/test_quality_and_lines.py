import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cauce.llm import line_dedup, quality_rules
from cauce.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def same(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, (tuple(r[c] for c in want.columns) for r in got.collect()))) == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    same(spark, name)


def brute_repeat(words, k=8):
    seen, marked = {}, set()
    for i in range(len(words) - k + 1):
        seen.setdefault(tuple(words[i:i + k]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            marked.update(i + j for i in at for j in range(k))
    return len(marked)


def test_repeat_words_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(300):
        ids = rng.integers(0, rng.integers(1, 4), rng.integers(0, 40))
        assert quality_rules.repeat_words(ids.astype(np.int64)) == brute_repeat(ids.tolist())


def test_quality_cases(small, empty):
    rows = quality_rules.judge(small).collect()
    assert len(rows) == small.count()
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 20)
    kept = quality_rules.keep(small)
    assert kept.columns == small.columns
    assert quality_rules.judge(empty).count() == 0 and quality_rules.keep(empty).count() == 0


def test_bad_host_takes_its_good_documents(spark):
    good, bad = " ".join(f"word{i}" for i in range(40)), "too short"
    rows = [(i, bad if i % 10 else good, "junk") for i in range(200)] + [(1000 + i, good + str(i), f"host{i % 5}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert not got[0].base_failed and not got[0].kept and all(got[1000 + i].kept for i in range(200))
    assert sorted(r.doc_id for r in quality_rules.keep(docs).collect()) == [1000 + i for i in range(200)]


def test_host_of_repeated_lines(spark):
    """Lines of two words that come again and again fail a host, though every text has enough words and no repeated window."""
    text = lambda i: "\n".join(x for j in range(12) for x in (f"only {i}x{j}", *["read more"] * (2 if j % 3 else 1)))
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(i, text(i), "lists") for i in range(60)] + [(1000 + i, good + str(i), f"host{i % 5}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert not any(r.base_failed for r in got.values())
    assert all(got[i].host_rejected and not got[i].kept and got[1000 + i].kept for i in range(60))


def test_prior_follows_the_hosts():
    a, b = quality_rules.beta_prior(4, 400, 0.04, 200, 2.0, 1.0)
    assert a == pytest.approx(b) and a + b > 1000  # equal hosts: a strong prior
    a, b = quality_rules.beta_prior(4, 400, 0.04, 200, 2.0, 2.0)
    assert a + b == 1.0  # hosts at 0 and 1: a weak one
    assert quality_rules.beta_prior(0, None, None, None, None, None) == (0.0, 1.0)


def brute_lines(rows):
    key = lambda x: x.encode().strip().lower().decode()
    held = {}
    for d, t, *_ in rows:
        for line in (t or "").split("\n"):
            held.setdefault(key(line), set()).add(1 << 63 if d is None else d)
    out = []
    for d, t, *_ in rows:
        stay = [x for x in (t or "").split("\n") if len(key(x)) < 10 or len(held[key(x)]) < 2 or min(held[key(x)]) == (1 << 63 if d is None else d)]
        n = len((t or "").split("\n"))
        out.append((d, n, n - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


def test_line_dedup_cases(small, empty):
    got = line_dedup.report(small).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256))
    rows = [(r.doc_id, r.text) for r in small.collect()]
    assert sorted(map(tuple, got.collect()), key=str) == brute_lines(rows)
    whole = line_dedup.dedup(small)
    assert whole.columns == small.columns
    assert sorted((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in whole.collect() if r.doc_id) == sorted((r[0], r[3]) for r in brute_lines(rows) if r[0])
    assert line_dedup.report(empty).count() == 0 and line_dedup.dedup(empty).count() == 0


def test_one_line_in_a_third_of_documents(spark):
    rows = [(i, f"own line number {i}\n" + ("Shared line of everyone" if i % 3 == 0 else "x")) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.report(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256))
    assert sorted(map(tuple, got.collect()), key=str) == brute_lines(rows)


def test_perfect_hash_finds_its_keys_only():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    prints = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    numbers = np.arange(20_000)
    index = line_dedup.Index(line_dedup.build_index(keys, prints, numbers, numbers * 7))
    slots = index.slots(keys, prints)
    assert sorted(slots) == list(range(20_000)) and (index.counts[slots] == numbers).all() and (index.owners[slots] == 7 * numbers).all()
    assert (index.slots(keys + np.uint64(1), prints) == -1).mean() > 0.999 and (index.slots(keys, prints + np.uint64(1)) == -1).all()
    one = line_dedup.Index(line_dedup.build_index(np.array([5, 5], np.uint64), np.array([1, 2], np.uint64), np.array([10, 20]), np.array([1, 2])))
    assert sorted(one.counts[one.slots(np.array([5, 5], np.uint64), np.array([2, 1], np.uint64))]) == [10, 20]
