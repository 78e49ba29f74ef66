"""Blocks of postings are built a piece at a time, and kept on disk."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark import StorageLevel

from cauce.operators import nmf, term_blocks as TB, text_models as TM


def batches(rows, size):
    kind = pa.schema({"id": pa.int64(), "block": pa.int32(), "words": pa.list_(pa.string())})
    for i in range(0, len(rows), size):
        yield pa.RecordBatch.from_pylist([{"id": k, "block": 7, "words": ws} for k, ws in rows[i:i + size]], kind)


@pytest.mark.parametrize("n", (1, 2))
def test_pieces_hold_every_posting_once_whatever_their_size(n, monkeypatch):
    rng = np.random.default_rng(n)
    rows = [(None if i % 11 == 3 else i % 17, None if i % 13 == 5 else [f"w{x}" for x in rng.geometric(0.2, i % 9)]) for i in range(60)]
    want, dfs = {}, Counter()
    for k, ws in rows:
        kept = [w for w in ws or [] if w != "w2" or n > 1]
        want.setdefault(k, Counter()).update(" ".join(kept[i:i + m]) for m in range(1, n + 1) for i in range(len(kept) - m + 1))
    for c in want.values():
        dfs.update(c.keys())
    for piece, size in ((5, 7), (1 << 18, 1000)):
        monkeypatch.setattr(TB, "PIECE", piece)
        got = TB.word_batches(batches(rows, size), pa.array([] if n > 1 else ["w2"], pa.string()))
        out = pa.concat_tables(list(TB.block_rows(*got, n, 3)))
        named = out.filter(out.column("bucket").is_valid()).sort_by("bucket")
        terms = [t for r in named.column("joined").to_pylist() for t in r.split("\n")]
        assert dict(zip(terms, TB.flat(named.column("dfs")).to_pylist())) == dict(dfs) and set(out.column("block").to_pylist()) == {7}
        found, ps = {}, out.filter(out.column("bucket").is_null())
        for i in range(ps.num_rows):
            ids, sizes, codes, tfs = TB.postings(ps, i)
            assert len(codes) <= piece or len(sizes) == 1
            for k, hi, m in zip(ids.to_pylist(), np.cumsum(sizes), sizes):
                assert k not in found
                found[k] = Counter({terms[c]: int(f) for c, f in zip(codes[hi - m:hi], tfs[hi - m:hi])})
        assert found == want
    assert TB.word_batches(iter([]), pa.array([], pa.string())) is None


def test_a_block_takes_few_bytes_a_word(monkeypatch):
    monkeypatch.setattr(TB, "PIECE", 1 << 12)
    rng = np.random.default_rng(4)
    n, docs = 400_000, 2000
    named = pa.DictionaryArray.from_arrays(pa.array(rng.integers(0, 3000, n), pa.int32()), pa.array([f"w{i}" for i in range(3000)])).dictionary_decode()
    words = pa.ListArray.from_arrays(pa.array(np.arange(docs + 1) * (n // docs), pa.int32()), named)
    b = pa.RecordBatch.from_arrays([pa.array(range(docs), pa.int64()), pa.array([0] * docs, pa.int32()), words], names=["id", "block", "words"])
    tracemalloc.start()
    got = TB.word_batches(iter([b]), pa.array([], pa.string()))
    held = sum(r.num_rows for r in TB.block_rows(*got, 1, 4))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held > 50 and peak < 20 * n


def test_what_blocks_keep_does_not_fill_the_heaps(spark, monkeypatch):
    kept, kind = [], type(spark.range(0))
    real = kind.persist
    monkeypatch.setattr(kind, "persist", lambda self, *a: kept.append(a) or real(self, *a))
    rows = [(i, f"red green w{i % 5} blue{i % 2}", i % 2, "test" if i % 5 == 0 else "train") for i in range(30)]
    d = spark.createDataFrame(rows, "doc_id long, text string, label int, split string")
    nmf.factorise_blocks(*nmf.tfidf_blocks(TB.term_blocks(d, "doc_id", "text"), 30, 1, 30), 2, rounds=1)
    TM.classify(d, rounds=1).collect()
    assert len(kept) == 5 and all(k == (StorageLevel.DISK_ONLY,) for k in kept)
