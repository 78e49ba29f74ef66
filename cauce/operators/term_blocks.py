"""Postings of a corpus in blocks of documents.

A posting as a row of its own takes some 40 bytes in every shuffle, and a
frequency, a weight or a length needs several.  Here the documents are dealt by
id into blocks of about ``BLOCK`` characters.  A block numbers its own terms and
holds its postings as arrays of these numbers; whatever concerns a term leaves
it once a block, not once a document, in arrays of one of the ``buckets`` that
the terms' hashes give.  A bucket adds up the blocks' counts of its terms and
sends each block what it asks for.  Rows meet by block or by bucket in Spark's
shuffles; a task holds one of them, whose size does not grow with the corpus.

Documents of one id count as one, texts of null have no terms.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.functions import strings as S
from cauce.session import scratch_path

BLOCK, BUCKET = 16 << 20, 8 << 20
#: Postings of a row of a block.
PIECE = 1 << 18

#: ``codes`` and ``tfs`` as by :func:`planes`, ``joined`` as by :func:`joined_terms`: what blocks hold most of, in few bytes.
ROWS = "block int, bucket int, ids array<long>, sizes array<int>, codes binary, tfs binary, joined string, dfs array<int>"
STATS = "block int, bucket int, dfs array<int>, at array<int>, terms array<string>"
_ARROW = {"joined": pa.string(), "block": pa.int32(), "bucket": pa.int32(), "ids": pa.list_(pa.int64()), "sizes": pa.list_(pa.int32()),
          "codes": pa.list_(pa.int32()), "tfs": pa.list_(pa.int32()), "terms": pa.list_(pa.string()), "dfs": pa.list_(pa.int32()),
          "at": pa.list_(pa.int32()), "piece": pa.int32(), "ws": pa.list_(pa.float64()), "hs": pa.list_(pa.float64()),
          "gram": pa.list_(pa.float64()), "counts": pa.list_(pa.int64()), "ranks": pa.list_(pa.int32()), "trained": pa.list_(pa.int32()),
          "n": pa.int64(), "s": pa.float64(), "q": pa.float64()}


def saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_rows(schema: str, rows: list[dict], ids: pa.DataType = pa.int64()) -> pa.Table:
    """Rows of the block tables' columns; columns that a row lacks are null."""
    out = {}
    for name, said in (c.strip().split(" ")[:2] for c in schema.split(",")):
        values, kind = [r.get(name) for r in rows], pa.list_(ids) if name == "ids" else pa.binary() if said == "binary" else _ARROW[name]
        if not pa.types.is_list(kind):
            out[name] = pa.array(values, kind)
            continue
        parts = [pa.array([], kind.value_type) if v is None else v.cast(kind.value_type) if isinstance(v, pa.Array) else pa.array(v, kind.value_type)
                 for v in values]
        offsets = pa.array(np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int32))
        out[name] = pa.ListArray.from_arrays(offsets, pa.concat_arrays(parts) if parts else pa.array([], kind.value_type),
                                             mask=pa.array([v is None for v in values], pa.bool_()))
    return pa.table(out)


def flat(column: pa.ChunkedArray) -> pa.Array:
    """The values of all lists of a column, one after the other."""
    column = column.combine_chunks()
    return column.flatten() if isinstance(column, pa.Array) else pa.concat_arrays([c.flatten() for c in column.chunks])


def planes(x: np.ndarray) -> bytes:
    """Integers as their lowest bytes, then the next ones and so on: small ones leave long stretches of zeros."""
    return x.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(x: pa.Scalar) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x.as_buffer(), np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _steps(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ascending numbers of neighbouring stretches as differences; a stretch begins with its first number."""
    steps = np.diff(codes, prepend=codes.dtype.type(0))
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    steps[first] = codes[first]
    return steps


def postings(rows: pa.Table, i: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """ids, terms a document, numbers of the terms and counts of a row of postings."""
    ids, sizes = (rows.column(c)[i].values for c in ("ids", "sizes"))
    sizes, steps = sizes.to_numpy(), from_planes(rows.column("codes")[i]).astype(np.int64)
    total = np.cumsum(steps)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    return ids, sizes, total - np.repeat(total[first] - steps[first], sizes[sizes > 0]), from_planes(rows.column("tfs")[i])


def joined_terms(terms: pa.Array) -> str:
    # words hold no line ends
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms), "\n")[0].as_py()


def split_terms(rows: pa.Table) -> pa.Table:
    """``terms`` as lists in place of ``joined``."""
    at = rows.schema.get_field_index("joined")
    return rows.set_column(at, "terms", pc.split_pattern(rows.column("joined"), "\n"))


def list_sizes(column: pa.ChunkedArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(column), 0).to_numpy()


def buckets_of(terms: pa.Array, buckets: int) -> np.ndarray:
    """The bucket of every term: a hash of its text, the same in every process."""
    return (pd.util.hash_array(terms.to_numpy(zero_copy_only=False).astype(object), categorize=False) >> np.uint64(32)) % np.uint64(buckets)


def numbered_terms(words: np.ndarray, texts: pa.Array, row: np.ndarray, ngram_max: int) -> tuple[list[np.ndarray], list[np.ndarray], pa.Array]:
    """Places and numbers of the 1- to n-grams of a row's words, and the terms by number."""
    base, first = words.astype(np.int64), 0
    places, codes, terms, gram, gram_texts = [np.arange(len(row))], [base], [texts], base, texts
    for n in range(2, ngram_max + 1):
        first += len(gram_texts)
        at = np.flatnonzero(row[:len(row) - n + 1] == row[n - 1:]) if len(row) >= n else np.empty(0, np.int64)
        pair, number = np.unique(gram[at] * len(texts) + base[at + n - 1], return_inverse=True)
        gram_texts = pc.binary_join_element_wise(gram_texts.take(pa.array(pair // max(len(texts), 1))),
                                                 texts.take(pa.array(pair % max(len(texts), 1))), " ")
        gram = np.zeros(len(row), np.int64)
        gram[at] = number
        places.append(at)
        codes.append(number + first)
        terms.append(gram_texts)
    return places, codes, pa.concat_arrays(terms)


def word_batches(batches, dropped: pa.Array) -> tuple[int, pa.Array, np.ndarray, np.ndarray, pa.Array] | None:
    """Of all rows of a block: its number, the ids, words a row, the words' numbers, and the words by number; a batch's texts
    go as soon as its words are numbered."""
    block, ids, sizes, codes, texts = None, [], [], [], pa.array([], pa.string())
    for b in batches:
        if not b.num_rows:
            continue
        words = b.column("words")
        size, one = pc.fill_null(pc.list_value_length(words), 0).to_numpy(), words.flatten()
        if len(dropped):
            keep = pc.invert(pc.is_in(one, dropped))
            size = np.bincount(np.repeat(np.arange(len(size)), size)[keep.to_numpy(zero_copy_only=False)], minlength=len(size))
            one = one.filter(keep)
        block = b.column("block")[0].as_py()
        ids.append(b.column("id"))
        sizes.append(size)
        named = one.dictionary_encode()
        at = pc.index_in(named.dictionary, texts)
        new = at.is_null()
        number = pc.fill_null(at, 0).to_numpy().astype(np.int32)
        number[new.to_numpy(zero_copy_only=False)] = len(texts) + np.arange(pc.sum(new).as_py() or 0)
        texts = pa.concat_arrays([texts, named.dictionary.filter(new)])
        codes.append(number[named.indices.to_numpy()])
        del b, words, one, named, at, new
        pa.default_memory_pool().release_unused()
    if block is None:
        return None
    return block, pa.concat_arrays(ids), np.concatenate(sizes).astype(np.int64), np.concatenate(codes), texts


def block_rows(block: int, ids: pa.Array, row_sizes: np.ndarray, words: np.ndarray, texts: pa.Array, ngram_max: int, buckets: int) -> Iterator[pa.Table]:
    """One block: rows of postings (ids, terms a document, numbers, counts) and one row a bucket (terms, documents that hold them)."""
    named = ids.dictionary_encode(null_encoding="encode")
    doc_of_row, docs = named.indices.to_numpy().astype(np.int64), named.dictionary
    row_ends, by_doc = np.cumsum(row_sizes), np.argsort(doc_of_row, kind="stable")
    row_at = np.searchsorted(doc_of_row[by_doc], np.arange(len(docs) + 1))
    if ngram_max > 1:
        row = np.repeat(np.arange(len(ids)), row_sizes)
        places, codes, terms = numbered_terms(words, texts, row, ngram_max)
        rows = [row[p] for p in places]
    else:
        codes, terms, rows = [words], texts, []
    # numbers in the order of the buckets, so that a bucket's terms are neighbours; in order of their texts they take less room
    bucket = buckets_of(terms, buckets).astype(np.int64)
    order = pc.sort_indices(terms).to_numpy()
    order = order[np.argsort(bucket[order], kind="stable")]
    number = np.empty(len(terms), np.int32)
    number[order] = np.arange(len(terms))
    # terms of a row: of each length they are neighbours
    cuts = [np.searchsorted(r, np.arange(len(ids) + 1)) for r in rows] or [np.r_[0, row_ends]]
    words_of_doc = np.bincount(doc_of_row, sum(np.diff(c) for c in cuts), len(docs))
    ends, dfs = np.cumsum(words_of_doc), np.zeros(len(terms), np.int32)
    lo, done, sizes, code, tfs = 0, 0, np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)
    while lo < len(docs):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PIECE, side="right")))
        some = by_doc[row_at[lo]:row_at[hi]]
        keys = np.concatenate([np.repeat(doc_of_row[some] - lo, c[some + 1] - c[some]) * len(terms) + number[np.concatenate([x[c[r]:c[r + 1]] for r in some])]
                               for c, x in zip(cuts, codes)])
        keys.sort()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
        doc, found = np.divmod(keys[starts], max(len(terms), 1))
        sizes, code = np.r_[sizes, np.bincount(doc, minlength=hi - lo)], np.r_[code, found.astype(np.int32)]
        tfs = np.r_[tfs, np.diff(np.r_[starts, len(keys)]).astype(np.int32)]
        dfs += np.bincount(found, minlength=len(terms)).astype(np.int32)
        lo = hi
        # the rest waits for the next documents
        while len(sizes) and (len(code) > PIECE or lo == len(docs)):
            n = max(1, int(np.searchsorted(np.cumsum(sizes), PIECE, side="right")))
            a = int(sizes[:n].sum())
            yield arrow_rows(ROWS, [{"block": block, "ids": docs.slice(done, n), "sizes": sizes[:n], "codes": planes(_steps(code[:a], sizes[:n])), "tfs": planes(tfs[:a])}])
            done, sizes, code, tfs = done + n, sizes[n:], code[a:], tfs[a:]
    edges, terms = np.searchsorted(bucket[order], np.arange(buckets + 1)), terms.take(pa.array(order))
    yield arrow_rows(ROWS, [{"block": block, "bucket": i, "joined": joined_terms(terms.slice(a, b - a)), "dfs": dfs[a:b]}
                            for i, (a, b) in enumerate(zip(edges, edges[1:])) if b > a])


class TermBlocks:
    """``postings``: block, ids, sizes, codes, tfs; ``terms``: block, bucket, joined, dfs; both of one written table."""

    def __init__(self, rows: DataFrame, blocks: int, buckets: int):
        self.blocks, self.buckets = blocks, buckets
        self.postings = rows.filter("bucket is null").select("block", "ids", "sizes", "codes", "tfs")
        self.terms = rows.filter("bucket is not null").select("block", "bucket", "joined", "dfs")

    def by_bucket(self, rows: DataFrame, run: Callable, schema: str) -> DataFrame:
        return rows.repartition(self.buckets, "bucket").groupBy("bucket").applyInArrow(run, schema)

    def by_block(self, rows: DataFrame, run: Callable, schema: str) -> DataFrame:
        return rows.repartition(self.blocks, "block").groupBy("block").applyInArrow(run, schema)


def term_blocks(docs: DataFrame, id_col: str, text_col: str, ngram_max: int = 1, min_len: int = 2, stop_words=(),
                block: int = BLOCK, bucket: int = BUCKET) -> TermBlocks:
    """T09 in blocks: the lower-cased words and n-grams of :func:`cauce.operators.corpus.term_counts`.

    ``stop_words`` are left out of the words (for ``ngram_max`` 1).  ``block`` and ``bucket``: characters of a block, and for each bucket."""
    size = docs.agg(F.coalesce(F.sum(F.length(text_col)), F.lit(0))).first()[0]
    cores = docs.sparkSession.sparkContext.defaultParallelism
    blocks, buckets = max(cores, -(-size // block)), max(cores, -(-size // bucket))
    # texts are dealt, not words: they are shorter
    dealt = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("_x")).repartition(blocks, "id")
    toks = dealt.select("id", F.spark_partition_id().alias("block"), S.words(F.col("_x"), min_len=min_len).alias("words"))
    dropped = pa.array(list(stop_words), pa.string())

    def run(batches):
        got = word_batches(batches, dropped)
        if got:
            for rows in block_rows(*got, ngram_max, buckets):
                yield from rows.to_batches()

    return TermBlocks(saved(toks.mapInArrow(run, ROWS), "term-blocks"), blocks, buckets)


def term_stats(tb: TermBlocks, asked: DataFrame) -> DataFrame:
    """What every block learns of its terms, written: a row (block, bucket) has ``dfs``, the documents of the corpus
    that hold each of its terms, and of those in ``asked`` (term) the places ``at`` and the ``terms``.

    Rows with block -1 are the asked terms of a bucket and their ``dfs``."""
    buckets = tb.buckets

    @F.pandas_udf("int")
    def bucket(term: pd.Series) -> pd.Series:
        return pd.Series(buckets_of(pa.array(term, pa.string()), buckets).astype(np.int32))

    asking = asked.select(bucket("term").alias("bucket"), "term").filter(~F.contains("term", F.lit("\n"))) \
        .groupBy("bucket").agg(F.array_join(F.collect_set("term"), "\n").alias("joined")) \
        .select(F.lit(-1).alias("block"), "bucket", "joined", F.lit(None).cast("array<int>").alias("dfs"))

    def run(t: pa.Table) -> pa.Table:
        t = split_terms(t)
        block, size = t.column("block").to_numpy(), list_sizes(t.column("terms"))
        named = flat(t.column("terms")).dictionary_encode()
        code, ends = named.indices.to_numpy(), np.cumsum(size)
        counts = np.zeros(len(named.dictionary), np.int64)
        want = np.zeros(len(counts), bool)
        for i, (b, hi, n) in enumerate(zip(block, ends, size)):
            own = code[hi - n:hi]
            if b < 0:
                want[own] = True
            else:
                counts[own] += t.column("dfs")[i].values.to_numpy()
        out = []
        for b, hi, n in zip(block, ends, size):
            own = code[hi - n:hi]
            at = np.flatnonzero(want[own] & (counts[own] > 0))
            names = named.dictionary.take(pa.array(own[at]))
            out.append({"block": b, "bucket": t.column("bucket")[0].as_py(), "dfs": counts[own[at] if b < 0 else own].astype(np.int32),
                        "at": None if b < 0 else at, "terms": names})
        return arrow_rows(STATS, out)

    return saved(tb.by_bucket(tb.terms.unionByName(asking), run, STATS), "term-stats")


def frequencies(stats: DataFrame) -> DataFrame:
    """term, df of the asked terms."""
    return stats.filter("block = -1").select(F.explode(F.arrays_zip(F.col("terms").alias("term"), F.col("dfs").alias("df"))).alias("s")).select("s.*")


def smoothed_idf(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.log((1.0 + n_docs) / (1.0 + df)) + 1.0


def square_sums(w: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of squares of neighbouring stretches, in whole parts and limbs as in ``inverted.square_sum``."""
    square, limb = w * w, float(1 << 40)
    whole = np.floor(square)
    first = np.floor((square - whole) * limb)
    second = np.floor(((square - whole) * limb - first) * limb)
    edges = np.r_[0, np.cumsum(sizes)]
    total = lambda x: np.diff(np.r_[0, np.cumsum(x.astype(np.int64))][edges])
    return total(whole) + (total(first) + total(second) / limb) / limb


def asked_weights(tb: TermBlocks, stats: DataFrame, n_docs: int) -> DataFrame:
    """id, length, terms, ws of the documents that hold an asked term: tf * idf of the asked terms, and the length of
    the document's vector over all its terms; ids of null are left out."""

    def run(t: pa.Table) -> pa.Table:
        kind = t.column("bucket").is_valid()
        st = t.filter(kind).sort_by("bucket")
        idf = smoothed_idf(n_docs, flat(st.column("dfs")).to_numpy().astype(np.float64))
        base = np.r_[0, np.cumsum(list_sizes(st.column("dfs")))][:-1]
        names = flat(st.column("terms"))
        named = np.full(len(idf), -1, np.int64)
        named[np.repeat(base, list_sizes(st.column("at"))) + flat(st.column("at")).to_numpy()] = np.arange(len(names))
        parts, ps = [], t.filter(pc.invert(kind))
        for i in range(ps.num_rows):
            ids, sizes, codes, tfs = postings(ps, i)
            w, name = tfs * idf[codes], named[codes]
            row, has = np.repeat(np.arange(len(sizes)), sizes), name >= 0
            held = np.bincount(row[has], minlength=len(sizes))
            offsets = pa.array(np.r_[0, np.cumsum(held)].astype(np.int32))
            part = pa.table({"id": ids, "length": np.sqrt(square_sums(w, sizes)),
                             "terms": pa.ListArray.from_arrays(offsets, names.take(pa.array(name[has]))),
                             "ws": pa.ListArray.from_arrays(offsets, pa.array(w[has]))})
            parts.append(part.filter(pc.and_(pa.array(held > 0), ids.is_valid())))
        schema = pa.schema({"id": pa.int64(), "length": pa.float64(), "terms": pa.list_(pa.string()), "ws": pa.list_(pa.float64())})
        return pa.concat_tables([p.cast(schema) for p in parts]) if parts else schema.empty_table()

    null = lambda *cs: [F.lit(None).cast(ty).alias(c) for c, ty in cs]
    own = tb.postings.select("block", "ids", "sizes", "codes", "tfs", *null(("bucket", "int"), ("dfs", "array<int>"), ("at", "array<int>"), ("terms", "array<string>")))
    learnt = stats.filter("block >= 0").select("block", *null(("ids", "array<long>"), ("sizes", "array<int>"), ("codes", "binary"), ("tfs", "binary")),
                                               "bucket", "dfs", "at", "terms")
    return saved(tb.by_block(own.unionByName(learnt), run, "id long, length double, terms array<string>, ws array<double>"), "asked-weights")
