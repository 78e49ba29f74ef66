r"""Line dedup through a sharded minimal perfect hash.

A line's key is the line stripped of ``[\x20\x09-\x0D]`` with A-Z lowered.
Keys of ten code points or more that two documents hold stay only in the
document with the smallest id; elsewhere their lines go.

1. One scan turns every line into a row of its document and 128-bit key hash.
2. Keys are reduced to (smallest id, largest id, lines) with map-side
   combining; a key is shared when the two ids differ.  A common line costs
   one row a task, not one a document.
3. Shared keys are cut into shards of about ``SHARD_KEYS``.  Each shard builds
   a minimal perfect hash (levels of collision-free bits, ranked) and arrays
   of fingerprints, counts and owners in its order.
4. Line rows are dealt by (shard, salt) and stream past their shard's arrays;
   ``SALTS`` copies of a shard's arrays let a hot line's probes spread.  Only
   the probes that must go come out.
5. Documents take their list of dropped lines by a join on id and text hash.

Cases: a null or empty text is one empty line; repeated rows of one document
count as one document and lose the same lines; a null doc_id counts as one
document with the largest id; empty tables give empty results.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cauce.llm.common import id_or_last, map_rows, prepare, saved, text_hash

MIN_POINTS = 10
SHARD_KEYS = 1 << 16
SALTS = 8
GAMMA = 2.0


def line_key(line: bytes) -> bytes | None:
    """The key of a line, or None for keys that are too short to count."""
    key = line.strip().lower()  # on bytes both are exactly the ASCII rules
    if len(key) < MIN_POINTS or len(key) < 4 * MIN_POINTS and sum((c & 0xC0) != 0x80 for c in key) < MIN_POINTS:
        return None
    return key


def key_hash(key: bytes) -> tuple[int, int]:
    return struct.unpack("<qq", xxhash.xxh3_128_digest(key))


def line_rows(docs: DataFrame) -> DataFrame:
    """owner, th (the text's hash), line and the two halves of its key hash, for lines that count."""

    def run(parts):
        for p in parts:
            out = {k: [] for k in ("owner", "th", "line", "a", "b")}
            for owner, th, text in zip(p["owner"], p["th"], p["text"]):
                for i, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
                    if (key := line_key(line)) is not None:
                        a, b = key_hash(key)
                        for k, v in zip(out, (owner, th, i, a, b)):
                            out[k].append(v)
            yield out

    return map_rows(docs, run, "owner long, th binary, line int, a long, b long")


# --- minimal perfect hash -------------------------------------------------

def _spread(x: np.ndarray, level: int) -> np.ndarray:
    x = x ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def build_index(keys: np.ndarray, prints: np.ndarray, counts: np.ndarray, owners: np.ndarray) -> bytes:
    """Serialise a minimal perfect hash over distinct 64-bit keys with its arrays in slot order.

    Each level hashes the keys left into GAMMA bits a key; keys alone on a
    bit settle there, the others go to the next level.  A key's slot is the
    rank of its bit.  Keys left after 40 levels (only equal 64-bit keys would)
    are stored sorted behind the slots.
    """
    left, levels = np.arange(len(keys)), []
    order: list[np.ndarray] = []
    while len(left) and len(levels) < 40:
        size = max(64, int(GAMMA * len(left)) // 64 * 64 + 64)
        at = _spread(keys[left], len(levels)) % np.uint64(size)
        alone = np.bincount(at.astype(np.int64), minlength=size) == 1
        bits = np.zeros(size, bool)
        hit = alone[at.astype(np.int64)]
        bits[at[hit].astype(np.int64)] = True
        order.append(left[hit][np.argsort(at[hit])])
        levels.append(np.packbits(bits, bitorder="little"))
        left = left[~hit]
    order.append(left)
    slots = np.concatenate(order) if order else np.empty(0, np.int64)
    head = [len(keys), len(left), len(levels), *map(len, levels)]
    return b"".join([np.array(head, np.int64).tobytes(), *[x.tobytes() for x in levels], prints[slots].astype(np.uint64).tobytes(),
                     counts[slots].astype(np.int64).tobytes(), owners[slots].astype(np.int64).tobytes()])


class Index:
    """Probe side of ``build_index``."""

    def __init__(self, blob: bytes):
        n, self.rest, k = np.frombuffer(blob, np.int64, 3)
        sizes, at = np.frombuffer(blob, np.int64, k, 24), 24 + 8 * int(k)
        self.levels, self.ranks, before = [], [], 0
        for s in sizes:
            bits = np.unpackbits(np.frombuffer(blob, np.uint8, int(s), at), bitorder="little").astype(bool)
            rank = np.cumsum(bits) - bits + before
            self.levels.append(bits)
            self.ranks.append(rank.astype(np.int64))
            before, at = before + int(bits.sum()), at + int(s)
        n = int(n)
        self.settled = n - int(self.rest)
        self.prints, self.counts, self.owners = (np.frombuffer(blob, t, n, at + 8 * n * i) for i, t in enumerate((np.uint64, np.int64, np.int64)))

    def slots(self, keys: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """The slot of each key whose fingerprint agrees, else -1."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for i, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            if not len(left):
                break
            at = (_spread(keys[left], i) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            found = rank[at[hit]]
            ok = self.prints[found] == prints[left[hit]]
            out[left[hit][ok]] = found[ok]
            left = left[~hit]
        for j in range(self.settled, self.settled + int(self.rest)):
            out[left[self.prints[j] == prints[left]]] = j
        return out


def shared_lines(lines: DataFrame) -> DataFrame:
    """Keys that two documents hold: a, b, owner (the smallest id), n (lines)."""
    return (lines.groupBy("a", "b").agg(F.min("owner").alias("owner"), F.max("owner").alias("last"), F.count(F.lit(1)).alias("n"))
            .where("owner <> last").drop("last"))


def index_shards(keys: DataFrame, n_shards: int) -> DataFrame:
    """shard, index: one row a shard with its perfect hash and arrays."""

    def build(pdf):
        a, b = (pdf[c].to_numpy(np.int64).view(np.uint64) for c in ("a", "b"))
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "index": [build_index(a, b, pdf["n"].to_numpy(), pdf["owner"].to_numpy())]})

    return keys.withColumn("shard", shard_of(n_shards)).groupBy("shard").applyInPandas(build, "shard int, index binary")


def shard_of(n_shards: int):
    return F.pmod(F.col("b"), F.lit(n_shards)).cast("int")


def dropped_lines(lines: DataFrame) -> DataFrame:
    """owner, th, line of every line that goes, found by probing the shards."""
    spark = lines.sparkSession
    keys = saved(shared_lines(lines), "shared-lines")
    n_shards = max(1, -(-keys.count() // SHARD_KEYS))
    shards = saved(index_shards(keys, n_shards), "line-index")
    salt = F.pmod(F.xxhash64("owner", "line"), F.lit(SALTS)).cast("int")
    none = {"owner": "long", "th": "binary", "line": "int", "a": "long", "b": "long", "index": "binary"}
    probes = lines.select(shard_of(n_shards).alias("shard"), salt.alias("salt"), "owner", "th", "line", "a", "b", F.lit(None).cast("binary").alias("index"))
    arrays = (shards.select("shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), "index")
              .select("shard", "salt", *[(F.col(c) if c == "index" else F.lit(None).cast(t).alias(c)) for c, t in none.items()]))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = (arrays.unionByName(probes).repartition(parts, "shard", "salt")
             .sortWithinPartitions("shard", "salt", F.col("index").isNull()))

    def probe(parts):
        index, at = None, None
        for p in parts:
            shard = np.array(p["shard"], np.int64) * SALTS + np.array(p["salt"], np.int64)
            gone = {k: [] for k in ("owner", "th", "line")}
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if p["index"][lo] is not None:
                    index, at, lo = Index(p["index"][lo]), shard[lo], lo + 1
                if lo == hi or at != shard[lo]:
                    continue  # no key of this shard is shared
                a, b = (np.array(p[c][lo:hi], np.int64).view(np.uint64) for c in ("a", "b"))
                slot = index.slots(a, b)
                for i in np.flatnonzero(slot >= 0):
                    if index.owners[slot[i]] != p["owner"][lo + i]:
                        for k in gone:
                            gone[k].append(p[k][lo + i])
            yield gone

    return map_rows(dealt, probe, "owner long, th binary, line int")


def dropped_by_document(docs: DataFrame) -> DataFrame:
    """owner, th, gone: the sorted numbers of the lines that a document's text loses; documents that lose none are absent."""
    prepare(docs.sparkSession)
    source = docs.select(id_or_last().alias("owner"), text_hash().alias("th"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    gone = dropped_lines(saved(line_rows(source), "lines")).groupBy("owner", "th").agg(F.array_sort(F.collect_set("line")).alias("gone"))
    return saved(gone, "dropped-lines")


def judged(docs: DataFrame) -> DataFrame:
    """row (a struct of all columns), text (empty for null), gone (null if nothing goes) of every document row."""
    rows = docs.select(F.struct("*").alias("row"), id_or_last().alias("owner"), text_hash().alias("th"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.join(dropped_by_document(docs), ["owner", "th"], "left").select("row", "text", "gone")


def kept_text() -> Column:
    """The text left of a judged row, in the JVM; untouched texts pass as they are."""
    lines, gone = F.split("text", "\n", -1), F.col("gone")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.when(gone.isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept of every document row."""
    return judged(docs).select("row.doc_id", F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
                               F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), kept_text().alias("kept"))


def dedup(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, with ``text`` cut to the lines that stay (empty for null)."""
    rows = judged(docs).select("row", kept_text().alias("kept"))
    return rows.select(*[F.col("kept").alias(c) if c.lower() == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
