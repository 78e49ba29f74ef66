"""Near-duplicate classes by order MinHash with banded alignment.

A text is its sequence of words ([^\\x20\\x09-\\x0D]+).  Its elements are the
runs of K = 5 words, each labelled with its occurrence number.  A sketch keeps
the ELL = 2 elements of smallest hash and hashes them in text order, so two
texts share a sketch with a probability that falls with their edit distance;
SKETCHES independent sketches a text give the candidates.  Texts of at most
SHORT words have too few runs for that; their candidates share what is left
when the allowed number of words is deleted, which loses none.  Two texts are near
when their word edit distance is at most 0.2 times the longer length
(similarity 0.8 or more), measured by bit-parallel alignment in a diagonal
band of that width.

Rows with one text are one node.  Each sketch value's smallest node is its
representative and is aligned with the value's other members.  The members
that are still in different classes then meet, with their texts, in cells of
two parts of about CELL members each, so no task holds a whole value.  In a
cell every pair of different classes is tested: bags of words (counts by
hashed word) bound the edit distance from below, and the pairs that the bound
leaves open are aligned, the closest first, until their classes are joined.  Only
links that join two classes leave a cell, fewer than it has members; a pair
that shares several values is tested in one of them.  A value whose m members
are no copies costs up to m * m / 2 comparisons of bags and m * m / CELL rows
into the cells.  Classes are the connected components of the links.

Cases: null and empty texts are equal; texts of at most SHORT words are found
exactly among each other (one of under four words is near its equals only); a class's id is its smallest doc_id (null only if all
its ids are null); every input row gives one output row; empty tables give
empty results.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from cauce.llm.common import NULL_ID, id_or_last, map_rows, prepare, saved, text_hash

K = 5
ELL = 2
SKETCHES = 64
SIMILARITY = 0.8
#: Texts of at most so many words have keys that near ones always share.
SHORT = 14
#: Most cells of (sketches x elements) held at once; longer texts go sketch by sketch.
CELLS = 1 << 21
#: Members of a value in one part, counts of a bag, and pairs compared at once.
CELL, BUCKETS, PAIRS = 1024, 256, 2048


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: One odd multiplier a sketch, from a counter.
MULTIPLIERS = _mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def elements(words: list[bytes]) -> np.ndarray:
    """Hashes of the occurrence-labelled K-word runs, in text order."""
    if len(words) < K:
        return _mix(np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64))
    w = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    n = len(w) - K + 1
    run = w[:n].copy()
    for j in range(1, K):
        run = _mix(run + np.uint64(j)) + w[j:j + n]
    run = _mix(run)
    order = np.argsort(run, kind="stable")
    ordered = run[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    if not fresh.all():
        first = np.flatnonzero(fresh)
        label = np.empty(n, np.uint64)
        label[order] = (np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))).astype(np.uint64)
        run = np.where(label == 0, run, _mix(run + label * np.uint64(0x9E3779B97F4A7C15)))
    return run


def sketches(words: list[bytes], multipliers: np.ndarray = MULTIPLIERS) -> np.ndarray:
    """One 64-bit value a sketch: its ELL smallest elements, hashed in text order."""
    e = elements(words)
    step = max(1, CELLS // len(e))
    picked = []
    with np.errstate(over="ignore"):
        for at in range(0, len(multipliers), step):
            v = e[None, :] * multipliers[at:at + step, None]
            rows, best = np.arange(len(v)), []
            for _ in range(min(ELL, len(e))):
                least = v.argmin(axis=1)
                best.append(least)
                v[rows, least] = np.uint64(0xFFFFFFFFFFFFFFFF)
            picked.append(np.sort(np.stack(best, axis=1), axis=1))
        value = multipliers.copy()
        for column in np.concatenate(picked).T:
            value = _mix(value + e[column])
    return value


def allowed(n: int) -> int:
    """Most word edits between near texts, the longer of n words."""
    return int((1 - SIMILARITY) * n + 1e-9)


def short_keys(words: list[bytes]) -> np.ndarray:
    """Hashes of what is left of a text of at most SHORT words when some are deleted, in order.

    Near texts, the longer of n words, have n - allowed(n) words in common in
    order, so a text leaves out words down to that number for every n that it
    may meet: near texts of at most SHORT words always share a key."""
    left = {n - allowed(n) for n in range(len(words), SHORT + 1)}
    kept = {b" ".join(some) for size in left if size <= len(words) for some in combinations(words, size)}
    return np.array([xxhash.xxh3_64_intdigest(k, seed=SHORT) for k in sorted(kept)], np.uint64)


def candidate_values(words: list[bytes]) -> np.ndarray:
    """Values that candidates share: deletion keys of short texts, sketches of those that may be near a longer one."""
    if len(words) > SHORT:
        return sketches(words)
    keys = short_keys(words)
    if len(words) + allowed(SHORT + 1) <= SHORT:
        return keys
    return np.concatenate([keys, sketches(words)])


def edit_distance(a: list, b: list, most: int) -> int | None:
    """Edit distance of two sequences if at most ``most``, else None.

    Bit b of the band stands for the row ``column - most + b``, so a diagonal
    keeps its bit from column to column (Myers' recurrences, shifted by one)."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi and a[lo] == b[lo]:
        lo += 1
    end = 0
    while end < hi - lo and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[lo:len(a) - end], b[lo:len(b) - end]
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return None
    if not b:
        return len(a)
    if len(a) - sum((Counter(a) & Counter(b)).values()) > most:
        return None  # words without a partner must all be edited
    at: dict = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    width = (1 << 2 * most + 1) - 1
    vp, vn = width >> most << most, 0
    goal, score = 1 << len(a) - len(b) + most, len(a) - len(b)
    for j, x in enumerate(b):
        shift = j - most
        eq = at.get(x, 0)
        eq = (eq >> shift if shift >= 0 else eq << -shift) & width
        d0 = ((((eq & vp) + vp) ^ vp) | eq | vn) & width
        hp = (vn | ~(d0 | vp)) & width
        hn = d0 & vp
        if not d0 & goal:
            score += 1
            if score > most:
                return None
        vp = (hn | ~(d0 >> 1 | hp)) & width
        vn = d0 >> 1 & hp
    return score


def is_near(a: str | None, b: str | None) -> bool:
    x, y = ((t or "").encode("utf-8", "surrogatepass").split() for t in (a, b))
    return edit_distance(x, y, allowed(max(len(x), len(y)))) is not None


def nodes(docs: DataFrame) -> DataFrame:
    """id, node (a text's hash), owner (its smallest doc_id), sketches: one row a distinct text.

    The ids are arbitrary but unique; they are fixed once the table is written."""

    def run(parts):
        for p in parts:
            words = ((t or "").encode("utf-8", "surrogatepass").split() for t in p["text"])
            yield {"node": p["node"], "owner": p["owner"], "sketches": [candidate_values(w).view(np.int64) for w in words]}

    rows = map_rows(docs.select(text_hash().alias("node"), id_or_last().alias("owner"), F.col("text").cast("string")), run,
                    "node binary, owner long, sketches array<long>")
    # all rows of one node hold the same sketches, so any will do
    texts = rows.groupBy("node").agg(F.min("owner").alias("owner"), F.any_value("sketches").alias("sketches"))
    return saved(texts.withColumn("id", F.monotonically_increasing_id()), "nodes")


def near_classes(docs: DataFrame, found: DataFrame) -> DataFrame:
    """node, class (its smallest id) of every id that is near another one."""
    members = found.select("id", F.explode("sketches").alias("value"))
    # values of one node alone have no candidates
    values = members.groupBy("value").agg(F.min("id").alias("rep"), F.max("id").alias("last")).where("rep <> last").drop("last")
    members = saved(members.join(values, "value").select("id", "value", "rep").where("id <> rep"), "values")
    texts = texts_of(docs, found, members)
    tested = saved(aligned(texts, members.select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct()), "aligned")
    links = tested.where("near").select("a", "b")
    classes = saved(components(links), "classes")
    members = saved(open_members(members.select("id", "value"), classes), "values")
    if members.head(1):
        new = saved(linked(texts, members), "links")
        if new.head(1):
            classes = saved(components(links.unionByName(new)), "classes")
    return classes


def open_members(members: DataFrame, classes: DataFrame) -> DataFrame:
    """id, value, class, m (the value's members) of the values whose members are in different classes."""
    known = classes.select(F.col("node").alias("id"), "class")
    members = members.select("id", "value").join(known.hint("merge"), "id", "left").withColumn("class", F.coalesce("class", "id"))
    values = members.groupBy("value").agg(F.min("class").alias("first"), F.max("class").alias("last"), F.count(F.lit(1)).alias("m"))
    return members.join(values.where("first <> last").select("value", "m").hint("merge"), "value")


def bag(words: list[bytes]) -> bytes:
    """Counts (at most 255) of the words by hash."""
    at = np.fromiter((xxhash.xxh3_64_intdigest(w) % BUCKETS for w in words), np.int64, len(words))
    return np.minimum(np.bincount(at, minlength=BUCKETS), 255).astype(np.uint8).tobytes()


def linked(texts: DataFrame, members: DataFrame) -> DataFrame:
    """a, b: near pairs of members of a value that join the classes of its cells; texts go into the cells, links come out."""
    each = members.groupBy("id").agg(F.any_value("class").alias("class"), F.collect_set(F.struct("value", "m")).alias("vs"))
    rows = each.join(texts.hint("merge"), "id").select("id", "class", "text", F.col("vs.value").alias("all"), F.explode("vs").alias("v"))
    parts = F.ceil(F.col("v.m") / CELL)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), parts)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    cell = ["value", "lo", "hi"]
    rows = rows.select(F.col("v.value").alias("value"), F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"),
                       "id", "class", "part", "all", "text")

    def run(batches):
        for value, rows in cells(batches):
            out = cell_links(value, rows)
            if out:
                yield dict(zip("ab", map(list, zip(*out))))

    return map_rows(rows.repartition(*cell).sortWithinPartitions(*cell), run, "a long, b long").distinct()


def cells(batches):
    """Value and list of (id, class, part, all, text): the rows of one cell, which follow one another."""
    key, rows = None, []
    for p in batches:
        for row in zip(*(p[c] for c in ("value", "lo", "hi", "id", "class", "part", "all", "text"))):
            if row[:3] != key:
                if rows:
                    yield key[0], rows
                key, rows = row[:3], []
            rows.append(row[3:])
    if rows:
        yield key[0], rows


def cell_links(value: int, rows: list) -> list[tuple[int, int]]:
    """Near pairs (larger id, smaller id) that join classes: at most one less than the cell has members.

    Every pair that may be near by its bags (:func:`open_pairs`) is aligned, the closest ones first, unless its
    two classes have been joined in this cell; a pair that meets in several values is left to the smallest."""
    words = [t.encode("utf-8", "surrogatepass").split() for *_, t in rows]
    ids, root = [r[0] for r in rows], {r[1]: r[1] for r in rows}

    def top(c):
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    out = []
    for i, j in open_pairs(value, rows, words):
        a, b = top(rows[i][1]), top(rows[j][1])
        if a == b:
            continue
        x, y = words[i], words[j]
        if edit_distance(x, y, allowed(max(len(x), len(y)))) is not None:
            root[max(a, b)] = min(a, b)
            out.append((max(ids[i], ids[j]), min(ids[i], ids[j])))
    return out


def open_pairs(value: int, rows: list, words: list) -> list[list[int]]:
    """Pairs of a cell's rows, closest first by their bags: of different classes, of different parts if the cell has
    two, not met in a smaller value, and not too far apart by their bags.

    A word that one text has more often than the other must be edited, so the
    larger of the two surpluses of the bags is at most the edit distance."""
    classes, part = (np.array([r[k] for r in rows], np.int64) for k in (1, 2))
    n = np.array([len(w) for w in words], np.int64)
    bags = np.frombuffer(b"".join(map(bag, words)), np.uint8).reshape(-1, BUCKETS).astype(np.int16)
    total = bags.sum(axis=1, dtype=np.int64)
    longer = np.maximum(n[:, None], n)
    apart = (classes[:, None] != classes) & (longer - np.minimum(n[:, None], n) <= (1 - SIMILARITY) * longer + 1e-9)
    if part.min() != part.max():
        apart &= part[:, None] != part
    i, j = np.nonzero(np.triu(apart, 1))
    # the smaller values of each row, filled up with numbers that no other row has
    width = max(len(r[3]) for r in rows)
    smaller = np.full((len(rows), width), -1, np.int64)
    held = np.zeros((len(rows), width), bool)
    for k, r in enumerate(rows):
        less = [v for v in r[3] if v < value]
        smaller[k, :len(less)], held[k, :len(less)] = less, True
    bound, first = np.empty(len(i), np.int64), np.empty(len(i), bool)
    for at in range(0, len(i), PAIRS):
        x, y = i[at:at + PAIRS], j[at:at + PAIRS]
        bound[at:at + PAIRS] = (np.abs(bags[x] - bags[y]).sum(axis=1, dtype=np.int64) + np.abs(total[x] - total[y])) // 2
        keep = bound[at:at + PAIRS] <= (1 - SIMILARITY) * np.maximum(n[x], n[y]) + 1e-9
        first[at:at + PAIRS] = keep
        x, y, some = x[keep], y[keep], np.flatnonzero(keep) + at
        met = ((smaller[x][:, :, None] == smaller[y][:, None, :]) & held[x][:, :, None] & held[y][:, None, :]).any(axis=(1, 2))
        first[some[met]] = False
    i, j, bound = i[first], j[first], bound[first]
    order = np.argsort(bound, kind="stable")
    return np.stack([i[order], j[order]], axis=1).tolist()


def texts_of(docs: DataFrame, found: DataFrame, members: DataFrame) -> DataFrame:
    """id, text of the nodes that share some value.  Every round reads this table; the documents are dealt out once."""
    shared = members.select("id").unionByName(members.select(F.col("rep").alias("id"))).distinct()
    wanted = saved(found.select("id", F.col("node").alias("th"), "owner").join(shared, "id", "left_semi"), "wanted")
    rows = docs.select(text_hash().alias("th"), id_or_last().alias("owner"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return saved(rows.join(wanted, ["th", "owner"]).dropDuplicates(["th", "owner"]).select("id", "text"), "texts")


def aligned(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """a, b, near for every pair of ids, by alignment of their texts."""
    both = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"))

    def run(parts):
        for p in parts:
            yield {"a": p["a"], "b": p["b"], "near": [is_near(x, y) for x, y in zip(p["text_a"], p["text_b"])]}

    return map_rows(both, run, "a long, b long, near boolean")


def components(links: DataFrame) -> DataFrame:
    """node, class (its component's smallest node) for every node of a link.

    Alternating large-star and small-star steps link a node's neighbours to the
    smallest of them, until each node has one link and no link's end links on.
    Neighbours are never gathered, only their minimum.  The many small joins of
    the rounds are merge joins, so that none passes through the driver."""
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e: DataFrame, large: bool) -> DataFrame:
        near = both(e) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = near.join(least.hint("merge"), "a")
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if large else (
            joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))))
        return out.where("a <> b")

    edges = saved(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        ends = edges.select(F.col("b").alias("a"), F.lit(2).alias("n"))
        starts = edges.select("a", F.lit(1).alias("n"))
        # a node with two links, or with one that another's link ends at
        tangled = starts.unionByName(ends.distinct()).groupBy("a").agg(F.sum("n").alias("s"), F.min("n").alias("m")).where("m = 1 and s > 1")
        if not tangled.head(1):
            break
        edges = saved(star(star(edges, True), False).distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("class")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("class")).distinct())


def classes(docs: DataFrame) -> DataFrame:
    """class, node, owner, class_id (the class's smallest doc_id, NULL_ID if none), class_texts (its distinct texts)."""
    prepare(docs.sparkSession)
    source = docs.select("doc_id", "text")
    found = nodes(source)
    linked = near_classes(source, found).withColumnRenamed("node", "id")
    named = found.select("id", "node", "owner").join(linked, "id", "left").withColumn("class", F.coalesce("class", "id"))
    totals = named.groupBy("class").agg(F.min("owner").alias("class_id"), F.count(F.lit(1)).alias("class_texts"))
    return named.join(totals, "class").select("class", "node", "owner", "class_id", "class_texts")


def labelled(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_texts (distinct texts of the class) of every document row."""
    found = classes(docs).select("node", "class_id", "class_texts")
    return (docs.select("doc_id", text_hash().alias("node")).join(found, "node")
            .select("doc_id", F.when(F.col("class_id") != NULL_ID, F.col("class_id")).alias("class_id"), "class_texts"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with the smallest id of their class; of equal such rows one."""
    best = classes(docs).where("owner = class_id").select("class", F.col("node").alias("th"), "owner")
    # one text a class, should two texts of it share the smallest id
    best = saved(best.groupBy("class", "owner").agg(F.min("th").alias("th")).drop("class"), "winners")
    rows = docs.select(F.struct("*").alias("row"), text_hash().alias("th"), id_or_last().alias("owner"))
    left = rows.join(best, ["th", "owner"], "left_semi").dropDuplicates(["th", "owner"])
    return left.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
