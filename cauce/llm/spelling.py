"""Spelling variants by search schemes over bidirectional FM-indexes.

The vocabulary is the distinct words of the corpus with ``shortest`` code
points or more and ``least`` occurrences or more.  Two words are near if they
differ by exactly one inserted, deleted or replaced code point.  One error
lies in one half of the word, so the other half is matched exactly: of a word
with L code points the left half is its first L // 2 and the right half the
rest.  A search that starts with the left half is extended to the right, one
that starts with the right half to the left, and either may spend one error
past its half; both end at a delimiter, so only whole words are met.

A bidirectional FM-index of a set of words holds the suffix ranks of
'#word#word#...#' and of its reverse.  A stretch of text is a pair of rank
intervals of one size; a step to either side moves one interval by the ranks
of the symbol and the other by the ranks of all smaller symbols.  Many words
step at once.

An index holds words that share halves: every word is indexed under the first
and the last halves that a near word may ask for (two of each), asks once with
its own left and once with its own right half, and halves are dealt to indexes
by hash, about SHARD words each.  Of a half that more than HALF words share
the words spread over several indexes, and the words that ask go to each.  A
near word that has the same left half is the left search's; the right search
leaves it out.  Only counts and the best form leave an index.

Cases: null texts hold no words; a null doc_id deletes nothing; repeated rows
count; ties go to the smallest word in code-point order; words of any length
are whole; an empty table or vocabulary gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cauce.functions.strings import explode_nonnull
from cauce.llm.common import arrow_schema, prepare, saved

LETTERS = "A-Za-z\\u00C0-\\u00FF"
SHORTEST, LEAST, RATIO = 7, 2, 10
SHARD, HALF = 8192, 4096
#: Words whose searches step together, and cells (rows x symbols) of a rank table.
TOGETHER, CELLS = 2048, 1 << 22


def occurrences(docs: DataFrame, shortest: int = SHORTEST, every: int = 31) -> DataFrame:
    """word of every run of letters, one row each; a run whose CRC-32 with its document's id is a multiple of
    ``every`` loses the code point at that number modulo its length.  Runs under ``shortest`` can't give words."""
    upper = "".join(map(chr, range(65, 91)))
    text = F.translate(F.col("text").cast("string"), upper, upper.lower())
    found = F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{shortest},}}+"), F.lit(0))
    runs = explode_nonnull(docs.select(F.col("doc_id").cast("string").alias("d"), found.alias("ws")), F.col("ws"), "w", "d")
    runs = runs.withColumn("h", F.crc32(F.concat(F.col("d"), F.lit(":"), F.col("w")))).withColumn("at", (F.col("h") % F.length("w")).cast("int"))
    shorter = F.concat(F.substr("w", F.lit(1), F.col("at")), F.substr("w", F.col("at") + 2))
    word = F.when(F.coalesce(F.col("h") % every == 0, F.lit(False)), shorter).otherwise(F.col("w"))
    return runs.select(word.alias("word")).where(F.length("word") >= shortest)


def vocabulary(words: DataFrame, least: int = LEAST) -> DataFrame:
    """id, word, n, size (code points) of the words found ``least`` times or more."""
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return saved(counted.withColumn("id", F.monotonically_increasing_id()).withColumn("size", F.length("word")), "vocabulary")


# ------------------------------------------------------------------ index
def suffix_order(text: np.ndarray, symbols: int) -> np.ndarray:
    """Starts of the suffixes in their order: by as many symbols as one number holds, then by doubling ranks."""
    n, bits = len(text), int(symbols).bit_length()
    step = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for j in range(step):
        key <<= bits
        key[:max(n - j, 0)] |= text[j:] + 1
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if new[-1] == n - 1 or step >= n:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new
        key = rank * (n + 1)
        key[:n - step] += rank[step:] + 1
        step *= 2


class Ranks:
    """How often each symbol, and each smaller one together, stands before a place of a text's last column
    (the symbols before the ordered suffixes).  Counts are kept at every ``gap``-th place."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.order = suffix_order(text, symbols)
        self.column = text[self.order - 1]
        n = len(text)
        self.gap = max(4, -(-n * symbols // CELLS))
        marks = n // self.gap + 1
        counts = np.bincount((np.arange(n) // self.gap + 1) * symbols + self.column, minlength=(marks + 1) * symbols)
        self.table = np.cumsum(counts.reshape(-1, symbols)[:marks], axis=0, dtype=np.int32)
        self.below = np.zeros((marks, symbols), np.int32)
        np.cumsum(self.table[:, :-1], axis=1, out=self.below[:, 1:])

    def all(self, place: np.ndarray) -> np.ndarray:
        """One row of counts a place."""
        mark = place // self.gap
        out = self.table[mark].astype(np.int64)
        for back in range(self.gap - 1):
            more = np.flatnonzero(mark * self.gap + back < place)
            out[more, self.column[mark[more] * self.gap + back]] += 1
        return out

    def of(self, place: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of one symbol a place, and of the smaller ones."""
        mark = place // self.gap
        own, below = self.table[mark, symbol].astype(np.int64), self.below[mark, symbol].astype(np.int64)
        for back in range(self.gap - 1):
            seen = self.column[np.minimum(mark * self.gap + back, len(self.column) - 1)]
            inside = mark * self.gap + back < place
            own += inside & (seen == symbol)
            below += inside & (seen < symbol)
        return own, below


class BiIndex:
    """Bidirectional FM-index of '#word#word#...#': an interval is (forward start, backward start, size).

    ``letters`` holds the words' symbols (1 and above; 0 is the delimiter) one word after another."""

    def __init__(self, letters: np.ndarray, sizes: np.ndarray, symbols: int):
        ends = np.cumsum(sizes)
        self.starts = ends - sizes + np.arange(1, len(sizes) + 1)
        text = np.insert(letters, np.concatenate([[0], ends]), 0)
        self.forward, self.backward = Ranks(text, symbols), Ranks(text[::-1].copy(), symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.n = len(text)

    def steps(self, interval: np.ndarray, right: bool):
        """Start of the forward and of the backward interval and size, for every symbol: three tables (row, symbol)."""
        ranks, moved, other = (self.backward, 1, 0) if right else (self.forward, 0, 1)
        lo = ranks.all(interval[:, moved])
        size = ranks.all(interval[:, moved] + interval[:, 2]) - lo
        start = self.before[:-1] + lo
        rest = interval[:, other, None] + np.cumsum(size, axis=1) - size
        return (rest, start, size) if right else (start, rest, size)

    def step(self, interval: np.ndarray, symbol: np.ndarray, right: bool) -> np.ndarray:
        """The intervals moved by one symbol each."""
        ranks, moved, other = (self.backward, 1, 0) if right else (self.forward, 0, 1)
        lo, below = ranks.of(interval[:, moved], symbol)
        hi, upto = ranks.of(interval[:, moved] + interval[:, 2], symbol)
        out = np.empty_like(interval)
        out[:, moved] = self.before[symbol] + lo
        out[:, other] = interval[:, other] + upto - below
        out[:, 2] = hi - lo
        return out

    def whole(self) -> np.ndarray:
        return np.array([[0, 0, self.n]], np.int64)

    def words_at(self, interval: np.ndarray) -> np.ndarray:
        """Index of the word that starts with each interval's first suffix '#word#'."""
        return np.searchsorted(self.starts, self.forward.order[interval[:, 0]] + 1)


def near_words(index: BiIndex, patterns: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row of patterns, indexed word) for words that hold a pattern's half exactly and have one error past it.

    ``patterns`` are words of one length, a row each; ``right`` starts with the left half and goes right.
    The result may name the pattern itself and may repeat."""
    length = patterns.shape[1]
    half = length // 2
    zero = np.zeros((len(patterns), 1), np.int64)
    # in the direction of the search: the exact half with its delimiter, then the rest with the other one
    path = np.hstack([zero, patterns, zero])
    path = path if right else path[:, ::-1]
    exact = 1 + (half if right else length - half)
    rows = np.arange(len(patterns))
    sound = np.repeat(index.whole(), len(patterns), axis=0)   # no error so far
    broken = np.empty((0, 3), np.int64)                       # one error so far
    broken_rows = np.empty(0, np.int64)
    out = []
    for at in range(path.shape[1]):
        symbol = path[:, at]
        if at < exact:
            sound = index.step(sound, symbol[rows], right)
            live = sound[:, 2] > 0
            sound, rows = sound[live], rows[live]
            continue
        steps = index.steps(sound, right)
        following = np.stack([t[np.arange(len(rows)), symbol[rows]] for t in steps], axis=1)
        # one symbol more in the indexed word, or another in place of this one; the delimiter ends a word
        where, letter = np.nonzero(steps[2][:, 1:] > 0)
        letter += 1
        extra = np.stack([t[where, letter] for t in steps], axis=1)
        other = (letter != symbol[rows[where]]) & (at < path.shape[1] - 1)
        extra_rows = rows[where]
        # states past this symbol: errors made before, a replaced symbol, a missing symbol
        came = index.step(np.concatenate([broken, extra]), symbol[np.concatenate([broken_rows, extra_rows])], right)
        came_rows = np.concatenate([broken_rows, extra_rows])
        live = came[:, 2] > 0
        states, state_rows = [came[live], extra[other]], [came_rows[live], extra_rows[other]]
        if at < path.shape[1] - 1:
            states.append(sound)
            state_rows.append(rows)
        broken, broken_rows = np.concatenate(states), np.concatenate(state_rows)
        live = following[:, 2] > 0
        sound, rows = following[live], rows[live]
    # words are distinct, so an interval that ends with both delimiters is one word
    return broken_rows, index.words_at(broken)


def searched(words: list[str], asking: list[str], left: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of asking, row of words) pairs: near words, each once.  ``left`` says which half each asks with."""
    symbols, flat = np.unique(np.frombuffer("".join([*words, *asking]).encode("utf-32-le", "surrogatepass"), np.uint32), return_inverse=True)
    flat = flat.astype(np.int64) + 1
    sizes = np.fromiter(map(len, [*words, *asking]), np.int64, len(words) + len(asking))
    n = int(sizes[:len(words)].sum())
    index = BiIndex(flat[:n], sizes[:len(words)], len(symbols) + 1)
    begins, sizes = (np.cumsum(sizes) - sizes)[len(words):], sizes[len(words):]
    for right in (True, False):
        for size in np.unique(sizes[left == right]).tolist():
            rows = np.flatnonzero((sizes == size) & (left == right))
            for lo in range(0, len(rows), TOGETHER):
                some = rows[lo:lo + TOGETHER]
                at, word = near_words(index, flat[begins[some][:, None] + np.arange(size)], right)
                if not len(at):
                    continue
                pairs = np.unique(some[at] * len(words) + word)
                half = size // 2
                yield np.array([(a, w) for a, w in zip((pairs // len(words)).tolist(), (pairs % len(words)).tolist())
                                if asking[a] != words[w] and (right or not words[w].startswith(asking[a][:half]))], np.int64).reshape(-1, 2).T


# ---------------------------------------------------------------- corpus
def _halves(words: DataFrame, shortest: int) -> DataFrame:
    """id, word, n, left (side), half (its hash), asks: the halves under which a word is indexed and asks."""
    size = F.col("size")
    own = size.cast("int")
    sides = []
    for left in (True, False):
        def part(asked):
            # of the halves that a word of ``asked`` code points uses, this word's symbols
            short = F.floor(asked / 2).cast("int")
            text = F.expr("word").substr(F.lit(1), short) if left else F.expr("word").substr(own - (asked - short) + 1, asked - short)
            return F.xxhash64(F.lit(left), text)
        lengths = F.filter(F.array(own - 1, own, own + 1), lambda a: a >= shortest)
        sides.append(words.select("id", "word", "n", F.lit(left).alias("left"), F.explode(F.array_distinct(F.transform(lengths, lambda a: part(a)))).alias("half"), F.lit(False).alias("asks")))
        sides.append(words.select("id", "word", "n", F.lit(left).alias("left"), part(own).alias("half"), F.lit(True).alias("asks")))
    out = sides[0]
    for s in sides[1:]:
        out = out.unionByName(s)
    return out


FOUND = "id long, n_near long, best_n long, best string"


def near_counts(words: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """id, n_near, best_n, best: number of near words, the greatest n among them and its smallest word."""
    spark = words.sparkSession
    halves = _halves(words, shortest)
    hot = saved(halves.where(~F.col("asks")).groupBy("half").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > HALF)
                .select("half", F.ceil(F.col("m") / HALF).cast("int").alias("parts")), "hot-halves")
    shards = max(1, -(-4 * words.count() // SHARD))  # a word is indexed under about four halves
    parts = F.coalesce("parts", F.lit(1))
    dealt = halves.join(hot, "half", "left").withColumn("part", F.explode(
        F.when(F.col("asks"), F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.pmod(F.xxhash64("id"), parts).cast("int")))))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("half", "part"), F.lit(shards)))
    dealt = dealt.select("shard", "asks", "id", "word", "n", "left", "half").repartition("shard").sortWithinPartitions("shard")
    struct = spark.createDataFrame([], FOUND).schema

    def run(batches):
        held, shard = [], None
        for b in batches:
            at = b.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                if shard is not None and at[lo] != shard:
                    yield answers(pa.Table.from_batches(held))
                    held = []
                shard = at[lo]
                held.append(b.slice(lo, hi - lo))
        if held:
            yield answers(pa.Table.from_batches(held))

    def answers(rows):
        asks, left = (rows.column(i).to_numpy(zero_copy_only=False).astype(bool) for i in (1, 5))
        ids, n, half, text = rows.column(2).to_numpy(), rows.column(4).to_numpy(), rows.column(6).to_numpy(), rows.column(3).to_pylist()
        # a word may be indexed here under several halves, and two parts of a half may lie here
        indexed, asking = np.flatnonzero(~asks), np.flatnonzero(asks)
        under = set(zip(ids[indexed].tolist(), half[indexed].tolist()))
        indexed = indexed[np.unique(ids[indexed], return_index=True)[1]]
        asking = asking[np.unique(np.stack([ids[asking], left[asking]], axis=1), axis=0, return_index=True)[1]]
        out: dict = {}
        if len(indexed) and len(asking):
            words = [text[i] for i in indexed]
            for at, word in searched(words, [text[i] for i in asking], left[asking]):
                for a, w in zip(asking[at].tolist(), indexed[word].tolist()):
                    # a word met here under another half is counted where it is indexed under the asked one
                    if (int(ids[w]), int(half[a])) in under:
                        out.setdefault((int(ids[a]), bool(left[a])), []).append((-int(n[w]), text[w]))
        best = [(k[0], len(v), -min(v)[0], min(v)[1]) for k, v in out.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*best) if best else [[]] * 4, arrow_schema(struct))],
                                          schema=arrow_schema(struct))

    found = dealt.mapInArrow(run, struct)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("id").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "id", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last form that a word's forms lead to.  ``forms``: word, form.

    Each form occurs ten times as often as its word, so a chain is short and has no circle."""
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
        reached = saved(reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not reached.where("moved").head(1):
            return reached.select("word", "root")
        reached = reached.select("word", "root")


def grouped(words: DataFrame, ratio: int = RATIO, shortest: int = SHORTEST) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of a vocabulary (id, word, n, size)."""
    near = near_counts(words, shortest)
    known = F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False))
    out = saved(words.select("id", "word", "n").join(near, "id", "left").select(
        "word", F.when(known, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(known, F.col("best_n")).alias("form_n")), "forms")
    last = roots(out.where("form is not null").select("word", "form"))
    return out.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame) -> DataFrame:
    """Spelling variants of the whole texts' words."""
    prepare(docs.sparkSession)
    return grouped(vocabulary(occurrences(docs)))
