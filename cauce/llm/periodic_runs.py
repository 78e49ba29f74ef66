"""Periodic runs of words by online dyadic square catching.

Words ([^\\x20\\x09-\\x0D]+) arrive one after another or many at a time.  A
square is a stretch followed by itself.  The left half of a square of period p
with 2^(k+1) - 1 <= p <= 2^(k+2) - 2 holds a whole aligned block of 2^k words,
which appears again p words later; if e periods are asked for, words agree
with those p later over e - 1 periods, so longer blocks serve the same p.
Once a block of level k is complete, a catcher waits for it: every appended
word completes one window of 2^k words, and that window is compared with the
blocks that lie one period of the level back.  A window that equals a block is
a catch; the catches of one period join into a stretch, whose ends are found
by comparing words, and a stretch of p words or more holds squares.  Squares
of one period that follow each other merge into a run.  A stretch that reaches
the last word stays open and goes on with the next words.

A run is a maximal stretch of words with smallest period q.  Only runs of
``exponent`` periods and ``shortest`` words or more are kept; catches that no
such run can hold are dropped before words are compared.  The state is the
words, and a few windows a level: about 8 * 2^k of level k.

``documents`` are coded word by word within a part of bounded size and follow
each other in streams, each with an end word of its own that no square can hold.

Cases: a null or empty text has no words and no runs; a null doc_id means that
no words of the query are replaced; every input row gives one output row,
repeated rows too; runs may overlap; empty tables give empty results; other
columns are never read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from itertools import chain, count

import numpy as np
from pyspark.sql import DataFrame, functions as F

from cauce.llm.common import map_rows

_ODD, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _STEP
    return x ^ (x >> np.uint64(29))


class SquareCatcher:
    """Runs of a growing sequence of integers; any division of it into appends gives the same runs.

    ``longest`` bounds the runs' length, if known: catchers of longer periods are not kept."""

    def __init__(self, exponent: int = 2, shortest: int = 0, longest: int | None = None):
        self.exponent, self.shortest, self.longest = exponent, shortest, longest
        self.n = 0
        self._words, self._cover = np.empty(1024, np.int64), np.full(1024, -1, np.int32)
        self._windows: list[tuple[int, np.ndarray]] = []  # a level: first window's start, hashes
        self._open: dict[tuple[int, int], int] = {}       # (period, start) of stretches that reach the end: their run or -1
        self._runs: list[list[int]] = []                  # start, end, period
        self._at: dict[tuple[int, int], int] = {}         # (start, end): the run; a multiple of its period has the same ends
        self._old, self._seen = 0, set()                  # words before this append; stretches met in it

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period), by start, then period."""
        return sorted((a, b - a, p) for a, b, p in self._runs)

    def append(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """Add words; gives (period, first start, last start) of the squares that end in them."""
        old, self.n = self.n, self.n + len(words)
        self._old, self._seen = old, set()
        if self.n > len(self._words):
            more = max(self.n, 2 * len(self._words)) - len(self._words)
            self._words = np.concatenate([self._words, np.empty(more, np.int64)])
            self._cover = np.concatenate([self._cover, np.full(more, -1, np.int32)])
        self._words[old:self.n] = words
        found: list[tuple[int, int, int]] = []
        for period, start in sorted(self._open):
            run = self._open.pop((period, start))
            self._keep(period, start, self._right(max(start, old - period), period), run, found)
        level, last = 0, None
        while (1 << level) <= self.n and self._useful(level):
            first, hashes = self._windows[level] if level < len(self._windows) else (0, np.empty(0, np.uint64))
            begin, end = max(0, old - (1 << level) + 1), self.n - (1 << level) + 1
            if level == 0:
                fresh = _mix(self._words[begin:end].astype(np.uint64) + _ODD)
            else:
                at, half = begin - last[0], 1 << level - 1
                fresh = _mix(last[1][at:at + end - begin] * _ODD + last[1][at + half:at + half + end - begin])
            last = (first, np.concatenate([hashes, fresh]))
            for catch in self._caught(level, begin, end, *last):
                self._stretch(*catch, found)
            if level < len(self._windows):
                self._windows[level] = last
            else:
                self._windows.append(last)
            level += 1
        for level, (first, hashes) in enumerate(self._windows):
            spare = max(0, len(hashes) - (8 << level))
            self._windows[level] = (first + spare, hashes[spare:].copy() if spare else hashes)
        return found

    def _useful(self, level: int) -> bool:
        return self.longest is None or self.exponent * self._periods(level)[0] <= self.longest

    def _periods(self, level: int) -> tuple[int, int]:
        """Least and greatest period of which a stretch of exponent - 1 periods holds an aligned block of 2^level,
        but need not hold one of twice that size."""
        return -(-((2 << level) - 1) // (self.exponent - 1)), -(-((4 << level) - 1) // (self.exponent - 1)) - 1

    def _need(self, period):
        """Least length of a stretch: a run without its last period."""
        return np.maximum((self.exponent - 1) * period, self.shortest - period)

    def _caught(self, level: int, begin: int, end: int, first: int, hashes: np.ndarray):
        """(period, start, end) of blocks that follow each other and are found again one period later, by period."""
        size, (least, most) = 1 << level, self._periods(level)
        offsets = np.arange(least, most + 1)
        blocks = np.arange(max(0, -(-(begin - most) // size)), max(0, -(-(end - least) // size))) * size
        if not len(blocks) or not len(offsets):
            return []
        window = blocks[:, None] + offsets
        seen = hashes[np.clip(window - first, 0, len(hashes) - 1)] == hashes[blocks - first][:, None]
        hit, which = np.nonzero(seen)
        s, p = blocks[hit], offsets[which]
        now = (s + p >= begin) & (s + p < end)
        s, p = s[now], p[now]
        if not len(s):
            return []
        order = np.lexsort((s, p))
        s, p = s[order], p[order]
        new = np.concatenate([[True], (p[1:] != p[:-1]) | (s[1:] != s[:-1] + size)])
        at = np.flatnonzero(new)
        a, b, p = s[at], s[np.append(at[1:], len(s)) - 1] + size, p[at]
        # neighbouring blocks that were compared and differ bound a stretch; others lie in an earlier or a later append
        bounded = (b + p < end) & ((a - size + p >= begin) | (a < size))
        run = self._cover[a]
        inside = np.zeros(len(a), bool)
        if self._runs:
            known = np.array(self._runs, np.int64)[run]
            inside = (run >= 0) & (known[:, 1] >= b + p) & (p % known[:, 2] == 0)
        keep = ~inside & (~bounded | (b - a + 2 * size - 2 >= self._need(p)))
        return zip(p[keep].tolist(), a[keep].tolist(), b[keep].tolist())

    def _stretch(self, period: int, a: int, b: int, found: list) -> None:
        run = self._cover[a]
        if run >= 0 and self._runs[run][1] >= b + period and period % self._runs[run][2] == 0:
            return  # the run's own period divides this one
        w = self._words
        same = w[a:b] == w[a + period:b + period]
        if same.all():
            pieces = [(a, b)]
        else:  # equal hashes of different words
            edge = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
            pieces = [(a + x, a + y) for x, y in edge.reshape(-1, 2).tolist()]
        for x, y in pieces:
            start = self._left(x, period)
            if (period, start) not in self._seen:
                self._keep(period, start, self._right(y, period), -1, found)

    def _left(self, at: int, period: int) -> int:
        step = 64
        while at:
            a = max(0, at - step)
            other = np.flatnonzero(self._words[a:at] != self._words[a + period:at + period])
            if len(other):
                return a + int(other[-1]) + 1
            at, step = a, 2 * step
        return 0

    def _right(self, at: int, period: int) -> int:
        step = 64
        while at + period < self.n:
            b = min(self.n - period, at + step)
            other = np.flatnonzero(self._words[at:b] != self._words[at + period:b + period])
            if len(other):
                return at + int(other[0])
            at, step = b, 2 * step
        return at

    def _keep(self, period: int, start: int, right: int, run: int, found: list) -> None:
        end = right + period
        self._seen.add((period, start))
        first = max(start, self._old - 2 * period + 1)
        if first <= right - period:
            found.append((period, first, right - period))
        if run < 0 and right - start >= self._need(period):
            at = self._cover[start]
            if at >= 0 and self._runs[at][1] >= end and period % self._runs[at][2] == 0:
                return
            if (start, end) in self._at:
                return
            run = len(self._runs)
            self._runs.append([start, start, period])
        if run >= 0:
            covered = self._runs[run][1]
            self._at.pop((start, covered), None)
            self._at[start, end] = run
            self._runs[run][1] = end
            # a place names the run over it that ends last
            place = self._cover[covered:end]
            ends = np.array([r[1] for r in self._runs] if place.max(initial=-1) >= 0 else [0], np.int64)
            place[(place < 0) | (ends[np.maximum(place, 0) % len(ends)] < end)] = run
        if end == self.n:
            self._open[period, start] = run


#: Words of one stream at least, unless the documents end; a longer document is a stream of its own.
STREAM = 1 << 15


def runs_of(texts: list[list], exponent: int, shortest: int) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of every word list."""
    out: list[list] = []
    at = size = 0
    for k, words in enumerate(texts):
        size += len(words)
        if size >= STREAM or k == len(texts) - 1:
            out += _runs_of(texts[at:k + 1], exponent, shortest)
            at, size = k + 1, 0
    return out


def _runs_of(texts: list[list], exponent: int, shortest: int) -> list[list[tuple[int, int, int]]]:
    codes: dict = defaultdict(count().__next__)
    sizes = np.array([len(t) for t in texts], np.int64)
    coded = np.fromiter(map(codes.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    catcher = SquareCatcher(exponent, shortest, int(sizes.max(initial=0)))
    catcher.append(np.insert(coded, ends, -1 - np.arange(len(texts))))
    begins = ends - sizes + np.arange(len(texts))
    runs: list[list] = [[] for _ in texts]
    found = catcher.runs()
    for k, (start, length, period) in zip((np.searchsorted(begins, [r[0] for r in found], "right") - 1).tolist(), found):
        runs[k].append((start - int(begins[k]), length, period))
    return runs


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that are in no run after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [w for w, k in zip(words, keep) if k]


def looped(words: list, doc_id: int | None) -> list:
    """Every tenth document by its id's CRC-32: from some word on, a stretch of its words again and again."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * -(-(n - a) // p))[:n - a]


def periodic_runs(docs: DataFrame, exponent: int = 4, shortest: int = 6, alter=None) -> DataFrame:
    """doc_id, runs (start, length, period; by start, then period), collapsed (kept words joined by one space).

    ``alter(words, doc_id)`` may replace a document's words before its runs are sought."""

    def run(parts):
        for p in parts:
            texts = [(t or "").encode("utf-8", "surrogatepass").split() for t in p["text"]]
            if alter is not None:
                texts = [alter(w, d) for w, d in zip(texts, p["doc_id"])]
            found = runs_of(texts, exponent, shortest)
            yield {"doc_id": p["doc_id"], "runs": [[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in found],
                   "collapsed": [b" ".join(collapse(w, rs)) for w, rs in zip(texts, found)]}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(rows, run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")


def digest(found: DataFrame) -> DataFrame:
    """One row a document: its number of runs, its longest run and the hashes of its runs and collapsed words."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["s"].alias("start"), (-best["l"]).alias("length"), best["p"].alias("period"),
        F.floor(F.lit(1000) * -best["l"] / best["p"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
