"""Token counts of every prefix by dynamic programming.

A byte-level tokenizer cuts a text into words by a fixed pattern and encodes
each by merges.  The forward states of ``merges`` give, for every prefix of a
word, its last token and so its count; a text's prefix counts are the counts
of the words before the cut plus the cut word's own.  Questions on truncation
and budgets are then lookups: ``count_at`` and ``longest_prefix``.

A prefix of a text may be cut into words differently from the text: white
space at its end is one word, an apostrophe word may fall into two, and a
special string may stay incomplete; the counts are those of the prefix itself.

Nothing is shuffled; a task holds a part of one batch and a bounded table of
words.  Cases: a null or empty text has no tokens and the one prefix count 0;
rows are kept as they are; empty tables give empty results.
"""

from __future__ import annotations

import json
from functools import lru_cache

import regex
from pyspark.sql import Column, DataFrame, functions as F

from cauce.llm.common import map_rows, prepare
from cauce.llm.merges import MergeStates, Remembered

#: The word pattern of the byte-level tokenizers (fixed, theirs), with white space spelled out.
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
SPACE = regex.compile(r"\p{White_Space}")
LIMIT = 1024
REMEMBERED = 400_000


def byte_letters() -> dict[str, int]:
    """Letter -> byte of the byte-level alphabet: printable bytes stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter:
    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model, letters = spec["model"], byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        whole = {bytes([b]) for b in range(256)} | {a + b for a, b in rank}
        self.states = MergeStates(whole, lambda a, b: rank.get((a, b)))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.totals = Remembered(REMEMBERED, lambda words: {w: c[-1] for w, c in self.counted(words)})
        self.prefixes = Remembered(REMEMBERED // 8, lambda words: dict(self.counted(words)))

    def counted(self, words):
        """(word, token counts after each of its characters) of distinct words."""
        by_bytes = {w.encode("utf-8", "surrogatepass"): w for w in words}
        for raw, last in self.states.walk(by_bytes):
            n = [0]
            for end in range(1, len(last)):
                n.append(n[end - len(last[end])] + 1)
            yield by_bytes[raw], tuple(n[i] for i in range(1, len(raw) + 1) if i == len(raw) or raw[i] & 0xC0 != 0x80)

    def segments(self, text: str) -> list[str]:
        """Ordinary text between the special strings; each gap is one token."""
        if self.cut is None or not any(s in text for s in self.special):
            return [text]
        return self.cut.split(text)

    def count_batch(self, texts: list[str]) -> list[int]:
        cut = [self.segments(t) for t in texts]
        words = [[w for s in segs for w in PATTERN.findall(s)] for segs in cut]
        get = self.totals.of(words)
        return [sum(map(get, ws)) + len(segs) - 1 for ws, segs in zip(words, cut)]

    def prefix_batch(self, texts: list[str]) -> list[list[int]]:
        """counts[p]: tokens of the first p characters, for p from 0 to the text's length."""
        return [self.prefix_counts(t) for t in texts]

    def of_words(self, text: str) -> list[int]:
        """Counts after each character of ordinary text."""
        words = PATTERN.findall(text)
        get, out, before = self.prefixes.of([words]), [], 0
        for w in words:
            c = get(w)
            if len(w) == 3 and w[0] == "'" and w in ("'re", "'ve", "'ll"):
                c = (c[0], c[0] + 1, c[2])  # cut behind its first letter it is two words
            out += [before + n for n in c]
            before += c[-1]
        # white space that ends a prefix is one word from the start of its run
        at = 0
        for run in regex.finditer(r"\p{White_Space}+", text):
            start, end = run.span()
            base = out[start - 1] if start else 0
            own = self.prefixes.of([[run[0]]])(run[0])
            for p in range(start, end):
                out[p] = base + own[p - start]
            at = end
        assert len(out) == len(text) and at <= len(text)
        return out

    def prefix_counts(self, text: str) -> list[int]:
        out, before, rest = [0], 0, text
        for k, seg in enumerate(segs := self.segments(text)):
            own = self.of_words(seg)
            out += [before + n for n in own]
            rest = rest[len(seg):]
            if k + 1 < len(segs):
                special = next(s for s in sorted(self.special, key=len, reverse=True) if rest.startswith(s))
                out += [before + self.of_words(seg + special[:i])[-1] for i in range(1, len(special))]
                before += (own[-1] if own else 0) + 1
                out.append(before)
                rest = rest[len(special):]
        return out


@lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document row."""
    prepare(docs.sparkSession)

    def run(parts):
        use = counter(tokenizer)
        for p in parts:
            texts = [t or "" for t in p["text"]]
            n = use.count_batch(texts)
            yield {"doc_id": p["doc_id"], "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in texts], "n_tokens": n,
                   "over_limit": [x > limit for x in n]}

    return map_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def prefix_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, counts (array<int>): counts[p] is the token count of the first p code points, p from 0."""
    prepare(docs.sparkSession)

    def run(parts):
        use = counter(tokenizer)
        for p in parts:
            yield {"doc_id": p["doc_id"], "counts": use.prefix_batch([t or "" for t in p["text"]])}

    return map_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, counts array<int>")


def count_at(counts: str | Column, length: int) -> Column:
    """Tokens of the first ``length`` code points; of the whole text if it is shorter."""
    c = F.col(counts) if isinstance(counts, str) else counts
    return F.get(c, F.least(F.lit(length), F.size(c) - 1))


def longest_prefix(counts: str | Column, budget: int) -> Column:
    """Code points of the longest prefix that takes at most ``budget`` tokens (counts may fall as a prefix grows)."""
    c = F.col(counts) if isinstance(counts, str) else counts
    return F.array_max(F.transform(c, lambda n, i: F.when(n <= budget, i)))
