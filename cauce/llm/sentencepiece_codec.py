"""SentencePiece encoding and decoding by a shared-prefix forward pass.

Spaces become marks, and a text is cut where no piece can reach across: before
each run of marks and around line breaks.  The distinct marked words of a
batch are sorted, which lays out their trie, and walked depth first: a forward
state is kept for every character of the current path, so a word reuses the
states of the prefix it shares with the word before it.

The vocabulary at hand is of the merge kind (byte-pair scores with byte
fallback), whose encoding is no sum of scores.  Its forward state at a prefix
is the last piece of the prefix's own encoding: piece t may follow piece s iff
merging the characters of s + t by score gives just [s, t].  A sequence whose
neighbours all may follow each other is the library's encoding, and a prefix
has exactly one, so the pass is Viterbi's with a single surviving predecessor.
Characters outside the vocabulary become their UTF-8 bytes' pieces.

Nothing is shuffled; a task holds one batch, and bounded tables of words and
of piece pairs that only save time.

Cases: a null or empty text has no pieces and decodes to the empty text; marks
(U+2581) in a text count as spaces, as the library has it; rows are kept as
they are; empty tables give empty results.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cauce.llm.common import map_rows, prepare
from cauce.llm.merges import MergeStates, Remembered

MARK = "▁"
#: Words a task remembers, in two generations of this size.
REMEMBERED = 400_000


class Codec:
    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        special = [sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(len(pieces))]
        # a space stands for the mark inside this class
        self.ids = {p.replace(MARK, " "): i for i, p in enumerate(pieces) if not special[i]}
        rank = {p: -sp.get_score(i) for p, i in self.ids.items()}
        self.states = MergeStates(self.ids, lambda a, b: rank.get(a + b))
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(pieces) if sp.is_byte(i)}
        self.output = {i: bytes([b]) for b, i in self.byte.items()} | {i: p.encode() for p, i in self.ids.items()}
        if any(re.search("[^ ] |[^\n]\n|\n[^\n]", p) for p in self.ids):
            raise ValueError("a piece reaches across words")
        # a cut between a letter or digit and a mark of punctuation is safe too if no piece has the two together
        before: dict[str, set[str]] = {chr(c): set() for c in range(33, 127) if not chr(c).isalnum()}
        for p in self.ids:
            for x, y in zip(p, p[1:]):
                if x.isalnum() and y in before:
                    before[y].add(x)
        free = "".join(re.escape(y) for y, xs in before.items() if not xs)
        safe = [f"(?=[{free}])"] * bool(free) + [f"(?<![{''.join(sorted(xs))}])(?={re.escape(y)})" for y, xs in before.items() if xs]
        self.cuts = re.compile(f" *+[^\\W_]++(?:{'|'.join(safe)})| *[^ ]+| +")
        self.words = Remembered(REMEMBERED, lambda words: {w: self.traced(w, last) for w, last in self.states.walk(words)})

    def traced(self, word: str, last: list) -> tuple[int, ...]:
        out, end = [], len(word)
        while end:
            piece = last[end]
            if piece in self.ids:
                out.append(self.ids[piece])
            else:
                out.extend(self.byte[b] for b in reversed(piece.encode("utf-8", "surrogatepass")))
            end -= len(piece)
        return tuple(reversed(out))

    def encode_batch(self, texts: list[str]) -> list[list[tuple[int, ...]]]:
        """Per text the ids of its marked words in order."""
        cut = [self.marked_words(t) for t in texts]
        get = self.words.of(cut)
        return [list(map(get, words)) for words in cut]

    def marked_words(self, text: str) -> list[str]:
        """The text cut into words with their leading spaces, and line breaks by themselves."""
        if not text:
            return []
        out = []
        for i, line in enumerate((" " + text.replace(MARK, " ")).split("\n")):
            if i:
                out.append("\n")
            out += self.cuts.findall(line)
        return out

    def decode(self, ids) -> str:
        """The text of ids; the mark that encoding put in front goes."""
        out = b"".join(map(self.output.__getitem__, ids)).decode("utf-8", "replace")
        return out[1:] if out[:1] == " " else out


@lru_cache(2)
def codec(model: str) -> Codec:
    return Codec(model)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (array<int>), round_trip (the ids decode to the text; a null text counts as empty)."""
    prepare(docs.sparkSession)

    def run(parts):
        use = codec(model)
        for p in parts:
            texts = [t or "" for t in p["text"]]
            by_word = use.encode_batch(texts)
            flat = [[i for w in words for i in w] for words in by_word]
            same = [use.decode(f) == t for f, t in zip(flat, texts)]
            ends = np.concatenate([[0], np.cumsum([len(f) for f in flat])]).astype(np.int32)
            values = np.fromiter((i for f in flat for i in f), np.int32, int(ends[-1]))
            yield {"doc_id": p["doc_id"], "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(values)).cast(pa.list_(pa.field("element", pa.int32(), True))), "round_trip": same}

    return map_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, ids array<int>, round_trip boolean")


def encode_rows(docs: DataFrame, model: str) -> DataFrame:
    """All columns of ``docs`` with ``ids`` put behind them (in place of a column of that name)."""
    prepare(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def ids(text: pd.Series) -> pd.Series:
        use, out = codec(model), []
        texts = [t or "" for t in text]
        for i in range(0, len(texts), 1000):
            out += [np.array([x for w in words for x in w], np.int32) for words in use.encode_batch(texts[i:i + 1000])]
        return pd.Series(out, dtype=object)

    return docs.withColumn("ids", ids(F.col("text").cast("string")))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, text of frames with doc_id and ids."""
    prepare(encoded.sparkSession)

    def run(parts):
        use = codec(model)
        for p in parts:
            yield {"doc_id": p["doc_id"], "text": [use.decode(i or []) for i in p["ids"]]}

    return map_rows(encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")), run, "doc_id long, text string")
