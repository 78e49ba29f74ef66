"""Which texts contain which passages, by multi-pattern automata.

Equal passages and equal texts are one class each: only one text of a class is
read, whatever the number of its copies, and pairs are between classes.
Passages are dealt into blocks of about ``BLOCK_CHARS`` characters.  A task
builds the Aho-Corasick automaton of a block and streams its share of the
texts past it, so every text is scanned once a block (one block for anything up
to ``BLOCK_CHARS``), whatever the number and the length of the passages; there
is no pair of text and passage that isn't found.  Texts of a block are dealt to
``SHARES`` tasks by hash, and to more where a block has more text.

Null texts and passages take no part.  The empty passage is in every text.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.session import scratch_path

BLOCK_CHARS = 4 << 20
#: Characters of text that one task takes past an automaton, about.
SHARE_CHARS = 4 << 20


def _classes(df: DataFrame, key: str, text: str, name: str) -> DataFrame:
    """class (hash of the text), ``name`` (an id) of every row with a text."""
    return df.filter(F.col(text).isNotNull()).select(F.unhex(F.sha2(F.col(text), 256)).alias("class"), F.col(key).alias(name))


def _distinct(df: DataFrame, text: str, name: str) -> DataFrame:
    """class, text: one row a distinct text, written once."""
    rows = df.filter(F.col(text).isNotNull()).select(F.unhex(F.sha2(F.col(text), 256)).alias("class"), F.col(text).cast("string").alias("text"))
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    # all rows of a class hold one text, so a copy that holds a third of the rows is reduced before the shuffle
    rows.groupBy("class").agg(F.any_value("text").alias("text")).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def class_pairs(docs: DataFrame, doc_text: str, passages: DataFrame, passage_text: str,
                block_chars: int = BLOCK_CHARS, share_chars: int = SHARE_CHARS) -> DataFrame:
    """(passage_class, text_class) for every distinct text that contains a distinct passage."""
    texts, patterns = _distinct(docs, doc_text, "texts"), _distinct(passages, passage_text, "passages")
    n_text, n_pattern = (df.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] for df in (texts, patterns))
    blocks, shares = max(1, -(-n_pattern // block_chars)), max(1, -(-n_text // share_chars))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    ours = patterns.select(F.pmod(F.xxhash64("class"), F.lit(blocks)).cast("int").alias("block"), every(shares).alias("share"),
                           F.lit(0).alias("kind"), "class", "text")
    theirs = texts.select(every(blocks).alias("block"), F.pmod(F.xxhash64("class"), F.lit(shares)).cast("int").alias("share"),
                          F.lit(1).alias("kind"), "class", "text")
    rows = ours.unionByName(theirs).repartition("block", "share").sortWithinPartitions("block", "share", "kind")
    schema = T._parse_datatype_string("passage_class binary, text_class binary")

    def run(batches):
        import ahocorasick

        cell, automaton, empty = None, None, None
        for b in batches:
            keys = np.stack([b.column(c).to_numpy() for c in ("block", "share", "kind")], axis=1)
            own, text = b.column("class").to_pylist(), b.column("text")
            left, right = [], []
            for i in range(b.num_rows):
                if cell != tuple(keys[i, :2]):
                    cell, automaton, empty = tuple(keys[i, :2]), ahocorasick.Automaton(), []
                t = text[i].as_py()
                if keys[i, 2] == 0:
                    if t:
                        automaton.add_word(t, own[i])
                    else:
                        empty.append(own[i])
                    continue
                if automaton.kind == ahocorasick.TRIE:
                    automaton.make_automaton()
                hits = {p for _, p in automaton.iter(t)} if len(automaton) else set()
                hits.update(empty)
                left += hits
                right += [own[i]] * len(hits)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["passage_class", "text_class"])

    return rows.mapInArrow(run, schema)


def containment_pairs(docs: DataFrame, doc_id: str, doc_text: str, passages: DataFrame, pid: str, ptext: str,
                      block_chars: int = BLOCK_CHARS, share_chars: int = SHARE_CHARS) -> DataFrame:
    """Exact ``(pid, doc_id)`` pairs where the document's text contains the passage: class pairs with their members."""
    pairs = class_pairs(docs, doc_text, passages, ptext, block_chars, share_chars)
    mine = _classes(passages, pid, ptext, "pid").withColumnRenamed("class", "passage_class")
    theirs = _classes(docs, doc_id, doc_text, "doc_id").withColumnRenamed("class", "text_class")
    return pairs.join(mine, "passage_class").join(theirs, "text_class").select("pid", "doc_id")
