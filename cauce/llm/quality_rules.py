r"""Quality rules with host verdicts.

Per document: words ``[^\x20\x09-\x0D]+``, characters in words, symbol
characters, lines with a word, repeated ones among them and words inside repeated 8-word windows.  A
document fails the base rules when it has under 20 words or over 30 % of its
words lie in repeated windows.  Per host (``source``) the failures of each
rule are summed, the host's failure rate is shrunk towards the rate of all
hosts by a beta prior fitted to the hosts' rates by moments, and a host whose
shrunk rate passes ``HOST_MAX_RATE`` for some rule takes all its documents
with it.

Cases: a null or empty text has no words and fails; a null source is a host
of its own; a null doc_id and repeated rows are kept as rows; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from cauce.llm.common import WHITE, map_rows, prepare, saved

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: A symbol to a word, and half of the lines with a word repeated: counted for the host only.
MAX_SYMBOLS_PER_WORD = 1.0
MAX_DUP_LINES_PER_LINE = 0.5
HOST_MAX_RATE = 0.5
RULES = ("short", "repetitive", "symbolic", "relined")


def repeat_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words lying in a window of that many words that occurs twice or more.

    Windows of 1, 2, 4, ... words get dense numbers by pairing the numbers of
    two half windows, so equal numbers mean equal windows (no hashing)."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    rank, width = ids, 1
    while width < window:
        step = min(width, window - width)
        pair = rank[:-step].astype(np.int64) * (int(rank.max()) + 1) + rank[step:]
        rank, width = np.unique(pair, return_inverse=True)[1], width + step
    twice = np.bincount(rank)[rank] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measures(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_word_lines of one text."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes.split knows exactly the six characters of WHITE
    white = len(raw) - len(raw.translate(None, WHITE))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    again = repeat_words(ids) if len(number) < len(words) else 0
    return len(words), len(text) - white, symbols, len(lines) - len(set(lines)), again, len(lines)


def failures(w: Column, symbols: Column, repeated: Column, again: Column, lines: Column) -> dict[str, Column]:
    return {"short": w < MIN_WORDS, "repetitive": 100 * again > MAX_REPEAT_PERCENT * w,
            "symbolic": symbols > MAX_SYMBOLS_PER_WORD * w, "relined": repeated > MAX_DUP_LINES_PER_LINE * lines}


def document_measures(docs: DataFrame) -> DataFrame:
    """doc_id, source and the six measures of every document row."""
    prepare(docs.sparkSession)

    def run(parts):
        for p in parts:
            m = [measures(t) for t in p["text"]]
            cols = list(zip(*m)) if m else [()] * 6
            yield {"doc_id": p["doc_id"], "source": p["source"], "n_words": cols[0], "word_chars": cols[1],
                   "n_symbols": cols[2], "n_dup_lines": cols[3], "n_repeat_words": cols[4], "n_word_lines": cols[5]}

    return map_rows(docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string")), run,
                    "doc_id long, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_word_lines long")


def host_verdicts(measured: DataFrame) -> DataFrame:
    """One row a host: n_docs, per rule its failures and shrunk rate, ``host_rejected``.

    The prior of a rule is Beta(a, b) with the mean of all documents and the
    variance that the hosts' rates show beyond sampling (method of moments).
    Only four sums a rule reach the driver, whatever the number of hosts.
    """
    fails = failures(*(F.col(c) for c in ("n_words", "n_symbols", "n_dup_lines", "n_repeat_words", "n_word_lines")))
    hosts = measured.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.sum(fails[r].cast("long")).alias(f"fail_{r}") for r in RULES])
    sums = hosts.agg(
        F.count(F.lit(1)).alias("hosts"), F.sum("n_docs").alias("docs"), F.sum(1 / F.col("n_docs")).alias("inverse"),
        *[F.sum(f"fail_{r}").alias(f"f_{r}") for r in RULES],
        *[F.sum(F.col(f"fail_{r}") / F.col("n_docs")).alias(f"r_{r}") for r in RULES],
        *[F.sum((F.col(f"fail_{r}") / F.col("n_docs")) ** 2).alias(f"q_{r}") for r in RULES]).first()
    rejected = F.lit(False)
    for r in RULES:
        a, b = beta_prior(sums["hosts"], sums["docs"], sums["inverse"], sums[f"f_{r}"], sums[f"r_{r}"], sums[f"q_{r}"])
        hosts = hosts.withColumn(f"rate_{r}", (F.col(f"fail_{r}") + F.lit(a)) / (F.col("n_docs") + F.lit(a + b)))
        rejected = rejected | (F.col(f"rate_{r}") > HOST_MAX_RATE)
    return hosts.withColumn("host_rejected", rejected)


def beta_prior(hosts, docs, inverse, fails, rates, squares) -> tuple[float, float]:
    """(a, b) from the number of hosts and documents and the sums of 1/n, failures, rates, squared rates.

    Strength a + b lies between 1 and a million documents; no hosts give (0, 1)."""
    if not hosts:
        return 0.0, 1.0
    mean = fails / docs
    seen = max(squares / hosts - (rates / hosts) ** 2, 0.0)
    between = max(seen - mean * (1 - mean) * inverse / hosts, 0.0)
    strength = 1e6 if between <= 0 else min(max(mean * (1 - mean) / between - 1, 1.0), 1e6)
    return mean * strength, (1 - mean) * strength


def judge(docs: DataFrame) -> DataFrame:
    """Measures, ``base_failed``, the host's rates and ``kept`` of every document row."""
    measured = saved(document_measures(docs), "measures")
    hosts = host_verdicts(measured).withColumnRenamed("source", "host")
    fails = failures(*(F.col(c) for c in ("n_words", "n_symbols", "n_dup_lines", "n_repeat_words", "n_word_lines")))
    base = fails["short"] | fails["repetitive"]
    return (measured.join(hosts, F.col("source").eqNullSafe(F.col("host")))
            .withColumn("base_failed", base)
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
            .drop("host"))


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    hosts = saved(host_verdicts(saved(document_measures(docs), "measures")).where("host_rejected").select(F.col("source").alias("host")), "hosts")

    @F.pandas_udf("boolean")
    def passes(text: pd.Series) -> pd.Series:
        found = (measures(t) for t in text)
        return pd.Series([w >= MIN_WORDS and 100 * a <= MAX_REPEAT_PERCENT * w for w, _, _, _, a, _ in found], dtype=bool)

    # a struct keeps the documents' own column names apart from the verdicts'
    rows = docs.where(passes(F.col("text").cast("string"))).select(F.struct("*").alias("row"), F.col("source").cast("string").alias("own"))
    return rows.join(hosts, F.col("own").eqNullSafe(F.col("host")), "left_anti").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
