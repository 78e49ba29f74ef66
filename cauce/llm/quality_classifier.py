"""Quality scores: random Fourier features, ridge regression by normal equations, isotonic calibration.

1. One scan turns every document into STATISTICS numbers about its text.
2. Means and deviations come from all documents; the standardised numbers go
   through FEATURES cosines whose directions are drawn for a Gaussian kernel.
3. Labelled rows (all of them) add their outer products by partition; the sum
   is one (FEATURES + 1) square matrix, whatever the number of rows.  Both
   labels weigh the same in total.
4. Raw scores of the labelled rows are counted on a grid and pooled.

Only documents whose crc32(doc_id as text) mod 3 is not 1 teach.  Cases: null
and empty texts have all-zero numbers and a score like any other; a null
doc_id is never held out and has no label; a document labelled twice takes
the mean; without labels every score is one half; rows are kept as they are.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cauce.llm.calibration import chance, counted, isotonic
from cauce.llm.common import map_rows, prepare, saved
from cauce.llm.quality_rules import measures

FEATURES = 256
WIDTH = 3.0
RIDGE = 1e-3
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.5
LOW, HIGH = -1.0, 2.0
MARKS = (b"!", b"?", b"|", b"#$%&*<>", b".,;:", b"0123456789")


def statistics(text: str | None) -> list[float]:
    """The numbers of one text: sizes, word and line shapes, shares of character classes, repetition."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    n_words, word_chars, symbols, dup_lines, repeat, _ = measures(text)
    words = raw.split()
    n = max(n_words, 1)
    chars = max(len(text), 1)
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    kinds: dict[bytes, int] = {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    share = np.fromiter(kinds.values(), float, len(kinds)) / n if kinds else np.ones(1)
    lines = raw.count(b"\n") + 1
    stirred = sum(a == b for a, b in zip(words, words[1:]))
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    wide = sum(1 for c in text if c.isupper()) - upper if not raw.isascii() else 0
    out = [math.log1p(len(text)), math.log1p(n_words), word_chars / n, float(lengths.std()), float(lengths.max()) ** 0.5,
           float((lengths <= 3).mean()), float((lengths == 1).mean()), (upper + wide) / chars, (len(raw) - len(text)) / chars,
           lines / n, dup_lines / lines, repeat / n, symbols / n, stirred / n, len(kinds) / n, float(share.max()),
           float(-(share * np.log(share)).sum()) / math.log(n + 1.0)]
    return out + [(len(raw) - len(raw.translate(None, m))) / n for m in MARKS]


STATISTICS = len(statistics(""))


def held_out(folds: int, fold: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def fourier(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """rows x (FEATURES + 1): the cosines of the standardised numbers, and ones."""
    rng = np.random.default_rng(11)
    turn = rng.standard_normal((STATISTICS, FEATURES)) / WIDTH
    shift = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((x - centre) / scale, -6, 6)
    return np.hstack([np.cos(z @ turn + shift) * math.sqrt(2 / FEATURES), np.ones((len(x), 1))])


def numbers(docs: DataFrame) -> DataFrame:
    """doc_id, x: the statistics of every document row."""

    def run(parts):
        for p in parts:
            yield {"doc_id": p["doc_id"], "x": [statistics(t) for t in p["text"]]}

    return map_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, x array<double>")


def labelled(rows: DataFrame, labels: DataFrame, column: str, folds: int, fold: int) -> DataFrame:
    """Rows that teach, with their label as a double."""
    known = labels.select(F.col("doc_id").cast("long"), F.col(column).cast("double").alias("label")).dropna()
    return rows.where(~held_out(folds, fold)).join(known.groupBy("doc_id").agg(F.avg("label").alias("label")), "doc_id")


def summed(rows: DataFrame, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Sum over the rows of each label of (features, label, 1) outer products: 2 x k x k."""
    k = FEATURES + 2

    def run(parts):
        total = np.zeros((2, k, k))
        for p in parts:
            y = np.array(p["label"], float)
            phi = np.hstack([fourier(np.array(p["x"], float).reshape(-1, STATISTICS), centre, scale), y[:, None]])
            for c in (0, 1):
                own = phi[(y >= 0.5) == bool(c)]
                total[c] += own.T @ own
        if total.any():
            yield {"slot": [int(total[:, -2, -2].sum()) % 16], "part": [total.tobytes()]}

    def add(pdf):
        return pd.DataFrame({"slot": [pdf["slot"].iloc[0]], "part": [sum(np.frombuffer(b) for b in pdf["part"]).tobytes()]})

    parts = map_rows(rows.select("x", "label"), run, "slot int, part binary").groupBy("slot").applyInPandas(add, "slot int, part binary")
    return sum((np.frombuffer(r["part"]) for r in parts.toLocalIterator()), np.zeros(2 * k * k)).reshape(2, k, k)


def fitted(rows: DataFrame, taught: DataFrame):
    """(centre, scale, weights, calibration), or None without both labels."""
    sums = rows.agg(*[f(F.col("x")[i]).alias(f"{n}{i}") for i in range(STATISTICS) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    centre = np.array([sums[f"m{i}"] or 0.0 for i in range(STATISTICS)])
    scale = np.array([sums[f"s{i}"] or 0.0 for i in range(STATISTICS)])
    scale[scale < 1e-9] = 1.0
    by_label = summed(taught, centre, scale)
    sizes = by_label[:, -2, -2]
    if not sizes.all():
        return None
    both = sum(m * (sizes.sum() / 2 / n) for m, n in zip(by_label, sizes))
    a, b = both[:-1, :-1], both[:-1, -1]
    weights = np.linalg.solve(a + RIDGE * sizes.sum() / FEATURES * np.diag([1.0] * FEATURES + [0.0]), b)

    def run(parts):
        for p in parts:
            yield {"raw": fourier(np.array(p["x"], float).reshape(-1, STATISTICS), centre, scale) @ weights, "label": p["label"]}

    cells = counted(map_rows(taught.select("x", "label"), run, "raw double, label double"), LOW, HIGH)
    return centre, scale, weights, isotonic(cells)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document row."""
    prepare(docs.sparkSession)
    rows = saved(numbers(docs), "statistics")
    taught = saved(labelled(rows, labels, "quality", FOLDS, HELD_OUT), "taught")
    model = fitted(rows, taught)

    def run(parts):
        for p in parts:
            if model is None:
                score = np.full(len(p["x"]), 0.5)
            else:
                centre, scale, weights, steps = model
                score = chance(fourier(np.array(p["x"], float).reshape(-1, STATISTICS), centre, scale) @ weights, steps)
            yield {"doc_id": p["doc_id"], "score": score}

    scored = map_rows(rows, run, "doc_id long, score double")
    return scored.select("doc_id", held_out(FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
