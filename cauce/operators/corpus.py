"""Text-corpus preparation and features.

Texts are processed whole; every step is a DataFrame expression or an
aggregate, so corpus size only changes the number of tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cauce.functions import strings as S
from cauce.functions import text as TX
from cauce.operators.relational import sequence_id
from cauce.session import scratch_path

# Fixed values of the preparation policy.
STATE_KEEP, STATE_QUARANTINE, STATE_DUPLICATE = "conservar", "cuarentena", "duplicado"
REASON_OK, REASON_NO_TEXT, REASON_SHORT, REASON_NO_LABEL, REASON_SEEN = (
    "ok", "texto ausente", "texto insuficiente", "etiqueta ausente", "clave ya vista")
MIN_TEXT_CHARS = 10
SPLITS = ("train", "validation", "test")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------- audit
def corpus_audit(df: DataFrame, id_col: str, text_col: str, label_col: str, family_col: str,
                 short_chars: int = MIN_TEXT_CHARS) -> DataFrame:
    """One row: rows, repeated ids, missing labels, families, duplicate texts,
    texts with conflicting labels, short texts."""
    base = df.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count(F.lit(1)) - F.count_distinct(id_col)).alias("repeated_ids"),
        F.count_if(F.col(label_col).isNull()).alias("missing_labels"),
        F.count_distinct(family_col).alias("families"),
        F.count_if(F.length(S.strip(text_col)) < short_chars).alias("short_texts"))
    per_text = df.groupBy(text_col).agg(F.count(F.lit(1)).alias("c"),
                                        F.count_distinct(label_col).alias("nl"))
    dup = per_text.agg(F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c") - 1)), F.lit(0)).cast("long"))
    conflicts = per_text.agg(F.count_if(F.col("nl") > 1))
    return base.withColumn("duplicate_texts", dup.scalar()).withColumn("conflicting_texts", conflicts.scalar())


# ------------------------------------------------------------ preparation
def prepare(df: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Keep the original text, add the processed one (NFC, spaces, redaction),
    and decide a state per id (W03): quarantine, duplicate of an earlier kept id, keep.

    The first id (by ``id_col`` order) of each processed text among eligible rows
    is canonical; later eligible rows point to it.  One aggregate + one join.
    """
    t = F.col(text_col)
    processed = S.redact(TX.normalize(t))
    d = df.withColumn("text_original", t).withColumn("text_processed", processed)
    no_text = t.isNull() | (S.strip(t) == "")
    short = F.length(S.strip(t)) < MIN_TEXT_CHARS
    no_label = F.col(label_col).isNull() | (S.strip(F.col(label_col).cast("string")) == "")
    quarantine_reason = (F.when(no_text, F.lit(REASON_NO_TEXT)).when(short, F.lit(REASON_SHORT))
                         .when(no_label, F.lit(REASON_NO_LABEL)))
    d = d.withColumn("_qr", quarantine_reason)
    firsts = d.filter(F.col("_qr").isNull()).groupBy(F.col("text_processed").alias("_key")) \
        .agg(F.min(id_col).alias("_first"))
    d = d.join(firsts, d["text_processed"].eqNullSafe(firsts["_key"]), "left").drop("_key")
    dup = F.col("_qr").isNull() & (F.col("_first") != F.col(id_col))
    return (d.withColumn("state", F.when(F.col("_qr").isNotNull(), F.lit(STATE_QUARANTINE))
                         .when(dup, F.lit(STATE_DUPLICATE)).otherwise(F.lit(STATE_KEEP)))
             .withColumn("reason", F.when(F.col("_qr").isNotNull(), F.col("_qr"))
                         .when(dup, F.lit(REASON_SEEN)).otherwise(F.lit(REASON_OK)))
             .withColumn("equivalent_id", F.when(dup, F.col("_first")))
             .drop("_qr", "_first"))


def decision_register(prepared: DataFrame, id_col: str) -> DataFrame:
    """One row per original id: state, reason, equivalent id."""
    return prepared.select(F.col(id_col).alias("id_original"), "state", "reason", "equivalent_id")


# ------------------------------------------------------------------ splits
def family_split(df: DataFrame, family_col: str, seed: int = 42,
                 fractions=(0.7, 0.15)) -> DataFrame:
    """Whole families go to one split.

    Families are ordered by ``md5(seed || family)`` (a seeded shuffle that does
    not depend on partitioning), numbered with a distributed global sequence,
    and cut at ``int(n * 0.7)`` and ``int(n * 0.15)`` families.  The family
    table joins back to rows (broadcast by AQE when small).
    """
    fam = df.select(F.col(family_col).alias("_family")).distinct() \
        .withColumn("_h", F.md5(F.concat(F.lit(str(seed)), F.col("_family").cast("string"))))
    fam = sequence_id(fam, ["_h", "_family"], "_rank", start=1)
    n = fam.agg(F.count(F.lit(1))).scalar()
    n_train = F.floor(n * F.lit(fractions[0]))
    n_val = F.floor(n * F.lit(fractions[1]))
    split = (F.when(F.col("_rank") <= n_train, F.lit(SPLITS[0]))
             .when(F.col("_rank") <= n_train + n_val, F.lit(SPLITS[1])).otherwise(F.lit(SPLITS[2])))
    fam = fam.select("_family", split.alias("split"))
    return df.join(fam, df[family_col].eqNullSafe(fam["_family"]), "left").drop("_family")


def drop_conflicting_groups(df: DataFrame, key_col, label_col: str) -> DataFrame:
    """Remove every row whose key carries contradictory labels (quarantined first)."""
    bad = df.groupBy(_c(key_col).alias("_k")).agg(F.count_distinct(label_col).alias("_n")) \
        .filter("_n > 1").select("_k")
    return df.join(bad, _c(key_col) == F.col("_k"), "left_anti")


def split_violations(df: DataFrame, id_col: str, text_col: str, family_col: str,
                     label_col: str, split_col: str = "split") -> DataFrame:
    """One row of violation counts; all zero means the split is sound."""
    ids = df.agg((F.count(F.lit(1)) - F.count_distinct(id_col)).alias("duplicate_ids"),
                 F.count_if(F.col(text_col).isNull() | (S.strip(text_col) == "")).alias("empty_texts"),
                 F.count_if(F.col(split_col).isNull()).alias("unassigned_rows"),
                 (F.lit(len(SPLITS)) - F.count_distinct(split_col)).alias("missing_splits"))
    fam = df.groupBy(family_col).agg(F.count_distinct(split_col).alias("k")) \
        .agg(F.count_if(F.col("k") > 1))
    txt = df.groupBy(text_col).agg(F.count_distinct(split_col).alias("k")) \
        .agg(F.count_if(F.col("k") > 1))
    cov = df.filter(F.col(label_col).isNotNull()).groupBy(split_col) \
        .agg(F.count_distinct(label_col).alias("nl")) \
        .agg(F.coalesce(F.max("nl") - F.min("nl"), F.lit(0)))
    # one-row aggregates attached as scalar subqueries (no cross join)
    return ids.withColumn("families_in_several_splits", fam.scalar()) \
        .withColumn("texts_in_several_splits", txt.scalar()) \
        .withColumn("label_coverage_gap", cov.scalar())


def assert_split_ok(violations: DataFrame) -> None:
    """Raise when any violation count is positive."""
    r = violations.first().asDict()
    bad = {k: v for k, v in r.items() if v}
    if bad:
        raise ValueError(f"split leakage or defects: {bad}")


def split_report(df: DataFrame, family_col: str, label_col: str, split_col: str = "split") -> DataFrame:
    """Rows, families, share of rows and labelled rows per split."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(family_col).alias("families"),
        F.count(label_col).alias("labelled"), F.count_distinct(label_col).alias("labels")) \
        .withColumn("share", F.col("rows") / total)


def text_leakage(a: DataFrame, a_id: str, a_text: str, b: DataFrame, b_id: str, b_text: str) -> DataFrame:
    """Pairs of rows whose normalised text is identical (equi-join on a text hash)."""
    ka = a.select(F.col(a_id).alias("left_id"), F.md5(S.canonical_key(TX.normalize(a_text))).alias("_h"))
    kb = b.select(F.col(b_id).alias("right_id"), F.md5(S.canonical_key(TX.normalize(b_text))).alias("_h"))
    return ka.join(kb, "_h").drop("_h")


# ---------------------------------------------------------------- features
def terms(text: Column, ngram_max: int = 1, min_len: int = 2) -> Column:
    """Lower-cased word tokens (at least ``min_len`` characters) plus n-grams up to ``ngram_max``.

    Pass a column that already holds the tokens' source text; :func:`term_counts`
    tokenizes once in its own projection so the regex is not re-run per n-gram.
    """
    toks = S.words(text, min_len=min_len)
    return ngram_terms(toks, ngram_max)


def ngram_terms(toks: Column, ngram_max: int) -> Column:
    """Tokens followed by their n-grams up to ``ngram_max``."""
    if ngram_max == 1:
        return toks
    out = toks
    for n in range(2, ngram_max + 1):
        out = F.concat(out, S.word_ngrams(toks, n))
    return out


def term_counts(docs: DataFrame, id_col: str, text_col: str, ngram_max: int = 1,
                min_len: int = 2) -> DataFrame:
    """``(id, term, tf)`` postings (one hash aggregate).

    Texts are dealt out by id before they are cut into terms: the counts of a
    document are then complete in its task, and the many postings need no
    shuffle of their own.
    """
    # an explicit number: the terms are many times the texts, so the exchange of the texts must not be coalesced
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_x")).repartition(parts, "id")
    # tokens first, in their own projection: the n-gram expression reads the
    # token column several times and must not re-run the tokenizer each time
    tok = dealt.select("id", S.words(F.col("_x"), min_len=min_len).alias("_w"))
    t = tok.select("id", ngram_terms(F.col("_w"), ngram_max).alias("_t"))
    return S.explode_nonnull(t, F.col("_t"), "term", "id").groupBy("id", "term") \
        .agg(F.count(F.lit(1)).alias("tf"))


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared scratch folder: read by column, lineage cut."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fit_idf(postings: DataFrame, n_docs) -> DataFrame:
    """Smoothed idf ``ln((1+n)/(1+df)) + 1`` per term (the fitted vocabulary)."""
    return with_idf(postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")), n_docs)


def with_idf(frequencies: DataFrame, n_docs) -> DataFrame:
    """``idf`` beside the ``df`` of each term."""
    return frequencies.withColumn("idf", F.log((F.lit(1) + n_docs) / (F.lit(1) + F.col("df"))) + 1)


def tfidf(postings: DataFrame, idf: DataFrame, l2: bool = True) -> DataFrame:
    """``(id, term, weight)``; terms outside the vocabulary are dropped (OOV).

    The join on ``term`` is a shuffle join; a very frequent term is the hot key
    there and AQE's skew-join splits it.  The L2 norm is a window per document,
    whose size is bounded by the document.
    """
    # the vocabulary grows with the corpus: never broadcast it on a size estimate
    # (a checkpointed input can make the estimate small); sort-merge join, with
    # AQE's skew handling for very frequent terms
    w = postings.join(idf.select("term", "idf").hint("merge"), "term") \
        .withColumn("weight", F.col("tf") * F.col("idf"))
    if l2:
        norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("id")))
        w = w.withColumn("weight", F.col("weight") / norm)
    return w.select("id", "term", "weight")


def oov_terms(postings: DataFrame, idf: DataFrame) -> DataFrame:
    """Postings whose term is not in the fitted vocabulary."""
    return postings.join(idf.select("term").hint("merge"), "term", "left_anti")
