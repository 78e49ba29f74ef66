"""Text column functions that need Python's Unicode or match-offset semantics.

Spark has no NFC normaliser and no "all matches with offsets" function, so
these few helpers are Arrow-batched UDFs (never row-at-a-time UDFs).  They take
a batch in parts of about ``PART_BYTES`` and hand Arrow arrays back, so the
Python objects of a worker are those of one part.  Everything else about text (tokens, n-grams, redaction) is built-in
expressions in :mod:`cauce.functions.strings`.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rule-based entity patterns (label, regex), applied in this order.
ENTITY_RULES = (
    ("FOLIO", r"\bINC-\d{4}\b"),
    ("PRODUCTO", r"\b(?:AulaPro|MesaApp|NubeTec)\b"),
)

SPAN = T.StructType([
    T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
    T.StructField("label", T.StringType()),
])
CHUNK = T.StructType([
    T.StructField("chunk_index", T.IntegerType()),
    T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
])
TOKEN = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
])


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


PART_BYTES = 1 << 20


def _in_parts(texts: pa.Array, convert) -> pa.Array:
    """``convert`` on slices of about PART_BYTES, one row at least, joined again."""
    rows = max(1, int(len(texts) * PART_BYTES / max(texts.nbytes, 1)))
    parts = [convert(texts.slice(i, rows)) for i in range(0, len(texts), rows)]
    return pa.concat_arrays(parts) if parts else convert(texts)


def _nfc_part(part: pa.Array) -> pa.Array:
    # ASCII is its own NFC
    if pc.all(pc.string_is_ascii(part)).as_py() is not False:
        return part
    return pa.array([None if x is None else unicodedata.normalize("NFC", x) for x in part.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def nfc(s: pa.Array) -> pa.Array:
    """F17 building block: Unicode NFC (null stays null)."""
    return _in_parts(s, _nfc_part)


def normalize(c) -> Column:
    """NFC, whitespace runs -> one space, trimmed.  Case and accents kept."""
    from cauce.functions.strings import PY_WS
    return F.trim(F.regexp_replace(nfc(_c(c)), PY_WS + "+", " "))


def changed_by_nfc(c) -> Column:
    """the raw value differs from its NFC form (composed vs decomposed)."""
    return _c(c) != nfc(_c(c))


def utf8_hex(c) -> Column:
    """byte view of the UTF-8 encoding."""
    return F.hex(F.encode(_c(c), "UTF-8"))


def _lists(part: pa.Array, rows_of, fields: dict) -> pa.Array:
    """One list of structs a text, built from columns; ``rows_of`` gives a text's tuples (a null text has null)."""
    ends, columns = [0], [[] for _ in fields]
    texts = part.to_pylist()
    for text in texts:
        for row in () if text is None else rows_of(text):
            for column, value in zip(columns, row):
                column.append(value)
        ends.append(len(columns[0]))
    values = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, fields.values())], names=list(fields))
    gone = pa.array([x is None for x in texts], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=gone)


def _spans_of(text, rules):
    return sorted((m.start(), m.end(), label) for label, pattern in rules for m in re.finditer(pattern, text))


def regex_spans(c, rules=ENTITY_RULES) -> Column:
    """all rule matches as ``[start, end)`` code-point offsets, sorted."""
    rules = tuple(rules)

    @F.arrow_udf(T.ArrayType(SPAN))
    def _spans(s: pa.Array) -> pa.Array:
        fields = {"start": pa.int32(), "end": pa.int32(), "label": pa.string()}
        return _in_parts(s, lambda part: _lists(part, lambda t: _spans_of(t, rules), fields))

    return _spans(_c(c))


@F.arrow_udf(T.ArrayType(TOKEN))
def token_offsets(s: pa.Array) -> pa.Array:
    """Word/punctuation tokens with code-point offsets (for BIO alignment)."""
    pat = re.compile(r"\w+|[^\w\s]")
    fields = {"token": pa.string(), "start": pa.int32(), "end": pa.int32()}
    return _in_parts(s, lambda part: _lists(part, lambda t: ((m.group(0), m.start(), m.end()) for m in pat.finditer(t)), fields))


def chunk_offsets(c, size: int, overlap: int) -> Column:
    """windows of ``size`` whitespace tokens, step ``size - overlap``.

    Returns ``array<struct<chunk_index, start, end>>`` in code points.  With n
    tokens there are 1 + ceil((n - size) / step) windows (at least one, none
    without tokens): the last one is the first to reach the final token.
    """
    if overlap < 0 or size <= overlap:
        raise ValueError("need 0 <= overlap < size")
    step = size - overlap

    @F.arrow_udf(T.ArrayType(CHUNK))
    def _chunks(s: pa.Array) -> pa.Array:
        def windows(text):
            spans = np.array([m.span() for m in re.finditer(r"\S+", text)], np.int64).reshape(-1, 2)
            first = np.arange(0, max(len(spans) - overlap, min(len(spans), 1)), step)
            last = np.minimum(first + size, len(spans)) - 1
            return zip(first.tolist(), spans[first, 0].tolist(), spans[last, 1].tolist())
        fields = {"chunk_index": pa.int32(), "start": pa.int32(), "end": pa.int32()}
        return _in_parts(s, lambda part: _lists(part, windows, fields))

    return _chunks(_c(c))


def bio_tags(tokens, spans) -> Column:
    """F30 spans -> BIO: a token is B when it starts a span, I when inside, else O.

    Pure array expressions: for each token find the last span that covers it.
    """
    def tag(tok):
        cover = F.filter(_c(spans), lambda s: (tok["start"] >= s["start"]) & (tok["end"] <= s["end"]))
        first = F.element_at(cover, -1)
        return F.when(F.size(cover) == 0, F.lit("O")) \
            .when(first["start"] == tok["start"], F.concat(F.lit("B-"), first["label"])) \
            .otherwise(F.concat(F.lit("I-"), first["label"]))
    return F.transform(_c(tokens), tag)


def bio_spans(tokens, tags) -> Column:
    """F30 BIO -> spans: a span runs from a B (or an I with another label) to the token before the next change."""
    rows = F.arrays_zip(_c(tokens).alias("tok"), _c(tags).alias("tag"))
    label = lambda x: F.substr(x["tag"], F.lit(3))
    kept = F.filter(F.transform(rows, lambda x, i: F.struct(x["tok"]["start"].alias("start"), x["tok"]["end"].alias("end"),
                                                            x["tag"].alias("tag"), i.alias("at"))), lambda x: x["tag"] != "O")
    pairs = F.arrays_zip(kept.alias("now"), F.concat(F.array(F.lit(None)), kept).alias("before"))
    opened = F.filter(F.transform(pairs, lambda p: F.when(
        p["now"]["tag"].startswith("B-") | p["before"].isNull() | (p["before"]["at"] != p["now"]["at"] - 1)
        | (label(p["before"]) != label(p["now"])), p["now"])), lambda x: x.isNotNull())
    nexts = F.concat(F.slice(opened, 2, F.greatest(F.size(opened) - 1, F.lit(0))), F.array(F.lit(None)))
    return F.transform(F.slice(F.arrays_zip(opened.alias("o"), nexts.alias("n")), 1, F.size(opened)), lambda z: F.struct(
        z["o"]["start"].alias("start"),
        F.element_at(F.filter(kept, lambda x: (x["at"] >= z["o"]["at"]) & (z["n"].isNull() | (x["at"] < z["n"]["at"]))), -1)["end"].alias("end"),
        label(z["o"]).alias("label")))


def first_piece_tags(word_ids, tags) -> Column:
    """F30 sub-word alignment: the first piece of each word takes the word's tag; others and pieces of no word take null."""
    ids = _c(word_ids)
    return F.transform(ids, lambda w, i: F.when(w.isNotNull() & ((i == 0) | ~w.eqNullSafe(F.get(ids, i - 1))),
                                                F.get(_c(tags), w)))


def ngrams(tokens, n: int) -> Column:
    """contiguous n-grams of a token array joined by one space.

    Built as a zip of ``n`` shifted slices: linear in the array length.  (A
    ``transform`` over positions that re-reads the token expression inside the
    lambda would re-run the tokenizer once per position.)
    """
    toks = _c(tokens)
    if n == 1:
        return toks
    m = F.greatest(F.size(toks) - n + 1, F.lit(0))
    shifted = [F.slice(toks, k + 1, m).alias(str(k)) for k in range(n)]
    z = F.arrays_zip(*shifted)
    return F.when(m > 0, F.transform(z, lambda s: F.concat_ws(" ", *[s[str(k)] for k in range(n)]))) \
        .otherwise(F.array().cast("array<string>"))
