"""String column functions.

All are built-in Catalyst expressions, so they stay inside whole-stage codegen.
Regexes use ``[\\p{L}\\p{N}_]`` instead of ``\\w`` because Java's ``\\w`` is
ASCII-only (``año`` would split into three tokens).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's behaviour.
EMAIL_TOKEN = "[CORREO]"
URL_TOKEN = "[URL]"
EMAIL_PATTERN = r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_.-]+\.[A-Za-z]{2,}"
URL_PATTERN = r"https?://\S+|www\.\S+"
WORD = r"[\p{L}\p{N}_]"
# Python's str.isspace() set, written so Java regex and RE2 read it the same way.
PY_WS = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
         r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# The same characters as a list, for trims.
WS_CHARS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                             0x202F, 0x205F, 0x3000]))
TOKEN_PATTERN = WORD + r"+|[^\p{L}\p{N}_\s]"
SUSPICIOUS_PATTERN = (r"ignora.{0,30}(instrucciones|reglas)|revela.{0,25}(secreto|contraseña)"
                      r"|ignore.{0,25}instructions")
# Ordered keyword rules of the support-ticket baseline; default label last.
TICKET_RULES = (
    ("pagos", r"factura|pag[oó]|cobro|cargo|tarjeta|reembolso"),
    ("acceso", r"contrase|sesión|usuario|c[oó]digo|cuenta|acceso"),
    ("conectividad", r"wifi|red|internet|vpn|conexión"),
)
TICKET_DEFAULT = "software"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """All white space off both ends (``trim`` takes spaces only)."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def norm_key(c) -> Column:
    """Case-fold + trim (F03 building block)."""
    return F.lower(F.trim(_c(c)))


def casefold_equal(a, b) -> Column:
    """equality after lower(trim())."""
    return norm_key(a) == norm_key(b)


def strip_quotes(c) -> Column:
    """remove literal quotes wrapped around a value, then spaces."""
    return F.trim(F.regexp_replace(F.trim(_c(c)), r"^['\"]+|['\"]+$", ""))


def full_match(c, pattern: str) -> Column:
    """whole-value regex test (``re.fullmatch``)."""
    return _c(c).rlike(f"^(?:{pattern})$")


def first_number(c) -> Column:
    """first number in a unit string ('74 bhp' -> 74.0); none -> null."""
    return F.expr("try_cast(nullif(regexp_extract({0}, '([0-9.]+)', 1), '') AS DOUBLE)"
                  .format(_sql(c)))


def to_number(c) -> Column:
    """coerce to double, bad values -> null (ANSI-safe)."""
    return _c(c).try_cast("double")


def sentinel_to_null(c, sentinels=("NA", "?")) -> Column:
    """domain sentinel text -> null."""
    col = _c(c)
    return F.when(F.trim(col).isin(list(sentinels)), F.lit(None)).otherwise(col)


def ascii_only(c) -> Column:
    """lossy ASCII view (tab..CR and printable ASCII kept)."""
    return F.regexp_replace(_c(c), r"[^\x09-\x0D\x20-\x7E]", "")


def redact(c) -> Column:
    """e-mail -> [CORREO], then URL -> [URL]."""
    return F.regexp_replace(F.regexp_replace(_c(c), EMAIL_PATTERN, EMAIL_TOKEN),
                            URL_PATTERN, URL_TOKEN)


def emails(c) -> Column:
    return F.regexp_extract_all(_c(c), F.lit(f"({EMAIL_PATTERN})"), 1)


def word_tokens(c) -> Column:
    """words and single punctuation marks of the lower-cased text."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(f"({TOKEN_PATTERN})"), 1)


def words(c, min_len: int = 1) -> Column:
    """Word tokens only (no punctuation) of at least ``min_len`` characters.

    ``WORD{n,}`` matches exactly the maximal word runs of length >= n (a
    greedy run is always matched from its first character), so no per-element
    filter lambda is needed; lambdas are interpreted, regexes are codegen'd.
    """
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(f"({WORD}{{{max(min_len, 1)},}})"), 1)


def word_ngrams(tokens, n: int) -> Column:
    """Contiguous n-grams of a word-token array (tokens contain no spaces), joined by ' '.

    One regex over the space-joined tokens: an anchored lookahead captures
    every run of ``n`` consecutive tokens, overlapping ones included.
    """
    if n == 1:
        return _c(tokens)
    pat = r"(?<![^ ])(?=([^ ]+" + r"(?: [^ ]+)" + f"{{{n - 1}}}))"
    return F.regexp_extract_all(F.array_join(_c(tokens), " "), F.lit(pat), 1)


def explode_nonnull(df, expr: Column, alias: str, *keep):
    """``explode`` of an array expression without Catalyst's inferred ``size > 0`` filter.

    A plain ``explode`` makes the optimizer add ``size(expr) > 0`` and push it
    down to the scan, evaluating an expensive ``expr`` (tokenizer, Arrow UDF)
    twice, the first time before any repartition.  ``explode_outer`` followed
    by a null filter on the output keeps a single evaluation.
    """
    return df.select(*keep, F.explode_outer(expr).alias(alias)).filter(F.col(alias).isNotNull())


def whitespace_tokens(c) -> Column:
    """plain whitespace split, empty pieces dropped."""
    return F.filter(F.split(_c(c), PY_WS + "+"), lambda t: t != "")


def sentences(c) -> Column:
    """pieces between runs of . ! ? followed by whitespace; empties dropped."""
    parts = F.split(_c(c), r"[.!?]+" + PY_WS + "+")
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != "")


def rule_label(c, rules, default: str) -> Column:
    """ordered (label, pattern) rules; the first match wins."""
    out = None
    for label, pattern in rules:
        cond = _c(c).rlike(pattern)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def suspicious(c) -> Column:
    """text that tries to steer a downstream reader."""
    return F.lower(_c(c)).rlike(SUSPICIOUS_PATTERN)


# Fixed value: characters stripped from both ends of a canonical key.
EDGE_CHARS = ' .,:;!?¿¡"'


def canonical_key(c) -> Column:
    """whitespace-collapsed lower text without edge punctuation.

    Callers pass NFC text (``text.normalize``) when the source may be decomposed.
    """
    s = F.lower(F.trim(F.regexp_replace(_c(c), PY_WS + "+", " ")))
    return F.btrim(s, F.lit(EDGE_CHARS))


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` + zero-padded number (``P`` + 000042)."""
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def id_number(c, prefix_len: int = 1) -> Column:
    """numeric part of an id such as ``P000042``; non-numeric -> null."""
    return F.substr(_c(c), F.lit(prefix_len + 1)).try_cast("long")


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass a column name for SQL-expression helpers")
