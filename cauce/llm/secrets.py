r"""Secret scans with corpus-wide ownership.

Base spans follow three fixed patterns (assign, access, hex).  Added patterns
propose keys of known makers, signed tokens, key blocks and long mixed
strings.  The hash of every candidate's value is counted over the whole
corpus: in how many repositories and with how many owners it occurs.  A value
with more than MAX_OWNERS owners is a widely copied example; one that few
owners hold and that looks random is live-looking.  Added candidates become
spans when they are live-looking; base spans stay, whatever the verdict.

``documents`` names an owner (``source``) and, as it has no repositories, each
document counts as one.  Counting goes (value, owner, repository), then
(value, owner), then value, each with map-side sums, so that a value that a
third of all documents hold moves a few rows a task.

Everything runs in the JVM.  Cases: a null text is empty and has no spans; a
null source is an owner of its own; repeated rows of one doc_id are one
repository; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cauce.llm.common import prepare, saved
from cauce.llm.spans import SPANS, found, let, listed, none, overlaps

BASE = ("assign", "access", "hex")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs shorter than asked fail anyway and hold no other match, so the lengths stand in the patterns.
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
MIN_ASSIGNED = 6
ADDED = {
    "issued": (r"(?<![A-Za-z0-9_])(?:gh[opsur]|glpat|xox[abeprs]|sk|pk|rk|npm|pypi)[_-][A-Za-z0-9_-]{16,}", r"[a-z][_-][A-Za-z0-9_-]{16}"),
    "signed": (r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "eyJ"),
    "block": (r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}", "PRIVATE KEY-----"),
    "mixed": (r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}+={0,2}", r"[A-Za-z0-9+/_-]{32}"),
}
KINDS = (*BASE, *ADDED)
MAX_OWNERS = 2
MIN_BITS = 3.0


def base_matches(text: Column) -> Column:
    assign = F.filter(found(text, "assign", ASSIGN, text.rlike("(?i)passw|secret|token|api_?key"), value=1), lambda s: F.length(s["value"]) >= MIN_ASSIGNED)
    return F.concat(assign, found(text, "access", ACCESS, text.contains("AKIA")), found(text, "hex", HEX, text.rlike("[0-9a-f]{24}")))


def bits(value: Column) -> Column:
    """Shannon entropy of a value's characters, in bits a character."""
    letters = F.filter(F.array_distinct(F.split(value, "")), lambda c: c != "")
    # one pass over the value for each distinct character
    share = lambda c: (F.length(value) - F.length(F.replace(value, c, F.lit("")))) / F.length(value)
    return F.aggregate(letters, F.lit(0.0), lambda a, c: let(share(c), lambda x: a - x * F.log2(x)))


def random_looking(span: Column) -> Column:
    """Digits and letters mixed (for ``mixed`` of both cases), no filler words, and enough entropy; key blocks always."""
    return (span["kind"] == "block") | ((span["kind"] != "mixed") | span["value"].rlike("[a-z]") & span["value"].rlike("[A-Z]")) & (span["value"].rlike("[0-9]") & span["value"].rlike("[A-Za-z]")
            & ~span["value"].rlike("(?i)example|sample|dummy|changeme|xxxx|placeholder|your") & (bits(span["value"]) >= MIN_BITS))


def candidates(docs: DataFrame) -> DataFrame:
    """row, doc_id, owner, base (spans), cand (all candidate spans with ``hash`` and ``random``)."""
    text = F.col("text")
    rows = docs.select("doc_id", F.col("source").cast("string").alias("owner"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("base", base_matches(text))
    loose = none()
    for k, (p, q) in ADDED.items():  # each leaves out what an earlier kind has found
        rows = rows.withColumn("loose", loose if k == next(iter(ADDED)) else F.col("loose"))
        rows = rows.withColumn("loose", F.concat("loose", F.filter(found(text, k, p, text.rlike(q)), lambda s: ~overlaps(s, F.concat(F.col("base"), F.col("loose"))))).cast(SPANS))
    described = F.transform(F.concat("base", "loose"), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.unhex(F.md5(s["value"])).alias("hash"), random_looking(s).alias("random")))
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "base", described.alias("cand"))


def ownership(found_rows: DataFrame) -> DataFrame:
    """hash, n_owners, n_repositories of every candidate value."""
    each = found_rows.select("doc_id", "owner", F.explode("cand.hash").alias("hash"))
    by_repository = each.groupBy("hash", "owner", "doc_id").agg(F.lit(1).alias("one"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repositories").alias("n_repositories"))


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base, spans, n_live, n_copied of every document row.

    n_live counts live-looking values, n_copied widely copied ones, among all candidates."""
    prepare(docs.sparkSession)
    rows = saved(candidates(docs), "secrets")
    owned = ownership(rows)
    each = rows.select("row", F.explode("cand").alias("c")).select("row", "c.*").join(owned, "hash")
    copied = F.col("n_owners") > MAX_OWNERS
    live = ~copied & F.col("random")
    span = F.struct("kind", "start", "end")
    verdicts = each.groupBy("row").agg(
        F.collect_list(F.when(live & ~F.col("kind").isin(*BASE), span)).alias("added"),
        F.sum(live.cast("long")).alias("n_live"), F.sum(copied.cast("long")).alias("n_copied"))
    plain = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    out = rows.join(verdicts, "row", "left")
    base = F.transform("base", plain)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", ordered(base).alias("base"),
                      ordered(F.concat(base, F.coalesce("added", F.transform(none(), plain)))).alias("spans"), zero("n_live"), zero("n_copied"))


def ordered(spans: Column) -> Column:
    """By start, then kind as listed."""
    place = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), place(s).alias("place"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.transform(keyed, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def digest(rows: DataFrame) -> DataFrame:
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select("doc_id", *map(n, BASE), F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                       listed(F.col("spans")).alias("spans"), "n_live", "n_copied")
