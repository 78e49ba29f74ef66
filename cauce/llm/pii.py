r"""Personal data by weak supervision.

Base spans follow fixed patterns and checks (email, ip, card, phone).  Beyond
them, loose patterns propose candidates: spoken e-mail addresses, local phone
numbers, social security numbers, account numbers, titled names, and the base
patterns' matches that fail their check.  On every candidate five labelers
vote yes, no or abstain:

* check: the strict form or checksum of its kind (regular expression);
* list: a gazetteer of its kind (domain endings, card prefixes, country codes, titles);
* before: context words in the characters before, for and against;
* after: context words behind;
* border: the span stands free of other letters and digits.

The votes are counted by pattern over the whole corpus (kinds x 3^5 rows at
most), expectation-maximisation finds each labeler's reliability and each
pattern's chance of being personal data, and a naive Bayes classifier over
span features is trained on these chances.  Candidates that it takes with
ACCEPT or more and that touch no base span are added; base spans stay.

Everything runs in the JVM.  Cases: a null text is empty and has no spans;
rows are kept as they are; without candidates nothing is learned or added;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from cauce.llm.common import prepare, saved
from cauce.llm.spans import count_of, found, listed, none, overlaps

BASE = ("email", "ip", "card", "phone")
#: Written so that no match starts inside an earlier run and nothing backtracks over a long one; they find what the plain patterns find (of runs of digits, those of 16 or more).
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
ADDED = {
    "email_spoken": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?+(?:\(at\)|\[at\])\x20?+[A-Za-z0-9-]++(?:\x20?+(?:\(dot\)|\[dot\]|\.)\x20?+[A-Za-z0-9-]++)++", r"[(\[]at[)\]]"),
    "phone_local": (r"(?<![0-9A-Za-z+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])", r"[0-9]{3}[\x20.-][0-9]{4}"),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9]{2}-[0-9]"),
    "account": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"),
    "name": (r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Monsieur|Madame)\.?\x20\p{Lu}[\p{L}'-]+(?:\x20\p{Lu}[\p{L}'-]+)?",
             r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Monsieur|Madame)\.?\x20\p{Lu}"),
}
LABELERS = ("check", "list", "before", "after", "border")
CONTEXT = 32
#: Words for and against around a span.
FOR = r"(?i)\b(?:e-?mail|mail|contact|write|phone|tel|call|mobile|fax|card|visa|pay|iban|account|ssn|social|name|address|ip|host|server|from|login)\b"
AGAINST = r"(?i)\b(?:version|ver|order|invoice|isbn|issn|page|chapter|ref|sku|figure|section|table|build)\b"
ENDINGS = r"(?i)\.(?:com|org|net|edu|gov|info|biz|io|co|eu|uk|de|fr|es|it|nl|us|ca|au|jp|br|mx|ar|ch|at)$"
ROUNDS = 8
ACCEPT = 0.9


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    turned = F.split(F.reverse(digits), "")
    twice = F.transform(turned, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(twice, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def valid(span: Column) -> Column:
    """The check of a span's kind."""
    value = span["value"]
    digits = F.regexp_replace(value, "[^0-9]", "")
    parts = F.split(value, r"\.")
    low = F.forall(parts, lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    return (F.when(span["kind"] == "email", F.lit(True)).when(span["kind"] == "ip", low)
            .when(span["kind"] == "card", F.length(digits).between(16, 19) & luhn(digits))
            .otherwise(F.length(digits).between(8, 15)))


def matches(text: Column) -> Column:
    """All matches of the base patterns, by kind as listed."""
    return F.concat(found(text, "email", EMAIL, text.contains("@")), found(text, "ip", IP, text.rlike(r"[0-9]\.[0-9]")),
                    found(text, "card", CARD, text.rlike(r"[0-9](?:[\x20-]?+[0-9]){15}")),
                    found(text, "phone", PHONE, text.contains("+")))


def votes(text: Column, span: Column, checked: Column) -> dict[str, Column]:
    """Each labeler's vote: 1 yes, 0 no, -1 abstains."""
    kind, value = span["kind"], span["value"]
    yes = lambda c: F.when(c, 1).otherwise(0)
    before = F.substring(text, F.greatest(span["start"] - CONTEXT, F.lit(0)) + 1, F.least(span["start"], F.lit(CONTEXT)))
    after = F.substring(text, span["end"] + 1, F.lit(CONTEXT))
    context = lambda c: F.when(c.rlike(AGAINST), 0).when(c.rlike(FOR), 1).otherwise(-1)
    digits = F.regexp_replace(value, "[^0-9]", "")
    listed_ = (F.when(kind.isin("email", "email_spoken"), F.when(value.rlike(ENDINGS), 1).otherwise(-1))
               .when(kind == "ip", yes(~value.rlike(r"^(?:0|255)\.")))
               .when(kind == "card", yes(digits.rlike(r"^(?:4|5[1-5]|2[2-7]|6(?:011|5)|3[0-9])")))
               .when(kind == "phone", yes(digits.rlike("^(?:1|2[07]|3|4|5|6[0-6]|7|8[1246]|9[0-58])")))
               .when(kind == "phone_local", yes(digits.rlike("^[2-9]")))
               .when(kind == "ssn", yes(~digits.rlike("^(?:000|666|9)|^...00|0000$")))
               .when(kind == "account", yes(value.rlike("^(?:AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)")))
               .otherwise(F.lit(1)))
    strict = (F.when(kind.isin(*BASE), yes(checked)).when(kind == "email_spoken", yes(value.rlike(r"(?i)dot|\.[A-Za-z]{2,}$")))
              .when(kind == "ssn", F.lit(1)).otherwise(F.lit(-1)))
    edge = F.concat(F.substring(before, -1, 1), F.lit(" "), F.substring(after, 1, 1))
    return {"check": strict, "list": listed_, "before": context(before), "after": context(after), "border": yes(~edge.rlike(r"[\p{L}\p{N}]"))}


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base (spans), cand (spans with votes and features) of every document row."""
    text = F.col("text")
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("all", matches(text))
    rows = rows.withColumn("base", F.filter("all", valid))
    loose = F.concat(none(), *[F.filter(found(text, k, p, text.rlike(q)), lambda s: ~overlaps(s, F.col("all"))) for k, (p, q) in ADDED.items()])

    def described(span):
        ok = valid(span) & span["kind"].isin(*BASE)
        v = votes(text, span, ok)
        length = span["end"] - span["start"]
        features = F.array(F.concat(F.lit("kind "), span["kind"]), F.concat(F.lit("length "), span["kind"], F.lit(" "), F.least(F.floor(length / 8), F.lit(8)).cast("string")),
                           *[F.concat(F.lit(f"{name} "), x.cast("string")) for name, x in v.items()])
        return F.struct(span["kind"].alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
                        F.concat_ws(",", span["kind"], *[x.cast("string") for x in v.values()]).alias("votes"), features.alias("features"))

    return rows.select("doc_id", "base", F.transform(F.concat("all", loose), described).alias("cand"))


def learned_votes(patterns: DataFrame) -> DataFrame:
    """patterns (votes, n, one column a labeler) with ``p``, the chance of personal data, after ROUNDS of expectation-maximisation.

    The first chances are the share of yes among the votes cast; later ones
    come from the reliabilities, which are a few sums a round (labelers x votes x classes)."""
    cast = sum((F.when(F.col(c) >= 0, 1).otherwise(0) for c in LABELERS), F.lit(0))
    agree = sum((F.when(F.col(c) == 1, 1).otherwise(0) for c in LABELERS), F.lit(0))
    p = (agree + 0.5) / (cast + 1.0)
    for _ in range(ROUNDS):
        told = patterns.withColumn("p", p)
        sums = told.agg(F.sum(F.col("p") * F.col("n")).alias("yes"), F.sum((1 - F.col("p")) * F.col("n")).alias("no"), *[
            F.sum(F.when(F.col(c) == v, F.col("n") * (F.col("p") if z else 1 - F.col("p"))).otherwise(0.0)).alias(f"{c}{v}{z}")
            for c in LABELERS for v in (1, 0, -1) for z in (1, 0)]).first()
        total = {1: sums["yes"] or 0.0, 0: sums["no"] or 0.0}
        odds = F.lit(math.log((total[1] + 1) / (total[0] + 1)))
        for c in LABELERS:
            share = {(v, z): ((sums[f"{c}{v}{z}"] or 0.0) + 1) / (total[z] + 3) for v in (1, 0, -1) for z in (1, 0)}
            for v in (1, 0):  # an abstention tells nothing
                odds = odds + F.when(F.col(c) == v, math.log(share[v, 1] / share[v, 0])).otherwise(0.0)
        p = 1 / (1 + F.exp(-odds))
    return patterns.withColumn("p", p)


def classifier(found_rows: DataFrame) -> tuple[float, dict[str, float]]:
    """Prior and weights (log odds by feature) of the naive Bayes span classifier."""
    each = found_rows.select(F.explode("cand").alias("c")).select("c.votes", "c.features")
    names = F.split("votes", ",")
    patterns = saved(each.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).select(
        "votes", "n", *[names[i + 1].cast("int").alias(c) for i, c in enumerate(LABELERS)]), "votes")
    chances = saved(learned_votes(patterns).select("votes", "n", "p"), "chances")
    # few votes patterns and features: both are fixed lists, whatever the size of the corpus
    counted = each.groupBy("votes", "features").agg(F.count(F.lit(1)).alias("m")).join(F.broadcast(chances), "votes")
    sums = counted.select(F.explode("features").alias("f"), (F.col("m") * F.col("p")).alias("yes"), (F.col("m") * (1 - F.col("p"))).alias("no"))
    rows = sums.groupBy("f").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).collect()
    total = chances.agg(F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no")).first()
    yes, no = total["yes"] or 0.0, total["no"] or 0.0
    return math.log((yes + 1) / (no + 1)), {r["f"]: math.log((r["yes"] + 1) / (yes + 2) / ((r["no"] + 1) / (no + 2))) for r in rows}


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans (base and added; kind, start, end) of every document row."""
    prepare(docs.sparkSession)
    rows = saved(candidates(docs), "pii")
    prior, weights = classifier(rows)
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else None

    def taken(c):
        score = F.aggregate(c["features"], F.lit(prior), lambda a, f: a + F.coalesce(F.element_at(table, f), F.lit(0.0)))
        return (1 / (1 + F.exp(-score)) >= ACCEPT) & ~c["kind"].isin(*BASE)

    plain = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    added = F.filter("cand", taken) if table is not None else F.filter("cand", lambda c: F.lit(False))
    base = F.transform("base", plain)
    return rows.select("doc_id", base.alias("base"), F.concat(base, F.transform(added, plain)).alias("spans"))


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", *[count_of(F.col("base"), k).alias(f"n_{k}") for k in BASE],
                       F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
                       (F.size("spans") - F.size("base")).cast("long").alias("n_added"))
