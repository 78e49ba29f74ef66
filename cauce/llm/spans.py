"""Spans of regular expressions in columns, with the JVM's functions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def none() -> Column:
    return F.array().cast(SPANS)


#: Matches whose lengths are added up one by one; the sums of whole groups of them are carried over.
GROUP = 64


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(lengths: Column) -> Column:
    """Struct of ``lengths`` and ``before``: the sum of everything in front of each group of GROUP lengths."""
    add = lambda a, x: a + x
    total = lambda xs: F.aggregate(xs, F.lit(0), add)
    groups = F.transform(F.sequence(F.lit(0), F.floor(F.size(lengths) / GROUP).cast("int")),
                         lambda g: total(F.slice(lengths, g * GROUP + 1, F.lit(GROUP))))
    start = F.struct(F.lit(0).alias("sum"), F.array(F.lit(0)).alias("out"))
    before = F.aggregate(groups, start, lambda acc, n: F.struct((acc["sum"] + n).alias("sum"), F.concat(acc["out"], F.array(acc["sum"] + n)).alias("out")), lambda acc: acc["out"])
    return F.struct(lengths.alias("lengths"), before.alias("before"))


def found(text: Column, kind: str, pattern: str, only_if: Column, value: int = 0) -> Column:
    """All matches, leftmost first, as (kind, start, end, value of a group); code points, end exclusive.

    A text cut at the matches gives the gaps between them, and the running sum
    of gaps and matches their places.  ``only_if`` spares texts that can't match."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = whole if value == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(value))
    rows = F.arrays_zip(whole.alias("whole"), part.alias("part"), F.split(text, pattern, -1).alias("gap"))
    rows = F.filter(rows, lambda r: r["whole"].isNotNull())

    def placed(rows):
        def spans(sums):
            def span(row, i):
                group = F.floor(i / GROUP).cast("int")
                ahead = F.aggregate(F.slice(sums["lengths"], group * GROUP + 1, i % GROUP), F.lit(0), lambda a, x: a + x)
                return let(F.get(sums["before"], group) + ahead + F.length(row["gap"]), lambda start: F.struct(
                    F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(row["whole"])).alias("end"), row["part"].alias("value")))
            return F.transform(rows, span)
        return let(let(F.transform(rows, lambda r: F.length(r["gap"]) + F.length(r["whole"])), running), spans)

    return F.when(F.coalesce(only_if, F.lit(False)), let(rows, placed).cast(SPANS)).otherwise(none())


def overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
