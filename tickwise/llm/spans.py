"""Regular-expression spans as native Spark columns: code-point offsets without a Python function."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickwise.llm.common import let

#: Matches per block of the two-level running sum.
BLOCK = 64

SPAN = "array<struct<start:int,end:int,value:string>>"


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def _running_before(xs: Column) -> Column:
    """For each element the sum of the elements before it, by blocks: far from quadratic for texts full of matches."""
    def of(xs: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / BLOCK).cast("int"))
        sums = F.transform(blocks, lambda b: _sum(F.slice(xs, b * BLOCK + 1, BLOCK)))
        starts = let(sums, lambda s: F.transform(blocks, lambda b: _sum(F.slice(s, F.lit(1), b))))
        return let(starts, lambda st: F.transform(xs, lambda x, i: F.element_at(st, F.floor(i / BLOCK).cast("int") + 1)
                                                  + _sum(F.slice(xs, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK))))
    return let(xs, of)


def spans(text: Column, pattern: str, keep=None) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` as (start, end, value), end exclusive.

    The gaps between matches come from ``split`` and the matches from
    ``regexp_extract_all``; their lengths add up to the offsets.  ``keep``
    filters on the matched value.  A null text gives an empty array.
    """
    def of(gaps: Column, vals: Column) -> Column:
        lengths = F.transform(vals, lambda v, i: F.length(F.element_at(gaps, i + 1)) + F.length(v))
        return let(_running_before(lengths), lambda before: F.transform(vals, lambda v, i: let(
            F.element_at(before, i + 1) + F.length(F.element_at(gaps, i + 1)),
            lambda start: F.struct(start.alias("start"), (start + F.length(v)).alias("end"), v.alias("value")))))

    found = let(F.split(text, pattern, -1), lambda gaps: let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda vals: of(gaps, vals)))
    if keep is not None:
        found = F.filter(found, lambda s: keep(s["value"]))
    return F.when(F.coalesce(text.rlike(pattern), F.lit(False)), found).otherwise(F.array().cast(SPAN))


def digest(parts: Column) -> Column:
    """Lowercase sha256 of a spans string."""
    return F.sha2(parts, 256)


def joined(entries: Column) -> Column:
    """kind:start:end, comma-joined, of an array of structs with those fields."""
    return F.array_join(F.transform(entries, lambda e: F.concat_ws(":", e["kind"], e["start"], e["end"])), ",")
