"""Places of pattern matches as columns, in code points, by Spark's own string functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spans sort by start, then by place (the kind's place in its list of kinds).
SPAN = "struct<start:int,place:int,end:int,kind:string>"
MATCH = "array<struct<start:int,end:int,hit:string>>"


def running_sums(values: Column) -> Column:
    """Sums of an array's values up to each place, by doubling: with the step of 2^k every place adds what stands 2^k before it.

    That takes n log n additions; appending one by one would copy the array n times.
    """
    steps = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")), lambda k: F.pow(F.lit(2), k).cast("int"))

    def add(sums: Column, step: Column) -> Column:
        return F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - step), F.lit(0)))

    return F.aggregate(steps, values, add)


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as array<struct<start, end, hit>>, end exclusive.

    Lengths of the pieces between matches and of the matches add up to the
    places. pattern must not match the empty string. Null text gives no match.
    """
    text = F.coalesce(text, F.lit(""))
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
    ends = running_sums(F.zip_with(gaps, hits, lambda gap, hit: F.length(gap) + F.length(hit)))
    found = F.zip_with(ends, hits, lambda end, hit: F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit")))
    return F.when(F.size(hits) > 0, found).otherwise(F.array().cast(MATCH))


def span(place: int, kind: str, start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(place).alias("place"), end.alias("end"), F.lit(kind).alias("kind"))


def listed(spans: Column) -> Column:
    """`kind:start:end` of sorted spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digest_columns(spans: Column, base_kinds: Sequence[str]) -> list[Column]:
    """n_<kind> for each base kind, base_sha256 over base spans, spans over all; from a sorted array of spans."""
    base = F.filter(spans, lambda s: s["kind"].isin(*base_kinds))
    return [*(count_of(spans, k).alias(f"n_{k}") for k in base_kinds), F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans")]
