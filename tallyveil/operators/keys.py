"""Group keys that are given, not found: one output row for each key, empty groups included."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def keys_from_values(spark: SparkSession, values: dict[str, Sequence]) -> DataFrame:
    """All combinations of the listed values, each list's repeats counted once."""
    frames = [spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in dict.fromkeys(vs)])).alias(name)) for name, vs in values.items()]
    return reduce(DataFrame.crossJoin, frames)


def keys_from_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(*(columns or df.columns)).distinct()


def keys_product(left: DataFrame, right: DataFrame) -> DataFrame:
    if both := set(left.columns) & set(right.columns):
        raise ValueError(f"both key sets have {sorted(both)}")
    return left.crossJoin(right)


def same_keys(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: equal, and whether the left has all keys of the right; null keys are keys like others."""
    cols = sorted(left.columns)
    if cols != sorted(right.columns):
        raise ValueError("the key sets have different columns")
    sides = left.select(*cols, F.lit(1).alias("l"), F.lit(0).alias("r")).union(right.select(*cols, F.lit(0).alias("l"), F.lit(1).alias("r")))
    per = sides.groupBy(*cols).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return per.agg(F.coalesce(F.min((F.col("l") == F.col("r")).cast("int")), F.lit(1)).cast("boolean").alias("equal"), F.coalesce(F.min((F.col("l") >= F.col("r")).cast("int")), F.lit(1)).cast("boolean").alias("contains"))


def keyed(df: DataFrame, keys: DataFrame | None, fill: dict[str, object], *aggregates: Column) -> DataFrame:
    """Aggregates of df for the given keys: a row for each key, with `fill` where a group has no rows.

    Keys match null-safely; groups that aren't listed are dropped before the
    shuffle's result grows. Without keys, or with keys without columns, all
    rows are one group.
    """
    if keys is None or not keys.columns:
        return df.agg(*aggregates).fillna(fill) if fill else df.agg(*aggregates)
    on = keys.columns
    sums = df.groupBy(*on).agg(*aggregates)
    k, s = keys.distinct().alias("k"), sums.alias("s")
    same = reduce(Column.__and__, [F.col(f"k.{c}").eqNullSafe(F.col(f"s.{c}")) for c in on])
    values = [c for c in sums.columns if c not in on]
    filled = [F.coalesce(F.col(f"s.{c}"), F.lit(fill[c])).alias(c) if c in fill else F.col(f"s.{c}") for c in values]
    return k.join(s, same, "left").select(*[F.col(f"k.{c}") for c in on], *filled)


def to_full_domain(counts: DataFrame, domain: DataFrame, value: str) -> DataFrame:
    """Counts for every row of a domain, zero where there are none."""
    return keyed(counts, domain, {value: 0}, F.sum(value).alias(value))
