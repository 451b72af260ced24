"""Joins of private tables: with public tables, with each other under bounded fan-out, and on ids."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .truncate import drop_large_groups, truncate_groups


def join(left: DataFrame, right: DataFrame, on: Sequence[str] | None = None, nulls: bool = True, how: str = "inner") -> DataFrame:
    """Equi-join on all common columns or on those given; other common columns get _left and _right.

    nulls: null keys match each other; else rows with a null key match nothing.
    """
    on = list(on or [c for c in left.columns if c in right.columns])
    if not on:
        raise ValueError("the tables have no column in common")
    both = (set(left.columns) & set(right.columns)) - set(on)
    l, r = left.alias("l"), right.alias("r")  # noqa: E741
    same = [F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) if nulls else F.col(f"l.`{c}`") == F.col(f"r.`{c}`") for c in on]
    mine = [F.col(f"l.`{c}`").alias(f"{c}_left" if c in both else c) for c in left.columns if c not in on]
    theirs = [F.col(f"r.`{c}`").alias(f"{c}_right" if c in both else c) for c in right.columns if c not in on]
    return l.join(r, reduce(Column.__and__, same), how).select(*[F.col(f"l.`{c}`") for c in on], *mine, *theirs)


def fanout(public: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row: the most rows that share a key."""
    return public.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"))


def bounded(df: DataFrame, on: Sequence[str], most: int, drop: bool) -> DataFrame:
    return drop_large_groups(df, on, most) if drop else truncate_groups(df, on, most)


def join_private(left: DataFrame, right: DataFrame, on: Sequence[str], most_left: int, most_right: int, *, drop: bool = False, nulls: bool = True) -> DataFrame:
    """Both sides keep at most so many rows of a key (or drop larger keys), then join."""
    return join(bounded(left, on, most_left, drop), bounded(right, on, most_right, drop), on, nulls)


def join_private_sensitivity(left: float, right: float, most_left: int, most_right: int, drop: bool = False) -> float:
    """Rows of the result that a change of so many rows on either side reaches."""
    s_left, s_right = (most_left, most_right) if drop else (2, 2)
    return most_left * s_right * right + most_right * s_left * left


def supersede(totals: DataFrame, detailed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of totals whose keys have no detailed rows."""
    keys = detailed.select(*[F.col(c).alias(f"__{c}") for c in on]).distinct()
    return totals.join(keys, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on], "left_anti")


def lookup(df: DataFrame, dimension: DataFrame, value: str, names: Sequence[str], result: str) -> DataFrame:
    """The dimension's `result` for a value that equals any of its names, in any case."""
    each = dimension.select(F.explode(F.array(*[F.lower(F.col(n)) for n in names])).alias("__name"), F.col(result)).distinct()
    return df.join(each, F.lower(F.col(value)) == F.col("__name"), "left").drop("__name")
