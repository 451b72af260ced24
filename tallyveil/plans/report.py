"""Accuracy of released counts against exact ones."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.quantile import exact_quantile


def paired(noisy: DataFrame, exact: DataFrame, keys: Sequence[str], value: str = "count") -> DataFrame:
    """Noisy rows with the exact value beside, zero where there is none."""
    same = reduce(Column.__and__, [F.col(f"n.{k}").eqNullSafe(F.col(f"e.{k}")) for k in keys])
    return noisy.alias("n").join(exact.alias("e"), same, "left").select(*[F.col(f"n.{k}") for k in keys], F.col(f"n.{value}").alias("noisy"), F.coalesce(F.col(f"e.{value}"), F.lit(0)).alias("exact"))


def error_report(pairs: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Per group: cells, size (exact), absolute and squared error."""
    d = F.col("noisy") - F.col("exact")
    return pairs.groupBy(*groups).agg(F.count(F.lit(1)).alias("cells"), F.sum("exact").alias("size"), F.sum(F.abs(d)).alias("absolute_error"), F.sum(d * d).alias("squared_error"))


def size_decade(size: Column) -> Column:
    """0, 1 for 1-9, 2 for 10-99 and so on."""
    return F.when(size <= 0, F.lit(0)).otherwise(F.floor(F.log10(size)).cast("int") + 1)


def margin_of_error(trials: DataFrame, by: Sequence[str], quantile: float = 0.95) -> DataFrame:
    """A quantile of the absolute error, with linear interpolation, for each class of groups."""
    return exact_quantile(trials, by, F.abs(F.col("noisy") - F.col("exact")), quantile, "margin")


def proportions(df: DataFrame, by: Sequence[str], column: str, values: Sequence) -> DataFrame:
    """Shares of listed values in each row's class, as columns p_<value>; absent ones are 0."""
    wide = df.groupBy(*by).pivot(column, list(values)).agg(F.count(F.lit(1))).fillna(0)
    total = reduce(Column.__add__, [F.coalesce(F.col(f"`{v}`"), F.lit(0)) for v in values])
    return wide.select(*by, *[(F.col(f"`{v}`") / total).alias(f"p_{v}") for v in values])


def trials_wide(trials: DataFrame, keys: Sequence[str], trial: str, numbers: Sequence[int], value: str) -> DataFrame:
    """Trials side by side, a column value_<trial> for each."""
    wide = trials.groupBy(*keys).pivot(trial, list(numbers)).agg(F.first(value))
    return wide.select(*keys, *[F.col(f"`{n}`").alias(f"{value}_{n}") for n in numbers])


def error_metric(trials: DataFrame, error: Column, by: Sequence[str], aggregate: Column, where: Column | None = None) -> DataFrame:
    """Any error of rows, any aggregate of `error`, over the rows of all trials that a filter lets through."""
    rows = trials if where is None else trials.filter(where)
    return rows.withColumn("error", error).groupBy(*by).agg(aggregate)
