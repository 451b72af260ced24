"""How far two tables are apart."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def signed_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every distinct row of either table with how many more of it the left has; one shuffle, null-safe."""
    cols = left.columns
    both = left.select(*cols, F.lit(1).alias("__d")).unionByName(right.select(*cols, F.lit(-1).alias("__d")))
    return both.groupBy(*cols).agg(F.sum("__d").alias("difference")).filter("difference <> 0")


def table_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: rows to add and remove to turn one multiset into the other."""
    return signed_counts(left, right).agg(F.coalesce(F.sum(F.abs("difference")), F.lit(0)).cast("long").alias("distance"))


def hamming_distance(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: rows to exchange; infinite (null) where sizes differ."""
    d = signed_counts(left, right).agg(F.coalesce(F.sum(F.when(F.col("difference") > 0, F.col("difference"))), F.lit(0)).alias("l"), F.coalesce(F.sum(F.when(F.col("difference") < 0, -F.col("difference"))), F.lit(0)).alias("r"))
    return d.select(F.when(F.col("l") == F.col("r"), F.col("l")).cast("long").alias("distance"))


def group_difference(left: DataFrame, right: DataFrame, groups: Sequence[str], norm: int = 1) -> DataFrame:
    """One row: the groups' differences, summed (norm 1) or as the root of summed squares (norm 2)."""
    per = signed_counts(left, right).groupBy(*groups).agg(F.sum(F.abs("difference")).alias("d"))
    total = F.sum("d") if norm == 1 else F.sqrt(F.sum(F.col("d") * F.col("d")))
    return per.agg(F.coalesce(total.cast("double"), F.lit(0.0)).alias("distance"))


def ids_changed(pairs: dict[str, tuple[DataFrame, DataFrame]], id_column: str) -> DataFrame:
    """One row: ids of which any row differs in any of several tables."""
    ids = [signed_counts(a, b).select(F.col(id_column).alias("id")) for a, b in pairs.values()]
    return reduce(DataFrame.unionByName, ids).distinct().agg(F.count(F.lit(1)).alias("ids"))


def vector_distance(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, norm: int = 1) -> DataFrame:
    """One row: the distance of two columns that keys align; absent values are zero."""
    same = reduce(Column.__and__, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    d = F.abs(F.coalesce(F.col(f"l.{value}"), F.lit(0)) - F.coalesce(F.col(f"r.{value}"), F.lit(0)))
    total = F.sum(d) if norm == 1 else F.sqrt(F.sum(d * d))
    return left.alias("l").join(right.alias("r"), same, "full").agg(F.coalesce(total.cast("double"), F.lit(0.0)).alias("distance"))


def overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that both tables have, each once; none when they are disjoint."""
    return left.intersect(right)
