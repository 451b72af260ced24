"""Bounds on group sizes, chosen by row content only, never by row position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def content_order(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """A fixed, seemingly random order: the digest of the values as text, then the values."""
    columns = columns or df.columns
    return [F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns])), *[F.col(c) for c in columns]]


def truncate_groups(df: DataFrame, keys: Sequence[str], most: int, order: Sequence[str] | None = None) -> DataFrame:
    """At most `most` rows of each key."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*content_order(df, order)))
    return df.withColumn("__at", at).filter(F.col("__at") <= most).drop("__at")


def drop_large_groups(df: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """Without the rows of keys that have more than `most`.

    Sizes are counted with partial aggregation and joined back, so a hot key
    costs one row in the shuffle, and its rows may be split.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > most).select(*[F.col(k).alias(f"__{k}") for k in keys])
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return df.join(sizes, on, "left_anti")


def limit_keys(df: DataFrame, groups: Sequence[str], keys: Sequence[str], most: int) -> DataFrame:
    """At most `most` different keys in each group; ties of the digest go by key.

    Ranks distinct (group, key) pairs, not rows.
    """
    pairs = df.select(*groups, *keys).distinct()
    at = F.row_number().over(Window.partitionBy(*groups).orderBy(*content_order(pairs, [*groups, *keys])))
    kept = pairs.withColumn("__at", at).filter(F.col("__at") <= most).select(*[F.col(c).alias(f"__{c}") for c in [*groups, *keys]])
    return df.join(kept, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in [*groups, *keys]], "left_semi")
