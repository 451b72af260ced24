"""Bounds on what one id contributes to several tables together, or to the parts of a split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import staged
from .prefix import copy_numbers, same

#: Contributions up to which a table of them is broadcast.
MOST_BROADCAST = 500_000
NULL = "\\0"


def content(columns: Sequence[str]) -> Column:
    """A digest of columns as text; bars and backslashes in values are escaped, so different rows have different texts."""
    escaped = lambda c: F.regexp_replace(F.col(f"`{c}`").cast("string"), r"([|\\])", r"\\$1")
    return F.sha2(F.concat_ws("|", *[F.coalesce(escaped(c), F.lit(NULL)) for c in columns]), 256)


def limit_across(tables: dict[str, DataFrame], ids: dict[str, str], most: int, groups: dict[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """Tables in which every id has at most `most` contributions, all tables taken together.

    ids: the id column of each table. A contribution is a row, repeated rows
    counting each; where groups names columns of a table, it is all rows of an
    id that agree in them, for instance in one part of a split. One ranking
    over all tables, by a digest of content, chooses what stays: at most `most`
    rows of an id leave a task for it, so an id with a third of all rows is no
    task's load. A null id is an id like others.
    """
    if most < 1:
        raise ValueError("an id needs at least one contribution")
    keyed, shapes = {}, []
    for name in sorted(tables):
        df, by = tables[name], (groups or {}).get(name)
        if by is None:
            df, by = copy_numbers(df, df.columns, "__copy"), [*df.columns, "__copy"]
        keyed[name] = df.withColumns({"__id": F.coalesce(F.col(f"`{ids[name]}`").cast("string"), F.lit(NULL)), "__place": content(by)})
        shapes.append(keyed[name].select("__id", F.lit(name).alias("__table"), "__place").distinct())
    rank = F.row_number().over(Window.partitionBy("__id").orderBy(content(["__id", "__table", "__place"])))
    ranked = reduce(DataFrame.unionByName, shapes).withColumn("__at", rank).filter(F.col("__at") <= most)
    kept = staged(ranked.drop("__at"), "contributions")
    out = {}
    for name, df in keyed.items():
        mine = kept.filter(F.col("__table") == name)
        side = F.broadcast(mine) if mine.count() <= MOST_BROADCAST else mine
        out[name] = df.alias("d").join(side.alias("k"), same("d", "k", ["__id", "__place"]), "left_semi").select(*[F.col(f"d.`{c}`") for c in tables[name].columns])
    return out


def parts_reached(df: DataFrame, ids: Sequence[str], column: str) -> DataFrame:
    """One row: in how many values of a column an id is at most."""
    pairs = df.select(*ids, column).distinct().groupBy(*ids).agg(F.count(F.lit(1)).alias("n"))
    return pairs.agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"))
