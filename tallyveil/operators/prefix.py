"""Running sums and numbers of rows without a task that holds a key's rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import staged

#: Ways into which equal rows are dealt.
SALTS = 64
#: Ranges of a key's values.
RANGES = 64
#: Keys up to which their cuts are broadcast (about half a kilobyte each).
MOST_CUTS = 50_000


def same(left: str, right: str, columns: Sequence[str]) -> Column:
    """Null-safe equality of columns of two aliases."""
    return reduce(Column.__and__, [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in columns])


def ranged(df: DataFrame, keys: Sequence[str], value: str, *, parts: int = RANGES) -> DataFrame:
    """df with span: in which of `parts` ranges of its key's values a row lies, cut so that each holds about as many rows.

    A key's own values cut its ranges, so values that cluster spread over ranges too.
    """
    steps = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    cuts = df.groupBy(*keys).agg(F.percentile_approx(value, steps, F.lit(10_000)).alias("__cuts"))
    if not keys:
        both = df.crossJoin(F.broadcast(cuts))  # one row
    else:
        side = F.broadcast(cuts) if cuts.count() <= MOST_CUTS else cuts
        both = df.alias("c").join(side.alias("k"), same("c", "k", keys)).select(*[F.col(f"c.`{n}`") for n in df.columns], "__cuts")
    return both.withColumn("span", F.size(F.filter("__cuts", lambda x: x < F.col(value)))).drop("__cuts")


def prefix_sums(df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], value: str, name: str) -> DataFrame:
    """df with name: the sum of value over a key's rows up to each one, in the order of (block, order).

    A block is a range of the order. Sums run inside blocks, and a window over
    a key sees one row for each of its blocks.
    """
    inside = Window.partitionBy(*keys, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = df.withColumn(name, F.sum(value).over(inside))
    totals = df.groupBy(*keys, block).agg(F.sum(value).alias("__held"))
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("__start", F.coalesce(F.sum("__held").over(before), F.lit(0))).drop("__held")
    both = own.alias("o").join(starts.alias("s"), same("o", "s", [*keys, block]))
    return both.select(*[F.col(f"o.`{c}`") for c in df.columns], (F.col(f"o.`{name}`") + F.col("s.__start")).alias(name))


def copy_numbers(df: DataFrame, columns: Sequence[str], name: str, *, salts: int = SALTS) -> DataFrame:
    """df with name: 1, 2, 3 ... for the rows that are equal in the columns, in any order.

    Equal rows are dealt into `salts` parts, numbered there, and each part
    starts where those before it end. The dealt rows are written once, so that
    parts and their starts come from the same dealing.
    """
    dealt = df.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    digest = F.xxhash64(*[F.col(f"`{c}`") for c in columns]) if columns else F.lit(0).cast("long")
    part = Window.partitionBy("__digest", *[F.col(f"`{c}`") for c in columns], "__salt").orderBy(F.lit(1))
    dealt = staged(dealt.withColumn("__digest", digest).withColumn("__own", F.row_number().over(part)), "numbered-rows")
    held = dealt.groupBy("__digest", *[F.col(f"`{c}`") for c in columns], "__salt").agg(F.max("__own").alias("__held"))
    key = Window.partitionBy("__digest", *[F.col(f"`{c}`") for c in columns])
    earlier = key.orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.withColumn("__start", F.sum("__held").over(earlier)).filter("__start IS NOT NULL").drop("__held")  # the first part of a key starts at 0
    both = dealt.alias("d").join(starts.alias("s"), same("d", "s", ["__digest", *columns, "__salt"]), "left")
    return both.select(*[F.col(f"d.`{c}`") for c in df.columns], (F.col("d.__own") + F.coalesce("s.__start", F.lit(0))).cast("long").alias(name))
