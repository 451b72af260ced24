"""Quantiles by the exponential mechanism over the gaps between sorted values, as windows.

No task holds a group: equal values merge first, a value's rank is the running
sum of counts, kept inside value ranges whose totals are summed on their own,
and the winning gap is one maximum for each key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import staged
from .noise import uniform
from .prefix import prefix_sums, ranged, same


def gaps(df: DataFrame, column: str, low: float, high: float, keys: DataFrame | None = None) -> DataFrame:
    """Gaps of each key: left, right, rank (values below the right edge), n (all values).

    Edges are low, the distinct clamped values strictly between, and high. A
    key without values has the one gap (low, high) with rank 0, and so has a
    table without values where there are no keys. Equal values merge into a
    table that is written once; all later steps read it, not df.
    """
    on = keys.columns if keys is not None else []
    value = F.col(column).cast("double")
    clean = df.filter(value.isNotNull() & ~F.isnan(value)).select(*on, F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high))).alias("v"))
    counted = staged(clean.groupBy(*on, "v").agg(F.count(F.lit(1)).alias("m")), "counted-values")
    counted = ranged(counted, on, "v")
    spans = counted.groupBy(*on, "span").agg(F.sum("m").alias("held"), F.max("v").alias("top"))
    per_key = Window.partitionBy(*on)
    earlier = per_key.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.select(*on, "span", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"), F.max("top").over(earlier).alias("left_of"), F.sum("held").over(per_key).alias("n"))
    inside = Window.partitionBy(*on, "span").orderBy("v")
    near = counted.withColumn("below", F.coalesce(F.sum("m").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("prior", F.lag("v").over(inside))
    c, s = near.alias("c"), starts.alias("s")
    same = F.col("c.span") == F.col("s.span")
    for k in on:
        same = same & F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}"))
    ranked = c.join(s, same).select(*[F.col(f"c.{k}") for k in on], "v", F.coalesce("prior", "left_of").alias("left"), (F.col("below") + F.col("before")).alias("rank"), "n", "m")
    # a gap ends at every value above low; the last one ends at high
    left = F.greatest(F.coalesce("left", F.lit(float(low))), F.lit(float(low)))
    upto = ranked.filter((F.col("v") > low) & (F.col("v") < high)).select(*on, left.alias("left"), F.col("v").alias("right"), F.col("rank"), "n")
    last = ranked.groupBy(*on).agg(F.max(F.when(F.col("v") < high, F.col("v"))).alias("left"), F.coalesce(F.sum(F.when(F.col("v") < high, F.col("m"))), F.lit(0)).alias("rank"), F.first("n").alias("n"))
    last = last.select(*on, F.coalesce("left", F.lit(float(low))).alias("left"), F.lit(float(high)).alias("right"), "rank", "n")
    out = upto.unionByName(last)
    filled = {"left": float(low), "right": float(high), "rank": 0, "n": 0}
    if not on:
        one = df.sparkSession.range(1).select(F.lit(True).alias("__one"))
        return one.join(out.filter("n IS NOT NULL").withColumn("__one", F.lit(True)), "__one", "left").select(*[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in filled.items()])
    k, o = keys.distinct().alias("k"), out.alias("o")
    same = None
    for name in on:
        one = F.col(f"k.{name}").eqNullSafe(F.col(f"o.{name}"))
        same = one if same is None else same & one
    return k.join(o, same, "left").select(*[F.col(f"k.{name}") for name in on], *[F.coalesce(F.col(f"o.{c}"), F.lit(v)).alias(c) for c, v in filled.items()])


def quantile_gap(df: DataFrame, column: str, quantile: float, low: float, high: float, keys: DataFrame | None = None, epsilon: float = math.inf) -> DataFrame:
    """The winning gap of each key: left, right.

    Score: ln(width) - epsilon |rank - quantile n| / (2 max(quantile, 1 - quantile)) + Gumbel
    noise. With no limit on the budget the gap nearest in rank wins, of equal
    ones that with the larger edges.
    """
    on = keys.columns if keys is not None else []
    found = gaps(df, column, low, high, keys)
    off = F.abs(F.col("rank") - F.lit(quantile) * F.col("n"))
    if math.isinf(epsilon):
        score: Column = F.struct((-off).alias("a"), F.col("left").alias("b"), F.col("right").alias("c"))
    else:
        gumbel = -F.log(-F.log(uniform(F.col("rank"))))
        score = F.log(F.col("right") - F.col("left")) - F.lit(epsilon) * off / (2 * max(quantile, 1 - quantile)) + gumbel
    scored = found.withColumn("score", score)
    return scored.groupBy(*on).agg(F.max_by(F.struct("left", "right"), "score").alias("gap")).select(*on, F.col("gap.left").alias("left"), F.col("gap.right").alias("right"))


def quantile(df: DataFrame, column: str, quantile: float, low: float, high: float, keys: DataFrame | None = None, name: str | None = None, epsilon: float = math.inf) -> DataFrame:
    """A uniform draw from the winning gap; equal bounds give the bound."""
    on = keys.columns if keys is not None else []
    name = name or f"{column}_quantile({quantile})"
    return quantile_gap(df, column, quantile, low, high, keys, epsilon).select(*on, (F.col("left") + uniform(F.col("left")) * (F.col("right") - F.col("left"))).alias(name))


def exact_quantile(df: DataFrame, by: Sequence[str], value: Column, quantile: float, name: str) -> DataFrame:
    """by, name: the exact quantile of a value that isn't null, interpolated between the two ranks next to it.

    Values are counted, ranks are running counts inside value ranges, and of
    each class only the two wanted ranks are looked up: no task holds a class.
    """
    counted = df.select(*by, value.cast("double").alias("v")).filter("v IS NOT NULL").groupBy(*by, "v").agg(F.count(F.lit(1)).alias("m"))
    counted = staged(counted, "counted-values")
    up = prefix_sums(ranged(counted, by, "v"), list(by), "span", ["v"], "m", "up")
    sizes = counted.groupBy(*by).agg(F.sum("m").alias("n"))
    u, s = up.alias("u"), sizes.alias("s")
    at = F.lit(quantile) * (F.col("s.n") - 1)
    held = lambda rank: (rank >= F.col("u.up") - F.col("u.m")) & (rank < F.col("u.up"))
    both = u.join(s, same("u", "s", by)) if by else u.crossJoin(s)
    near = both.filter(held(F.floor(at)) | held(F.ceil(at))).select(*[F.col(f"u.`{c}`").alias(c) for c in by], F.when(held(F.floor(at)), F.col("u.v")).alias("a"), F.when(held(F.ceil(at)), F.col("u.v")).alias("b"), (at - F.floor(at)).alias("part"))
    ends = near.groupBy(*by).agg(F.max("a").alias("a"), F.max("b").alias("b"), F.max("part").alias("part"))
    return ends.select(*by, (F.col("a") * (1 - F.col("part")) + F.col("b") * F.col("part")).alias(name))
