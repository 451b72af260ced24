"""Keyed aggregates with bounded contributions; exact as they stand, noisy through `noise.add_noise`.

All take explicit keys (see `keys.keyed`). Numeric ones drop null and NaN and
clamp to [low, high], infinities included. The parts that need noise are plain
columns of one aggregation, so one shuffle serves all of them.
"""

from __future__ import annotations

import math
from decimal import Decimal
from fractions import Fraction
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bins import Bins
from .keys import keyed, keys_from_values
from .special import drop_null_and_nan

#: Keys up to which they are broadcast to find their groups' rows.
MOST_BROADCAST = 100_000
#: How far apart bounds of whole numbers are when squares of deviations may pass 64 bits in a sum, and from where even decimals of 38 digits may.
WIDE, WIDEST = 2**20, 2 * 10**13
#: (value, reach of one row, INTEGER or DECIMAL, parts that share the budget) -> value with noise
Noise = Callable[..., Column]


def _exact(value: Column, reach: float, kind: str, parts: int = 1) -> Column:
    return value


def count(df: DataFrame, keys: DataFrame | None = None, name: str = "count", noise: Noise = _exact) -> DataFrame:
    out = keyed(df, keys, {name: 0}, F.count(F.lit(1)).alias(name))
    return out.withColumn(name, noise(F.col(name), 1, "INTEGER"))


def count_distinct(df: DataFrame, columns: Sequence[str] | None = None, keys: DataFrame | None = None, name: str | None = None, noise: Noise = _exact) -> DataFrame:
    """Distinct rows, or distinct values of columns, in each group: a distinct and a count, so no task holds a group's set."""
    name = name or f"count_distinct({', '.join(columns or [])})"
    on = keys.columns if keys is not None else []
    out = keyed(df.select(*dict.fromkeys([*on, *(columns or df.columns)])).distinct(), keys, {name: 0}, F.count(F.lit(1)).alias(name))
    return out.withColumn(name, noise(F.col(f"`{name}`"), 1, "INTEGER"))


def _clamped(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    if low > high:
        raise ValueError("low must not be above high")
    return drop_null_and_nan(df, [column]).withColumn(column, F.least(F.greatest(F.col(column), F.lit(low)), F.lit(high)).cast(dict(df.dtypes)[column]))


def _kind(df: DataFrame, column: str) -> str:
    return "DECIMAL" if dict(df.dtypes)[column] in ("double", "float") else "INTEGER"


def bounded_sum(df: DataFrame, column: str, low: float, high: float, keys: DataFrame | None = None, name: str | None = None, noise: Noise = _exact, scale_digits: int | None = None) -> DataFrame:
    """Sum of clamped values; scale_digits sums whole numbers of that many decimal digits, free of rounding by order.

    Such steps stay inside the bounds: a value that rounds past one counts as the last step before it.
    """
    name, kind = name or f"{column}_sum", _kind(df, column)
    value = F.col(column) if scale_digits is None else F.least(F.greatest(F.round(F.col(column) * 10**scale_digits), F.lit(_step(low, scale_digits, math.ceil))), F.lit(_step(high, scale_digits, math.floor))).cast("long")
    if scale_digits is not None and _step(low, scale_digits, math.ceil) > _step(high, scale_digits, math.floor):
        raise ValueError(f"no number of {scale_digits} digits lies between the bounds")
    out = keyed(_clamped(df, column, low, high), keys, {name: 0}, F.sum(value).alias(name))
    total = F.coalesce(F.col(name), F.lit(0)) if scale_digits is None else F.coalesce(F.col(name), F.lit(0)) / F.lit(float(10**scale_digits))
    reach = max(abs(low), abs(high))
    return out.withColumn(name, noise(total, reach, kind) if reach else total)


def _step(bound: float, digits: int, rounding: Callable) -> int:
    """A bound in whole steps, from its decimal digits."""
    return rounding(Fraction(str(bound)) * 10**digits)


def _midpoint(low: float, high: float, whole: bool) -> float:
    if whole:
        return round(Fraction(int(low) + int(high), 2))
    return low * 0.5 + high * 0.5


def moments(df: DataFrame, column: str, low: float, high: float, keys: DataFrame | None, noise: Noise, parts: int) -> tuple[DataFrame, float, float]:
    """n, dev (sum of deviations from the middle) and sqdev (of their squares from the squares' middle), and both middles.

    Each of the `parts` parts in use gets an equal share of the budget. A whole
    middle may lie off the true one, so the reach of a row is the longer way
    to a bound. With equal bounds deviations are zero for all rows and need no
    noise. Whole numbers between bounds WIDE or more apart are summed as
    decimals, and take noise as floating-point numbers; bounds WIDEST apart are refused.
    """
    whole = _kind(df, column) == "INTEGER"
    mid = _midpoint(low, high, whole)
    top = max(high - mid, mid - low) ** 2
    mid2 = _midpoint(0, top, whole)
    wide = whole and high - low >= WIDE
    if whole and high - low >= WIDEST:
        raise ValueError(f"bounds of whole numbers must be less than {WIDEST} apart")
    d = (F.col(column).cast("decimal(20,0)") - F.lit(Decimal(mid))).cast("decimal(19,0)") if wide else F.col(column) - F.lit(mid)
    squares = (d * d).cast("decimal(38,0)") - F.lit(Decimal(mid2)) if wide else d * d - F.lit(mid2)
    out = keyed(_clamped(df, column, low, high), keys, {} if wide else {"n": 0, "dev": 0, "sqdev": 0}, F.count(F.lit(1)).alias("n"), F.sum(d).alias("dev"), F.sum(squares).alias("sqdev"))
    if wide:
        out = out.withColumns({"n": F.coalesce("n", F.lit(0)), "dev": F.col("dev").cast("double"), "sqdev": F.col("sqdev").cast("double")})
    kind = "INTEGER" if whole and not wide else "DECIMAL"

    def share(name: str, reach: float, of: str) -> Column:
        value = F.coalesce(name, F.lit(0))
        return noise(value, reach, of, parts) if reach else value

    noisy = {"n": share("n", 1, "INTEGER"), "dev": share("dev", max(high - mid, mid - low), kind)}
    if parts > 2:
        noisy["sqdev"] = share("sqdev", max(top - mid2, mid2), kind)
    return out.withColumns(noisy), mid, mid2


def average(df: DataFrame, column: str, low: float, high: float, keys: DataFrame | None = None, name: str | None = None, noise: Noise = _exact) -> DataFrame:
    """Sum of deviations from the middle over at least one row, plus the middle; an empty group gives the middle."""
    out, mid, _ = moments(df, column, low, high, keys, noise, 2)
    return out.withColumn(name or f"{column}_average", F.col("dev") / F.greatest(F.col("n"), F.lit(1)) + F.lit(mid)).drop("n", "dev", "sqdev")


def variance(df: DataFrame, column: str, low: float, high: float, keys: DataFrame | None = None, name: str | None = None, noise: Noise = _exact, root: bool = False) -> DataFrame:
    """Population variance, from 0 to a quarter of the squared range; with at most one row the middles' own."""
    out, mid, mid2 = moments(df, column, low, high, keys, noise, 3)
    off, squares = F.col("dev") / F.col("n"), F.col("sqdev") / F.col("n") + F.lit(float(mid2))
    of_squares = _midpoint(0 if low <= 0 <= high else min(low**2, high**2), max(low**2, high**2), _kind(df, column) == "INTEGER")
    value = F.when(F.col("n") <= 1, F.lit(float(of_squares - mid**2))).otherwise(squares - off * off)
    value = F.greatest(F.lit(0.0), F.least(value, F.lit((high - low) ** 2 / 4)))
    name = name or f"{column}_{'stdev' if root else 'variance'}"
    return out.withColumn(name, F.sqrt(value) if root else value).drop("n", "dev", "sqdev")


def stdev(df: DataFrame, column: str, low: float, high: float, keys: DataFrame | None = None, name: str | None = None, noise: Noise = _exact) -> DataFrame:
    return variance(df, column, low, high, keys, name or f"{column}_stdev", noise, root=True)


def histogram(df: DataFrame, column: str, bins: Bins, name: str | None = None, noise: Noise = _exact) -> DataFrame:
    """Count of every bin, empty ones included."""
    name = name or f"{column}_bin"
    binned = df.select(bins.column(F.col(column), _kind(df, column) == "DECIMAL").alias(name))
    return count(binned, keys_from_values(df.sparkSession, {name: bins.all_bins()}), "count", noise)


def selection_threshold(epsilon: float, delta: float) -> int:
    """The count from which a row may be published: one that a single unit holds reaches it with probability delta at most."""
    q = math.exp(-epsilon)
    return 1 + max(1, math.ceil(math.log(delta * (1 + q)) / math.log(q)))


def common_rows(df: DataFrame, threshold: int, name: str = "count", noise: Noise = _exact) -> DataFrame:
    """Distinct rows whose (noisy) count reaches a threshold, as `selection_threshold` gives it."""
    out = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(name))
    return out.withColumn(name, noise(F.col(name), 1, "INTEGER")).filter(F.col(name) >= threshold)


#: Parts in which a group's partial rows are combined before they meet.
PARTS = 64


def apply_to_groups(df: DataFrame, keys: DataFrame, function: Callable, schema: str, fill: dict[str, object], combine: Callable | None = None) -> DataFrame:
    """A pandas function of each listed group that gives one row (with its key); absent groups get `fill`.

    With combine, function sees slices of a group, whatever a task reads at a
    time, and combine makes one row of several such rows, in any order and
    grouping: first in PARTS parts of a group, then of their rows. No task then
    holds a group, and rows aren't shuffled. Without it a whole group is one
    task's memory: for functions whose results don't combine.
    """
    on = keys.columns
    listed = df.join(F.broadcast(keys) if keys.count() <= MOST_BROADCAST else keys, on, "left_semi")
    if combine is None:
        values = listed.groupBy(*on).applyInPandas(function, schema)
    else:

        def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for _, own in batch.groupby(list(on), dropna=False, sort=False):
                    yield function(own)

        part = F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)).cast("int")
        sliced = listed.mapInPandas(slices, schema).withColumn("__part", part)
        some = sliced.groupBy(*on, "__part").applyInPandas(lambda rows: combine(rows.drop(columns="__part")), schema)
        values = some.groupBy(*on).applyInPandas(combine, schema)
    firsts = [F.first(c).alias(c) for c in values.columns if c not in on]
    return keyed(values, keys, fill, *firsts)
