"""Noise as a column: exact integer samplers on the operating system's randomness, drawn once and released.

The samplers follow Canonne, Kamath and Steinke, "The Discrete Gaussian for
Differential Privacy" (2020), over whole batches at once.
"""

from __future__ import annotations

import math
import secrets
from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import new_folder, staged
from .prefix import prefix_sums

#: Float values are moved to multiples of this before noise, so that the noise can be whole multiples too.
GRID = Fraction(1, 2**20)


#: Decimal digits that scales keep; they are rounded up.
SCALE_STEPS = 10**6
#: Beyond it products of bounds no longer fit 64 bits, and rows are drawn one by one.
LARGE = 2**40


def _rounded_up(x: float, steps: int = SCALE_STEPS) -> Fraction:
    if x <= 0:
        raise ValueError("noise needs a scale above zero")
    return Fraction(math.ceil(Fraction(x) * steps), steps)


def below(n: np.ndarray) -> np.ndarray:
    """A whole number from 0 to n - 1 for each n, all equally likely: 64 random bits, drawn again beyond the last whole multiple of n."""
    n = n.astype(np.uint64)
    out, todo = np.empty(len(n), np.uint64), np.arange(len(n))
    last = np.uint64(2**64 - 1) - np.uint64(2**64 - 1) % n  # a multiple of n
    while len(todo):
        bits = np.frombuffer(secrets.token_bytes(8 * len(todo)), np.uint64)
        out[todo] = bits % n[todo]
        todo = todo[bits >= last[todo]]
    return out.astype(np.int64)


def coins(top: np.ndarray, bottom: int | np.ndarray) -> np.ndarray:
    """True with probability exp(-top / bottom) each, for top from 0 to bottom: whether the first failure of draws with chances x, x / 2, x / 3 ... has an odd number."""
    bottom = np.broadcast_to(np.asarray(bottom, np.int64), len(top))
    k, todo = np.ones(len(top), np.int64), np.arange(len(top))
    while len(todo):
        todo = todo[below(bottom[todo] * k[todo]) < top[todo]]
        k[todo] += 1
    return k % 2 == 1


def two_sided_geometric(scale: Fraction, size: int) -> np.ndarray:
    """size draws of k with probability proportional to exp(-|k| / scale)."""
    s, t = scale.denominator, scale.numerator
    if t >= LARGE:  # a scale that large may be whole
        s, t = 1, math.ceil(scale)
        if t >= LARGE:
            raise ValueError("the scale is too large")
    return geometric_each(np.full(size, t, np.int64), np.full(size, s, np.int64))


def geometric_each(t: np.ndarray, s: np.ndarray) -> np.ndarray:
    """A draw of k with probability proportional to exp(-|k| s / t) for each of t and s."""
    out, todo = np.zeros(len(t), np.int64), np.arange(len(t))
    while len(todo):
        u = below(t[todo])
        good = coins(u, t[todo])
        todo, u, rest = todo[good], u[good], todo[~good]
        v, on = np.zeros(len(todo), np.int64), np.arange(len(todo))
        while len(on):
            on = on[coins(np.ones(len(on), np.int64), 1)]
            v[on] += 1
        k, negative = (u + t[todo] * v) // s[todo], below(np.full(len(todo), 2)) == 1
        again = negative & (k == 0)
        out[todo] = np.where(negative, -k, k)
        todo = np.concatenate([rest, todo[again]])
    return out


def rare_coins(top: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    """True with probability exp(-top / bottom) each, for any top: one coin for each whole unit, and one for the rest."""
    whole, out = top // bottom, np.ones(len(top), bool)
    todo = np.flatnonzero(whole > 0)
    while len(todo):  # a unit fails with a chance of 63 %, so few are looked at twice
        good = coins(np.ones(len(todo), np.int64), 1)
        out[todo[~good]] = False
        todo = todo[good]
        whole[todo] -= 1
        todo = todo[whole[todo] > 0]
    left = np.flatnonzero(out)
    out[left] = coins(top[left] % bottom[left], bottom[left])
    return out


def as_ratio(variance: float | Fraction) -> tuple[int, int] | None:
    """The variance as n / d with n of 16 bits, or d = 1, rounded up by less than one part in 32,768; None where products of these pass 64 bits."""
    variance = Fraction(variance)
    if variance <= 0:
        raise ValueError("noise needs a variance above zero")
    d = 1
    while variance * d < 2**15:
        d *= 2
    return (math.ceil(variance * d), d) if 2**-5 <= variance <= 2**26 else None


def gaussian_each(n: np.ndarray, d: np.ndarray) -> np.ndarray:
    """A draw of k with probability proportional to exp(-k k d / (2 n)) for each variance n / d, as `as_ratio` gives them.

    Geometric draws of scale t, the whole number above the deviation, stay with
    probability exp(-(|k| - n / (d t))^2 d / (2 n)), in whole numbers; draws
    beyond 20 t stay with one below exp(-180), which counts as zero.
    """
    t = np.floor(np.sqrt(n // d)).astype(np.int64) + 1
    out, todo = np.zeros(len(n), np.int64), np.arange(len(n))
    while len(todo):
        m, e, s = n[todo], d[todo], t[todo]
        k = geometric_each(s, np.ones(len(todo), np.int64))
        size = np.abs(k)
        near = size <= 20 * s
        good = near & rare_coins((np.where(near, size, 0) * e * s - m) ** 2, 2 * m * e * s**2)
        out[todo] = k
        todo = todo[~good]
    return out


def _coin(p: Fraction) -> bool:
    """True with probability exp(-p)."""
    while p > 1:
        if not coins(np.ones(1, np.int64), 1)[0]:
            return False
        p -= 1
    k = 1
    while secrets.randbelow(p.denominator * k) < p.numerator:
        k += 1
    return k % 2 == 1


def discrete_gaussian(variance: float | Fraction, size: int) -> np.ndarray:
    """size draws of k with probability proportional to exp(-k k / (2 variance)); very small and very large variances row by row."""
    if ratio := as_ratio(variance):
        return gaussian_each(*(np.full(size, x, np.int64) for x in ratio))
    variance = _rounded_up(variance, 10**12)
    t = math.isqrt(math.floor(variance)) + 1
    out, todo = np.zeros(size, np.int64), np.arange(size)
    while len(todo):
        out[todo] = two_sided_geometric(Fraction(t), len(todo))
        todo = todo[[not _coin((abs(int(k)) - variance / t) ** 2 / (2 * variance)) for k in out[todo]]]
    return out


def gaussians(variances: np.ndarray) -> np.ndarray:
    """A draw for each variance, all together where their ratios fit."""
    kinds, place = np.unique(variances, return_inverse=True)
    ratios = [as_ratio(v) for v in kinds]
    n, d = (np.array([r[i] if r else 0 for r in ratios], np.int64)[place] for i in (0, 1))
    out, fit = np.zeros(len(variances), np.int64), d > 0
    out[fit] = gaussian_each(n[fit], d[fit])
    for i in [i for i, r in enumerate(ratios) if not r]:
        out[place == i] = discrete_gaussian(float(kinds[i]), int((place == i).sum()))
    return out


def _drawn(value: Column, draw: Callable[[int], np.ndarray], grid: Fraction | None) -> Column:
    """value plus a draw for every row; doubles in steps of grid. Null values get none."""

    if grid is None:

        @F.pandas_udf("long")
        def add(values: pd.Series) -> pd.Series:
            return values + draw(len(values))
    else:
        step = float(grid)

        @F.pandas_udf("double")
        def add(values: pd.Series) -> pd.Series:
            return (values / step).round() * step + draw(len(values)) * step

    return add.asNondeterministic()(value)


def uniform(row: Column) -> Column:
    """A number from 0 to 1, both left out, from the operating system's randomness; row: any column, for the number of rows."""

    @F.pandas_udf("double")
    def draw(rows: pd.Series) -> pd.Series:
        return pd.Series((below(np.full(len(rows), 2**53 - 1)) + 1) / 2**53, index=rows.index)

    return draw.asNondeterministic()(row)


def geometric_noise(value: Column, scale: float) -> Column:
    exact = _rounded_up(scale)
    return _drawn(value.cast("long"), lambda n: two_sided_geometric(exact, n), None)


def geometric_noise_by(value: Column, scale: Column) -> Column:
    """Geometric noise of each row's own scale, which must be above zero."""

    @F.pandas_udf("long")
    def add(values: pd.Series, scales: pd.Series) -> pd.Series:
        out = values.astype("int64").copy()
        for s in scales.unique():
            own = scales == s
            out[own] += two_sided_geometric(_rounded_up(s), int(own.sum()))
        return out

    return add.asNondeterministic()(value.cast("long"), scale.cast("double"))


def gaussian_noise_by(value: Column, variance: Column) -> Column:
    """Discrete Gaussian noise of each row's own variance, drawn for a whole batch at once."""

    @F.pandas_udf("long")
    def add(values: pd.Series, variances: pd.Series) -> pd.Series:
        return values.astype("int64") + gaussians(variances.to_numpy())

    return add.asNondeterministic()(value.cast("long"), variance.cast("double"))


def laplace_noise(value: Column, scale: float) -> Column:
    """Laplace noise on a grid: the scale is widened by a grid step for the rounding."""
    steps = (_rounded_up(scale, 10**9) + GRID) / GRID
    steps = Fraction(math.ceil(steps * 1000), 1000)
    return _drawn(value.cast("double"), lambda n: two_sided_geometric(steps, n), GRID)


def gaussian_noise(value: Column, variance: float) -> Column:
    exact = _rounded_up(variance)
    return _drawn(value.cast("long"), lambda n: discrete_gaussian(exact, n), None)


def noise_scale(budget: float, sensitivity: float, mechanism: str = "pure") -> float:
    """Laplace scale for epsilon, or the Gaussian's standard deviation for rho; no budget limit gives 0."""
    if budget <= 0:
        raise ValueError("a budget must be above zero")
    if math.isinf(budget):
        return 0.0
    return sensitivity / budget if mechanism == "pure" else sensitivity / math.sqrt(2 * budget)


def mechanism(budget: float, unit: float = 1, kind: str = "pure", prefer: str = "default") -> Callable[[Column, float, str], Column]:
    """The noise of an aggregate: function of (column, reach of one row, INTEGER or DECIMAL, parts that share the budget).

    unit: rows that one unit of change reaches. Laplace noise is geometric on
    integers; under rho budgets (kind "zcdp") the default is Gaussian, which
    exists for integers only.
    """
    prefer = ("laplace" if kind == "pure" else "gaussian") if prefer == "default" else prefer
    if prefer == "gaussian" and kind == "pure":
        raise ValueError("Gaussian noise needs a rho budget")

    def add(value: Column, reach: float, column_kind: str, parts: int = 1) -> Column:
        if reach <= 0 or unit <= 0:
            raise ValueError("noise needs a reach above zero")
        scale = noise_scale(budget / parts, reach * unit, kind)
        if scale == 0:
            return value
        if prefer == "gaussian":
            if column_kind != "INTEGER":
                raise NotImplementedError("Gaussian noise on floating-point numbers; ask for laplace")
            return gaussian_noise(value, scale**2)
        return geometric_noise(value, scale) if column_kind == "INTEGER" else laplace_noise(value, scale)

    return add


def once(noise: Callable) -> Callable:
    """noise that may be used for one aggregate: its parts together take one budget, more are refused."""
    used = []

    def add(value: Column, reach: float, column_kind: str, parts: int = 1) -> Column:
        used.append(Fraction(1, parts))
        if sum(used) > 1:
            raise ValueError("one charge pays for one aggregate")
        return noise(value, reach, column_kind, parts)

    return add


def inverse_cdf(kind: str, scale: Column | float, p: Column | float) -> Column:
    """The value up to which a mechanism's noise falls with probability p: geometric or laplace."""
    scale = F.lit(scale) if not isinstance(scale, Column) else scale
    p = F.lit(float(p)) if not isinstance(p, Column) else p
    if kind == "laplace":
        return -scale * F.signum(p - 0.5) * F.log(1 - 2 * F.abs(p - 0.5))
    q = F.exp(-1 / scale)
    low = F.ceil(scale * F.log(p * (1 + q)))
    high = F.ceil(-scale * F.log((1 - p) * (1 + q)) - 1)
    return F.when(scale == 0, F.lit(0)).otherwise(F.when(p < 1 / (1 + q), low).otherwise(F.greatest(high, F.lit(0)))).cast("long")


#: Deviations beyond which a Gaussian has less mass than floats tell from none, and the values whose sums run together.
TAIL = 9
RUN = 4096
#: Values of all mass tables together up to which they are broadcast.
MOST_MASSES = 2_000_000
#: Ways into which rows of one variance are dealt beyond that.
LANES = 64


def masses(variances: DataFrame) -> DataFrame:
    """variance, value, mass, below: the discrete Gaussian's mass on each value and on all up to it, for each different variance above zero.

    Sums run inside spans of RUN values, whose totals are summed on their own.
    """
    v = F.col("variance")
    tail = (F.ceil(TAIL * F.sqrt(v)) + 1).cast("long")
    spans = variances.filter("variance > 0").select("variance").distinct().select("variance", tail.alias("tail"), F.explode(F.sequence(F.floor(-tail / RUN), F.floor(tail / RUN))).alias("span"))
    each = spans.select("variance", "tail", "span", F.explode(F.sequence(F.col("span") * RUN, F.col("span") * RUN + (RUN - 1))).alias("value")).filter(F.abs("value") <= F.col("tail"))
    weighed = each.select("variance", "span", "value", F.exp(-F.col("value") * F.col("value") / (2 * v)).alias("weight"))
    sums = prefix_sums(weighed, ["variance"], "span", ["value"], "weight", "up")
    total = weighed.groupBy("variance").agg(F.sum("weight").alias("total"))
    return sums.join(total, "variance").select("variance", "value", (F.col("weight") / F.col("total")).alias("mass"), (F.col("up") / F.col("total")).alias("below"))


def gaussian_bounds(df: DataFrame, variance: str, chance: str, name: str) -> DataFrame:
    """df with name: the value up to which discrete Gaussian noise of a row's variance falls with a row's chance (from 0 to 1).

    Chances are looked up by halving in the mass table of the variance, which
    is broadcast while its values are few, and joined by dealt-out rows beyond.
    No variance (0 or null) means no noise, and the bound is 0; a null chance gives null.
    """
    wanted = df.select(F.col(variance).cast("double").alias("variance")).distinct()
    found = masses(wanted).groupBy("variance").agg(F.array_sort(F.collect_list(F.struct("value", "below"))).alias("t"))
    tables = staged(found.select(F.col("variance").alias("__v"), F.get("t", F.lit(0))["value"].alias("__low"), F.transform("t", lambda x: x["below"]).alias("__below")), "gaussian-masses")
    size = tables.agg(F.sum(F.size("__below"))).first()[0] or 0
    rows = df.withColumn("__lane", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(LANES)))
    same = F.col(variance).cast("double") == F.col("__v")
    if size <= MOST_MASSES:
        both = rows.join(F.broadcast(tables), same, "left")
    else:
        dealt = tables.withColumn("__to", F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))))
        both = rows.join(dealt, same & (F.col("__lane") == F.col("__to")), "left")
    high = F.size("__below")
    steps = F.sequence(F.lit(1), F.greatest(F.ceil(F.log2(high.cast("double"))), F.lit(0)).cast("int") + 1)

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        enough = F.get("__below", middle) >= F.col(chance)
        return F.when(s["lo"] >= s["hi"], s).otherwise(F.struct(F.when(enough, s["lo"]).otherwise(middle + 1).alias("lo"), F.when(enough, middle).otherwise(s["hi"]).alias("hi")))

    at = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), (high - 1).alias("hi")), halve)["lo"]
    bound = F.when(F.col(chance).isNotNull(), F.when(F.col("__v").isNull(), F.lit(0)).otherwise(F.col("__low") + at)).cast("long")
    return both.withColumn(name, bound).drop("__v", "__low", "__below", "__lane", "__to")


def suppressed(df: DataFrame, column: str, threshold: Column | float) -> DataFrame:
    return df.filter(F.col(column) > threshold)


def suppression_threshold(scale: float, chance: float, kind: str = "geometric") -> Column:
    """Counts of zero stay at or below it with the given chance; no noise gives 0."""
    return F.lit(0) if scale == 0 else inverse_cdf(kind, scale, chance)


def not_negative(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.greatest(F.col(column), F.lit(0).cast(dict(df.dtypes)[column])))


def released(df: DataFrame, folder: str | None = None) -> DataFrame:
    """df, written once in random placement, and read back: its noise is never drawn again."""
    folder = folder or new_folder(df.sparkSession, "released")
    out = df.repartition(F.rand()).sortWithinPartitions(*df.columns)
    out.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _cell_masses(spark: SparkSession, kind: str, scale: float, tail: int) -> DataFrame:
    """cell, mass: what of the noise falls on each cell from -tail to tail, the last ones with all beyond."""
    if kind == "gaussian":
        below = masses(spark.range(1).select(F.lit(float(scale) ** 2).alias("variance")))
        cell = F.greatest(F.lit(-tail), F.least(F.lit(tail), F.col("value"))).cast("int")
        return below.groupBy(cell.alias("cell")).agg(F.sum("mass").alias("mass"))
    cells = spark.range(-tail, tail + 1).select(F.col("id").cast("int").alias("cell"))
    size = F.abs("cell").cast("double")
    if kind == "laplace":  # a cell is one scale wide
        beyond = F.exp(0.5 - size) / 2
        return cells.select("cell", F.when(size == tail, beyond).when(size == 0, F.lit(1 - math.exp(-0.5))).otherwise(beyond - F.exp(-0.5 - size) / 2).alias("mass"))
    q = math.exp(-1 / scale)
    return cells.select("cell", F.when(size == tail, F.lit(q**tail / (1 + q))).otherwise(F.lit((1 - q) / (1 + q)) * F.pow(F.lit(q), size)).alias("mass"))


def noise_fit(noise: DataFrame, column: str, scale: float, tail: int, kind: str = "geometric") -> DataFrame:
    """Draws of noise against what is expected: cell, observed, expected, part (of chi squared).

    Cells of geometric and Gaussian noise (of which scale is the deviation)
    are the values up to `tail` in size, with all beyond in the last ones;
    cells of Laplace noise are a scale wide, with 0 in the middle of the middle one.
    """
    value = F.round(F.col(column) / F.lit(scale)) if kind == "laplace" else F.col(column)
    cell = F.greatest(F.lit(-tail), F.least(F.lit(tail), value.cast("long")))
    observed = noise.groupBy(cell.cast("int").alias("cell")).agg(F.count(F.lit(1)).alias("observed"))
    cells = _cell_masses(noise.sparkSession, kind, scale, tail)
    total = noise.agg(F.count(F.lit(1)).alias("total"))
    both = cells.join(observed, "cell", "left").crossJoin(F.broadcast(total))
    expected = F.col("mass") * F.col("total")
    seen = F.coalesce("observed", F.lit(0))
    return both.select("cell", seen.alias("observed"), expected.alias("expected"), ((seen - expected) * (seen - expected) / expected).alias("part"))
