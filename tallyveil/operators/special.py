"""Null, NaN and infinite values: replaced, dropped, counted."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import KINDS, ColumnSpec

DEFAULTS = {"bigint": 0, "int": 0, "double": 0.0, "float": 0.0, "string": "", "date": dt.date(1970, 1, 1), "timestamp": dt.datetime(1970, 1, 1, tzinfo=dt.UTC)}
FLOATS = ("double", "float")


def is_inf(c: Column) -> Column:
    return F.coalesce(F.abs(c) == F.lit(float("inf")), F.lit(False))


def _each(df: DataFrame, change: dict[str, Column]) -> DataFrame:
    return df.select(*[change[c].alias(c) if c in change else F.col(f"`{c}`") for c in df.columns])


def replace_null_and_nan(df: DataFrame, values: dict[str, object] | None = None) -> DataFrame:
    """Nulls and NaNs become given values; without any, the default of each column's type."""
    kinds = dict(df.dtypes)
    values = values or {c: DEFAULTS[k] for c, k in kinds.items() if k in DEFAULTS}
    change = {}
    for c, v in values.items():
        col = F.nanvl(F.col(c), F.lit(None).cast("double")) if kinds[c] in FLOATS else F.col(c)
        change[c] = F.coalesce(col, F.lit(v).cast(kinds[c]))
    return _each(df, change)


def replace_infinity(df: DataFrame, values: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Infinities become a (negative, positive) pair; without any given, zeros in all columns of doubles."""
    values = values or {c: (0.0, 0.0) for c, k in df.dtypes if k in FLOATS}
    inf = float("inf")
    return _each(df, {c: F.when(F.col(c) == -inf, F.lit(lo)).when(F.col(c) == inf, F.lit(hi)).otherwise(F.col(c)) for c, (lo, hi) in values.items()})


def drop_null_and_nan(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(columns or df.columns))  # Spark drops NaN with null


def drop_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def drop_nan(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with null stay."""
    for c in columns:
        df = df.filter(~F.coalesce(F.isnan(c), F.lit(False)))
    return df


def drop_infinity(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    for c in columns or [c for c, k in df.dtypes if k in FLOATS]:
        df = df.filter(~is_inf(F.col(c)))
    return df


def special_counts(df: DataFrame) -> DataFrame:
    """One row: nulls, NaNs and infinities of every column, in one pass."""
    out = []
    for c, k in df.dtypes:
        out.append(F.count_if(F.col(c).isNull()).alias(f"{c}_null"))
        if k in FLOATS:
            out += [F.count_if(F.coalesce(F.isnan(c), F.lit(False))).alias(f"{c}_nan"), F.count_if(is_inf(F.col(c))).alias(f"{c}_inf")]
    return df.agg(*out)


def spec_problems(df: DataFrame, columns: dict[str, ColumnSpec]) -> DataFrame:
    """column, problem, rows: columns that are absent, unexpected or of another kind, and nulls, NaNs or infinities where the spec forbids them; one scan."""
    kinds = {f.name: KINDS.get(type(f.dataType)) for f in df.schema}
    found = [(c, "absent", 0) for c in columns if c not in kinds] + [(c, "unexpected", 0) for c in kinds if c not in columns]
    found += [(c, f"is {kinds[c]}, not {s.kind}", 0) for c, s in columns.items() if c in kinds and kinds[c] != s.kind]
    tests = {}
    for c, s in columns.items():
        if kinds.get(c) != s.kind:
            continue
        if not s.nulls:
            tests[c, "null"] = F.col(c).isNull()
        if s.kind == "DECIMAL" and not s.nans:
            tests[c, "NaN"] = F.isnan(c)
        if s.kind == "DECIMAL" and not s.infs:
            tests[c, "infinity"] = is_inf(F.col(c))
    shape = df.sparkSession.createDataFrame(found, "column string, problem string, rows long")
    if not tests:
        return shape
    counts = df.agg(*[F.count_if(F.coalesce(t, F.lit(False))).alias(f"t{i}") for i, t in enumerate(tests.values())])
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(p).alias("problem"), F.col(f"t{i}").alias("rows")) for i, (c, p) in enumerate(tests)])
    return shape.unionByName(counts.select(F.explode(each).alias("p")).select("p.*").filter("rows > 0"))
