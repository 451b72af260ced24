"""Row by row: projections, filters, maps, ids, digits and recodes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .prefix import copy_numbers


def select(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """All at once, so names can be swapped."""
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


def where(df: DataFrame, predicate: str) -> DataFrame:
    return df.filter(F.expr(predicate))


def map_columns(df: DataFrame, columns: dict[str, Column], augment: bool = False) -> DataFrame:
    """New columns from expressions; with augment the old ones stay and win where names clash."""
    if not augment:
        return df.select(*[e.alias(c) for c, e in columns.items()])
    return df.select("*", *[e.alias(c) for c, e in columns.items() if c not in df.columns])


def _by_python(df: DataFrame, rows_of: Callable[[dict], list[dict]], schema: str) -> DataFrame:
    """Rows that a Python function makes of each row; Arrow keeps whole numbers beside nulls exact, and a null is None."""
    shape = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([new for row in batch.to_pylist() for new in rows_of(row)], schema=shape)

    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, function: Callable[[dict], dict], schema: str) -> DataFrame:
    """A Python function of rows, for what no expression can say; one Arrow batch at a time. What it doesn't give is null."""
    return _by_python(df, lambda row: [function(row)], schema)


def flat_map(df: DataFrame, rows: Column, most: int, name: str, augment: bool = True) -> DataFrame:
    """Up to `most` rows for each row: the first elements of an array."""
    kept = [c for c in df.columns if c != name] if augment else []
    return df.select(*[F.col(f"`{c}`") for c in kept], F.explode(F.slice(rows, 1, most)).alias(name))


def flat_map_rows(df: DataFrame, function: Callable[[dict], list[dict]], most: int, schema: str) -> DataFrame:
    """Up to `most` rows for each row from a Python function, for what no expression can say; one Arrow batch at a time."""
    return _by_python(df, lambda row: function(row)[:most], schema)


def grouping_flat_map(df: DataFrame, groups: Column, most: int, name: str) -> DataFrame:
    """Up to `most` different groups for each row; a later aggregate must group by them."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != name], F.explode(F.array_distinct(F.slice(groups, 1, most))).alias(name))


def unique_id(df: DataFrame, name: str) -> DataFrame:
    """An id from a row's values and its number among equal rows, which are numbered in parts."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    numbered = copy_numbers(df, df.columns, "__copy")
    return numbered.withColumn(name, F.hex(F.to_json(F.array(*[F.coalesce(c.cast("string"), F.lit("\u0000")) for c in cols], F.col("__copy").cast("string"))))).drop("__copy")


def digitize(value: Column, edges: Sequence[float]) -> Column:
    """How many edges are at or below the value; null stays null."""
    return reduce(Column.__add__, [(value >= F.lit(e)).cast("int") for e in edges])


def bin_range(index: Column, edges: Sequence[int], last: int) -> Column:
    """(low, high) of a digitized value: from 0, up to but not including the next edge, at the end `last`."""
    low, high = [0, *edges], [*[e - 1 for e in edges], last]
    return F.element_at(F.array(*[F.struct(F.lit(a).alias("low"), F.lit(b).alias("high")) for a, b in zip(low, high, strict=True)]), (index + 1).cast("int"))


def recode(df: DataFrame, statements: dict[str, str]) -> DataFrame:
    """Columns from SQL expressions, in order, so later ones see earlier ones."""
    for name, expression in statements.items():
        df = df.withColumn(name, F.expr(expression))
    return df


def blank_to(value: Column, word: str = "Null") -> Column:
    """Text of blanks only becomes a word."""
    return F.regexp_replace(value, r"^\s*$", word)


def relabel(value: Column, names: dict[object, object]) -> Column:
    """Listed values are exchanged, others stay."""
    return reduce(lambda c, kv: F.when(value == F.lit(kv[0]), F.lit(kv[1])).otherwise(c), names.items(), value)


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], kind: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), kind, value)


def parts_by_key(df: DataFrame, keys: Sequence[str], parts: Sequence[tuple]) -> list[DataFrame]:
    """A disjoint table for each listed key value, null-safely."""
    return [df.filter(reduce(Column.__and__, [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(keys, part, strict=True)])) for part in parts]


def region_columns(df: DataFrame, levels: dict[str, tuple[Sequence[str], dict[str, str]]], nation: str | None = None) -> DataFrame:
    """Region ids by joining codes; a code among a level's sentinels makes the whole id "NULL"."""
    out = {}
    for name, (codes, none) in levels.items():
        joined = F.concat(*[F.col(c) for c in codes])
        absent = reduce(Column.__or__, [F.col(c) == F.lit(v) for c, v in none.items()], F.lit(False))
        out[name] = F.when(absent, F.lit("NULL")).otherwise(joined)
    if nation is not None:
        out["NATION"] = F.lit(nation)
    return df.withColumns(out)
