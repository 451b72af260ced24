"""What is known about a table beside its rows: column kinds, special values, and how far one unit of change reaches."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Spark type -> kind; integers are held as long, floats as double.
KINDS = {T.IntegerType: "INTEGER", T.LongType: "INTEGER", T.FloatType: "DECIMAL", T.DoubleType: "DECIMAL", T.StringType: "VARCHAR", T.DateType: "DATE", T.TimestampType: "TIMESTAMP"}
SPARK = {"INTEGER": T.LongType(), "DECIMAL": T.DoubleType(), "VARCHAR": T.StringType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType()}


@dataclass(frozen=True)
class ColumnSpec:
    """Kind of a column and the special values that it may hold."""

    kind: str
    nulls: bool = True
    nans: bool = False
    infs: bool = False


@dataclass(frozen=True)
class TableSpec:
    """Columns by name; sensitivity: rows that one unit of change adds or removes at most.

    With a grouping column, that many rows count in each of its groups'
    sums, and it must be among the keys of every aggregate. With an id column,
    a unit is all rows of an id.
    """

    columns: dict[str, ColumnSpec]
    sensitivity: float = 1
    grouping_column: str | None = None
    id_column: str | None = None
    norm: int = field(default=1)

    def scaled(self, by: float, **changes) -> TableSpec:
        return replace(self, sensitivity=self.sensitivity * by, **changes)


def coerced(df: DataFrame) -> DataFrame:
    """df with integers as long and floats as double; other types than those of KINDS, and nameless columns, are refused."""
    for f in df.schema:
        if not f.name:
            raise ValueError("a column has no name")
        if type(f.dataType) not in KINDS:
            raise ValueError(f"column {f.name} has the type {f.dataType.simpleString()}; cast it first")
    return df.select(*[F.col(f"`{f.name}`").cast(SPARK[KINDS[type(f.dataType)]]).alias(f.name) for f in df.schema])


def carries(before: DataFrame, after: DataFrame, column: str) -> bool:
    """Whether a column of before is the very same attribute in after, not another one of its name."""
    ids = [{a.exprId().id() for a in _attributes(df) if a.name() == column} for df in (before, after)]
    return len(ids[1]) == 1 and ids[1] <= ids[0]


def _attributes(df: DataFrame) -> list:
    output = df._jdf.queryExecution().analyzed().output()
    return [output.apply(i) for i in range(output.size())]


def spec_of(df: DataFrame, sensitivity: float = 1, grouping_column: str | None = None, id_column: str | None = None) -> TableSpec:
    """The spec of a coerced DataFrame: nulls where the schema has them, NaN and infinities in every double."""
    columns = {f.name: ColumnSpec(KINDS[type(f.dataType)], f.nullable, *[isinstance(f.dataType, (T.DoubleType, T.FloatType))] * 2) for f in df.schema}
    if grouping_column and columns[grouping_column].kind == "DECIMAL":
        raise ValueError("a grouping column can't hold floating-point numbers")
    return TableSpec(columns, sensitivity, grouping_column, id_column)
