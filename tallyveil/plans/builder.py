"""Queries written as chains: row steps, keys, one aggregate; run by a session within a budget."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates, joins, quantile, rows, special, truncate
from ..operators.bins import Bins

if TYPE_CHECKING:
    from .budget import Session


@dataclass(frozen=True)
class State:
    """A table on its way: rows, how many of them a unit of change reaches, a column that keys must have, and an id.

    With an id column a unit of change is all rows of an id, however many, so
    steps that multiply rows change nothing; `limit_rows_per_id` gives the
    number of rows that an aggregate needs.
    """

    df: DataFrame
    reach: float
    grouping: str | None
    session: Session
    ident: str | None = None

    def to(self, df: DataFrame, by: float = 1, grouping: str | None = None) -> State:
        for column in self.fixed:
            if column not in df.columns:
                raise ValueError(f"the column {column} must stay")
        return replace(self, df=df, reach=self.reach * (1 if self.ident else by), grouping=grouping or self.grouping)

    @property
    def fixed(self) -> list[str]:
        """The columns that a unit of change is told by; no step may assign them."""
        return [c for c in (self.ident, self.grouping) if c]

    def without(self, columns) -> None:
        for column in self.fixed:
            if column in columns:
                raise ValueError(f"the column {column} can't be changed")

    def public(self, table: str | DataFrame) -> DataFrame:
        return self.session.public[table] if isinstance(table, str) else table


def _checked(function: Callable[[dict], list[dict]], fixed: list[str], first: bool = False) -> Callable:
    """A function of rows that stops where a fixed column comes back changed; first: gives the only row itself."""

    def run(row: dict) -> list[dict] | dict:
        out = function(row)
        for made in out:
            for column in fixed:
                if column not in made or (made[column] is not row[column] and made[column] != row[column]):
                    raise ValueError(f"the column {column} can't be changed")
        return out[0] if first else out

    return run


@dataclass(frozen=True)
class Query:
    """Steps from a private table."""

    source: str
    steps: tuple[Callable[[State], State], ...] = ()

    def then(self, step: Callable[[State], State]) -> Query:
        return Query(self.source, (*self.steps, step))

    def _rows(self, change: Callable[[DataFrame], DataFrame], by: float = 1) -> Query:
        return self.then(lambda s: s.to(change(s.df), by))

    def select(self, *columns: str) -> Query:
        return self._rows(lambda df: rows.select(df, columns))

    def rename(self, names: dict[str, str]) -> Query:
        def step(s: State) -> State:
            return replace(s, ident=names.get(s.ident, s.ident), grouping=names.get(s.grouping, s.grouping)).to(rows.rename(s.df, names))

        return self.then(step)

    def limit_rows_per_id(self, most: int) -> Query:
        """Of every id at most so many rows stay; a unit of change then reaches that many."""

        def step(s: State) -> State:
            if not s.ident:
                raise ValueError("the table has no id column")
            return replace(s, df=truncate.truncate_groups(s.df, [s.ident], most), reach=most * s.reach, ident=None)

        return self.then(step)

    def limit_groups_per_id(self, groups: Sequence[str], most: int, rows_each: int) -> Query:
        """Of every id at most so many groups stay, with so many rows in each."""

        def step(s: State) -> State:
            if not s.ident:
                raise ValueError("the table has no id column")
            few = truncate.limit_keys(s.df, [s.ident], list(groups), most)
            return replace(s, df=truncate.truncate_groups(few, [s.ident, *groups], rows_each), reach=most * rows_each * s.reach, ident=None)

        return self.then(step)

    def filter(self, predicate: str) -> Query:
        return self._rows(lambda df: rows.where(df, predicate))

    def _assigned(self, names: Sequence[str], change: Callable[[DataFrame], DataFrame], by: float = 1) -> Query:
        """A step that gives columns new values."""

        def step(s: State) -> State:
            s.without(names)
            return s.to(change(s.df), by)

        return self.then(step)

    def _by_rows(self, change: Callable[[State], DataFrame], by: float = 1) -> Query:
        return self.then(lambda s: s.to(change(s), by))

    def map(self, columns: dict[str, Column], augment: bool = False) -> Query:
        """Columns by expressions; an id or grouping column may only be taken over as it is."""
        return self._assigned([c for c, v in columns.items() if str(v) != str(F.col(c))], lambda df: rows.map_columns(df, columns, augment))

    def map_rows(self, function: Callable[[dict], dict], schema: str) -> Query:
        """A Python function of each row; it must give an id or grouping column back as it was."""
        return self._by_rows(lambda s: rows.map_rows(s.df, _checked(lambda row: [function(row)], s.fixed, first=True), schema))

    def flat_map(self, values: Column, most: int, name: str, augment: bool = True) -> Query:
        return self._assigned([name], lambda df: rows.flat_map(df, values, most, name, augment), most)

    def flat_map_rows(self, function: Callable[[dict], list[dict]], most: int, schema: str) -> Query:
        """As `map_rows`, with any number of rows, of which `most` stay."""
        return self._by_rows(lambda s: rows.flat_map_rows(s.df, _checked(function, s.fixed), most, schema), most)

    def grouping_flat_map(self, values: Column, most: int, name: str) -> Query:
        """Groups of each row; the aggregate must have them among its keys. A table that must be grouped already can't get a second such column."""

        def step(s: State) -> State:
            s.without([name])
            if s.grouping:
                raise ValueError(f"the table is grouped by {s.grouping} already")
            return s.to(rows.grouping_flat_map(s.df, values, most, name), most, name)

        return self.then(step)

    def bin_column(self, column: str, bins: Bins, name: str | None = None) -> Query:
        name = name or f"{column}_binned"
        return self._assigned([name], lambda df: df.withColumn(name, bins.column(F.col(column), dict(df.dtypes)[column] in special.FLOATS)))

    def _replaced(self, values: dict | None, change: Callable, defaults: Callable[[DataFrame], dict]) -> Query:
        def step(s: State) -> State:
            s.without(values or ())
            own = values or {c: v for c, v in defaults(s.df).items() if c not in s.fixed}
            return s.to(change(s.df, own) if own else s.df)

        return self.then(step)

    def replace_null_and_nan(self, values: dict[str, object] | None = None) -> Query:
        """Without values, the default of each type in all columns but an id or grouping column."""
        return self._replaced(values, special.replace_null_and_nan, lambda df: {c: special.DEFAULTS[k] for c, k in df.dtypes if k in special.DEFAULTS})

    def replace_infinity(self, values: dict[str, tuple[float, float]] | None = None) -> Query:
        return self._replaced(values, special.replace_infinity, lambda df: {c: (0.0, 0.0) for c, k in df.dtypes if k in special.FLOATS})

    def drop_null_and_nan(self, columns: Sequence[str] | None = None) -> Query:
        return self._rows(lambda df: special.drop_null_and_nan(df, columns))

    def drop_infinity(self, columns: Sequence[str] | None = None) -> Query:
        return self._rows(lambda df: special.drop_infinity(df, columns))

    def join_public(self, table: str | DataFrame, on: Sequence[str] | None = None, nulls: bool = True, most: int | None = None) -> Query:
        """most: rows of the public table that share a key; counted where it isn't given."""

        def step(s: State) -> State:
            public = s.public(table)
            keys = list(on or [c for c in s.df.columns if c in public.columns])
            fan = most if most is not None else joins.fanout(public, keys).first()["most"]
            return s.to(joins.join(s.df, public, keys, nulls), max(fan, 1))

        return self.then(step)

    def join_private(self, other: Query, most_left: int, most_right: int, on: Sequence[str], drop: bool = False, nulls: bool = True) -> Query:
        def step(s: State) -> State:
            right = other.state(s.session)
            if s.grouping or right.grouping:
                raise ValueError("a table that must be grouped can't be joined with a private one")
            if s.ident or right.ident:
                if s.ident != right.ident or s.ident not in on:
                    raise ValueError("tables with an id are joined on it")
                return replace(s, reach=max(s.reach, right.reach)).to(joins.join(s.df, right.df, on, nulls))
            out = joins.join_private(s.df, right.df, on, most_left, most_right, drop=drop, nulls=nulls)
            return replace(s, df=out, reach=joins.join_private_sensitivity(s.reach, right.reach, most_left, most_right, drop))

        return self.then(step)

    def state(self, session: Session) -> State:
        df, spec = session.private[self.source]
        out = State(df, spec.sensitivity, spec.grouping_column, session, spec.id_column)
        for step in self.steps:
            out = step(out)
        return out

    def bounded(self, session: Session) -> State:
        """The table for an aggregate, which needs to know how many rows a unit of change reaches."""
        out = self.state(session)
        if out.ident:
            raise ValueError(f"limit the rows of each {out.ident} first")
        return out

    def groupby(self, keys: DataFrame) -> Grouped:
        return Grouped(self, keys)

    def histogram(self, column: str, bins: Bins, name: str | None = None) -> Measured:
        return Measured(self, None, lambda df, keys, noise: aggregates.histogram(df, column, bins, name, noise))

    def __getattr__(self, name: str) -> Callable:
        if name in Grouped.AGGREGATES:
            return getattr(Grouped(self, None), name)
        raise AttributeError(name)


@dataclass(frozen=True)
class Measured:
    """A query with its aggregate, function of (df, keys, noise), or of epsilon for quantiles."""

    query: Query
    keys: DataFrame | None
    aggregate: Callable
    by_epsilon: bool = False


@dataclass(frozen=True)
class Grouped:
    """Steps and the keys to aggregate by."""

    AGGREGATES = ("count", "count_distinct", "sum", "average", "variance", "stdev", "quantile", "min", "max", "median")

    query: Query
    keys: DataFrame | None

    def count(self, name: str = "count") -> Measured:
        return Measured(self.query, self.keys, lambda df, keys, noise: aggregates.count(df, keys, name, noise))

    def count_distinct(self, columns: Sequence[str] | None = None, name: str | None = None) -> Measured:
        return Measured(self.query, self.keys, lambda df, keys, noise: aggregates.count_distinct(df, columns, keys, name, noise))

    def _numeric(self, aggregate: Callable, column: str, low: float, high: float, name: str | None) -> Measured:
        return Measured(self.query, self.keys, lambda df, keys, noise: aggregate(df, column, low, high, keys, name, noise))

    def sum(self, column: str, low: float, high: float, name: str | None = None) -> Measured:
        return self._numeric(aggregates.bounded_sum, column, low, high, name)

    def average(self, column: str, low: float, high: float, name: str | None = None) -> Measured:
        return self._numeric(aggregates.average, column, low, high, name)

    def variance(self, column: str, low: float, high: float, name: str | None = None) -> Measured:
        return self._numeric(aggregates.variance, column, low, high, name)

    def stdev(self, column: str, low: float, high: float, name: str | None = None) -> Measured:
        return self._numeric(aggregates.stdev, column, low, high, name)

    def quantile(self, column: str, q: float, low: float, high: float, name: str | None = None) -> Measured:
        return Measured(self.query, self.keys, lambda df, keys, epsilon: quantile.quantile(df, column, q, low, high, keys, name, epsilon), by_epsilon=True)

    def min(self, column: str, low: float, high: float, name: str | None = None) -> Measured:
        return self.quantile(column, 0, low, high, name or f"{column}_min")

    def max(self, column: str, low: float, high: float, name: str | None = None) -> Measured:
        return self.quantile(column, 1, low, high, name or f"{column}_max")

    def median(self, column: str, low: float, high: float, name: str | None = None) -> Measured:
        return self.quantile(column, 0.5, low, high, name or f"{column}_median")
