"""Queries within a privacy budget, and audits of what was spent."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.contributions import limit_across
from ..operators.noise import mechanism, once, released
from ..operators.rows import parts_by_key
from ..operators.truncate import limit_keys
from ..spec import TableSpec, carries, coerced, spec_of
from .builder import Measured, Query, State

#: A request this much (relatively) above what is left is lowered to it.
SLACK = 1e-9


class BudgetError(ValueError):
    """A charge that the budget can't pay."""


class Session:
    """Private and public tables, a budget, and the charges against it.

    kind is "pure" (epsilon) or "zcdp" (rho). Results are written once to the
    folder, so their noise is never drawn again.
    """

    def __init__(self, budget: float, folder: str, kind: str = "pure") -> None:
        self.left, self.kind, self.folder = budget, kind, folder.rstrip("/")
        self.private: dict[str, tuple[DataFrame, TableSpec]] = {}
        self.public: dict[str, DataFrame] = {}
        self.charges: list[tuple[str, float]] = []
        self.together: dict[str, frozenset[str]] = {}

    def add_private(self, name: str, df: DataFrame, sensitivity: float = 1, grouping_column: str | None = None, id_column: str | None = None) -> None:
        df = coerced(df)
        self._put(name, df, spec_of(df, sensitivity, grouping_column, id_column))

    def _put(self, name: str, df: DataFrame, spec: TableSpec) -> None:
        """A private table, new or in place of another; bounds of that other one with further tables end."""
        self.private[name] = (df, spec)
        self.together.pop(name, None)

    def add_public(self, name: str, df: DataFrame) -> None:
        self.public[name] = coerced(df)

    def charge(self, name: str, amount: float) -> float:
        if amount <= 0:
            raise BudgetError("a query needs a budget above zero")
        if amount > self.left:
            if math.isinf(amount) or amount > self.left * (1 + SLACK):
                raise BudgetError(f"{amount} is asked for, {self.left} is left")
            amount = self.left
        if not math.isinf(self.left):
            self.left -= amount
        self.charges.append((name, amount))
        return amount

    def evaluate(self, source: str, query: Callable, amount: float, prefer: str = "default") -> DataFrame:
        """Runs query(df, noise), one keyed aggregate, on a private table and releases its result."""
        df, spec = self.private[source]
        if spec.id_column:
            raise ValueError(f"rows of one {spec.id_column} have no limit; run a query that sets one")
        amount = self.charge(source, amount)
        out = query(df, once(mechanism(amount, spec.sensitivity, self.kind, prefer)))
        if spec.grouping_column and spec.grouping_column not in out.columns:
            raise ValueError(f"the result must be grouped by {spec.grouping_column}")
        return released(out, f"{self.folder}/{uuid.uuid4().hex}")

    def run(self, measured: Measured, amount: float, prefer: str = "default") -> DataFrame:
        """Runs a built query; a charge is made only when the query is sound."""
        state = self._sound(measured)
        return self._measured(measured, state, self.charge(measured.query.source, amount), prefer)

    def _sound(self, measured: Measured) -> State:
        state = measured.query.bounded(self)
        if state.grouping and (measured.keys is None or state.grouping not in measured.keys.columns):
            raise ValueError(f"the keys must have {state.grouping}")
        return state

    def _measured(self, measured: Measured, state: State, amount: float, prefer: str) -> DataFrame:
        keys = measured.keys
        if measured.by_epsilon:
            epsilon = amount / state.reach if self.kind == "pure" else math.sqrt(8 * amount) / state.reach
            out = measured.aggregate(state.df, keys, epsilon)
        else:
            out = measured.aggregate(state.df, keys, mechanism(amount, state.reach, self.kind, prefer))
        return released(out, f"{self.folder}/{uuid.uuid4().hex}")

    def bound_ids(self, tables: Sequence[str], most: int) -> None:
        """Of every id at most so many rows stay in all these tables together; they then are tables without an id.

        A unit of change reaches `most` rows of one table, or fewer of several,
        so `run_together` pays once for one query of each.
        """
        specs = {name: self.private[name][1] for name in tables}
        for name, spec in specs.items():
            if not spec.id_column:
                raise ValueError(f"{name} has no id column")
        cut = limit_across({name: self.private[name][0] for name in tables}, {name: s.id_column for name, s in specs.items()}, most)
        for name, df in cut.items():
            self.private[name] = (df, spec_of(df, most * specs[name].sensitivity, specs[name].grouping_column))
            self.together[name] = frozenset(tables)

    def run_together(self, measured: dict[str, Measured], amount: float, prefer: str = "default") -> dict[str, DataFrame]:
        """Runs one query on each of several tables that `bound_ids` has bounded together, for one charge.

        Of an id's rows k lie in one table, the others in others; each costs
        amount / most, so all together cost the amount at most.
        """
        sources = [m.query.source for m in measured.values()]
        if len(set(sources)) < len(sources) or any(not self.together.get(s, frozenset()) >= set(sources) for s in sources):
            raise ValueError("one query for each of some tables whose ids are bounded together")
        states = {name: self._sound(m) for name, m in measured.items()}
        amount = self.charge(" and ".join(sources), amount)
        return {name: self._measured(m, states[name], amount, prefer) for name, m in measured.items()}

    def create_view(self, name: str, source: str | Query, change: Callable[[DataFrame], DataFrame] | None = None, factor: float = 1, cache: bool = False) -> None:
        """A derived private table: from the steps of a query, whose reach is known, or from a change of a source's rows.

        factor: rows of a change's result for each row of the source that
        changes. The columns that a unit of change is told by, an id and a
        grouping column, must come through a change as they are.
        """
        if isinstance(source, Query):
            state = source.state(self)
            out, spec = coerced(state.df), TableSpec({}, state.reach, state.grouping, state.ident)
            factor = 1
        else:
            df, spec = self.private[source]
            out = change(df)
            for column in (spec.grouping_column, spec.id_column):
                if column and not carries(df, out, column):
                    raise ValueError(f"a view must keep {column} as it is")
            out = coerced(out)
        self._put(name, out.persist() if cache else out, spec_of(out, spec.sensitivity * factor, spec.grouping_column, spec.id_column))

    def delete_view(self, name: str) -> None:
        self.private.pop(name)[0].unpersist()
        self.together.pop(name, None)

    def split(self, source: str, column: str, parts: dict[str, object], amount: float, most_parts: int | None = None) -> dict[str, Session]:
        """A session with `amount` and all public tables for each disjoint part of a table.

        Rows of a unit without an id lie in different parts only as far as
        they are fewer in each, so this session is charged once. An id may have
        all its rows in every part: most_parts bounds in how many it stays, the
        others are dropped, and the charge is that many amounts. A null value
        is a part like others. Values that repeat would be parts that share
        their rows, and are refused.
        """
        values = list(parts.values())
        if any(v in values[:i] for i, v in enumerate(values)):
            raise ValueError("the parts of a split are disjoint: each value once")
        df, spec = self.private[source]
        if spec.id_column:
            if not most_parts:
                raise ValueError(f"an id of {spec.id_column} may be in every part; say in how many at most")
            listed = reduce(Column.__or__, [F.col(column).eqNullSafe(F.lit(v)) for v in parts.values()])
            df = limit_keys(df.filter(listed), [spec.id_column], [column], most_parts)
            self.charge(f"split of {source}", amount * most_parts)
        else:
            amount = self.charge(f"split of {source}", amount)
        out = {}
        for (name, _), part in zip(parts.items(), parts_by_key(df, [column], [(v,) for v in parts.values()]), strict=True):
            out[name] = Session(amount, self.folder, self.kind)
            out[name].public = dict(self.public)
            out[name].private[name] = (part, spec)
        return out


def charge_audit(charges: DataFrame, budget: float, dataset: str = "dataset", split: str = "split", part: str = "part", loss: str = "loss") -> DataFrame:
    """spent and remaining of each dataset: its own charges (null split) add, of a split's disjoint parts the largest sum counts."""
    own = charges.filter(F.col(split).isNull()).groupBy(dataset).agg(F.sum(loss).alias("loss"))
    parts = charges.filter(F.col(split).isNotNull()).groupBy(dataset, split, part).agg(F.sum(loss).alias("loss"))
    most = parts.groupBy(dataset, split).agg(F.max("loss").alias("loss")).select(dataset, "loss")
    return own.unionByName(most).groupBy(dataset).agg(F.sum("loss").alias("spent")).withColumn("remaining", F.lit(budget) - F.col("spent"))


def rho_of_epsilon(epsilon: Column) -> Column:
    return epsilon * epsilon / 2


def epsilon_of_rho(rho: Column, delta: float) -> Column:
    """The epsilon with which (epsilon, delta) holds."""
    return rho + 2 * F.sqrt(rho * F.lit(math.log(1 / delta)))


def split_counts(df: DataFrame, column: str, parts: Sequence) -> DataFrame:
    """Counts of all listed parts in one job instead of one for each."""
    from ..operators.aggregates import count
    from ..operators.keys import keys_from_values

    return count(df, keys_from_values(df.sparkSession, {column: list(parts)}))
