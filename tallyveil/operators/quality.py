"""Rules for columns and records, checked in one pass, and the rows that break them."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import staged
from .prefix import prefix_sums, ranged, same


@dataclass(frozen=True)
class Rule:
    """What a column may hold; null breaks every rule but that of an allowed "null"."""

    column: str

    def valid(self) -> Column:
        raise NotImplementedError

    def holds(self) -> Column:
        return F.coalesce(self.valid(), F.lit(False))

    def clipped(self) -> Column:
        raise ValueError(f"values of {self.column} can't be clipped")


@dataclass(frozen=True)
class Pattern(Rule):
    """The whole text matches."""

    pattern: str

    def valid(self) -> Column:
        return F.col(self.column).rlike(f"^(?:{self.pattern})$")


@dataclass(frozen=True)
class Range(Rule):
    """low <= value < high, in equal bins."""

    low: float
    high: float
    bins: int = 1

    def valid(self) -> Column:
        return (F.col(self.column) >= self.low) & (F.col(self.column) < self.high)

    def clipped(self) -> Column:
        top = self.high - (self.high - self.low) / self.bins
        return F.when(F.col(self.column) >= self.high, F.lit(top)).when(F.col(self.column) < self.low, F.lit(self.low)).otherwise(F.col(self.column))

    def encoded(self) -> Column:
        return F.floor((F.col(self.column) - self.low) / ((self.high - self.low) / self.bins)).cast("int")

    def decoded(self, code: Column) -> Column:
        return F.lit(self.low) + code * ((self.high - self.low) / self.bins)


@dataclass(frozen=True)
class Splits(Rule):
    """edges[0] <= value <= edges[-1], in bins between edges; the last edge is in the last bin."""

    edges: tuple

    def valid(self) -> Column:
        return F.col(self.column).between(self.edges[0], self.edges[-1])

    def clipped(self) -> Column:
        return F.least(F.greatest(F.col(self.column), F.lit(self.edges[0])), F.lit(self.edges[-1]))

    def encoded(self) -> Column:
        return sum((F.when(F.col(self.column) >= e, 1).otherwise(0) for e in self.edges[1:-1]), F.lit(0))

    def decoded(self, code: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, self.edges)), (code + 1).cast("int"))


@dataclass(frozen=True)
class OneOf(Rule):
    """One of the codes in the first column of a table of any size, compared as text.

    Reports count a column's values first, so they meet the table once each.
    Where rows themselves are wanted, `marked` gives them the rule's mark.
    """

    codes: DataFrame

    @property
    def mark(self) -> str:
        return f"__ok_{self.column}"

    def valid(self) -> Column:
        return F.col(f"`{self.mark}`")


@dataclass(frozen=True)
class Values(Rule):
    """One of listed values."""

    values: tuple

    def valid(self) -> Column:
        return F.col(self.column).isin(list(self.values))

    def encoded(self) -> Column:
        return F.array_position(F.array(*map(F.lit, self.values)), F.col(self.column)).cast("int") - 1

    def decoded(self, code: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, self.values)), (code + 1).cast("int"))


def column_problems(df: DataFrame, rules: Sequence[Rule], unexpected: str = "error", ordered: bool = False) -> list[str]:
    """What is wrong with the columns themselves; unexpected ones are an error, a warning ("warn"), or ignored ("ignore")."""
    if unexpected not in ("error", "warn", "ignore"):
        raise ValueError(f"unexpected columns are no {unexpected}")
    names, out = [r.column for r in rules], []
    out += [f"missing column {c}" for c in names if c not in df.columns]
    more = [f"unexpected column {c}" for c in df.columns if c not in names]
    if unexpected == "error":
        out += more
    elif unexpected == "warn" and more:
        warnings.warn("; ".join(more), stacklevel=2)
    if ordered and not out and [c for c in df.columns if c in names] != names:
        out.append("columns are not in order")
    return out


#: Values up to which a table of invalid ones is broadcast to mark rows.
MOST_BROADCAST = 500_000


def invalid_values(df: DataFrame, rules: Sequence[OneOf]) -> DataFrame:
    """column, value, n: a column's values that its table of codes hasn't (null among them), and their rows.

    All columns are counted in one pass; a value that a third of all rows have
    is one count for each task, and meets the codes once.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(r.column).alias("column"), F.col(f"`{r.column}`").cast("string").alias("value")) for r in rules]))
    counted = df.select(pairs.alias("p")).select("p.*").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    codes = reduce(DataFrame.unionByName, [r.codes.select(F.lit(r.column).alias("column"), F.col(f"`{r.codes.columns[0]}`").cast("string").alias("value")) for r in rules]).distinct()
    return counted.join(codes, ["column", "value"], "left_anti")


def marked(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """df with the mark of every `OneOf`, by a join with the invalid values only."""
    tables = [r for r in rules if isinstance(r, OneOf)]
    if not tables:
        return df
    bad = staged(invalid_values(df, tables).filter("value IS NOT NULL"), "invalid-values")
    for r in tables:
        own = bad.filter(F.col("column") == r.column).select(F.col("value").alias("__bad"))
        side = F.broadcast(own) if own.count() <= MOST_BROADCAST else own
        both = df.join(side, F.col(f"`{r.column}`").cast("string") == F.col("__bad"), "left")
        df = both.withColumn(r.mark, F.col("__bad").isNull() & F.col(f"`{r.column}`").isNotNull()).drop("__bad")
    return df


def rule_report(df: DataFrame, rules: Sequence[Rule], shown: int = 10) -> DataFrame:
    """A row for each rule: column, checked, invalid, examples (the first invalid values as text).

    One scan for all rules but those of code tables, and one for all of these.
    """
    tables, rules = [r for r in rules if isinstance(r, OneOf)], [r for r in rules if not isinstance(r, OneOf)]
    parts = ([_rule_report(df, rules, shown)] if rules else []) + ([_table_report(df, tables, shown)] if tables else [])
    return reduce(DataFrame.unionByName, parts)


def _table_report(df: DataFrame, rules: Sequence[OneOf], shown: int) -> DataFrame:
    bad = staged(invalid_values(df, rules), "invalid-values")
    named = bad.withColumn("value", F.coalesce("value", F.lit("null")))
    first = named.withColumn("at", F.row_number().over(Window.partitionBy("column").orderBy("value"))).filter(F.col("at") <= shown)
    examples = first.groupBy("column").agg(F.array_join(F.array_sort(F.collect_list("value")), ",").alias("examples"))
    counts = bad.groupBy("column").agg(F.sum("n").alias("invalid"))
    every = df.agg(F.count(F.lit(1)).alias("checked")).select(F.explode(F.array(*[F.lit(r.column) for r in rules])).alias("column"), "checked")
    both = every.join(counts, "column", "left").join(examples, "column", "left")
    return both.select("column", "checked", F.coalesce("invalid", F.lit(0)).cast("long").alias("invalid"), F.coalesce("examples", F.lit("")).alias("examples"))


def _rule_report(df: DataFrame, rules: Sequence[Rule], shown: int) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, r in enumerate(rules):
        aggs.append(F.count_if(~r.holds()).alias(f"bad{i}"))
    counts = df.agg(*aggs)
    bad = df.select(F.explode(F.array_compact(F.array(*[F.when(~r.holds(), F.struct(F.lit(r.column).alias("column"), F.coalesce(F.col(r.column).cast("string"), F.lit("null")).alias("value"))) for r in rules]))).alias("b")).select("b.*").distinct()
    first = Window.partitionBy("column").orderBy("value")
    examples = bad.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= shown).groupBy("column").agg(F.array_join(F.array_sort(F.collect_list("value")), ",").alias("examples"))
    rows = counts.select("n", F.explode(F.array(*[F.struct(F.lit(r.column).alias("column"), F.col(f"bad{i}").alias("invalid")) for i, r in enumerate(rules)])).alias("r"))
    return rows.select("r.column", F.col("n").alias("checked"), "r.invalid").join(examples, "column", "left").select("column", "checked", "invalid", F.coalesce("examples", F.lit("")).alias("examples"))


def validated(df: DataFrame, rules: Sequence[Rule], strategy: str = "error") -> DataFrame:
    """Out-of-bounds values: an error, their rows removed, or clipped."""
    columns = df.columns
    if strategy == "remove":
        return marked(df, rules).filter(reduce(Column.__and__, [r.holds() for r in rules])).select(*[F.col(f"`{c}`") for c in columns])
    if strategy == "clip":
        return df.withColumns({r.column: r.clipped() for r in rules})
    if strategy == "error":
        plain, tables = [r for r in rules if not isinstance(r, OneOf)], [r for r in rules if isinstance(r, OneOf)]
        if (plain and not df.filter(~reduce(Column.__and__, [r.holds() for r in plain])).isEmpty()) or (tables and not invalid_values(df, tables).isEmpty()):
            raise ValueError("values are out of bounds")
        return df
    raise ValueError(f"no strategy {strategy}")


def quarantine(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Rows that break any named check, with the sorted names in `reasons`."""
    broken = [F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in sorted(checks.items())]
    return df.withColumn("reasons", F.array_join(F.array_compact(F.array(*broken)), ",")).filter("reasons <> ''")


def cell_index(codes: Sequence[Column], sizes: Sequence[int]) -> Column:
    """One number for a tuple of codes, the last one running fastest."""
    out: Column = F.lit(0).cast("long")
    for code, size in zip(codes, sizes, strict=True):
        out = out * size + code
    return out


def cell_codes(index: Column, sizes: Sequence[int]) -> list[Column]:
    """The codes that a cell's number stands for."""
    out = []
    for size in reversed(sizes):
        out.append((index % size).cast("int"))
        index = F.floor(index / size)
    return out[::-1]


def rules_from_codes(codes: DataFrame, column: str, rule_column: str, most: int = 1_000) -> Values | OneOf:
    """A rule from a code table: listed values while they are few, the table itself beyond."""
    found = [r[0] for r in codes.select(column).dropna().distinct().orderBy(column).limit(most + 1).collect()]
    return Values(rule_column, tuple(found)) if len(found) <= most else OneOf(rule_column, codes.select(column).dropna())


def gaps_in_codes(df: DataFrame, columns: Sequence[str], none: str = "Null") -> DataFrame:
    """Rows in which a code follows the first absent one."""
    absent = [(F.col(c) == none).cast("int") for c in columns]
    late = [(absent[i] == 1) & (absent[i + 1] == 0) for i in range(len(columns) - 1)]
    return df.filter(reduce(Column.__or__, late))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def ambiguous_codes(mapping: DataFrame, attributes: DataFrame, on: str, code: str, levels: Sequence[str]) -> DataFrame:
    """Codes that map to more than one characteristic with the same attributes."""
    return duplicate_keys(mapping.join(attributes, on), [code, *levels])


def inconsistent_flags(df: DataFrame, first: str, second: str, level: str) -> DataFrame:
    """Rows whose two flags are both "True", or whose flags are "Null" elsewhere than at level 0."""
    null = (F.col(first) == "Null") | (F.col(second) == "Null")
    return df.filter(((F.col(first) == "True") & (F.col(second) == "True")) | (null != (F.col(level) == "0")))


def outside_states(df: DataFrame, states: Sequence[str], region: str = "REGION_ID", kind: str = "REGION_TYPE", exempt: Sequence[str] = ("USA", "AIANNH")) -> DataFrame:
    """Rows of regions that aren't in any of the states."""
    return df.filter(~F.col(kind).isin(list(exempt)) & ~F.substring(F.col(region), 1, 2).isin(list(states)))


def merged_ranges(ranges: DataFrame, group: Sequence[str], low: str = "low", high: str = "high") -> DataFrame:
    """Overlapping or adjacent whole-number ranges of a field become one.

    Different ranges of a field are cut into spans by their low ends. The
    highest end before a range is a running maximum inside its span, or what
    the spans before it reach; so a window holds a span, or one row for each span.
    """
    different = staged(ranges.select(*group, low, high).distinct(), "ranges")
    cut = ranged(different, group, low)
    inside = Window.partitionBy(*group, "span").orderBy(low, high).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*group).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    reached = cut.groupBy(*group, "span").agg(F.max(high).alias("__end")).withColumn("__carried", F.max("__end").over(before)).drop("__end")
    both = cut.withColumn("__own", F.max(high).over(inside)).alias("c").join(reached.alias("r"), same("c", "r", [*group, "span"]))
    top = F.greatest("c.__own", "r.__carried")
    fresh = both.select(*[F.col(f"c.`{c}`") for c in cut.columns], F.when(F.col(f"c.`{low}`") > top + 1, 1).otherwise(0).alias("__new"))
    placed = prefix_sums(staged(fresh, "range-starts"), list(group), "span", [low, high], "__new", "__at")
    return placed.groupBy(*group, "__at").agg(F.min(low).alias(low), F.max(high).alias(high)).drop("__at")


def output_problems(df: DataFrame, rules: Sequence[Rule], states: Sequence[str], count_column: str = "COUNT", negatives: bool = False, region: str = "REGION_ID", kind: str = "REGION_TYPE", exempt: Sequence[str] = ("USA", "AIANNH")) -> DataFrame:
    """One row for each kind of problem with an output table: problem, rows; one scan for all."""
    outside = ~F.col(kind).isin(list(exempt)) & ~F.substring(F.col(region), 1, 2).isin(list(states))
    checks = {f"rule {r.column}": ~r.holds() for r in rules} | {"state": outside}
    if not negatives:
        checks["negative"] = F.col(count_column) < 0
    counts = df.agg(*[F.count_if(c).alias(f"p{i}") for i, c in enumerate(checks.values())])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("problem"), F.col(f"p{i}").alias("rows")) for i, n in enumerate(checks)])).alias("p")).select("p.*")


def invalid_tables(tables: dict[str, DataFrame], rules: dict[str, Sequence[Rule]], may_be_empty: Sequence[str] = ()) -> dict[str, list[str]]:
    """Problems of each table of a set: absent, empty, wrong columns, or rules with invalid values; sound tables are left out."""
    out = {}
    for name, own in rules.items():
        if name not in tables:
            out[name] = ["the table is missing"]
            continue
        found = column_problems(tables[name], own)
        if not found:
            report = rule_report(tables[name], own).collect()
            if not any(r.checked for r in report) and name not in may_be_empty:
                found.append("the table is empty")
            found += sorted(f"{r.column}: {r.invalid} invalid, such as {r.examples}" for r in report if r.invalid)
        if found:
            out[name] = found
    return out


def invalid_files(spark: SparkSession, folder: str, rules: dict[str, Sequence[Rule]], schemas: dict[str, str], *, sep: str = ",", header: bool = True, may_be_empty: Sequence[str] = ()) -> dict[str, list[str]]:
    """Problems of delimited files, folder/name for each name of rules, as `invalid_tables` gives them; a file that can't be read is missing."""
    tables = {}
    for name in rules:
        try:
            tables[name] = spark.read.csv(f"{folder.rstrip('/')}/{name}", schema=schemas[name], sep=sep, header=header, enforceSchema=False)
        except AnalysisException as gone:
            if gone.getCondition() != "PATH_NOT_FOUND":
                raise
    return invalid_tables(tables, rules, may_be_empty)


@dataclass(frozen=True)
class Check:
    """A named check of a table set: gives the rows that break it."""

    name: str
    broken: Callable[[dict[str, DataFrame]], DataFrame]


def phased_problems(tables: dict[str, DataFrame], prior: dict[str, Sequence[Rule]], rebuilt: Callable[[dict[str, DataFrame]], dict[str, Sequence[Rule]]], checks: Sequence[Check]) -> DataFrame:
    """phase, problem, rows: what is wrong with a set of tables, checked in three phases.

    1. Rules that are known beforehand. 2. Rules made anew from the code tables
    that passed. 3. Checks between tables. Only the first phase that finds
    anything reports, as later ones rely on those before. A phase's report is
    written once; a phase without rules or checks finds nothing.
    """
    spark = next(iter(tables.values())).sparkSession

    def of_rules(phase: int, rules: dict[str, Sequence[Rule]]) -> DataFrame:
        reports = [rule_report(tables[t], own, 0).select(F.lit(phase).alias("phase"), F.concat(F.lit(f"{t}."), "column").alias("problem"), F.col("invalid").alias("rows")) for t, own in rules.items()]
        return found(reports)

    def found(reports: list[DataFrame]) -> DataFrame:
        nothing = spark.createDataFrame([], "phase int, problem string, rows long")
        return staged(reduce(DataFrame.unionByName, reports).filter("rows > 0"), "problems") if reports else nothing

    missing = sorted(set(prior) - set(tables))
    if missing:
        raise ValueError(f"tables are missing: {', '.join(missing)}")
    first = of_rules(1, prior)
    if not first.isEmpty():
        return first
    second = of_rules(2, rebuilt(tables))
    if not second.isEmpty():
        return second
    return found([c.broken(tables).agg(F.lit(3).alias("phase"), F.lit(c.name).alias("problem"), F.count(F.lit(1)).alias("rows")) for c in checks])
