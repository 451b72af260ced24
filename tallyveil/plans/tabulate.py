"""Adaptive tabulation: totals decide how fine a group's table is, all groups and levels in one job."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import _exact, count
from ..operators.keys import keyed
from ..operators.noise import not_negative, suppressed, suppression_threshold
from ..operators.rows import digitize
from ..scratch import staged

#: Age edges of each level's table; level 0 has the total only.
AGE_EDGES = {1: (18, 45, 65), 2: (5, 18, 25, 35, 45, 55, 65, 75), 3: (5, 10, 15, 18, 20, 21, 22, 25, 30, 35, 40, 45, 50, 55, 60, 62, 65, 67, 70, 75, 80, 85)}
LAST_AGE = 115
ALL = "*"
#: Groups up to which their levels are broadcast to the rows; beyond, adaptive execution splits hot groups of the join.
MOST_BROADCAST = 500_000
#: Codes up to which their groups (a hundred times as many at most) are one broadcast row of maps, which are searched from their start.
MOST_MAPPED = 1_000
#: Rows of a task where persons' codes are gathered.
ROWS_OF_TASK = 250_000


def expand_codes(df: DataFrame, key: str, short: str, codes: DataFrame, code: str) -> DataFrame:
    """Lists like `1000:1010,1200` as one row for each code that the code table has."""
    items = df.select(key, F.explode(F.split(F.regexp_replace(short, r"\s", ""), ",")).alias("__item"))
    ends = items.select(key, F.split("__item", ":").alias("e"))
    each = ends.select(key, F.explode(F.sequence(F.element_at("e", 1).cast("int"), F.element_at("e", -1).cast("int"))).alias("__code"))
    known = codes.select(F.col(code), F.col(code).cast("int").alias("__code")).distinct()
    return each.distinct().join(known, "__code").select(key, code)


def groups_of_lists(alone_of: Column, any_of: Column, *more: Column, kind: str = "string") -> Column:
    """Different groups of a person from lists for each code: those that all codes have alone, those that any has, and others given."""
    none = F.array().cast(f"array<{kind}>")
    alone = F.aggregate(alone_of, F.coalesce(F.get(alone_of, F.lit(0)), none), lambda a, x: F.array_intersect(a, x))
    return F.array_distinct(F.concat(alone, F.flatten(any_of), *more))


def code_arrays(rows: DataFrame, person: str, code: str, name: str = "codes", most_rows: int | None = None) -> DataFrame:
    """One row for each person, with the array of their different codes.

    Rows are dealt into as many tasks as they need, about ROWS_OF_TASK in each,
    before they are gathered: arrays that map tasks begin have no bound but the
    size of a file's split. most_rows, where it is known, spares a count.
    """
    tasks = max(1, -(-(rows.count() if most_rows is None else most_rows) // ROWS_OF_TASK))
    return rows.select(person, code).repartition(tasks, person).groupBy(person).agg(F.collect_set(code).alias(name))


def code_groups(persons: DataFrame, person: str, codes: str, mapping: DataFrame, code: str, group: str, alone: str, *, once: bool = False) -> DataFrame:
    """(person, group) by the person's array of codes.

    mapping: code, group, and whether the group counts those who have its
    codes alone. Alone: all of a person's codes map to the group; otherwise any
    of them. Rows of one person count each for itself; once: there is one row
    for each person, so that no pair needs to be found twice.

    A code's groups become lists. Few codes are one broadcast row of maps, and a
    person's groups come from their own row, with no shuffle and no table in
    memory; more codes meet the persons' codes in a join, by the row.
    """
    kind = mapping.schema[group].dataType.simpleString()
    none = F.array().cast(f"array<{kind}>")
    of = lambda is_alone: F.array_distinct(F.transform(F.filter("__all", lambda g: F.coalesce(g["alone"], F.lit(True)) == is_alone), lambda g: g["grp"]))
    whole = mapping.filter(F.col(code).isNotNull()).groupBy(code).agg(F.collect_set(F.struct(F.col(group).alias("grp"), F.col(alone).alias("alone"))).alias("__all"))
    lists = staged(whole.select(F.col(code).alias("__code"), of(True).alias("__alone"), of(False).alias("__any")), "code-lists")
    n, entries = lists.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("__alone") + F.size("__any")), F.lit(0))).first()
    if n <= MOST_MAPPED and entries <= MOST_MAPPED * 100:
        maps = lists.agg(*[F.map_from_entries(F.collect_list(F.struct("__code", c))).alias(c) for c in ("__alone", "__any")])
        found = lambda c: F.transform(F.array_distinct(codes), lambda x: F.coalesce(F.try_element_at(F.col(c), x), none))
        out = persons.crossJoin(F.broadcast(maps)).select(person, F.explode(groups_of_lists(found("__alone"), found("__any"), kind=kind)).alias(group))
    else:
        numbered = staged(persons.select(F.col(person).alias("__person"), F.array_distinct(codes).alias("__codes")).withColumn("__row", F.monotonically_increasing_id()), "coded-persons")
        each = numbered.select("__person", "__row", F.explode("__codes").alias("__code")).join(F.broadcast(lists) if entries <= MOST_BROADCAST else lists, "__code", "left")
        found = lambda c: F.collect_list(F.coalesce(c, none))
        by_row = each.groupBy("__row", "__person").agg(groups_of_lists(found("__alone"), found("__any"), kind=kind).alias("__found"))
        out = by_row.select(F.col("__person").alias(person), F.explode("__found").alias(group))
    return out if once else out.distinct()


def regions_long(df: DataFrame, regions: dict[str, str], name: str = "REGION_ID", kind: str = "REGION_TYPE") -> DataFrame:
    """One row for each region that a row lies in: type -> column."""
    rest = [c for c in df.columns if c not in regions.values()]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias(kind), F.col(c).cast("string").alias(name)) for k, c in regions.items()]))
    return df.select(*rest, each.alias("__r")).select(*rest, "__r.*")


def _domain(persons: DataFrame, groups: Sequence[str], domain: DataFrame | None, noise: Callable) -> DataFrame:
    """The groups to count. Those that the rows have may only be read where counts are exact: with noise they would tell who exists."""
    if domain is not None:
        return domain
    if noise is not _exact:
        raise ValueError("noisy counts need a domain of groups that doesn't come from the rows")
    return persons.select(*groups).distinct()


def levels(persons: DataFrame, groups: Sequence[str], thresholds: Sequence[float], domain: DataFrame | None = None, noise: Callable = _exact) -> DataFrame:
    """First stage: each group's (noisy) total and the level that it earns."""
    totals = count(persons, _domain(persons, groups, domain, noise), "total", noise)
    return totals.withColumn("level", digitize(F.col("total"), thresholds))


def _cells(level: Column, sexes: Sequence[str]) -> Column:
    """The (sex, low, high) cells of a level's table."""
    out = F.array(F.struct(F.lit(ALL).alias("sex"), F.lit(ALL).alias("low"), F.lit(ALL).alias("high")))
    for at, edges in AGE_EDGES.items():
        starts = [0, *edges]
        ends = [*[e - 1 for e in edges], LAST_AGE]
        cells = F.array(*[F.struct(F.lit(s).alias("sex"), F.lit(str(a)).alias("low"), F.lit(str(b)).alias("high")) for s in sexes for a, b in zip(starts, ends, strict=True)])
        out = F.when(level == at, cells).otherwise(out)
    return out


def _low(level: Column, age: Column) -> Column:
    """The first age of an age's bin in a level's table."""
    out: Column = F.lit(ALL)
    for at, edges in AGE_EDGES.items():
        low = F.element_at(F.array(*[F.lit(str(a)) for a in (0, *edges)]), digitize(age, edges) + 1)
        out = F.when(level == at, low).otherwise(out)
    return out


def with_age_bins(persons: DataFrame, age: str = "age") -> DataFrame:
    """persons with the place of their age among each level's bins, from 0: age4, age9, age23."""
    return persons.withColumns({f"age{len(edges) + 1}": digitize(F.col(age), edges) for edges in AGE_EDGES.values()})


def adaptive_cells(persons: DataFrame, levelled: DataFrame, groups: Sequence[str], sexes: Sequence[str], sex: str = "sex", age: str = "age", noise: Callable = _exact) -> DataFrame:
    """Second stage: counts of every cell of every group's own table, empty cells included, in one aggregation."""
    own = staged(levelled.select(*groups, "level"), "levels")
    few = own.count() <= MOST_BROADCAST
    cells = own.select(*groups, "level", F.explode(_cells(F.col("level"), sexes)).alias("c")).select(*groups, "c.*")
    placed = persons.join(F.broadcast(own) if few else own, list(groups)).select(*groups, F.when(F.col("level") == 0, F.lit(ALL)).otherwise(F.col(sex)).alias("sex"), _low(F.col("level"), F.col(age)).alias("low"))
    counts = keyed(placed, cells.select(*groups, "sex", "low"), {"count": 0}, F.count(F.lit(1)).alias("count"))
    out = cells.join(counts, [*groups, "sex", "low"])
    return out.withColumn("count", noise(F.col("count"), 1, "INTEGER"))


def marginals(cells: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Totals of each group and of its sexes, from its cells, in one grouping."""
    fine = cells.filter(F.col("low") != ALL)
    sums = fine.groupingSets([list(groups), [*groups, "sex"]], *groups, "sex").agg(F.sum("count").alias("count"))
    return sums.select(*groups, F.coalesce("sex", F.lit(ALL)).alias("sex"), F.lit(ALL).alias("low"), F.lit(ALL).alias("high"), "count").unionByName(cells.filter(F.col("low") == ALL))


def with_marginals(cells: DataFrame, groups: Sequence[str]) -> DataFrame:
    return cells.filter(F.col("low") != ALL).unionByName(marginals(cells, groups))


def exact_cells(persons: DataFrame, levelled: DataFrame, groups: Sequence[str], sexes: Sequence[str]) -> DataFrame:
    """Exact counts, zeros included, of the cells of each group's own level."""
    return adaptive_cells(persons, levelled, groups, sexes)


def nested_cells(level: Column, sexes: Sequence[str]) -> Column:
    """The (sex, table, low, high) cells of a level's table and of all coarser ones; a bin that a coarser table of the level has is left out of the finer."""
    out, seen = F.array().cast("array<struct<sex:string,table:int,low:int,high:int>>"), set()
    for at, edges in AGE_EDGES.items():
        bins = [(a, b) for a, b in zip((0, *edges), (*[e - 1 for e in edges], LAST_AGE), strict=True) if (a, b) not in seen]
        seen |= set(bins)
        cells = F.array(*[F.struct(F.lit(s).alias("sex"), F.lit(at).alias("table"), F.lit(a).alias("low"), F.lit(b).alias("high")) for s in sexes for a, b in bins])
        out = F.when(level >= at, F.concat(out, cells)).otherwise(out)
    return out


def _table_of_level(level: Column, age: Column) -> Column:
    """For an age the (table, low) of each nested bin that it lies in, down to the level."""
    out, seen = [], set()
    for at, edges in AGE_EDGES.items():
        bins = list(zip((0, *edges), (*[e - 1 for e in edges], LAST_AGE), strict=True))
        new = [a for a, b in bins if (a, b) not in seen]
        seen |= set(bins)
        low = F.element_at(F.array(*[F.lit(a) for a, _ in bins]), digitize(age, edges) + 1)
        out.append(F.when((level >= at) & low.isin(new), F.struct(F.lit(at).alias("table"), low.alias("low"))))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def target_cells(persons: DataFrame, levelled: DataFrame, groups: Sequence[str], sexes: Sequence[str], sex: str = "sex", age: str = "age") -> tuple[DataFrame, DataFrame]:
    """Exact counts for the levels that an earlier run published: (totals of all groups, cells).

    levelled: groups with their level (see `characteristics.published_levels`).
    Every group has a total. A group of level 1 or more has a row for each sex,
    and the cells of its level's table and of all coarser tables, zeros
    included, in one aggregation over persons; a bin of two tables counts once.
    Rows: groups, sex, low, high (as text, `*` for all ages), count.
    """
    own = staged(levelled.select(*groups, F.col("level").cast("int").alias("level")), "levels")
    few = own.count() <= MOST_BROADCAST
    placed = persons.select(*groups, F.col(sex).alias("sex"), F.col(age).alias("age")).join(F.broadcast(own) if few else own, list(groups))
    # one row of every person for its total, its sex and each of its bins
    level = F.col("level")
    fine = F.transform(_table_of_level(level, F.col("age")), lambda x: F.struct(F.col("sex").alias("sex"), x["table"].alias("table"), x["low"].alias("low")))
    marks = F.array(F.struct(F.lit(ALL).alias("sex"), F.lit(0).alias("table"), F.lit(-1).alias("low")), F.when(level > 0, F.struct(F.col("sex").alias("sex"), F.lit(0).alias("table"), F.lit(-1).alias("low"))))
    each = placed.select(*groups, F.explode(F.concat(F.filter(marks, lambda x: x.isNotNull()), fine)).alias("c")).select(*groups, "c.*")
    counts = each.groupBy(*groups, "sex", "table", "low").agg(F.count(F.lit(1)).alias("count"))
    whole = lambda s: F.struct(F.lit(s).alias("sex"), F.lit(0).alias("table"), F.lit(-1).alias("low"), F.lit(-1).alias("high"))
    cells = F.concat(F.array(whole(ALL)), F.when(level > 0, F.array(*[whole(s) for s in sexes])).otherwise(F.array().cast("array<struct<sex:string,table:int,low:int,high:int>>")), nested_cells(level, sexes))
    domain = own.select(*groups, F.explode(cells).alias("c")).select(*groups, "c.*")
    full = keyed(counts, domain.select(*groups, "sex", "table", "low"), {"count": 0}, F.sum("count").alias("count")).join(domain, [*groups, "sex", "table", "low"])
    ages = [F.when(F.col(c) < 0, F.lit(ALL)).otherwise(F.col(c).cast("string")).alias(c) for c in ("low", "high")]
    rows = staged(full.select(*groups, "sex", *ages, "count"), "target-cells")
    return rows.filter(F.col("sex") == ALL).select(*groups, F.col("count").alias("COUNT")), rows.filter(F.col("sex") != ALL)


def workload(cells: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The level of a group by the number of its published rows: 1, or sexes x bins with marginals."""
    n = F.count(F.lit(1))
    return cells.groupBy(*groups).agg(n.alias("rows"))


def detail_totals(persons: DataFrame, groups: Sequence[str], domain: DataFrame | None = None, noise: Callable = _exact, scale: float = 0.0, chance: float = 0.0, negatives: bool = False) -> DataFrame:
    """Totals of groups that get no finer table: noisy counts, small ones suppressed, negatives cut to zero on request.

    chance: with which a group of nobody is suppressed; 0 keeps all.
    """
    out = count(persons, _domain(persons, groups, domain, noise), "count", noise)
    if chance > 0:
        out = suppressed(out, "count", suppression_threshold(scale, chance))
    return out if negatives else not_negative(out, "count")


def population_groups(persons: DataFrame, person: str, regions: dict[str, str], group_of: DataFrame, group: str) -> DataFrame:
    """One row for each person, region and characteristic; two key columns, no joined text."""
    return regions_long(persons.join(group_of.select(person, group), person), regions)


def shaped(table: DataFrame, groups: Sequence[str], names: dict[str, str]) -> DataFrame:
    """Output columns in order: groups, AGESTART, AGEEND, SEX (`*` for all, names for codes), COUNT."""
    sex = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col("sex")), F.col("sex"))
    return table.select(*groups, F.col("low").alias("AGESTART"), F.col("high").alias("AGEEND"), sex.alias("SEX"), F.col("count").alias("COUNT"))


def tabulation(persons: DataFrame, groups: Sequence[str], sexes: Sequence[str], thresholds: Sequence[float], *, domain: DataFrame | None = None, stage_one: Callable = _exact, stage_two: Callable = _exact, release: Callable[[DataFrame], DataFrame] = lambda df: df, negatives: bool = True) -> tuple[DataFrame, DataFrame]:
    """The whole run for all regions and characteristics at once: (totals, tables by sex and age).

    release materialises noisy results, so that the levels which choose the
    tables are the ones that are published.
    """
    levelled = release(levels(persons, groups, thresholds, domain, stage_one))
    cells = release(adaptive_cells(persons, levelled, groups, sexes, noise=stage_two))
    if not negatives:
        cells = not_negative(cells, "count")
    table = with_marginals(cells, groups)
    return table.filter((F.col("sex") == ALL) & (F.col("low") == ALL)).select(*groups, F.col("count").alias("COUNT")), table.filter(~((F.col("sex") == ALL) & (F.col("low") == ALL)))
