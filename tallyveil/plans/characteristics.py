"""Persons' codes as characteristics, with a bound on the rows of a person, and run parameters by region type and level."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import count
from ..operators.noise import gaussian_bounds, gaussian_noise_by, geometric_noise_by, inverse_cdf, not_negative, released
from ..scratch import staged
from ..sources.sinks import write_delimited
from .tabulate import ALL, adaptive_cells, groups_of_lists, regions_long, with_marginals

#: Rows of a mapping up to which it is one broadcast row of maps, and ways into which the rows of a code are dealt beyond.
MOST_CODES = 100_000
LANES = 16
#: Region types whose tables are made of detailed groups; all others take coarse ones.
DETAILED = ("USA", "STATE", "PR-STATE")


def chosen(groups: DataFrame, *, kind: str | None = None, alone: bool | None = None, detailed_only: bool | None = None, coarse_only: bool | None = None, level: str | None = None) -> DataFrame:
    """Characteristics (group, kind, alone, detailed_only, coarse_only, level) that fit; None takes all.

    kind is "race" or "ethnicity"; only races are counted alone or in combination.
    """
    if detailed_only and coarse_only:
        raise ValueError("a group can't be both detailed only and coarse only")
    if alone is not None and kind != "race":
        raise ValueError("only races are counted alone or in combination")
    for column, value in {"kind": kind, "alone": alone, "detailed_only": detailed_only, "coarse_only": coarse_only, "level": level}.items():
        if value is not None:
            groups = groups.filter(F.col(column) == F.lit(value))
    return groups


def _found(alone_of: Column, any_of: Column, ethnic: Column) -> Column:
    """Sorted groups of a person from lists for each code: those that all codes have alone, those that any has, those of the ethnicity."""
    return F.array_sort(groups_of_lists(alone_of, any_of, ethnic))


@dataclass(frozen=True)
class Characteristics:
    """Which groups a code stands for, as one row of maps or, for large mappings, as a table of lists; and how many rows a person gets at most."""

    maps: DataFrame | None
    most_codes: int
    reach: int
    lists: DataFrame | None = None

    def of(self, persons: DataFrame, codes: str, ethnicity: str, name: str = "grp") -> DataFrame:
        """persons with a row for each of their characteristics, `reach` at most.

        codes: array of a person's race codes; more than most_codes are an error.
        Alone: groups that all codes have; in combination: groups that any code has.
        The maps are broadcast and take no shuffle. A table of lists is joined by
        the different codes of persons, whose lists then meet the persons again.
        """
        own = F.when(F.size(codes) > self.most_codes, F.raise_error(F.lit(f"a person has more than {self.most_codes} codes"))).otherwise(F.array_distinct(codes))
        none = F.array().cast("array<string>")
        if self.lists is not None:
            return self._joined(persons.withColumn("__own", own), ethnicity, name)
        wide = persons.crossJoin(F.broadcast(self.maps)).withColumn("__own", own)
        of = lambda kind, code: F.coalesce(F.try_element_at(f"__{kind}", code), none)
        found = _found(F.transform("__own", lambda c: of("alone", c)), F.transform("__own", lambda c: of("any", c)), of("ethnicity", F.col(ethnicity)))
        return wide.withColumn(name, F.explode(F.slice(found, 1, self.reach))).drop("__own", "__alone", "__any", "__ethnicity")

    def _joined(self, persons: DataFrame, ethnicity: str, name: str) -> DataFrame:
        """As `of`, by joins: one row for each code of a person (an ethnicity is one more) meets the code's lists, dealt out so that no frequent code is one task's."""
        none = F.array().cast("array<string>")
        numbered = staged(persons.withColumn("__row", F.monotonically_increasing_id()), "persons")
        race = F.transform("__own", lambda c: F.struct(F.lit(True).alias("race"), c.cast("string").alias("code")))
        every = F.explode(F.concat(race, F.array(F.struct(F.lit(False).alias("race"), F.col(ethnicity).cast("string").alias("code")))))
        each = numbered.select("__row", every.alias("c")).select("__row", "c.*", F.pmod(F.col("__row"), F.lit(LANES)).alias("lane"))
        dealt = self.lists.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))))
        met = each.join(dealt, ["code", "lane"], "left").select("__row", "race", *[F.coalesce(k, none).alias(k) for k in ("alone", "any", "ethnicity")])
        lists = lambda k, race: F.collect_list(F.when(F.col("race") == race, F.col(k)))
        by_row = met.groupBy("__row").agg(_found(lists("alone", True), lists("any", True), F.flatten(lists("ethnicity", False))).alias("__found"))
        return numbered.join(by_row, "__row").withColumn(name, F.explode(F.slice("__found", 1, self.reach))).drop("__own", "__row", "__found")


def characteristics(groups: DataFrame, mapping: DataFrame, most_codes: int, **choice) -> Characteristics:
    """groups: as in `chosen`; mapping: code, group. choice: detailed_only, coarse_only, level.

    reach = groups of a race code x max(2, most_codes) + groups of an ethnicity
    code: a person has at most most_codes codes in combination, and their
    groups alone are those of one code.
    """
    many = mapping.count() > MOST_CODES
    spark = groups.sparkSession
    kinds = {"alone": chosen(groups, kind="race", alone=True, **choice), "any": chosen(groups, kind="race", alone=False, **choice), "ethnicity": chosen(groups, kind="ethnicity", **choice)}
    maps, most, tables = spark.range(1).select(), {}, None
    for kind, own in kinds.items():
        lists = mapping.join(own.select("group"), "group", "left_semi").groupBy(F.col("code").cast("string").alias("code")).agg(F.array_sort(F.collect_set("group")).alias("own"))
        most[kind] = lists.agg(F.max(F.size("own"))).first()[0] or 0
        if many:
            own_lists = lists.withColumnRenamed("own", kind)
            tables = own_lists if tables is None else tables.join(own_lists, "code", "full")
            continue
        row = lists.agg(F.map_from_entries(F.collect_list(F.struct("code", "own"))).alias(f"__{kind}"))
        maps = row if not maps.columns else maps.crossJoin(row)
    reach = max(most["alone"], most["any"]) * max(2, most_codes) + most["ethnicity"]
    return Characteristics(None, most_codes, reach, staged(tables, "code-lists")) if many else Characteristics(maps, most_codes, reach)


def population_domain(regions: DataFrame, groups: DataFrame, plan: DataFrame) -> DataFrame:
    """The groups that a run makes, and how: REGION_TYPE, REGION_ID, grp, budget, thresholds, chance, totals_only.

    regions: REGION_TYPE, REGION_ID. plan: a row for each REGION_TYPE and level
    with budget, thresholds (array of three), chance. Pairs without a budget are
    left out, and so are coarse groups where region types take detailed ones
    and detailed groups elsewhere. Groups that are detailed only get totals only.
    """
    own = groups.select(F.col("group").alias("grp"), "level", "detailed_only", "coarse_only").join(F.broadcast(plan.filter("budget > 0")), "level")
    fine = F.col("REGION_TYPE").isin(*DETAILED)
    own = own.filter(F.when(fine, ~F.col("coarse_only")).otherwise(~F.col("detailed_only")))
    return regions.distinct().join(own, "REGION_TYPE").select("REGION_TYPE", "REGION_ID", "grp", "budget", "thresholds", "chance", F.col("detailed_only").alias("totals_only"))


GROUPS = ("REGION_TYPE", "REGION_ID", "grp")


def noise_of(budget: Column, reach: int, kind: str) -> Column:
    """What noise a budget asks for: the scale of geometric noise for epsilon, the variance of Gaussian noise for rho."""
    return F.lit(float(reach)) / budget if kind == "pure" else F.lit(float(reach) ** 2) / (2 * budget)


def _unsuppressed(df: DataFrame, reach: int, kind: str) -> DataFrame:
    """Rows whose COUNT passes what the noise of a group of nobody stays below with its chance; a chance of zero keeps all."""
    spread = noise_of(F.col("budget"), reach, kind)
    if kind == "pure":
        limited = df.withColumn("__limit", inverse_cdf("geometric", spread, F.col("chance")))
    else:
        limited = gaussian_bounds(df.withColumn("__spread", spread), "__spread", "chance", "__limit")
    return limited.filter((F.col("chance") <= 0) | (F.col("COUNT") > F.col("__limit")))


def planned_tabulation(persons: DataFrame, regions: dict[str, str], domain: DataFrame, sexes: Sequence[str], *, kind: str = "pure", reach: int = 1, first_share: float = 0.1, noisy: bool = True, release: Callable[[DataFrame], DataFrame] | None = None, negatives: bool = False) -> tuple[DataFrame, DataFrame]:
    """The whole run by `population_domain`: (totals, tables by sex and age).

    persons: one row for each person and characteristic (grp, sex, age and the
    region columns). Every group's counts get noise for its own budget, epsilon
    (kind "pure") or rho ("zcdp"), of which first_share pays for the total that
    chooses its table. Groups that get totals only spend all on it, and are
    suppressed where a group of nobody would be with their chance. reach: rows
    of one person. noisy=False gives exact counts. Totals and cells are written
    once, by release, so what chooses the tables is what is published.
    """
    if kind not in ("pure", "zcdp"):
        raise ValueError("budgets are pure (epsilon) or zcdp (rho)")
    release = release or (released if noisy else lambda df: staged(df, "planned"))
    on, long = list(GROUPS), regions_long(persons, regions)
    by_row = geometric_noise_by if kind == "pure" else gaussian_noise_by

    def with_noise(df: DataFrame, column: str, share: Column) -> DataFrame:
        return df.withColumn(column, by_row(F.col(column), noise_of(F.col("budget") * share, reach, kind))) if noisy else df

    counted = count(long, domain.select(*on), "total")
    totals = counted.join(domain, on)
    share = F.when(F.col("totals_only"), 1.0).otherwise(first_share)
    totals = release(with_noise(totals, "total", share))
    reached = F.size(F.filter("thresholds", lambda t: F.col("total") >= t))
    levelled = totals.withColumn("level", F.when(F.col("totals_only"), 0).otherwise(reached))
    single = levelled.filter("totals_only").withColumnRenamed("total", "COUNT")
    single = (_unsuppressed(single, reach, kind) if noisy else single).select(*on, "COUNT")
    cells = adaptive_cells(long, levelled.filter("NOT totals_only"), on, sexes)
    cells = with_noise(cells.join(domain.select(*on, "budget"), on), "count", F.lit(1 - first_share)).drop("budget")
    cells = release(cells)
    if not negatives:
        cells, single = not_negative(cells, "count"), not_negative(single, "COUNT")
    table = with_marginals(cells, on)
    whole = (F.col("sex") == ALL) & (F.col("low") == ALL)
    return single.unionByName(table.filter(whole).select(*on, F.col("count").alias("COUNT"))), table.filter(~whole)


def write_run(totals: DataFrame, tables: DataFrame, folder: str, names: dict[str, str] | None = None) -> None:
    """A run's two tables as delimited text with headers: t1 (totals), t2 (by sex and age, sexes under their names)."""
    folder = folder.rstrip("/")
    groups = [F.col("REGION_ID"), F.col("REGION_TYPE"), F.col("grp").alias("ITERATION_CODE")]
    sex = F.col("sex")
    for code, name in (names or {}).items():
        sex = F.when(F.col("sex") == code, F.lit(name)).otherwise(sex)
    write_delimited(totals.select(*groups, "COUNT"), f"{folder}/t1")
    write_delimited(tables.select(*groups, F.col("low").alias("AGESTART"), F.col("high").alias("AGEEND"), sex.alias("SEX"), F.col("count").alias("COUNT")), f"{folder}/t2")


#: Rows that are published for a group -> level of its table.
ROWS_OF_LEVEL = {1: 0, 10: 1, 20: 2, 48: 3}


def published_levels(tables: Sequence[DataFrame], groups: Sequence[str] = GROUPS) -> DataFrame:
    """groups, STAT_LEVEL: from the number of a group's rows in each run's output, the highest over all runs."""
    level = F.create_map(*[F.lit(x) for pair in ROWS_OF_LEVEL.items() for x in pair])
    out = None
    for t in tables:
        one = t.groupBy(*groups).agg(F.count(F.lit(1)).cast("int").alias("rows")).select(*groups, F.try_element_at(level, F.col("rows")).alias("STAT_LEVEL"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy(*groups).agg(F.max("STAT_LEVEL").alias("STAT_LEVEL"))
