"""Delimited, fixed-width and commented text files as typed tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def delimited(spark: SparkSession, paths: str | Sequence[str], schema: str, *, sep: str = "|", only: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Files with a header row and a fixed schema, filtered to listed values of columns (pushed into the scan)."""
    df = spark.read.csv(paths if isinstance(paths, str) else list(paths), schema=schema, sep=sep, header=True)
    for column, values in (only or {}).items():
        df = df.filter(F.col(column).isin(list(values)))
    return df


def templated_paths(template: str, states: Sequence[str], special: dict[str, str] | None = None) -> list[str]:
    """One path for each state: the template's {state}, or another template for listed states."""
    return [(special or {}).get(s, template).format(state=s) for s in states]


@dataclass(frozen=True)
class Field:
    """A field of a fixed-width record: from start (0-based) to end (exclusive)."""

    name: str
    start: int
    end: int
    kind: str = "string"

    def of(self, line: Column) -> Column:
        text = F.substring(line, self.start + 1, self.end - self.start)
        return text if self.kind == "string" else F.trim(text).try_cast(self.kind)


def parse_fixed(lines: DataFrame, layout: Sequence[Field], column: str = "value") -> DataFrame:
    """Typed fields of fixed-width lines; what is no number becomes null, and short lines give empty fields."""
    return lines.select(*[f.of(F.col(column)).alias(f.name) for f in layout])


def parse_piped(lines: DataFrame, layout: Sequence[Field], column: str = "value", sep: str = r"\|") -> DataFrame:
    """Typed fields of delimited lines, and whether a line has as many fields as the layout (well_formed)."""
    parts = F.split(F.col(column), sep, -1)
    part = lambda i: F.get(parts, F.lit(i))
    fields = [(part(i) if f.kind == "string" else F.trim(part(i)).try_cast(f.kind)).alias(f.name) for i, f in enumerate(layout)]
    return lines.select(*fields, (F.size(parts) == len(layout)).alias("well_formed"))


def fixed_width(spark: SparkSession, paths: str | Sequence[str], layout: Sequence[Field]) -> DataFrame:
    return parse_fixed(spark.read.text(paths if isinstance(paths, str) else list(paths)), layout)


def piped(spark: SparkSession, paths: str | Sequence[str], layout: Sequence[Field]) -> DataFrame:
    return parse_piped(spark.read.text(paths if isinstance(paths, str) else list(paths)), layout)


def layout_of(text: str) -> list[Field]:
    """Fields from lines of `NAME start-end [kind]`."""
    out = []
    for line in filter(str.strip, text.splitlines()):
        name, span, *kind = line.split()
        start, end = map(int, span.split("-"))
        out.append(Field(name, start, end, *kind))
    return out


def file_counts(df: DataFrame) -> DataFrame:
    """Records of every file that df reads, in one job."""
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("records"))


def totals_in_scope(totals: DataFrame, states: Sequence[str], areas: DataFrame, *, nation: str = "USA", state_types: Sequence[str] = ("STATE", "COUNTY", "TRACT", "PLACE"), area_type: str = "AIANNH", region: str = "REGION_ID", kind: str = "REGION_TYPE", area: str = "AIANNHCE") -> DataFrame:
    """Group totals of the nation, of regions in the states, and of areas that the geography has."""
    prefixed = F.col(kind).isin(list(state_types)) & F.substring(F.col(region), 1, 2).isin(list(states))
    first = totals.filter((F.col(kind) == nation) | prefixed)
    known = areas.select(F.col(area).alias("__area")).distinct()
    second = totals.filter(F.col(kind) == area_type).join(known, F.col(region) == F.col("__area"), "left_semi")
    return first.unionByName(second)


def persons(person: DataFrame, unit: DataFrame, geography: DataFrame, *, unit_key: str = "mafid", block_key: str = "block_id", relation: str = "relship", householder: Sequence[str] = ("20",), codes: Sequence[str] = ()) -> DataFrame:
    """Person records with their unit and block: upper-case names, blank codes as "Null", and HOUSEHOLDER."""
    out = person.join(unit, unit_key).join(geography, block_key)
    out = out.withColumn("HOUSEHOLDER", F.col(relation).isin(list(householder)))
    out = out.withColumns({c: F.regexp_replace(F.col(c), r"^\s*$", "Null") for c in codes})
    return out.toDF(*[c.upper() for c in out.columns])


def units(person: DataFrame, unit: DataFrame, geography: DataFrame, *, unit_key: str = "mafid", block_key: str = "block_id", relation: str = "relship", householder: Sequence[str] = ("20",), household_type: str = "hht", recodes: dict[int, int] | None = None, codes: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """Units with their householder and block, without those of household type 0: types recoded, blank codes as "Null", upper-case names, and of columns those that are asked for."""
    out = unit.filter(F.col(household_type) != 0).join(person.filter(F.col(relation).isin(list(householder))), unit_key).join(geography, block_key)
    kind = F.col(household_type)
    for old, new in (recodes or {6: 4, 7: 5}).items():
        kind = F.when(F.col(household_type) == old, new).otherwise(kind)
    out = out.withColumns({household_type: kind, **{c: F.regexp_replace(F.col(c), r"^\s*$", "Null") for c in codes}})
    out = out.toDF(*[c.upper() for c in out.columns])
    return out.select(*columns) if columns else out


def geography_of_units(geography: DataFrame, unit: DataFrame, block_key: str = "block_id") -> DataFrame:
    """One row for each block that units are in; geography columns are null where it has none."""
    return geography.join(unit.select(block_key).distinct(), block_key, "right_outer")


def related_persons(unit: DataFrame, person: DataFrame, *, unit_key: str = "mafid", relation: str = "relship", related: Sequence[str] = (), size: str = "final_pop") -> DataFrame:
    """Units with the number of persons related to the householder: households of two or more; a count of one or less is zero."""
    counts = person.groupBy(unit_key).agg(F.sum(F.when(F.col(relation).isin(list(related)), 1).otherwise(0)).alias("related"))
    counts = counts.filter("related > 1")
    out = unit.join(counts, unit_key, "left")
    return out.withColumn("related", F.when(F.col(size) >= 2, F.coalesce("related", F.lit(0))).otherwise(0).cast("long"))


#: Relationships of persons who are family of a householder, the householder included; and the type of units that are households. Fixed values.
FAMILY = ("20", "21", "23", "25", "26", "27", "28", "29", "30", "31", "32", "33")
HOUSEHOLD = 2
PERSON_COLUMNS = ("RTYPE", "MAFID", "QAGE", "CENHISP", "CENRACE", "RELSHIP")
UNIT_COLUMNS = ("RTYPE", "MAFID", "FINAL_POP", "NPF", "HHSPAN", "HHRACE", "TEN", "HHT", "HHT2", "CPLT")
PLACE_COLUMNS = ("RTYPE", "MAFID", "TABBLKST", "TABBLKCOU", "TABTRACTCE", "TABBLK", "TABBLKGRPCE", "REGIONCE", "DIVISIONCE", "PLACEFP", "AIANNHCE")


def _upper(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def household_records(person: DataFrame, unit: DataFrame, *, family: Sequence[str] = FAMILY, household: int = HOUSEHOLD, columns: Sequence[str] | None = UNIT_COLUMNS) -> DataFrame:
    """Units with what their persons say: upper-case names, NPF, whole numbers, and blank races as "00".

    NPF: persons of family relationships in households (by RTYPE) of two or
    more; one such person, none, and other units give 0. Persons are counted by
    unit before they meet the units, so a large unit is one partial sum for each
    task, and units are shuffled once, on their id. Spaces for HHSPAN are 0.
    Persons without a unit count nowhere; units with a null id have no persons.
    """
    person, unit = _upper(person), _upper(unit)
    number = lambda c: F.expr(f"try_cast(trim({c}) AS BIGINT)")
    related = person.groupBy("MAFID").agg(F.sum(F.col("RELSHIP").isin(list(family)).cast("long")).alias("__n")).filter("__n > 1")
    both = unit.withColumns({"FINAL_POP": number("CAST(FINAL_POP AS STRING)"), "HHSPAN": F.coalesce(number("CAST(HHSPAN AS STRING)"), F.lit(0).cast("long"))}).join(related, "MAFID", "left")
    full = (F.col("FINAL_POP") >= 2) & (F.col("RTYPE").cast("int") == household)
    out = both.withColumn("NPF", F.when(full, F.coalesce("__n", F.lit(0))).otherwise(0).cast("long")).withColumn("HHRACE", F.regexp_replace("HHRACE", r"^\s+$", "00")).drop("__n")
    return out.select(*columns) if columns else out


def household_persons(person: DataFrame, columns: Sequence[str] = PERSON_COLUMNS) -> DataFrame:
    return _upper(person).select(*columns)


def household_places(unit: DataFrame, geography: DataFrame, *, block: str = "OIDTB", place: str = "OIDTABBLK", columns: Sequence[str] = PLACE_COLUMNS) -> DataFrame:
    """A row for each unit whose block the geography has, with the block's places."""
    own = _upper(unit).select("RTYPE", "MAFID", F.col(block).cast("long").alias("__block"))
    geo = _upper(geography).withColumn("__block", F.col(place).cast("long"))
    return own.join(geo, "__block").select(*columns)


#: What orders lines: their file, the block of it that a task read, and a number that grows along the block.
PLACE = ("path", "block", "at")


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a file, or of a folder's files by their names, with their PLACE.

    Scans deal out files by size, not by name, so numbers that grow over tasks tell the order of lines in one block only.
    """
    own = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")]
    return spark.read.text(path).select("value", *own, F.monotonically_increasing_id().alias("at"))


def commented(spark: SparkSession, path: str, sep: str = ",") -> tuple[DataFrame, list[str], DataFrame]:
    """Comment lines (#), the header's names (of the first other line), and the data lines of a text file, or of a folder whose files go by their names."""
    lines = _numbered(spark, path)
    note = F.col("value").startswith("#")
    comments, rest = lines.filter(note).select("value"), lines.filter(~note)
    first = rest.orderBy(*PLACE).first()
    names = first["value"].split(sep) if first else []
    return comments, names, rest.filter(F.col("value") != (first["value"] if first else "")).select("value")


def join_commented(spark: SparkSession, paths: Sequence[str], folder: str, sep: str = ",") -> None:
    """Concatenates commented files with one header: comments first, each file's record count among them; lines keep their order, over as many tasks as they need."""
    parts = [commented(spark, p, sep) for p in paths]
    if len({tuple(names) for _, names, _ in parts}) != 1:
        raise ValueError("the files' headers differ")
    counts = [f"# {p}: {data.count()} records" for p, (_, _, data) in zip(paths, parts, strict=True)]
    out = spark.createDataFrame([(0, 0, "", 0, i, c) for i, c in enumerate(counts)] + [(2, 0, "", 0, 0, sep.join(parts[0][1]))], "part int, file int, path string, block long, at long, value string")
    note = F.col("value").startswith("#")
    for i, p in enumerate(paths):
        lines = _numbered(spark, p).filter(note | (F.col("value") != sep.join(parts[0][1])))
        out = out.unionByName(lines.select(F.when(note, 1).otherwise(3).alias("part"), F.lit(i).alias("file"), *PLACE, "value"))
    order = ("part", "file", *PLACE)
    out.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.mode("overwrite").text(folder)
