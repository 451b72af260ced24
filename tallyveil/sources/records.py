"""Layouts of unit, person and count-control records: where each field stands and what it may hold.

A record that breaks a rule is not an error of the job: `broken_fields` names
the fields that are wrong, and such rows can be put aside.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .readers import Field, parse_fixed, parse_piped

# Fields, positions (from, to), and what is allowed.
#   codes a b c    one of these texts; shorter values are filled with spaces on the left
#   number a-b c   a whole number in one of these ranges, spaces around it left out
#   text a-b       between two texts of the field's width, with spaces inside read as zeros
#   whole          any whole number;  any: any text;  or blank: spaces only are allowed too

UNIT = """
RTYPE 0-1 codes 2 4
MAFID 1-10 number 100000001-899999999
BCUSTATEFP 10-12 text 01-02 04-06 08-13 15-42 44-51 53-56 72-72
VERSION 12-17 number 0-99999
FINAL_POP 17-22 text 0-99999
HHLDRAGE 22-25 text 15-115 or blank
HHSPAN 25-26 codes 1 2 or blank
HHLDRACE 26-27 codes 1 2 3 4 5 6 or blank
HHRACE 27-29 codes 01..63 or blank
TEN 29-30 codes 0..4
TEN_A 30-31 codes 0..4
TEN_R 31-32 codes 0..4
VACS 32-33 codes 0..7
QGQTYP 33-36 codes 101 102 103 104 105 106 201 202 203 301 401 402 403 404 405 501 601 602 701 702 704 706 801 802 900 901 903 904 or blank
GQSEX 36-37 codes 1 2 3 or blank
OIDTB 37-59 whole
HHT 59-60 codes 0..7
HHT2 60-62 codes 00..12
CPLT 62-63 codes 0..5
UPART 63-64 codes 0..5
MULTG 64-65 codes 0..2
PAOC 65-66 codes 0..4
P18 66-68 number 0-99
P60 68-70 number 0-99
P65 70-72 number 0-99
P75 72-74 number 0-99
PAC 74-75 codes 0..4
HHSEX 75-76 codes 0..2
"""
PERSON = """
RTYPE 0-1 codes 3 5
MAFID 1-10 number 100000001-899999999
CUF_PNC 10-15 number 1-99999
BCUSTATEFP 15-17 text 01-02 04-06 08-13 15-42 44-51 53-56 72-72
VERSION 17-22 number 0-99999
QSEX 22-23 codes 1 2
QAGE 23-26 number 0-115
QDB 26-34 number 19040402-20200401
QDOB_MONTH 34-36 number 1-12
QDOB_DAY 36-38 number 1-31
QDOB_YEAR 38-42 number 1904-2020
QSPAN 42-46 number 1000-8999 9000 9100 9200 9500 9900 9950
QSPANX 46-47 codes 1..7
CENHISP 47-48 number 1-2
QRACE1 48-52 number 1000-8999 9000 9500 9900
QRACE2 52-56 number 1000-8999 9000 9500 9900 or blank
QRACE3 56-60 number 1000-8999 9000 9500 9900 or blank
QRACE4 60-64 number 1000-8999 9000 9500 9900 or blank
QRACE5 64-68 number 1000-8999 9000 9500 9900 or blank
QRACE6 68-72 number 1000-8999 9000 9500 9900 or blank
QRACE7 72-76 number 1000-8999 9000 9500 9900 or blank
QRACE8 76-80 number 1000-8999 9000 9500 9900 or blank
QRACEX 80-81 codes 1..6
CENRACE 81-83 codes 01..63
RACE2010 83-85 codes 01..31
RELSHIP 85-87 codes 20..38
QGQTYP 87-90 codes 101 102 103 104 105 106 201 202 203 301 401 402 403 404 405 501 601 602 701 702 704 706 801 802 900 901 903 904 or blank
LIVE_ALONE 90-91 codes 0..2
"""
CONTROL = """
BCUSTATEFP 0-2 any
VERSION 2-7 whole
COUNT_UNIT 7-17 whole
COUNT_UNIT_HU 17-27 whole
COUNT_UNIT_GQ 27-37 whole
COUNT_PER 37-47 whole
COUNT_PER_HU 47-57 whole
COUNT_PER_GQ 57-67 whole
"""


@dataclass(frozen=True)
class RecordField:
    """A field of a record, and what it may hold."""

    name: str
    start: int
    end: int
    kind: str
    allowed: tuple[str, ...]
    blank: bool

    def valid(self) -> Column:
        x, width = F.col(self.name), self.end - self.start
        fits = F.length(x) <= width
        if self.kind == "any":
            good = x.isNotNull()
        elif self.kind == "codes":
            good = fits & F.lpad(x, width, " ").isin([c.rjust(width) for c in self.allowed])
        elif self.kind == "text":
            filled, number = F.lpad(F.replace(x, F.lit(" "), F.lit("0")), width, " "), x.try_cast("double")
            inside = [F.when(F.contains(x, F.lit(".")) & number.isNotNull(), number.between(float(a), float(b))).otherwise(filled.between(a.rjust(width), b.rjust(width))) for a, b in self.ranges()]
            good = fits & reduce(Column.__or__, inside)
        else:
            number = F.trim(x).try_cast("decimal(38,0)")
            good = F.trim(x).rlike("^[+-]?[0-9]+$") & (number.isNotNull() if self.kind == "whole" else reduce(Column.__or__, [number.between(int(a), int(b)) for a, b in self.ranges()]))
        if self.blank:
            good = good | (x == " " * width)
        return F.coalesce(good & (x != "None"), F.lit(False))

    def ranges(self) -> list[tuple[str, str]]:
        return [tuple((a + "-" + a).split("-")[:2]) if "-" not in a else tuple(a.split("-")) for a in self.allowed]


def record(text: str) -> tuple[RecordField, ...]:
    """Fields from the lines of a layout."""
    out = []
    for line in filter(str.strip, text.splitlines()):
        line, blank, _ = line.partition(" or blank")
        name, span, kind, *allowed = line.split()
        start, end = map(int, span.split("-"))
        every: list[str] = []
        for a in allowed:
            low, dots, high = a.partition("..")
            every += [str(i).zfill(len(low)) for i in range(int(low), int(high) + 1)] if dots else [a]
        out.append(RecordField(name, start, end, kind, tuple(every), bool(blank)))
    return tuple(out)


def _fields(layout: Sequence[RecordField]) -> list[Field]:
    return [Field(f.name, f.start, f.end) for f in layout]


def fixed_records(lines: DataFrame, layout: Sequence[RecordField], column: str = "value") -> DataFrame:
    """The fields of fixed-width lines, as text."""
    return parse_fixed(lines, _fields(layout), column)


def piped_records(lines: DataFrame, layout: Sequence[RecordField], column: str = "value") -> DataFrame:
    """The fields of lines divided by |, as text, and well_formed: whether a line has as many as the layout."""
    return parse_piped(lines, _fields(layout), column)


def broken_fields(records: DataFrame, layout: Sequence[RecordField], name: str = "broken") -> DataFrame:
    """records with the names of the fields that break their rules, in the layout's order; null fields break theirs."""
    return records.withColumn(name, F.array_compact(F.array(*[F.when(~f.valid(), F.lit(f.name)) for f in layout])))


def field_report(records: DataFrame, layout: Sequence[RecordField]) -> DataFrame:
    """field, checked, broken: one row for each field, from one scan.

    Every record gives the names of its broken fields, and one empty name; these are counted.
    """
    names = broken_fields(records, layout, "__broken").select(F.explode(F.concat(F.array(F.lit("")), "__broken")).alias("field"))
    counts = names.groupBy("field").agg(F.count(F.lit(1)).alias("n"))  # at most one row for each field, and one
    one = counts.agg(F.map_from_entries(F.collect_list(F.struct("field", "n"))).alias("of"))
    of = lambda name: F.coalesce(F.try_element_at("of", name), F.lit(0).cast("long"))
    each = one.select("of", F.explode(F.array(*[F.lit(f.name) for f in layout])).alias("field"))
    return each.select("field", of(F.lit("")).alias("checked"), of(F.col("field")).alias("broken"))
