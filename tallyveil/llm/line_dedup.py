"""Removal of lines that repeat across sites.

Every line is addressed by its SHA-256. One aggregation gives each line a
HyperLogLog sketch of the sites that it is on; a sketch has a bounded size, so
a line on many sites is one small row for each map task. Sketches decide all
lines that are clearly below or above the wanted number of sites. For the
lines near it, distinct pairs of line and site are counted. Lines on enough
sites are removed from every document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import staged

#: Distinct sites from which a line is boilerplate.
MIN_SITES = 10
#: Log2 of a sketch's slots; the standard error of an estimate is at most 1.04 / sqrt(2^12) = 1.7 %.
SLOTS = 12
#: Estimates within this share of the wanted number of sites (8 standard errors), or within NEAR sites, are counted exactly.
MARGIN = 0.14
NEAR = 2
#: Lines up to which a table of lines is broadcast (about 100 bytes each).
MOST_BROADCAST = 500_000
SALTS = 64
#: Spaces around a line that don't count.
BLANK = " \t\r"


def _pieces(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """All lines that aren't blank: id, body (hash of the text), at (from 0), site, line (SHA-256, spaces around it left out), salt."""
    body = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    each = docs.select(F.col(id_col).alias("id"), body.alias("body"), F.col(site_col).cast("string").alias("site"), F.posexplode(_pieces(F.col(text_col))).alias("at", "piece"))
    each = each.withColumn("piece", F.btrim("piece", F.lit(BLANK))).filter("piece <> ''")
    salt = F.pmod(F.xxhash64("id", "body", "at"), F.lit(SALTS)).cast("int")
    return each.select("id", "body", "at", "site", F.unhex(F.sha2("piece", 256)).alias("line"), salt.alias("salt"))


def line_sites(found: DataFrame) -> DataFrame:
    """line, sites: a sketch of each line's sites. Null sites are no site; tables of several corpora merge by hll_union_agg(sites)."""
    site = F.concat(F.lit("s"), F.col("site"))  # sketches leave out empty strings
    return found.groupBy("line").agg(F.hll_sketch_agg(site, SLOTS).alias("sites"))


def _of(found: DataFrame, table: DataFrame) -> DataFrame:
    """The rows of found whose line is in table (distinct lines), which is broadcast while its count allows that; beyond, both sides are salted."""
    if table.count() <= MOST_BROADCAST:
        return found.join(F.broadcast(table), "line", "left_semi")
    return found.join(table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["line", "salt"], "left_semi")


def boilerplate(found: DataFrame, *, min_sites: int = MIN_SITES) -> DataFrame:
    """Lines of `lines` that are on at least min_sites distinct sites: line."""
    margin = max(NEAR, math.ceil(min_sites * MARGIN))
    guess = staged(line_sites(found).select("line", F.hll_sketch_estimate("sites").alias("guess")).filter(F.col("guess") >= min_sites - margin), "line-guesses")
    near = guess.filter(F.col("guess") <= min_sites + margin).select("line")
    counted = _of(found, near).filter("site IS NOT NULL").select("line", "site").distinct().groupBy("line").count().filter(F.col("count") >= min_sites)
    return staged(guess.filter(F.col("guess") > min_sites + margin).select("line").unionByName(counted.select("line")), "boilerplate")


def _marked(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_sites: int) -> DataFrame:
    """docs as a struct `row`, with id, pieces, and gone: places of removed lines, or null."""
    found = lines(docs, id_col, text_col, site_col)
    hits = _of(found, boilerplate(found, min_sites=min_sites)).groupBy("id", "body").agg(F.collect_set("at").alias("gone"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("body"))
    both = rows.alias("d").join(hits.alias("h"), F.col("d.id").eqNullSafe(F.col("h.id")) & (F.col("d.body") == F.col("h.body")), "left")
    return both.select("row", F.col("d.id").alias("id"), _pieces(F.col(f"row.`{text_col}`")).alias("pieces"), "gone")


def _kept() -> Column:
    every = F.array_join("pieces", "\n")
    return F.when(F.col("gone").isNull(), every).otherwise(F.array_join(F.filter("pieces", lambda _, at: ~F.array_contains("gone", at)), "\n"))


def line_spread(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", *, min_sites: int = MIN_SITES) -> DataFrame:
    """One row for each row of docs: id, n_lines, n_removed, kept_sha256.

    Lines lie between line feeds; spaces, tabs and carriage returns around
    them don't count for equality. Blank lines stay and are not counted. Of
    all other lines those on at least min_sites distinct sites are removed,
    wherever they stand; a null site counts as none. kept_sha256 digests the
    text that remains. Null text counts as empty; repeated rows give repeated
    results; an empty table gives no rows. Other columns play no part.
    """
    marked = _marked(docs.select(*dict.fromkeys([id_col, text_col, site_col])), id_col, text_col, site_col, min_sites)
    n_lines = F.size(F.filter("pieces", lambda p: F.btrim(p, F.lit(BLANK)) != "")).cast("long")
    n_removed = F.coalesce(F.size("gone"), F.lit(0)).cast("long")
    return marked.select(F.col("id").alias(id_col), n_lines.alias("n_lines"), n_removed.alias("n_removed"), F.sha2(_kept(), 256).alias("kept_sha256"))


def without_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", *, min_sites: int = MIN_SITES) -> DataFrame:
    """docs without the lines that `line_spread` removes; null texts stay null."""
    marked = _marked(docs, id_col, text_col, site_col, min_sites)
    text = F.when(F.col("gone").isNull(), F.col(f"row.`{text_col}`")).otherwise(_kept())
    return marked.select(*[(text if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


OP4_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, source, string_split(coalesce(text, ''), chr(10)) AS pieces FROM documents),
l AS (SELECT k, source, i, pieces[i] AS piece, trim(pieces[i], ' ' || chr(9) || chr(13)) AS line FROM (SELECT *, unnest(range(1, len(pieces) + 1)) AS i FROM d)),
b AS (SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}),
n AS (SELECT k, count(*) FILTER (l.line <> '') AS n_lines, count(b.line) AS n_removed, string_agg(piece, chr(10) ORDER BY i) FILTER (b.line IS NULL) AS kept
      FROM l LEFT JOIN b USING (line) GROUP BY k)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d JOIN n USING (k)
"""
