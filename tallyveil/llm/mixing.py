"""Mixing sources to target weights by exact word budgets.

Rows get a key that is random but fixed (a hash of seed and id) and are cut
into ranges of that key, so a hot source spreads over many tasks. Each range
is sorted on its own, prefix sums of the ranges' totals give every range its
start, and a row is taken when its place in its source's order lies below the
source's budget. Whole epochs come first, the rest of the budget is the head
of one more pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import staged

WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of the key that name a range: 16 ** 3 ranges in each source.
RANGE_DIGITS = 3


def word_count(text: Column) -> Column:
    """Number of words divided by ASCII white space; null counts as no words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """Targets from a table (source, size): source, source_size, target.

    Sources in order of code points, null last, get the weights in turn. They
    share `share` times all sizes by weight; a target stops at `limit` times
    its source's size, and what it can't use goes to the others by weight.
    That is filling to one common level: sorted by limit over weight, a source
    is at its limit while its ratio is not above the level of those left.
    The table of sources is a dimension: one row for each, ranked in one task.
    """
    by_code = Window.orderBy(F.col("source").asc_nulls_last())
    everywhere = Window.partitionBy()
    turn = F.array(*[F.lit(float(w)) for w in weights])
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(turn, ((F.row_number().over(by_code) - 1) % len(weights) + 1).cast("int")))
        .withColumn("most", F.col("source_size") * F.lit(float(limit)))
        .withColumn("ratio", F.col("most") / F.col("weight"))
    )
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everywhere) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    filled = sources.withColumn("place", F.row_number().over(by_ratio)).withColumn("level", level)
    open_ = F.when(F.col("ratio") > F.col("level"), F.col("place"))
    filled = filled.withColumn("first_open", F.min(open_).over(everywhere)).withColumn("open_level", F.max(F.when(F.col("place") == F.col("first_open"), F.col("level"))).over(everywhere))
    target = F.when(F.col("place") >= F.col("first_open"), F.col("open_level") * F.col("weight")).otherwise(F.col("most"))
    return filled.select("source", "source_size", target.alias("target"))


def _keyed(docs: DataFrame, id_col: str, source_col: str, size: Column, seed: str, row: Column | None) -> DataFrame:
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string")))
    return docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), key.alias("key"), F.substring(key, 1, RANGE_DIGITS).alias("span"),
        *([] if row is None else [row.alias("row")]),
    )


def _taken(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str, weights: Sequence[float], share: float, limit: float, row: Column | None) -> DataFrame:
    size = word_count(F.col(text_col))
    sized = staged(_keyed(docs, id_col, source_col, size, seed, None), "sizes")
    rows = sized if row is None else _keyed(docs, id_col, source_col, size, seed, row)
    targets = source_targets(sized, weights, share, limit)
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0)).cast("long")
    targets = targets.withColumn("budget", budget).withColumn("epochs", epochs).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    spans = sized.groupBy("source", "span").agg(F.sum("size").alias("span_size"))
    earlier = Window.partitionBy("source").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("span_start", F.coalesce(F.sum("span_size").over(earlier), F.lit(0)).cast("long")).drop("span_size")
    plan = spans.alias("p").join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source"))).select("p.source", "span", "span_start", "source_size", "target", "epochs", "rest")
    inside = Window.partitionBy("source", "span").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    both = placed.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.span") == F.col("p.span")))
    head = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("span_start") - F.col("before")))
    return both.select("id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + head).cast("long").alias("taken"), *([] if row is None else ["row"]))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, seed: str = "mix", weights: Sequence[float] = (5, 2, 1), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """One row for each row of docs: id, size, source_size, target, taken.

    size is the number of words (null text: 0), target the word budget of the
    row's source, taken the words that the mix takes from the row, repeats
    counted. Every source's sum of taken is the whole part of its target; the
    row at the cut is taken in part. The order depends on seed and id only, so
    reruns agree; equal ids go by size, and rows equal in both are alike. A
    null source is a source of its own, last in order; null ids share a key.
    An empty table gives no rows; other columns, whatever their names, play no
    part.
    """
    return _taken(docs, id_col, text_col, source_col, seed, weights, share, limit, None).withColumnRenamed("id", id_col)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, seed: str = "mix", weights: Sequence[float] = (5, 2, 1), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """The rows of docs that the mix takes anything from, with all their columns and mix_words (words to take, repeats counted).

    A column of docs called mix_words is replaced.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    out = _taken(docs, id_col, text_col, source_col, seed, weights, share, limit, row).filter("taken > 0")
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "mix_words"], F.col("taken").alias("mix_words"))


def mixture_sql(documents: str = "documents") -> str:
    """DuckDB SQL for `mixture` with its default parameters."""
    return f"""
sized AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
                 md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM {documents}),
by_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, CAST(list_value(5, 2, 1)[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight,
                   source_size * CAST(2 AS DOUBLE) AS most FROM by_source),
levels AS (SELECT *, row_number() OVER by_ratio AS place, most / weight AS ratio,
                  ((SELECT sum(source_size) FROM weighed) * CAST(1.5 AS DOUBLE) - coalesce(sum(most) OVER (by_ratio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(weight) OVER (by_ratio ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
           FROM weighed WINDOW by_ratio AS (ORDER BY most / weight, source NULLS LAST)),
opened AS (SELECT min(place) AS first_open FROM levels WHERE ratio > level),
targets AS (SELECT source, source_size, CASE WHEN place >= first_open THEN (SELECT level FROM levels l, opened o WHERE l.place = o.first_open) * weight ELSE most END AS target
            FROM levels, opened),
budgets AS (SELECT *, CAST(floor(target) AS BIGINT) AS budget, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM targets),
placed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sized),
mixed AS (SELECT p.doc_id, p.size, b.source_size, b.target,
                 CAST(epochs * p.size + greatest(0, least(p.size, budget - epochs * b.source_size - before)) AS BIGINT) AS taken
          FROM placed p JOIN budgets b ON p.source IS NOT DISTINCT FROM b.source)"""


OP7_SQL = f"WITH {mixture_sql()} SELECT doc_id, size, source_size, target, taken FROM mixed"
