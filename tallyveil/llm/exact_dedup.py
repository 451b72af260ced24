"""Exact duplicates, found by salted merging of content groups.

Rows meet in three stages, and each compares whole texts, not only digests:

1. locally: every map task merges its own equal texts (partial aggregation);
2. salted: the tasks' results merge per (digest, salt, text), so one hot text
   is spread over `salts` reducers;
3. globally: the at most `salts` winners of a text merge into one.

Only ids, digests and winners travel back to the rows. A digest that stands
for two different texts is noticed, and its rows are matched by text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import staged

SALTS = 64


def _members(docs: DataFrame, id_col: str, text_col: str, salts: int, digest: Callable[[Column], Column], row: Column | None) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        digest(text).alias("digest"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int").alias("salt"),
        text.alias("text"),
        *([] if row is None else [row.alias("row")]),
    )


def _winners(members: DataFrame) -> DataFrame:
    """One row for each (digest, text): keep_id, group_size and the salts that hold its rows."""
    salted = members.groupBy("digest", "salt", "text").agg(F.max("id").alias("id"), F.count(F.lit(1)).alias("n"))
    return salted.groupBy("digest", "text").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"), F.collect_list("salt").alias("salts"))


def _matched(docs: DataFrame, id_col: str, text_col: str, salts: int, digest: Callable[[Column], Column], row: Column | None) -> DataFrame:
    members = _members(docs, id_col, text_col, salts, digest, row)
    found = _winners(members).select("digest", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size", "salts")
    found = staged(found, "exact-groups")
    unclear = found.groupBy("digest").count().filter("count > 1").select("digest")
    on = ["digest", "salt"]
    columns = ["id", "keep_id", "group_size", "text_sha256", "digest", "salt", *([] if row is None else ["row"])]
    if unclear.isEmpty():
        out = members.drop("text").join(found.withColumn("salt", F.explode("salts")), on).select(*columns)
    else:
        plain = found.join(unclear, "digest", "left_anti").withColumn("salt", F.explode("salts"))
        mixed = members.join(unclear, "digest", "left_semi")
        texts = _winners(mixed).withColumn("text_sha256", F.sha2("text", 256)).withColumn("salt", F.explode("salts"))
        out = members.drop("text").join(plain, on).select(*columns).unionByName(mixed.join(texts, [*on, "text"]).select(*columns))
    same = Window.partitionBy("digest", "salt", "text_sha256", "id").orderBy("id")
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")) & (F.row_number().over(same) == 1))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, salts: int = SALTS, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row for each row of docs: id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and all empty texts are one group. Of equal
    texts the row with the largest id stays; null ids come before all others,
    and a group of null ids only has a null keep_id. Of rows that repeat both
    text and id, one is kept. An empty table gives no rows. Other columns,
    whatever their names, play no part.
    """
    out = _matched(docs, id_col, text_col, salts, digest, None)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, salts: int = SALTS, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """The rows of docs that `exact_groups` keeps, with all their columns, whatever their names; exactly one for each text.

    Null and empty texts are one group, of which one row stays; ties of id and
    text leave one row; null ids lose to all others; an empty table gives no rows.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return _matched(docs, id_col, text_col, salts, digest, row).filter("kept").select("row.*")


OP2_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT *, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
             row_number() OVER (PARTITION BY text, doc_id) AS copy_no FROM d)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size,
       doc_id IS NOT DISTINCT FROM keep_id AND copy_no = 1 AS kept, sha256(text) AS text_sha256
FROM g
"""
