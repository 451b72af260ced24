"""Removal of benchmark passages from training text.

The benchmark's windows of consecutive words become a hashed set, broadcast
while its counted size allows that and joined by shuffle beyond. One pass over
the documents hashes every window of words, looks it up, and holds the words
of a hit against the benchmark's, so that equal hashes alone never count.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import staged

WINDOW = 10
#: Between words and in words, before A-Z are lowered and after.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: Windows of a benchmark up to which their set is broadcast (about 100 bytes each).
MOST_BROADCAST = 1_000_000
SALTS = 16


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BREAK + "+"), "")


def benchmark_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text", *, window: int = WINDOW) -> DataFrame:
    """Distinct (item, width, hash, gram) of the items' windows; an item with fewer words than `window`, but not none, is one."""
    split = items.select(F.col(item_col).alias("item"), words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    width = F.least(F.size("w"), F.lit(window))
    each = split.select("item", "w", width.alias("width"), F.explode(F.sequence(F.lit(1), F.size("w") - width + 1)).alias("at"))
    gram = F.slice("w", F.col("at"), F.col("width"))
    return each.select("item", "width", F.xxhash64(gram).alias("hash"), F.array_join(gram, " ").alias("gram")).distinct()


def _row(id_col: str, text_col: str) -> list[Column]:
    """What tells documents apart: the id, and a hash of the text in case ids repeat."""
    return [F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("body")]


def _hits(docs: DataFrame, grams: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per document with hits: id, body, at (sorted struct<start, width>, words from 0), grams."""
    known = grams.select("width", "hash", "gram").distinct()
    widths = [r.width for r in known.select("width").distinct().orderBy("width").collect()]  # as many as a window has words
    split = docs.select(*_row(id_col, text_col), words(F.col(text_col)).alias("w"))
    placed = split.select("id", "body", "w", F.posexplode("w").alias("start", "first"))
    if len(widths) == 1:
        placed = placed.withColumn("width", F.lit(widths[0]))
    else:
        placed = placed.withColumn("width", F.explode(F.array(*[F.lit(w) for w in widths])) if widths else F.lit(WINDOW))
    piece = F.slice("w", F.col("start") + 1, F.col("width"))
    seen = placed.filter(F.col("start") + F.col("width") <= F.size("w"))
    if known.count() <= MOST_BROADCAST:
        seen = seen.withColumn("hash", F.xxhash64(piece)).alias("d")
        same = (F.col("d.hash") == F.col("k.hash")) & (F.col("d.width") == F.col("k.width")) & (F.array_join(piece_of("d"), " ") == F.col("k.gram"))
        joined = seen.join(F.broadcast(known.alias("k")), same)
    else:
        # Only hashes are shuffled for all windows; the words of those that are known are then fetched and compared.
        hashed = seen.select("id", "body", "start", "width", F.xxhash64(piece).alias("hash")).join(known.select("width", "hash").distinct(), ["width", "hash"], "left_semi")
        found = hashed.groupBy("id", "body").agg(F.collect_set(F.struct("start", "width", "hash")).alias("found")).alias("f")
        back = split.alias("s").join(found, F.col("s.id").eqNullSafe(F.col("f.id")) & (F.col("s.body") == F.col("f.body"))).select("s.id", "s.body", "w", F.explode("found").alias("x"))
        back = back.select("id", "body", F.col("x.start").alias("start"), F.col("x.width").alias("width"), F.col("x.hash").alias("hash"), F.array_join(F.slice("w", F.col("x.start") + 1, F.col("x.width")), " ").alias("gram")).alias("d")
        joined = back.join(known.alias("k"), (F.col("d.hash") == F.col("k.hash")) & (F.col("d.width") == F.col("k.width")) & (F.col("d.gram") == F.col("k.gram")))
    hits = joined.select("d.id", "d.body", F.col("d.start").alias("start"), F.col("d.width").alias("width"), F.col("k.gram").alias("gram"))
    return hits.groupBy("id", "body").agg(F.array_sort(F.collect_set(F.struct("start", "width"))).alias("at"), F.collect_set("gram").alias("grams"))


def piece_of(side: str) -> Column:
    return F.slice(F.col(f"{side}.w"), F.col(f"{side}.start") + 1, F.col(f"{side}.width"))


def _covered(at: Column) -> Column:
    """Number of words under sorted, overlapping windows."""
    first = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(seen: Column, x: Column) -> Column:
        end = x["start"] + x["width"]
        return F.struct(F.greatest(seen["end"], end).alias("end"), (seen["n"] + F.greatest(F.lit(0), end - F.greatest(seen["end"], x["start"]))).alias("n"))

    return F.aggregate(at, first, step, lambda seen: seen["n"])


def _items_of(hits: DataFrame, grams: DataFrame) -> DataFrame:
    """hits with the items of their windows; a window that a third of all documents have is spread over salts where the windows aren't broadcast."""
    if grams.count() <= MOST_BROADCAST:
        return hits.join(F.broadcast(grams), "gram")
    salted = grams.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return hits.withColumn("salt", F.pmod(F.xxhash64("id", "body"), F.lit(SALTS)).cast("int")).join(salted, ["gram", "salt"]).drop("salt")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", *, window: int = WINDOW) -> DataFrame:
    """One row for each document: id, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are runs of letters, digits and all non-ASCII characters, with A-Z
    lowered. n_hit counts the words inside any occurrence of a window, n_items
    the items with an occurring window; items_sha256 digests their ids, sorted
    as strings. Null text has no words; a null item id counts as an item and
    is left out of the digest. Repeated documents give repeated rows. Empty
    tables on either side give no hits or no rows.
    """
    grams = staged(benchmark_windows(items, item_col, item_text_col, window=window), "benchmark-windows")
    hits = staged(_hits(docs, grams, id_col, text_col).select("id", "body", _covered(F.col("at")).alias("n_hit"), "grams"), "window-hits")
    listed = _items_of(hits.select("id", "body", F.explode("grams").alias("gram")), grams.select("gram", F.struct(F.col("item").cast("string").alias("item")).alias("item")))
    listed = listed.groupBy("id", "body").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = hits.drop("grams").alias("h").join(listed.alias("l"), F.col("h.id").eqNullSafe(F.col("l.id")) & (F.col("h.body") == F.col("l.body"))).select("h.id", "h.body", "n_hit", "items")
    counted = docs.select(*_row(id_col, text_col), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD + "+")), F.lit(0)).cast("long").alias("n_words"))
    both = counted.alias("d").join(found.alias("f"), F.col("d.id").eqNullSafe(F.col("f.id")) & (F.col("d.body") == F.col("f.body")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    names = F.array_join(F.transform(F.coalesce("items", F.array().cast("array<struct<item:string>>")), lambda x: x["item"]), ",")
    return both.select(F.col("d.id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def _with_hits(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, window: int) -> DataFrame:
    grams = staged(benchmark_windows(items, item_col, item_text_col, window=window), "benchmark-windows")
    hits = staged(_hits(docs, grams, id_col, text_col).select("id", "body", "at"), "window-hits")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_row(id_col, text_col))
    return rows.alias("d").join(hits.alias("h"), F.col("d.id").eqNullSafe(F.col("h.id")) & (F.col("d.body") == F.col("h.body")), "left").select("row", "at")


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", *, window: int = WINDOW) -> DataFrame:
    """The documents without any benchmark window, with all their columns, whatever their names.

    Null and empty texts have no window and stay; repeated rows stay or go
    together; null items and items without words give no window; an empty
    table on either side gives no rows or takes none away.
    """
    return _with_hits(docs, items, id_col, text_col, item_col, item_text_col, window).filter("at IS NULL").select("row.*")


def without_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", *, window: int = WINDOW) -> DataFrame:
    """All documents, with the hit words (and the breaks before them) cut from their texts.

    Texts without a hit stay as they are, null ones too; overlapping windows
    are cut once; repeated rows are cut alike; an empty table gives no rows.
    """
    both = _with_hits(docs, items, id_col, text_col, item_col, item_text_col, window)
    text = F.col(f"row.`{text_col}`")
    pieces = F.regexp_extract_all(text, F.lit(f"{BREAK}*{WORD}+"), F.lit(0))
    kept = F.filter(pieces, lambda _, i: ~F.exists("at", lambda x: (x["start"] <= i) & (i < x["start"] + x["width"])))
    cut = F.when(F.col("at").isNull(), text).otherwise(F.concat(F.array_join(kept, ""), F.regexp_extract(text, f"{BREAK}*$", 0)))
    return both.select(*[(cut if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, width, array_to_string(w[i:i + width - 1], ' ') AS gram
      FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS i FROM (SELECT *, least(len(w), 10) AS width FROM b WHERE len(w) > 0))),
x AS (SELECT k, i, width, array_to_string(w[i:i + width - 1], ' ') AS gram
      FROM (SELECT k, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM d, (SELECT DISTINCT width FROM g))),
h AS (SELECT DISTINCT k, i, x.width, item_id FROM x JOIN g ON x.gram = g.gram AND x.width = g.width),
n AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + width)) AS p FROM h) GROUP BY k),
t AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (k) LEFT JOIN t USING (k)"""
