"""Registered queries over the driver's tables, each beside SQL that gives the same rows.

Noisy operators run without a budget limit here, where they are exact.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .operators import aggregates, contributions, diff, joins, keys, noise, prefix, quality, quantile, rows, special, truncate
from .operators.bins import Bins
from .plans import budget, characteristics, report, tabulate
from .plans.builder import Query as Steps
from .sources import readers, records, sinks
from .scratch import new_folder
from .spec import ColumnSpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


FLAGS = {"l_returnflag": ["N", "A", "R", "X"], "l_linestatus": ["O", "F"]}
FLAG_KEYS = "(VALUES ('N'), ('A'), ('R'), ('X')) a(f) CROSS JOIN (VALUES ('O'), ('F')) b(s)"
FLAG_JOIN = f"FROM {FLAG_KEYS} LEFT JOIN lineitem l ON l.l_returnflag = a.f AND l.l_linestatus = b.s GROUP BY a.f, b.s"


def flag_keys(spark: SparkSession) -> DataFrame:
    return keys.keys_from_values(spark, FLAGS)


# keyed aggregates


@query(f"SELECT a.f AS l_returnflag, b.s AS l_linestatus, count(l.l_orderkey) AS n {FLAG_JOIN}")
def keyed_count(spark, d):
    return aggregates.count(table(spark, d, "lineitem"), flag_keys(spark), "n")


@query("""
WITH e AS (SELECT CASE WHEN user_id % 7 = 0 THEN NULL ELSE event_type END AS kind FROM events), k AS (SELECT DISTINCT kind FROM e UNION ALL SELECT 'absent')
SELECT k.kind, count(e.one) AS n FROM k LEFT JOIN (SELECT *, 1 AS one FROM e) e ON e.kind IS NOT DISTINCT FROM k.kind GROUP BY k.kind""")
def keyed_count_null_key(spark, d):
    e = table(spark, d, "events").select(F.when(F.col("user_id") % 7 != 0, F.col("event_type")).alias("kind"))
    listed = e.distinct().union(keys.keys_from_values(spark, {"kind": ["absent"]}))
    return aggregates.count(e, listed, "n")


@query("SELECT count(*) AS n FROM events")
def count_total(spark, d):
    return aggregates.count(table(spark, d, "events"), None, "n")


@query("SELECT DISTINCT p_brand, n_name FROM part, nation")
def keyset_product(spark, d):
    return keys.keys_product(keys.keys_from_rows(table(spark, d, "part"), ["p_brand"]), keys.keys_from_rows(table(spark, d, "nation"), ["n_name"]))


@query("SELECT DISTINCT p_brand FROM part WHERE p_size > 45 AND p_brand LIKE '%1'")
def keyset_filter_select(spark, d):
    return keys.keys_from_rows(table(spark, d, "part"), ["p_brand", "p_size"]).filter("p_size > 45 AND p_brand LIKE '%1'").select("p_brand").distinct()


@query("""SELECT NOT EXISTS (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer) AND NOT EXISTS (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) AS equal,
NOT EXISTS (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer) AS contains""")
def keyset_equality(spark, d):
    return keys.same_keys(table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "orders").select(F.col("o_custkey").alias("k")))


@query("SELECT event_type, count(*) AS n FROM (SELECT DISTINCT event_type, user_id FROM events) GROUP BY event_type")
def count_distinct_cols(spark, d):
    e = table(spark, d, "events")
    return aggregates.count_distinct(e, ["user_id"], keys.keys_from_rows(e, ["event_type"]), "n")


@query("SELECT count(*) AS n FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_shipdate FROM lineitem)")
def count_distinct_rows(spark, d):
    return aggregates.count_distinct(table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_shipdate"), name="n")


@query(f"SELECT a.f AS l_returnflag, b.s AS l_linestatus, CAST(coalesce(sum(CASE WHEN l_extendedprice IS NOT NULL THEN CAST(round(least(greatest(l_extendedprice, 2000.0), 50000.0) * 100) AS BIGINT) END), 0) AS DOUBLE) / 100 AS total {FLAG_JOIN}")
def bounded_sum(spark, d):
    return aggregates.bounded_sum(table(spark, d, "lineitem"), "l_extendedprice", 2000.0, 50000.0, flag_keys(spark), "total", scale_digits=2)


@query("SELECT CAST(sum(least(greatest(c_nationkey, 3), 20)) AS BIGINT) AS total FROM customer")
def bounded_sum_total(spark, d):
    return aggregates.bounded_sum(table(spark, d, "customer").select(F.col("c_nationkey").cast("long")), "c_nationkey", 3, 20, None, "total")


def clamped_quantity(of: str) -> str:
    return f"SELECT a.f AS l_returnflag, b.s AS l_linestatus, {of} {FLAG_JOIN}"


Q = "CASE WHEN l_quantity IS NOT NULL THEN least(greatest(l_quantity, 5.0), 45.0) END"


@query(clamped_quantity(f"round(coalesce(sum(({Q}) - 25.0) / count(l_quantity), 0) + 25.0, 4) AS mean"))
def bounded_average(spark, d):
    out = aggregates.average(table(spark, d, "lineitem"), "l_quantity", 5.0, 45.0, flag_keys(spark), "mean")
    return out.withColumn("mean", F.round("mean", 4))


VARIANCE = f"CASE WHEN count(l_quantity) <= 1 THEN 1025.0 - 625.0 ELSE greatest(0.0, least(400.0, sum(({Q}) * ({Q}) - 1025.0) / count(l_quantity) + 1025.0 - pow(sum(({Q}) - 25.0) / count(l_quantity) + 25.0, 2))) END"


@query(clamped_quantity(f"round({VARIANCE}, 4) AS var"))
def bounded_variance(spark, d):
    out = aggregates.variance(table(spark, d, "lineitem"), "l_quantity", 5.0, 45.0, flag_keys(spark), "var")
    return out.withColumn("var", F.round("var", 4))


@query(clamped_quantity(f"round(sqrt({VARIANCE}), 4) AS sd"))
def bounded_stdev(spark, d):
    out = aggregates.stdev(table(spark, d, "lineitem"), "l_quantity", 5.0, 45.0, flag_keys(spark), "sd")
    return out.withColumn("sd", F.round("sd", 4))


@query("SELECT o_orderstatus, round((count(*) * sum(x * x) - sum(x) * sum(x)) / (CAST(count(*) AS DOUBLE) * count(*)) / 1e12, 2) AS var FROM (SELECT o_orderstatus, CAST(least(greatest(CAST(o_orderkey AS BIGINT) * 99991, 0), 5000000000) AS HUGEINT) AS x FROM orders) GROUP BY o_orderstatus")
def variance_wide(spark, d):
    """Whole numbers whose squares pass 64 bits in a sum."""
    o = table(spark, d, "orders").select("o_orderstatus", (F.col("o_orderkey").cast("long") * 99991).alias("x"))
    out = aggregates.variance(o, "x", 0, 5_000_000_000, keys.keys_from_rows(o, ["o_orderstatus"]), "var")
    return out.withColumn("var", F.round(F.col("var") / 1e12, 2))


# quantiles


def gap_sql(q: float) -> str:
    return f"""
WITH v AS (SELECT o_orderpriority AS k, least(greatest(o_totalprice, 1000.0), 400000.0) AS v FROM orders),
n AS (SELECT k, count(*) AS n FROM v GROUP BY k),
e AS (SELECT DISTINCT k, v FROM v WHERE v > 1000.0 AND v < 400000.0 UNION ALL SELECT DISTINCT k, 400000.0 FROM v),
g AS (SELECT e.k, coalesce(lag(e.v) OVER (PARTITION BY e.k ORDER BY e.v), 1000.0) AS l, e.v AS r FROM e),
c AS (SELECT k, v, coalesce(sum(m) OVER (PARTITION BY k ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT k, v, sum(m) AS m FROM (SELECT k, v, 1 AS m FROM v UNION ALL SELECT k, r, 0 FROM g) GROUP BY k, v)),
s AS (SELECT g.k, l, r, abs(below - {q} * n) AS off FROM g JOIN c ON g.k = c.k AND g.r = c.v JOIN n ON n.k = g.k)
SELECT k AS o_orderpriority, l AS "left", r AS "right" FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY off, l DESC, r DESC) AS pos FROM s) WHERE pos = 1"""


def _gap(spark: SparkSession, d: str, q: float) -> DataFrame:
    o = table(spark, d, "orders")
    return quantile.quantile_gap(o, "o_totalprice", q, 1000.0, 400000.0, keys.keys_from_rows(o, ["o_orderpriority"]))


@query(gap_sql(0.9))
def quantile_gap(spark, d):
    return _gap(spark, d, 0.9)


@query(gap_sql(0.5))
def median_gap(spark, d):
    return _gap(spark, d, 0.5)


@query(gap_sql(0))
def min_gap(spark, d):
    return _gap(spark, d, 0)


@query(gap_sql(1))
def max_gap(spark, d):
    return _gap(spark, d, 1)


@query("SELECT CAST(0 AS DOUBLE) AS \"left\", CASE WHEN count(*) = 0 THEN CAST(50 AS DOUBLE) END AS \"right\" FROM lineitem WHERE l_quantity < -1")
def quantile_gap_empty(spark, d):
    """No rows pass: the whole range is the only gap, as it is for a key without rows."""
    return quantile.quantile_gap(table(spark, d, "lineitem").filter("l_quantity < -1"), "l_quantity", 0.5, 0.0, 50.0)


# bins


@query("""
SELECT b.name AS bin, count(l.l_quantity) AS count FROM (VALUES ('[0, 10)', 0, 10, false), ('[10, 25)', 10, 25, false), ('[25, 50]', 25, 50, true)) b(name, lo, hi, closed)
LEFT JOIN lineitem l ON l.l_quantity >= lo AND (l.l_quantity < hi OR closed AND l.l_quantity = hi) GROUP BY b.name""")
def histogram_left(spark, d):
    return aggregates.histogram(table(spark, d, "lineitem").select(F.col("l_quantity").cast("long")), "l_quantity", Bins((0, 10, 25, 50), right=False), "bin")


@query("""
SELECT b.name AS bin, count(l.l_quantity) AS count FROM (VALUES ('low', 1, 10, false), ('high', 10, 40, true)) b(name, lo, hi, later)
LEFT JOIN lineitem l ON l.l_quantity <= hi AND (l.l_quantity > lo OR NOT later AND l.l_quantity = lo) GROUP BY b.name""")
def histogram_right(spark, d):
    return aggregates.histogram(table(spark, d, "lineitem"), "l_quantity", Bins((1.0, 10.0, 40.0), names=("low", "high")), "bin")


ODD_VALUE = "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 11 = 1 THEN CAST('NaN' AS DOUBLE) WHEN event_id % 11 = 2 THEN CAST('Infinity' AS DOUBLE) WHEN event_id % 11 = 3 THEN CAST('-Infinity' AS DOUBLE) ELSE value END"


def odd_events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "event_type", F.expr(ODD_VALUE).alias("value"))


@query(f"""
SELECT event_id, CASE WHEN isnan(value) THEN 'none' WHEN value > 0 AND value <= 20 THEN '(0.00, 20.00]' WHEN value > 20 AND value <= 60.5 THEN '(20.00, 60.50]' END AS bin
FROM (SELECT event_id, {ODD_VALUE} AS value FROM events)""")
def bin_with_nan(spark, d):
    bins = Bins((0.0, 20.0, 60.5), both=False, nan="none")
    return odd_events(spark, d).select("event_id", bins.column(F.col("value"), floating=True).alias("bin"))


@query("SELECT o_orderkey, CAST(o_totalprice >= 50000 AS INTEGER) + CAST(o_totalprice >= 150000 AS INTEGER) + CAST(o_totalprice >= 250000 AS INTEGER) AS bin FROM orders")
def digitized(spark, d):
    return table(spark, d, "orders").select("o_orderkey", rows.digitize(F.col("o_totalprice"), [50000, 150000, 250000]).alias("bin"))


@query("""
SELECT p_partkey, CASE WHEN p_size >= 30 THEN 30 WHEN p_size >= 10 THEN 10 ELSE 0 END AS low, CASE WHEN p_size >= 30 THEN 115 WHEN p_size >= 10 THEN 29 ELSE 9 END AS high FROM part""")
def bin_ranges(spark, d):
    return table(spark, d, "part").select("p_partkey", rows.bin_range(rows.digitize(F.col("p_size"), [10, 30]), [10, 30], 115).alias("r")).select("p_partkey", "r.*")


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) >= 12")
def partition_selection(spark, d):
    return aggregates.common_rows(table(spark, d, "events").select("user_id"), 12, "n")


# joins


@query("SELECT o_orderkey, o_custkey, c_name, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey")
def public_join(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    return joins.join(o, c)


@query("SELECT c_nationkey AS key, c_name AS name_left, n_name AS name_right FROM customer JOIN nation ON c_nationkey = n_nationkey")
def public_join_overlap(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("key"), F.col("c_name").alias("name"))
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    return joins.join(c, n, ["key"])


@query("SELECT max(n) AS most FROM (SELECT count(*) AS n FROM customer GROUP BY c_nationkey)")
def public_join_fanout(spark, d):
    return joins.fanout(table(spark, d, "customer"), ["c_nationkey"])


def content_sql(*columns: str) -> str:
    return f"sha256(concat_ws('|', {', '.join(columns)}))"


def order_of(*columns: str) -> str:
    return f"md5(concat_ws('|', {', '.join(f'CAST({c} AS VARCHAR)' for c in columns)})), {', '.join(columns)}"


@query(f"""
WITH o AS (SELECT * FROM (SELECT o_orderkey, o_custkey AS key, row_number() OVER (PARTITION BY o_custkey ORDER BY {order_of("o_orderkey", "o_custkey")}) AS pos FROM orders) WHERE pos <= 2),
c AS (SELECT * FROM (SELECT c_custkey, c_nationkey AS key, row_number() OVER (PARTITION BY c_nationkey ORDER BY {order_of("c_custkey", "c_nationkey")}) AS pos FROM customer) WHERE pos <= 3)
SELECT o.key, o_orderkey, c_custkey FROM o JOIN c ON o.key = c.key""")
def private_join_truncate(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("key"))
    return joins.join_private(o, c, ["key"], 2, 3)


@query("""
SELECT o.o_custkey AS key, o_orderkey, l_linenumber FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) o
JOIN (SELECT *, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem) l ON l.l_suppkey = o.o_custkey WHERE o.n <= 9 AND l.n <= 580""")
def private_join_drop(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    line = table(spark, d, "lineitem").select("l_linenumber", F.col("l_suppkey").alias("key"))
    return joins.join_private(o, line, ["key"], 9, 580, drop=True)


@query("SELECT o_orderkey AS id, o_custkey, l_linenumber FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def join_on_id(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    return joins.join(o, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber"), ["id"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12)")
def superseded_totals(spark, d):
    c = table(spark, d, "customer").filter("c_nationkey < 12").select(F.col("c_custkey").alias("o_custkey"))
    return joins.supersede(table(spark, d, "orders").select("o_orderkey", "o_custkey"), c, ["o_custkey"])


@query("""
SELECT c_custkey, n_nationkey FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN lower(n_name) ELSE CAST(n_nationkey AS VARCHAR) END AS place FROM customer JOIN nation ON c_nationkey = n_nationkey) c
LEFT JOIN nation n ON c.place = lower(n.n_name) OR c.place = CAST(n.n_nationkey AS VARCHAR)""")
def place_lookup(spark, d):
    n = table(spark, d, "nation")
    c = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.lower("n_name")).otherwise(F.col("n_nationkey").cast("string")).alias("place"))
    return joins.lookup(c, n.withColumn("code", F.col("n_nationkey").cast("string")), "place", ["n_name", "code"], "n_nationkey").drop("place")


# group truncation


@query(f"""
SELECT event_id, user_id, event_type FROM (SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY {order_of("event_id", "user_id", "event_type")}) AS pos FROM events) WHERE pos <= 3""")
def truncate_rows(spark, d):
    return truncate.truncate_groups(table(spark, d, "events").select("event_id", "user_id", "event_type"), ["user_id"], 3)


@query("SELECT o_orderkey, o_custkey FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE n <= 15")
def drop_large_groups(spark, d):
    return truncate.drop_large_groups(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"], 15)


@query(f"""
WITH p AS (SELECT DISTINCT user_id, event_type FROM events),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {order_of("user_id", "event_type")}) AS pos FROM p) WHERE pos <= 2)
SELECT event_id, user_id, event_type FROM events SEMI JOIN k USING (user_id, event_type)""")
def limit_keys(spark, d):
    return truncate.limit_keys(table(spark, d, "events").select("event_id", "user_id", "event_type"), ["user_id"], ["event_type"], 2)


# special values


@query(f"SELECT event_id, event_type, CASE WHEN value IS NULL OR isnan(value) THEN -1.5 ELSE value END AS value FROM (SELECT event_id, event_type, {ODD_VALUE} AS value FROM events)")
def replace_null_nan(spark, d):
    return special.replace_null_and_nan(odd_events(spark, d), {"value": -1.5})


@query(f"SELECT event_id, event_type, value FROM (SELECT event_id, event_type, {ODD_VALUE} AS value FROM events) WHERE value IS NOT NULL AND NOT isnan(value)")
def drop_null_nan(spark, d):
    return special.drop_null_and_nan(odd_events(spark, d), ["value"])


@query(f"SELECT event_id, event_type, CASE WHEN value = CAST('Infinity' AS DOUBLE) THEN 9.0 WHEN value = CAST('-Infinity' AS DOUBLE) THEN -9.0 ELSE value END AS value FROM (SELECT event_id, event_type, {ODD_VALUE} AS value FROM events)")
def replace_inf(spark, d):
    return special.replace_infinity(odd_events(spark, d), {"value": (-9.0, 9.0)})


@query(f"SELECT event_id, event_type, value FROM (SELECT event_id, event_type, {ODD_VALUE} AS value FROM events) WHERE value IS NULL OR NOT isinf(value)")
def drop_inf(spark, d):
    return special.drop_infinity(odd_events(spark, d))


@query(f"SELECT CAST(count(*) FILTER (value IS NULL) AS BIGINT) AS value_null, CAST(count(*) FILTER (isnan(value)) AS BIGINT) AS value_nan, CAST(count(*) FILTER (isinf(value)) AS BIGINT) AS value_inf FROM (SELECT {ODD_VALUE} AS value FROM events)")
def special_counts(spark, d):
    return special.special_counts(odd_events(spark, d).select("value"))


# rows


@query("SELECT o_orderkey AS key, o_custkey % 10 AS bucket, o_orderstatus FROM orders WHERE o_totalprice > 100000 AND o_orderstatus <> 'P'")
def select_filter_map(spark, d):
    o = rows.where(table(spark, d, "orders"), "o_totalprice > 100000 AND o_orderstatus <> 'P'")
    o = rows.map_columns(o, {"bucket": F.col("o_custkey") % 10, "o_orderkey": F.lit(0)}, augment=True)
    return rows.rename(rows.select(o, ["o_orderkey", "bucket", "o_orderstatus"]), {"o_orderkey": "key"})


@query("SELECT n_name AS r_name, r_name AS n_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def rename_swap(spark, d):
    both = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")
    return rows.rename(both, {"n_name": "r_name", "r_name": "n_name"})


@query("SELECT o_orderkey, o_custkey * 2 + length(o_orderpriority) AS code FROM orders")
def map_python(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return rows.map_rows(o, lambda r: {"o_orderkey": r["o_orderkey"], "code": r["o_custkey"] * 2 + len(r["o_orderpriority"])}, "o_orderkey long, code long")


@query("SELECT doc_id, unnest(string_split(text, ' ')[1:5]) AS word FROM documents")
def flat_map_limit(spark, d):
    return rows.flat_map(table(spark, d, "documents").select("doc_id", "text"), F.split("text", " "), 5, "word").select("doc_id", "word")


@query("SELECT DISTINCT p_partkey, unnest(list_slice([p_brand, p_type, p_brand, p_name], 1, 3)) AS grp FROM part")
def grouping_flat_map(spark, d):
    p = table(spark, d, "part")
    return rows.grouping_flat_map(p, F.array("p_brand", "p_type", "p_brand", "p_name"), 3, "grp").select("p_partkey", "grp")


@query("""SELECT o_custkey, o_orderstatus, hex(CAST(to_json([CAST(o_custkey AS VARCHAR), o_orderstatus, CAST(n AS VARCHAR)]) AS VARCHAR)) AS id
FROM (SELECT o_custkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey, o_orderstatus) AS n FROM orders)""")
def unique_id(spark, d):
    return rows.unique_id(table(spark, d, "orders").select("o_custkey", "o_orderstatus"), "id")


@query("SELECT l_returnflag, row_number() OVER (PARTITION BY l_returnflag) AS n FROM lineitem")
def numbered_copies(spark, d):
    """Three values only, each in a third of all rows or so."""
    return prefix.copy_numbers(table(spark, d, "lineitem").select("l_returnflag"), ["l_returnflag"], "n")


@query("SELECT c_custkey, CASE WHEN c_nationkey = 6 THEN 4 WHEN c_nationkey = 7 THEN 5 ELSE c_nationkey END AS kind, CASE WHEN c_custkey % 3 = 0 THEN 'Null' ELSE c_mktsegment END AS segment, CAST(c_custkey * 2 + 1 AS BIGINT) AS next FROM customer")
def recoded(spark, d):
    c = table(spark, d, "customer").withColumn("s", F.when(F.col("c_custkey") % 3 == 0, "  ").otherwise(F.col("c_mktsegment")))
    c = rows.recode(c, {"twice": "c_custkey * 2", "next": "twice + 1"})
    return c.select("c_custkey", rows.relabel(F.col("c_nationkey"), {6: 4, 7: 5}).alias("kind"), rows.blank_to(F.col("s")).alias("segment"), "next")


@query("SELECT c_custkey, 'c_nationkey' AS kind, CAST(c_nationkey AS BIGINT) AS id FROM customer UNION ALL SELECT c_custkey, 'c_custkey', c_custkey FROM customer")
def unpivot_regions(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").cast("long"), "c_custkey")
    return rows.unpivot(c, ["k"], ["c_nationkey", "c_custkey"], "kind", "id").withColumnRenamed("k", "c_custkey")


@query("""
SELECT c_custkey, lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS STATE, lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS COUNTY,
CASE WHEN c_mktsegment = 'BUILDING' THEN 'NULL' ELSE lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || c_mktsegment END AS PLACE, '1' AS NATION FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def region_columns(spark, d):
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.select("c_custkey", F.lpad(F.col("n_regionkey").cast("string"), 2, "0").alias("st"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("cou"), F.col("c_mktsegment").alias("pl"))
    return rows.region_columns(c, {"STATE": (["st"], {}), "COUNTY": (["st", "cou"], {}), "PLACE": (["st", "pl"], {"pl": "BUILDING"})}, "1").drop("st", "cou", "pl")


# noise and its after-care


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > ceil(-2.0 * ln((1 - 0.999) * (1 + exp(-1 / 2.0))) - 1)")
def suppress_small(spark, d):
    o = table(spark, d, "orders")
    out = aggregates.count(o, keys.keys_from_rows(o, ["o_custkey"]), "n", noise.mechanism(float("inf")))
    return noise.suppressed(out, "n", noise.suppression_threshold(2.0, 0.999))


@query("SELECT o_orderkey, greatest(o_custkey - 700, 0) AS n FROM orders")
def clamp_negative(spark, d):
    return noise.not_negative(table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") - 700).alias("n")), "n")


@query("""
SELECT l_linenumber, round(CASE WHEN p = 0.5 THEN 0 ELSE -scale * sign(p - 0.5) * ln(1 - 2 * abs(p - 0.5)) END, 6) AS bound
FROM (SELECT DISTINCT l_linenumber, l_linenumber * 0.125 AS p, l_linenumber * 1.5 AS scale FROM lineitem WHERE l_linenumber < 8)""")
def noise_bounds(spark, d):
    line = table(spark, d, "lineitem").select("l_linenumber").filter("l_linenumber < 8").distinct()
    return line.select("l_linenumber", F.round(noise.inverse_cdf("laplace", F.col("l_linenumber") * 1.5, F.col("l_linenumber") * 0.125), 6).alias("bound"))


MASSES = """w AS (SELECT DISTINCT v FROM g), m AS (SELECT v, k, exp(-k * k / (2 * v)) AS m FROM (SELECT v, unnest(range(-CAST(ceil(9 * sqrt(v)) AS BIGINT) - 1, CAST(ceil(9 * sqrt(v)) AS BIGINT) + 2)) AS k FROM w)),
t AS (SELECT v, sum(m) AS total FROM m GROUP BY v), c AS (SELECT m.v, k, sum(m) OVER (PARTITION BY m.v ORDER BY k) / total AS below FROM m JOIN t ON m.v = t.v)"""


@query(f"""
WITH g AS (SELECT o_orderkey, (o_orderkey % 7 + 1) * (o_orderkey % 7 + 1) / 0.5 AS v, (o_orderkey % 997 + 1) / 1000.0 AS p FROM orders), {MASSES}
SELECT o_orderkey, CAST(min(k) AS BIGINT) AS bound FROM g JOIN c ON g.v = c.v AND below >= p GROUP BY o_orderkey""")
def noise_bounds_gaussian(spark, d):
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").select(k, ((k % 7 + 1) * (k % 7 + 1) / F.lit(0.5)).alias("v"), ((k % 997 + 1) / F.lit(1000.0)).alias("p"))
    return noise.gaussian_bounds(o, "v", "p", "bound").select("o_orderkey", "bound")


@query("""
WITH g AS (SELECT DISTINCT CAST(l_linenumber AS DOUBLE) AS v FROM lineitem), m AS (SELECT v, k, exp(-k * k / (2 * v)) AS m FROM (SELECT v, unnest(range(-25, 26)) AS k FROM g)), t AS (SELECT v, sum(m) AS total FROM m GROUP BY v)
SELECT v AS variance, k AS value, round(m / total, 9) AS mass, round(sum(m) OVER (PARTITION BY m.v ORDER BY k) / total, 9) AS below FROM m JOIN t USING (v) WHERE abs(k) <= ceil(9 * sqrt(v)) + 1""")
def gaussian_masses(spark, d):
    line = table(spark, d, "lineitem").select(F.col("l_linenumber").cast("double").alias("variance"))
    out = noise.masses(line)
    return out.withColumns({"mass": F.round("mass", 9), "below": F.round("below", 9)})


Q_FIT = 0.6065306597126334


@query(f"""
WITH d AS (SELECT CAST(l_linenumber - 4 AS INTEGER) AS k FROM lineitem), o AS (SELECT greatest(-3, least(3, k)) AS cell, count(*) AS observed FROM d GROUP BY 1),
c AS (SELECT CAST(unnest(range(-3, 4)) AS INTEGER) AS cell), e AS (SELECT cell, (SELECT count(*) FROM d) * CASE WHEN abs(cell) = 3 THEN pow({Q_FIT}, 3) / (1 + {Q_FIT}) ELSE (1 - {Q_FIT}) / (1 + {Q_FIT}) * pow({Q_FIT}, abs(cell)) END AS expected FROM c)
SELECT cell, coalesce(observed, 0) AS observed, round(expected, 4) AS expected, round(pow(coalesce(observed, 0) - expected, 2) / expected, 4) AS part FROM e LEFT JOIN o USING (cell)""")
def noise_fit(spark, d):
    out = noise.noise_fit(table(spark, d, "lineitem").select((F.col("l_linenumber") - 4).alias("k")), "k", 2.0, 3)
    return out.withColumns({"expected": F.round("expected", 4), "part": F.round("part", 4)})


@query()
def noise_fit_of_draws(spark, d):
    """Draws of geometric noise, one for each line item, against their distribution."""
    drawn = noise.released(table(spark, d, "lineitem").select(noise.geometric_noise(F.col("l_linenumber") * 0, 2.0).alias("k")))
    return noise.noise_fit(drawn, "k", 2.0, 8)


@query()
def noise_fit_of_gaussians(spark, d):
    """Draws of discrete Gaussian noise, one for each line item, against their distribution."""
    drawn = noise.released(table(spark, d, "lineitem").select(noise.gaussian_noise(F.col("l_linenumber") * 0, 4.0).alias("k")))
    return noise.noise_fit(drawn, "k", 2.0, 8, "gaussian")


@query()
def noise_fit_of_laplace(spark, d):
    """Draws of Laplace noise, one for each line item, against their distribution."""
    drawn = noise.released(table(spark, d, "lineitem").select(noise.laplace_noise(F.col("l_linenumber") * 0.0, 3.0).alias("k")))
    return noise.noise_fit(drawn, "k", 3.0, 6, "laplace")


@query()
def keyed_count_noisy(spark, d):
    return aggregates.count(table(spark, d, "lineitem"), flag_keys(spark), "n", noise.mechanism(1.0))


@query()
def bounded_sum_noisy(spark, d):
    return aggregates.bounded_sum(table(spark, d, "lineitem"), "l_quantity", 0.0, 50.0, flag_keys(spark), "total", noise.mechanism(1.0))


@query()
def keyed_count_gaussian(spark, d):
    return aggregates.count(table(spark, d, "lineitem"), flag_keys(spark), "n", noise.mechanism(0.5, kind="zcdp"))


@query()
def median_noisy(spark, d):
    o = table(spark, d, "orders")
    return quantile.quantile(o, "o_totalprice", 0.5, 1000.0, 400000.0, keys.keys_from_rows(o, ["o_orderpriority"]), "median", epsilon=1.0)


# budgets


@query(f"""
WITH o AS (SELECT CAST(o_custkey AS VARCHAR) AS id, 'orders' AS t, CAST(o_orderkey AS VARCHAR) AS x, {content_sql("o_custkey", "o_orderkey", "1")} AS place FROM orders),
l AS (SELECT CAST(k AS VARCHAR) AS id, 'visits' AS t, CAST(m AS VARCHAR) AS x, {content_sql("k", "m", "pos")} AS place FROM (SELECT user_id % 500 AS k, event_id % 4 AS m, row_number() OVER (PARTITION BY user_id % 500, event_id % 4) AS pos FROM events)),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {content_sql("id", "t", "place")}) AS pos FROM (SELECT * FROM o UNION ALL SELECT * FROM l))
SELECT t AS "table", CAST(id AS BIGINT) AS id, CAST(x AS BIGINT) AS x FROM r WHERE pos <= 5""")
def limited_across_tables(spark, d):
    """At most five rows of a customer in two tables together, repeated rows counting each."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    v = table(spark, d, "events").select((F.col("user_id") % 500).alias("k"), (F.col("event_id") % 4).alias("m"))
    out = contributions.limit_across({"orders": o, "visits": v}, {"orders": "o_custkey", "visits": "k"}, 5)
    shape = lambda name, k, x: out[name].select(F.lit(name).alias("table"), F.col(k).cast("long").alias("id"), F.col(x).cast("long").alias("x"))
    return shape("orders", "o_custkey", "o_orderkey").unionByName(shape("visits", "k", "m"))


@query(f"""
WITH p AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')), k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {order_of("o_custkey", "o_orderpriority")}) AS pos FROM p)
SELECT part, count(o_orderkey) AS n FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('5-LOW')) v(part) LEFT JOIN (SELECT o.* FROM orders o JOIN k ON o.o_custkey = k.o_custkey AND o.o_orderpriority = k.o_orderpriority AND pos <= 2) q ON q.o_orderpriority = part GROUP BY part""")
def split_by_ids(spark, d):
    """Parts of a table with an id: every customer in at most two of three parts."""
    session = budget.Session(float("inf"), new_folder(spark, "released"))
    session.add_private("orders", table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority"), id_column="o_custkey")
    parts = session.split("orders", "o_orderpriority", {"a": "1-URGENT", "b": "2-HIGH", "c": "5-LOW"}, float("inf"), most_parts=2)
    names = {"a": "1-URGENT", "b": "2-HIGH", "c": "5-LOW"}
    counts = [s.run(Steps(n).limit_rows_per_id(10_000).count("n"), float("inf")).select(F.lit(names[n]).alias("part"), "n") for n, s in parts.items()]
    return reduce(DataFrame.unionByName, counts)


@query("SELECT s.o_orderstatus, count(o.o_orderkey) AS count FROM (VALUES ('O'), ('F'), ('Z')) s(o_orderstatus) LEFT JOIN orders o USING (o_orderstatus) GROUP BY s.o_orderstatus")
def split_counts(spark, d):
    return budget.split_counts(table(spark, d, "orders"), "o_orderstatus", ["O", "F", "Z"])


CHARGES = "SELECT event_type AS dataset, CASE WHEN user_id % 3 > 0 THEN 's' || (user_id % 3) END AS split, CAST(user_id % 5 AS VARCHAR) AS part, event_id % 4 + 1 AS loss FROM events"


@query(f"""
WITH c AS ({CHARGES}), p AS (SELECT dataset, split, part, sum(loss) AS loss FROM c WHERE split IS NOT NULL GROUP BY ALL), m AS (SELECT dataset, max(loss) AS loss FROM p GROUP BY dataset, split),
t AS (SELECT dataset, CAST(sum(loss) AS BIGINT) AS spent FROM (SELECT dataset, loss FROM m UNION ALL SELECT dataset, loss FROM c WHERE split IS NULL) GROUP BY dataset)
SELECT dataset, spent, 100000 - spent AS remaining FROM t""")
def charge_audit(spark, d):
    e = table(spark, d, "events")
    part = F.col("user_id") % 3
    c = e.select(F.col("event_type").alias("dataset"), F.when(part > 0, F.concat(F.lit("s"), part.cast("string"))).alias("split"), (F.col("user_id") % 5).cast("string").alias("part"), (F.col("event_id") % 4 + 1).alias("loss"))
    return budget.charge_audit(c, 100_000)


@query("SELECT event_id, pow(e, 2) / 2 AS rho, round(pow(e, 2) / 2 + 2 * sqrt(pow(e, 2) / 2 * ln(1000000)), 6) AS epsilon FROM (SELECT event_id, (event_id % 8 + 1) * 0.25 AS e FROM events)")
def charge_convert(spark, d):
    e = table(spark, d, "events").select("event_id", ((F.col("event_id") % 8 + 1) * 0.25).alias("e")).withColumn("rho", budget.rho_of_epsilon(F.col("e")))
    return e.select("event_id", "rho", F.round(budget.epsilon_of_rho(F.col("rho"), 1e-6), 6).alias("epsilon"))


# data quality

RULES = [quality.Pattern("c_name", r"Customer#0*[1-9][0-9]*"), quality.Range("c_nationkey", 0, 20), quality.Splits("c_acctbal", (0.0, 1000.0, 9000.0)), quality.Values("c_mktsegment", ("BUILDING", "MACHINERY"))]
BROKEN = {
    "c_name": r"NOT regexp_full_match(c_name, 'Customer#0*[1-9][0-9]*')",
    "c_nationkey": "NOT (c_nationkey >= 0 AND c_nationkey < 20)",
    "c_acctbal": "NOT (c_acctbal BETWEEN 0 AND 9000)",
    "c_mktsegment": "c_mktsegment NOT IN ('BUILDING', 'MACHINERY')",
}


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", (SELECT count(*) FROM customer) AS checked, (SELECT count(*) FROM customer WHERE {b}) AS invalid" for c, b in BROKEN.items()))
def rule_report(spark, d):
    return quality.rule_report(table(spark, d, "customer"), RULES).drop("examples")


@query("SELECT 'c_mktsegment' AS \"column\", string_agg(c_mktsegment, ',' ORDER BY c_mktsegment) AS examples FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') ORDER BY 1 LIMIT 2)")
def rule_examples(spark, d):
    return quality.rule_report(table(spark, d, "customer"), RULES[3:], shown=2).select("column", "examples")


@query(f"SELECT c_custkey, array_to_string(list_filter([{', '.join(f'CASE WHEN {BROKEN[c]} THEN {chr(39)}{c}{chr(39)} END' for c in sorted(BROKEN))}], lambda x: x IS NOT NULL), ',') AS reasons FROM customer WHERE {' OR '.join(BROKEN.values())}")
def quarantine_rows(spark, d):
    return quality.quarantine(table(spark, d, "customer"), {r.column: r.holds() for r in RULES}).select("c_custkey", "reasons")


@query(f"SELECT count(*) AS kept, CAST(sum(c_nationkey) AS BIGINT) AS nations FROM customer WHERE NOT ({BROKEN['c_nationkey']} OR {BROKEN['c_acctbal']})")
def validated_rows(spark, d):
    return quality.validated(table(spark, d, "customer"), RULES[1:3], "remove").agg(F.count(F.lit(1)).alias("kept"), F.sum("c_nationkey").alias("nations"))


@query("SELECT c_custkey, least(greatest(c_acctbal, 0.0), 9000.0) AS clipped, CASE WHEN least(greatest(c_acctbal, 0.0), 9000.0) >= 1000 THEN 1 ELSE 0 END AS code, CAST(c_nationkey // 5 AS INTEGER) AS bin FROM customer")
def encoded_values(spark, d):
    c = quality.validated(table(spark, d, "customer"), [RULES[2]], "clip")
    return c.select("c_custkey", F.col("c_acctbal").alias("clipped"), RULES[2].encoded().alias("code"), quality.Range("c_nationkey", 0, 25, 5).encoded().alias("bin"))


@query("SELECT p_partkey, CAST(p_size * 100 + p_partkey % 100 AS BIGINT) AS cell, p_size AS a, CAST(p_partkey % 100 AS INTEGER) AS b FROM part")
def cell_numbers(spark, d):
    p = table(spark, d, "part").withColumn("cell", quality.cell_index([F.col("p_size"), F.col("p_partkey") % 100], [51, 100]))
    a, b = quality.cell_codes(F.col("cell"), [51, 100])
    return p.select("p_partkey", "cell", a.alias("a"), b.alias("b"))


@query("SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return quality.duplicate_keys(table(spark, d, "orders"), ["o_custkey", "o_orderstatus"])


@query("SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey NOT IN (10, 11, 12)")
def bad_state(spark, d):
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.select("o_orderkey", F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("REGION_ID"), F.lit("STATE").alias("REGION_TYPE"))
    return quality.outside_states(o, ["10", "11", "12"]).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 4 = 1")
def gaps_in_codes(spark, d):
    code = lambda m: F.when(F.col("o_orderkey") % 4 == m, "Null").otherwise("1000")
    o = table(spark, d, "orders").select("o_orderkey", F.lit("1000").alias("a"), code(1).alias("b"), F.when(F.col("o_orderkey") % 4 == 2, "Null").otherwise("2000").alias("c"))
    return quality.gaps_in_codes(o, ["a", "b", "c"]).select("o_orderkey")


@query("SELECT p_brand, p_size, count(*) AS n FROM (SELECT p_brand, p_type, p_size FROM part) GROUP BY p_brand, p_size HAVING count(*) > 1")
def ambiguous_codes(spark, d):
    p = table(spark, d, "part")
    return quality.ambiguous_codes(p.select("p_partkey", "p_brand"), p.select("p_partkey", "p_size"), "p_partkey", "p_brand", ["p_size"])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 = 0 OR (o_orderkey % 5 = 0) <> (o_custkey % 3 = 0)")
def inconsistent_flags(spark, d):
    k = F.col("o_orderkey")
    flag = lambda m: F.when((k % 5 == 0) & ~((k % 2 == 0) & (k % 3 == 0)), "Null").when(k % m == 0, "True").otherwise("False")
    o = table(spark, d, "orders").select(k, flag(2).alias("a"), flag(3).alias("b"), F.when(F.col("o_custkey") % 3 == 0, "0").otherwise("1").alias("level"))
    return quality.inconsistent_flags(o, "a", "b", "level").select("o_orderkey")


@query("""
WITH r AS (SELECT p_brand, CAST(p_size AS BIGINT) AS low, CAST(p_size + p_partkey % 2 AS BIGINT) AS high FROM part),
m AS (SELECT *, max(high) OVER (PARTITION BY p_brand ORDER BY low, high ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM r),
g AS (SELECT *, sum(CASE WHEN low > top + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY p_brand ORDER BY low, high) AS pos FROM m)
SELECT p_brand, min(low) AS low, max(high) AS high FROM g GROUP BY p_brand, pos""")
def merged_ranges(spark, d):
    p = table(spark, d, "part").select("p_brand", F.col("p_size").cast("long").alias("low"), (F.col("p_size") + F.col("p_partkey") % 2).cast("long").alias("high"))
    return quality.merged_ranges(p, ["p_brand"])


@query("""
WITH r AS (SELECT CAST(l_orderkey * 10 AS BIGINT) AS low, CAST(l_orderkey * 10 + l_linenumber * 4 - 5 AS BIGINT) AS high FROM lineitem),
m AS (SELECT *, max(high) OVER (ORDER BY low, high ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM (SELECT DISTINCT * FROM r WHERE high >= low)),
g AS (SELECT *, sum(CASE WHEN low > top + 1 THEN 1 ELSE 0 END) OVER (ORDER BY low, high) AS pos FROM m)
SELECT 'key' AS field, min(low) AS low, max(high) AS high FROM g GROUP BY pos""")
def merged_ranges_of_one_field(spark, d):
    """All ranges are of one field."""
    low = F.col("l_orderkey").cast("long") * 10
    r = table(spark, d, "lineitem").select(F.lit("key").alias("field"), low.alias("low"), (low + F.col("l_linenumber") * 4 - 5).cast("long").alias("high")).filter("high >= low")
    return quality.merged_ranges(r, ["field"])


@query("SELECT 'negative' AS problem, count(*) FILTER (c_acctbal < 0) AS rows FROM customer UNION ALL SELECT 'state', count(*) FILTER (c_nationkey > 12) FROM customer UNION ALL SELECT 'rule REGION_TYPE', 0")
def output_problems(spark, d):
    c = table(spark, d, "customer").select(F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("REGION_ID"), F.lit("STATE").alias("REGION_TYPE"), F.col("c_acctbal").alias("COUNT"))
    return quality.output_problems(c, [quality.Values("REGION_TYPE", ("STATE", "USA"))], [f"{i:02d}" for i in range(13)])


# sources


LAYOUT = readers.layout_of("KEY 0-9 long\nNATION 9-11 int\nSEGMENT 11-21\nBALANCE 21-32 double\nBAD 11-13 int")


@query("SELECT c_custkey AS KEY, c_nationkey AS NATION, rpad(c_mktsegment, 10, ' ') AS SEGMENT, c_acctbal AS BALANCE, CAST(NULL AS INTEGER) AS BAD FROM customer")
def fixed_width_parse(spark, d):
    line = F.concat(F.lpad(F.col("c_custkey").cast("string"), 9, "0"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.rpad("c_mktsegment", 10, " "), F.lpad(F.col("c_acctbal").cast("string"), 11, " "))
    return readers.parse_fixed(table(spark, d, "customer").select(line.alias("value")), LAYOUT)


@query("SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def delimited_scan(spark, d):
    """Orders written as delimited text, read with a schema and a filter."""
    folder = new_folder(spark, "orders-text")
    sinks.write_delimited(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice")), folder)
    return readers.delimited(spark, folder, "o_orderkey long, o_orderstatus string, o_totalprice double", only={"o_orderstatus": ["F"]})


@query("SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (1, 2, 7)")
def state_files(spark, d):
    """Customers in a folder for each nation, of which a list of states names three, one by another template."""
    folder = new_folder(spark, "customers-text")
    c = table(spark, d, "customer").select("c_custkey", "c_name", F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("st"))
    c.write.partitionBy("st").option("header", True).option("sep", "|").csv(folder)
    paths = readers.templated_paths(folder + "/st={state}", ["01", "02", "72"], {"72": folder + "/st=07"})
    return readers.delimited(spark, paths, "c_custkey long, c_name string")


@query("SELECT REGION_TYPE, REGION_ID, total FROM (SELECT 'STATE' AS REGION_TYPE, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS REGION_ID, count(*) AS total FROM customer GROUP BY ALL UNION ALL SELECT 'USA', '1', count(*) FROM customer) WHERE REGION_TYPE = 'USA' OR REGION_ID IN ('01', '02')")
def totals_of_files(spark, d):
    """Totals in scope over a list of files."""
    c = table(spark, d, "customer")
    folders = [new_folder(spark, "totals-text") for _ in range(2)]
    sinks.write_delimited(c.groupBy(F.lit("STATE").alias("REGION_TYPE"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("REGION_ID")).agg(F.count(F.lit(1)).alias("total")), folders[0])
    sinks.write_delimited(c.agg(F.count(F.lit(1)).alias("total")).select(F.lit("USA").alias("REGION_TYPE"), F.lit("1").alias("REGION_ID"), "total"), folders[1])
    both = readers.delimited(spark, folders, "REGION_TYPE string, REGION_ID string, total long")
    return readers.totals_in_scope(both, ["01", "02"], table(spark, d, "nation").select(F.col("n_name").alias("AIANNHCE")))


def _commented(spark: SparkSession, df: DataFrame, k: str, n: str) -> str:
    """A folder of text with a comment, a header, and a line for each row."""
    folder = new_folder(spark, "commented-text")
    head = spark.createDataFrame([(0, 0, "# kept by hand"), (0, 1, "k,n")], "part int, at long, value string")
    lines = df.select(F.lit(1).alias("part"), F.col(k).cast("long").alias("at"), F.concat_ws(",", F.col(k).cast("string"), F.col(n)).alias("value"))
    head.unionByName(lines).orderBy("part", "at").select("value").write.text(folder)
    return folder


@query("SELECT s_suppkey AS k, s_name AS n FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer")
def commented_files(spark, d):
    """Two commented files with one header, joined and split again."""
    folder = new_folder(spark, "joined-text")
    readers.join_commented(spark, [_commented(spark, table(spark, d, "supplier"), "s_suppkey", "s_name"), _commented(spark, table(spark, d, "customer"), "c_custkey", "c_name")], folder)
    _, names, lines = readers.commented(spark, folder)
    return readers.parse_piped(lines, readers.layout_of(f"{names[0]} 0-1 long\n{names[1]} 1-2"), sep=",").select("k", "n")


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def released_counts(spark, d):
    """Written once in random placement; the session runs it on a private table."""
    session = budget.Session(float("inf"), new_folder(spark, "released"))
    session.add_private("orders", table(spark, d, "orders").select("o_orderkey", "o_orderpriority"))
    session.add_public("names", table(spark, d, "orders").select("o_orderpriority").distinct())
    return session.run(Steps("orders").join_public("names", ["o_orderpriority"], most=1).groupby(session.public["names"]).count("n"), float("inf"))


@query("SELECT o_orderkey AS KEY, o_orderstatus AS STATUS, o_orderkey % 5 <> 0 AS well_formed FROM orders")
def piped_parse(spark, d):
    line = F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.when(F.col("o_orderkey") % 5 == 0, "more"))
    return readers.parse_piped(table(spark, d, "orders").select(line.alias("value")), readers.layout_of("KEY 0-1 long\nSTATUS 1-2"))


@query("""
SELECT o_orderkey, c_custkey, n_name AS N_NAME, CASE WHEN o_orderstatus = 'O' THEN 'Null' ELSE o_orderstatus END AS CODE, o_orderpriority = '1-URGENT' AS HOUSEHOLDER
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def person_assembly(spark, d):
    p = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("mafid"), F.when(F.col("o_orderstatus") == "O", " ").otherwise(F.col("o_orderstatus")).alias("code"), F.col("o_orderpriority").alias("relship"))
    u = table(spark, d, "customer").select(F.col("c_custkey").alias("mafid"), F.col("c_nationkey").alias("block_id"))
    g = table(spark, d, "nation").select(F.col("n_nationkey").alias("block_id"), "n_name")
    out = readers.persons(p, u, g, householder=["1-URGENT"], codes=["code"])
    return out.select(F.col("O_ORDERKEY").alias("o_orderkey"), F.col("MAFID").alias("c_custkey"), "N_NAME", "CODE", "HOUSEHOLDER")


@query("SELECT c_custkey AS mafid, CAST(CASE WHEN n >= 2 AND r > 1 THEN r ELSE 0 END AS BIGINT) AS related FROM (SELECT c_custkey, count(o_orderkey) AS n, count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH')) AS r FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)")
def related_persons(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("mafid"), F.col("o_orderpriority").alias("relship"))
    u = table(spark, d, "customer").select(F.col("c_custkey").alias("mafid"))
    u = u.join(o.groupBy("mafid").agg(F.count(F.lit(1)).alias("final_pop")), "mafid", "left").fillna(0)
    return readers.related_persons(u, o, related=["1-URGENT", "2-HIGH"]).select("mafid", "related")


@query("""
WITH u AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN 3 ELSE 2 END AS RTYPE, count(o_orderkey) AS pop, c_nationkey AS n, c_mktsegment AS seg FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL),
f AS (SELECT o_custkey AS id, count(*) FILTER (20 + o_orderkey % 15 IN (20, 21, 23, 25, 26, 27, 28, 29, 30, 31, 32, 33)) AS k FROM orders GROUP BY o_custkey)
SELECT RTYPE, id AS MAFID, pop AS FINAL_POP, CAST(CASE WHEN pop >= 2 AND RTYPE = 2 AND k > 1 THEN k ELSE 0 END AS BIGINT) AS NPF, CAST(CASE WHEN n % 2 = 0 THEN 0 ELSE n END AS BIGINT) AS HHSPAN, CASE WHEN seg = 'BUILDING' THEN '00' ELSE seg END AS HHRACE
FROM u LEFT JOIN f USING (id)""")
def household_records(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    person = o.select(F.col("o_custkey").alias("mafid"), (F.col("o_orderkey") % 15 + 20).cast("string").alias("relship"))
    sizes = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    unit = c.join(sizes, c["c_custkey"] == sizes["o_custkey"], "left").select(
        F.when(F.col("c_custkey") % 5 == 0, 3).otherwise(2).alias("rtype"), F.col("c_custkey").alias("mafid"), F.lpad(F.coalesce("n", F.lit(0)).cast("string"), 5, " ").alias("final_pop"),
        F.when(F.col("c_nationkey") % 2 == 0, "  ").otherwise(F.col("c_nationkey").cast("string")).alias("hhspan"), F.when(F.col("c_mktsegment") == "BUILDING", "  ").otherwise(F.col("c_mktsegment")).alias("hhrace"),
    )
    return readers.household_records(person, unit, columns=["RTYPE", "MAFID", "FINAL_POP", "NPF", "HHSPAN", "HHRACE"])


@query("SELECT CAST(2 AS INTEGER) AS RTYPE, c_custkey AS MAFID, n_name AS TABBLKST FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_nationkey < 20")
def household_places(spark, d):
    unit = table(spark, d, "customer").select(F.lit(2).alias("rtype"), F.col("c_custkey").alias("mafid"), F.col("c_nationkey").alias("oidtb"))
    geo = table(spark, d, "nation").filter("n_nationkey < 20").select(F.col("n_nationkey").cast("string").alias("oidtabblk"), F.col("n_name").alias("tabblkst"))
    return readers.household_places(unit, geo, columns=["RTYPE", "MAFID", "TABBLKST"])


@query("""
SELECT REGION_ID, REGION_TYPE, count FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN '1' ELSE lpad(CAST(o_custkey % 40 AS VARCHAR), 2, '0') END AS REGION_ID, CASE WHEN o_orderkey % 3 = 0 THEN 'USA' WHEN o_orderkey % 3 = 1 THEN 'STATE' ELSE 'AIANNH' END AS REGION_TYPE, o_orderkey AS count FROM orders)
WHERE REGION_TYPE = 'USA' OR REGION_TYPE = 'STATE' AND REGION_ID IN ('01', '02') OR REGION_TYPE = 'AIANNH' AND REGION_ID IN (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') FROM nation)""")
def totals_in_scope(spark, d):
    k = F.col("o_orderkey") % 3
    t = table(spark, d, "orders").select(F.when(k == 0, "1").otherwise(F.lpad((F.col("o_custkey") % 40).cast("string"), 2, "0")).alias("REGION_ID"), F.when(k == 0, "USA").when(k == 1, "STATE").otherwise("AIANNH").alias("REGION_TYPE"), F.col("o_orderkey").alias("count"))
    return readers.totals_in_scope(t, ["01", "02"], table(spark, d, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("AIANNHCE")))


# tabulation

PEOPLE = "SELECT o_orderkey AS id, n_name AS NATION, r_name AS REGION, 'ALL' AS WORLD, o_orderpriority AS grp, o_orderstatus AS sex, CAST(least(115, floor(o_totalprice / 4000)) AS INTEGER) AS age FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
LONG = f"p AS ({PEOPLE}), q AS (SELECT 'WORLD' AS REGION_TYPE, WORLD AS REGION_ID, grp, sex, age FROM p UNION ALL SELECT 'REGION', REGION, grp, sex, age FROM p UNION ALL SELECT 'NATION', NATION, grp, sex, age FROM p)"
GROUPS = ["REGION_TYPE", "REGION_ID", "grp"]
SEXES = ["O", "F", "P"]
THRESHOLDS = [100, 400, 2000]
LEVELS = f"{LONG}, t AS (SELECT REGION_TYPE, REGION_ID, grp, count(*) AS total, CAST(count(*) >= 100 AS INTEGER) + CAST(count(*) >= 400 AS INTEGER) + CAST(count(*) >= 2000 AS INTEGER) AS level FROM q GROUP BY ALL)"


def bin_sql(level: int) -> str:
    edges = tabulate.AGE_EDGES[level]
    return f"list_max(list_filter([0, {', '.join(map(str, edges))}], lambda x: x <= age))"


def bins_sql() -> str:
    out = []
    for level, edges in tabulate.AGE_EDGES.items():
        out += [f"({level}, '{s}', {a}, {b})" for s in SEXES for a, b in zip([0, *edges], [*[e - 1 for e in edges], tabulate.LAST_AGE], strict=True)]
    return ", ".join(out)


CELLS = f"""{LEVELS}, b(level, sex, low, high) AS (VALUES {bins_sql()}),
x AS (SELECT q.REGION_TYPE, q.REGION_ID, q.grp, q.sex, CASE level WHEN 1 THEN {bin_sql(1)} WHEN 2 THEN {bin_sql(2)} ELSE {bin_sql(3)} END AS low, count(*) AS n FROM q JOIN t ON q.REGION_TYPE = t.REGION_TYPE AND q.REGION_ID = t.REGION_ID AND q.grp = t.grp WHERE level > 0 GROUP BY ALL),
c AS (SELECT t.REGION_TYPE, t.REGION_ID, t.grp, b.sex, CAST(b.low AS VARCHAR) AS low, CAST(b.high AS VARCHAR) AS high, coalesce(n, 0) AS count
      FROM t JOIN b ON t.level = b.level LEFT JOIN x ON x.REGION_TYPE = t.REGION_TYPE AND x.REGION_ID = t.REGION_ID AND x.grp = t.grp AND x.sex = b.sex AND x.low = b.low
      UNION ALL SELECT REGION_TYPE, REGION_ID, grp, '*', '*', '*', total FROM t WHERE level = 0)"""


def people(spark: SparkSession, d: str) -> DataFrame:
    o, c, n, r = (table(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    joined = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    wide = joined.select(F.col("n_name").alias("NATION"), F.col("r_name").alias("REGION"), F.lit("ALL").alias("WORLD"), F.col("o_orderpriority").alias("grp"), F.col("o_orderstatus").alias("sex"), F.least(F.lit(115), F.floor(F.col("o_totalprice") / 4000)).cast("int").alias("age"))
    return tabulate.regions_long(wide, {"WORLD": "WORLD", "REGION": "REGION", "NATION": "NATION"})


def index_sql(level: int) -> str:
    return f"len(list_filter([{', '.join(map(str, tabulate.AGE_EDGES[level]))}], lambda x: x <= age))"


@query(f"SELECT id, CAST({index_sql(1)} AS INTEGER) AS age4, CAST({index_sql(2)} AS INTEGER) AS age9, CAST({index_sql(3)} AS INTEGER) AS age23 FROM ({PEOPLE})")
def root_view(spark, d):
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    people = o.select(F.col("o_orderkey").alias("id"), F.least(F.lit(115), F.floor(F.col("o_totalprice") / 4000)).cast("int").alias("age"))
    return tabulate.with_age_bins(people).select("id", "age4", "age9", "age23")


@query(f"WITH {LEVELS} SELECT * FROM t")
def adaptive_levels(spark, d):
    return tabulate.levels(people(spark, d), GROUPS, THRESHOLDS)


@query(f"WITH {CELLS} SELECT * FROM c")
def adaptive_cells(spark, d):
    p = people(spark, d)
    return tabulate.adaptive_cells(p, tabulate.levels(p, GROUPS, THRESHOLDS), GROUPS, SEXES)


@query(f"""WITH {CELLS} SELECT * FROM c UNION ALL SELECT REGION_TYPE, REGION_ID, grp, sex, '*', '*', CAST(sum(count) AS BIGINT) FROM c WHERE low <> '*' GROUP BY REGION_TYPE, REGION_ID, grp, sex
UNION ALL SELECT REGION_TYPE, REGION_ID, grp, '*', '*', '*', CAST(sum(count) AS BIGINT) FROM c WHERE low <> '*' GROUP BY REGION_TYPE, REGION_ID, grp""")
def published_table(spark, d):
    p = people(spark, d)
    cells = tabulate.adaptive_cells(p, tabulate.levels(p, GROUPS, THRESHOLDS), GROUPS, SEXES)
    return tabulate.with_marginals(cells, GROUPS)


@query(f"WITH {CELLS} SELECT REGION_TYPE, REGION_ID, grp, count(*) AS rows FROM c GROUP BY ALL")
def workload_rows(spark, d):
    p = people(spark, d)
    return tabulate.workload(tabulate.adaptive_cells(p, tabulate.levels(p, GROUPS, THRESHOLDS), GROUPS, SEXES), GROUPS)


@query("""
WITH c AS (SELECT DISTINCT l_orderkey, p_brand AS code FROM lineitem JOIN part ON l_partkey = p_partkey), n AS (SELECT l_orderkey, count(*) AS n FROM c GROUP BY l_orderkey),
m AS (SELECT DISTINCT p_brand AS code, substr(p_brand, 1, 7) AS grp, false AS alone FROM part UNION SELECT DISTINCT p_brand, substr(p_brand, 1, 7) || ' alone', true FROM part),
f AS (SELECT l_orderkey, grp, alone, count(DISTINCT c.code) AS k FROM c JOIN m USING (code) GROUP BY ALL)
SELECT DISTINCT l_orderkey, grp FROM f JOIN n USING (l_orderkey) WHERE NOT alone OR k = n""")
def alone_in_combination(spark, d):
    part = table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("code"))
    items = table(spark, d, "lineitem")
    line = items.join(part, F.col("l_partkey") == F.col("p_partkey"))
    persons = tabulate.code_arrays(line, "l_orderkey", "code", most_rows=items.count())  # keys of parts are unique
    brands = part.select("code").distinct()
    group = F.substring("code", 1, 7)
    mapping = brands.select("code", group.alias("grp"), F.lit(False).alias("alone")).union(brands.select("code", F.concat(group, F.lit(" alone")), F.lit(True)))
    return tabulate.code_groups(persons, "l_orderkey", "codes", mapping, "code", "grp", "alone", once=True)


@query("SELECT n_nationkey AS key, lpad(CAST(p.p_partkey AS VARCHAR), 4, '0') AS code FROM nation JOIN part p ON p.p_partkey BETWEEN n_nationkey * 10 AND n_nationkey * 10 + 5 OR p.p_partkey = 1000 + n_nationkey")
def expand_codes(spark, d):
    k = F.col("n_nationkey")
    pad = lambda c: F.lpad(c.cast("string"), 4, "0")
    short = table(spark, d, "nation").select(k.alias("key"), F.concat(pad(k * 10), F.lit(":"), pad(k * 10 + 5), F.lit(", "), pad(k + 1000)).alias("short"))
    codes = table(spark, d, "part").select(F.lpad(F.col("p_partkey").cast("string"), 4, "0").alias("code")).filter(F.length("code") == 4)
    return tabulate.expand_codes(short, "key", "short", codes, "code")


# accuracy reports

PAIRS = "SELECT o_orderpriority AS grp, c_mktsegment AS seg, o_orderstatus AS st, count(*) AS exact, count(*) + count(*) % 7 - 3 AS noisy FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"


def pairs(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    exact = o.groupBy(F.col("o_orderpriority").alias("grp"), F.col("c_mktsegment").alias("seg"), F.col("o_orderstatus").alias("st")).agg(F.count(F.lit(1)).alias("count"))
    return report.paired(exact.withColumn("count", F.col("count") + F.col("count") % 7 - 3), exact, ["grp", "seg", "st"])


@query(f"SELECT grp, seg, count(*) AS cells, CAST(sum(exact) AS BIGINT) AS size, CAST(sum(abs(noisy - exact)) AS BIGINT) AS absolute_error, CAST(sum(pow(noisy - exact, 2)) AS BIGINT) AS squared_error FROM ({PAIRS}) GROUP BY grp, seg")
def error_report(spark, d):
    return report.error_report(pairs(spark, d), ["grp", "seg"])


@query(f"SELECT grp, decade, quantile_cont(abs(noisy - exact), 0.95) AS margin FROM (SELECT *, CASE WHEN exact <= 0 THEN 0 ELSE CAST(floor(log10(exact)) AS INTEGER) + 1 END AS decade FROM ({PAIRS})) GROUP BY grp, decade")
def moe_by_size(spark, d):
    p = pairs(spark, d).withColumn("decade", report.size_decade(F.col("exact")))
    return report.margin_of_error(p, ["grp", "decade"])


@query(" ".join(["SELECT o_orderpriority,", ", ".join(f"count(*) FILTER (o_orderstatus = '{s}') / CAST(count(*) AS DOUBLE) AS p_{s}" for s in SEXES), "FROM orders GROUP BY o_orderpriority"]))
def workload_pivot(spark, d):
    return report.proportions(table(spark, d, "orders"), ["o_orderpriority"], "o_orderstatus", SEXES)


@query("SELECT c_nationkey, CAST(sum(c_acctbal) FILTER (c_custkey % 3 = 0) > 0 AS INTEGER) AS sign_0, CAST(sum(c_acctbal) FILTER (c_custkey % 3 = 1) > 0 AS INTEGER) AS sign_1, CAST(sum(c_acctbal) FILTER (c_custkey % 3 = 2) > 0 AS INTEGER) AS sign_2 FROM customer GROUP BY c_nationkey")
def trials_wide(spark, d):
    t = table(spark, d, "customer").groupBy("c_nationkey", (F.col("c_custkey") % 3).alias("trial")).agg((F.sum("c_acctbal") > 0).cast("int").alias("sign"))
    return report.trials_wide(t, ["c_nationkey"], "trial", [0, 1, 2], "sign")


@query(f"SELECT seg, max(abs(noisy - exact)) AS worst FROM ({PAIRS}) WHERE exact > 20 GROUP BY seg")
def error_metric(spark, d):
    return report.error_metric(pairs(spark, d), F.abs(F.col("noisy") - F.col("exact")), ["seg"], F.max("error").alias("worst"), F.col("exact") > 20)


# differences

CHANGED = "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 50 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 97 <> 0"


def two_orders(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    k = F.col("o_orderkey")
    return o, o.filter(k % 97 != 0).withColumn("o_orderstatus", F.when(k % 50 == 0, "X").otherwise(F.col("o_orderstatus")))


DIFF = f"a AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders), b AS ({CHANGED}), s AS (SELECT * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))"


@query(f"WITH {DIFF} SELECT count(*) AS distance FROM s")
def table_diff(spark, d):
    return diff.table_difference(*two_orders(spark, d))


@query(f"WITH {DIFF} SELECT CAST(sum(n) AS DOUBLE) AS distance FROM (SELECT o_custkey, count(*) AS n FROM s GROUP BY o_custkey)")
def group_diff_l1(spark, d):
    return diff.group_difference(*two_orders(spark, d), ["o_custkey"])


@query(f"WITH {DIFF} SELECT round(sqrt(sum(n * n)), 6) AS distance FROM (SELECT o_custkey, count(*) AS n FROM s GROUP BY o_custkey)")
def group_diff_l2(spark, d):
    return diff.group_difference(*two_orders(spark, d), ["o_custkey"], 2).select(F.round("distance", 6).alias("distance"))


@query(f"WITH {DIFF} SELECT count(DISTINCT o_custkey) AS ids FROM s")
def id_diff(spark, d):
    return diff.ids_changed({"orders": two_orders(spark, d)}, "o_custkey")


@query(f"WITH {DIFF} SELECT CASE WHEN (SELECT count(*) FROM a) = (SELECT count(*) FROM b) THEN CAST(0 AS BIGINT) END AS distance")
def hamming_sizes_differ(spark, d):
    return diff.hamming_distance(*two_orders(spark, d))


@query("SELECT count(*) FILTER (o_orderkey % 50 = 0 AND o_orderstatus <> 'X') AS distance FROM orders")
def hamming_distance(spark, d):
    a, _ = two_orders(spark, d)
    return diff.hamming_distance(a, a.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 50 == 0, "X").otherwise(F.col("o_orderstatus"))))


@query("SELECT CAST(sum(abs(CASE WHEN o_orderkey % 97 = 0 THEN o_custkey ELSE o_orderkey % 5 END)) AS DOUBLE) AS distance FROM orders")
def vector_distance(spark, d):
    a, b = two_orders(spark, d)
    return diff.vector_distance(a, b.withColumn("o_custkey", F.col("o_custkey") + F.col("o_orderkey") % 5), ["o_orderkey"], "o_custkey")


@query("SELECT DISTINCT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def code_overlap(spark, d):
    return diff.overlap(table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")))


@query("SELECT n_name, coalesce(n, 0) AS n FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 8000 GROUP BY c_nationkey) ON n_nationkey = c_nationkey")
def full_domain(spark, d):
    n = table(spark, d, "nation")
    c = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING' AND c_acctbal > 8000").join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))
    return keys.to_full_domain(c, n.select("n_name"), "n")


@query("SELECT o_orderpriority, CAST(max(o_totalprice) * 100 AS BIGINT) AS cents FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY o_orderpriority UNION ALL SELECT 'absent', -1")
def apply_to_groups(spark, d):
    o = table(spark, d, "orders").select("o_orderpriority", (F.col("o_totalprice") * 100).cast("long").alias("c"))
    listed = keys.keys_from_rows(o, ["o_orderpriority"]).filter("o_orderpriority <> '5-LOW'").union(keys.keys_from_values(spark, {"k": ["absent"]}))
    return aggregates.apply_to_groups(o, listed, lambda g: g.groupby("o_orderpriority", as_index=False).agg(cents=("c", "max")), "o_orderpriority string, cents long", {"cents": -1}, lambda g: g.groupby("o_orderpriority", as_index=False).agg(cents=("cents", "max")))


@query("SELECT l_returnflag, CAST(min(l_quantity) AS BIGINT) AS low, CAST(sum(CAST(l_quantity AS BIGINT) * CAST(l_quantity AS BIGINT)) % 1000007 AS BIGINT) AS digest FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_returnflag")
def groups_in_parts(spark, d):
    """Two of three flags, each a third of all rows or more, by slices that combine."""
    line = table(spark, d, "lineitem").select("l_returnflag", F.col("l_quantity").cast("long").alias("q"))
    listed = keys.keys_from_rows(line, ["l_returnflag"]).filter("l_returnflag <> 'R'")
    one = lambda g, low, digest: g.iloc[:1][["l_returnflag"]].assign(low=low, digest=digest % 1_000_007)
    return aggregates.apply_to_groups(line, listed, lambda g: one(g, g["q"].min(), (g["q"] * g["q"]).sum()), "l_returnflag string, low long, digest long", {}, lambda g: one(g, g["low"].min(), g["digest"].sum()))


# record layouts

PERSON_FIELDS = {
    "RTYPE": ("substr('354', CAST(o_orderkey % 3 + 1 AS INTEGER), 1)", "o_orderkey % 3 = 2"),
    "MAFID": ("lpad(CAST(o_custkey + 100000001 AS STRING), 9, '0')", "false"),
    "CUF_PNC": ("lpad(CAST(o_orderkey % 1000 AS STRING), 5, '0')", "o_orderkey % 1000 = 0"),
    "BCUSTATEFP": ("lpad(CAST(o_custkey % 80 AS STRING), 2, '0')", "o_custkey % 80 IN (0, 3, 7, 14, 43, 52) OR o_custkey % 80 > 56 AND o_custkey % 80 <> 72"),
    "VERSION": ("'00001'", "false"),
    "QSEX": ("CAST(o_orderkey % 4 AS STRING)", "o_orderkey % 4 IN (0, 3)"),
    "QAGE": ("lpad(CAST(o_orderkey % 130 AS STRING), 3, ' ')", "o_orderkey % 130 > 115"),
    "QDB": ("'19900415'", "false"),
    "QDOB_MONTH": ("lpad(CAST(o_orderkey % 14 AS STRING), 2, '0')", "o_orderkey % 14 IN (0, 13)"),
    "QDOB_DAY": ("' 5'", "false"),
    "QDOB_YEAR": ("CAST(1900 + o_orderkey % 100 AS STRING)", "o_orderkey % 100 < 4"),
    "QSPAN": ("lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0')", "o_orderkey % 10000 < 1000 OR o_orderkey % 10000 > 9000 AND o_orderkey % 10000 NOT IN (9100, 9200, 9500, 9900, 9950)"),
    "QSPANX": ("'7'", "false"),
    "CENHISP": ("'2'", "false"),
    "QRACE1": ("'    '", "true"),
    "QRACE2": ("CASE WHEN o_orderkey % 2 = 0 THEN '    ' ELSE '0999' END", "o_orderkey % 2 = 1"),
    **{f"QRACE{i}": ("'    '", "false") for i in range(3, 9)},
    "QRACEX": ("'x'", "true"),
    "CENRACE": ("lpad(CAST(o_orderkey % 70 AS STRING), 2, '0')", "o_orderkey % 70 = 0 OR o_orderkey % 70 > 63"),
    "RACE2010": ("'31'", "false"),
    "RELSHIP": ("lpad(CAST(o_orderkey % 45 AS STRING), 2, '0')", "o_orderkey % 45 NOT BETWEEN 20 AND 38"),
    "QGQTYP": ("CASE WHEN o_orderkey % 2 = 0 THEN '   ' ELSE '107' END", "o_orderkey % 2 = 1"),
    "LIVE_ALONE": ("'0'", "false"),
}


@query(" UNION ALL ".join(f"SELECT '{f}' AS field, count(*) AS checked, count(*) FILTER ({bad}) AS broken FROM orders" for f, (_, bad) in PERSON_FIELDS.items()))
def person_record_rules(spark, d):
    line = F.expr(f"concat({', '.join(x for x, _ in PERSON_FIELDS.values())})")
    lines = table(spark, d, "orders").select(line.alias("value"))
    layout = records.record(records.PERSON)
    return records.field_report(records.fixed_records(lines, layout), layout)


@query("""SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS BCUSTATEFP, count(*) AS COUNT_UNIT, count(*) FILTER (c_acctbal > 0) AS COUNT_UNIT_HU, CASE WHEN c_nationkey % 2 = 0 THEN 'VERSION' ELSE '' END AS broken
FROM customer GROUP BY c_nationkey""")
def control_records(spark, d):
    own = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_acctbal") > 0).alias("h"))
    wide = lambda c: F.lpad(F.col(c).cast("string"), 10, "0")
    line = F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.when(F.col("c_nationkey") % 2 == 0, "two  ").otherwise("    2"), wide("n"), wide("h"), *[F.lit("0000000000")] * 4)
    layout = records.record(records.CONTROL)
    found = records.broken_fields(records.fixed_records(own.select(line.alias("value")), layout), layout)
    return found.select("BCUSTATEFP", F.col("COUNT_UNIT").cast("long").alias("COUNT_UNIT"), F.col("COUNT_UNIT_HU").cast("long").alias("COUNT_UNIT_HU"), F.array_join("broken", ",").alias("broken"))


@query("SELECT o_orderkey % 3 AS state, o_orderkey % 7 = 0 AS well_formed, concat_ws(',', CASE WHEN o_orderkey % 3 = 0 THEN 'RTYPE' END, CASE WHEN o_orderkey % 7 <> 0 THEN 'HHSEX' END) AS broken, count(*) AS n FROM orders GROUP BY ALL")
def unit_records_piped(spark, d):
    fields = ["CAST(o_orderkey % 3 * 2 AS STRING)", "'100000001'", "'72'", "'0'", "'  12'", "' 40'", "' '", "'6'", "'63'", "'4'", "'0'", "'0'", "'7'", "'   '", "' '", "'123'", "'7'", "'12'", "'5'", "'0'", "'2'", "'4'", "'0'", "' 9'", "'10'", "'99'", "'4'", "CASE WHEN o_orderkey % 7 = 0 THEN '2' END"]
    lines = table(spark, d, "orders").select("o_orderkey", F.expr(f"concat_ws('|', {', '.join(fields)})").alias("value"))
    layout = records.record(records.UNIT)
    out = records.broken_fields(records.piped_records(lines, layout), layout)
    state = (F.col("RTYPE").cast("int") / 2).cast("long")
    return out.groupBy(state.alias("state"), "well_formed", F.array_join("broken", ",").alias("broken")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT c_custkey AS MAFID, CASE n_regionkey + 3 WHEN 6 THEN 4 WHEN 7 THEN 5 ELSE n_regionkey + 3 END AS HHT, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Null' ELSE c_mktsegment END AS CODE, o_orderkey AS PERSON_ID
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey WHERE o_orderpriority = '2-HIGH' AND c_nationkey <> 3""")
def unit_assembly(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    u = c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(F.col("c_custkey").alias("mafid"), F.col("c_nationkey").alias("block_id"), F.when(F.col("c_nationkey") == 3, 0).otherwise(F.col("n_regionkey") + 3).alias("hht"), F.when(F.col("c_mktsegment") == "BUILDING", " ").otherwise(F.col("c_mktsegment")).alias("code"))
    p = table(spark, d, "orders").select(F.col("o_custkey").alias("mafid"), F.col("o_orderkey").alias("person_id"), F.col("o_orderpriority").alias("relship"))
    g = n.select(F.col("n_nationkey").alias("block_id"), "n_name")
    return readers.units(p, u, g, householder=["2-HIGH"], codes=["code"], columns=["MAFID", "HHT", "CODE", "PERSON_ID"])


@query("SELECT k AS block_id, s_name FROM (SELECT DISTINCT o_custkey AS k FROM orders) LEFT JOIN supplier ON s_suppkey = k")
def block_geography(spark, d):
    u = table(spark, d, "orders").select(F.col("o_custkey").alias("block_id"))
    return readers.geography_of_units(table(spark, d, "supplier").select(F.col("s_suppkey").alias("block_id"), "s_name"), u)


@query("SELECT count(*) AS records FROM lineitem UNION ALL SELECT count(*) FROM orders")
def file_records(spark, d):
    both = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")).unionByName(table(spark, d, "orders").select(F.col("o_orderkey").alias("k")))
    name = F.regexp_extract("file", r"(lineitem|orders)\.parquet", 1)
    return readers.file_counts(both).groupBy(name.alias("table")).agg(F.sum("records").alias("records")).select("records")


# checks of table sets


@query("SELECT 'r_regionkey' AS column, count(*) AS checked, count(*) FILTER (n_regionkey + n_nationkey % 2 NOT IN (SELECT r_regionkey FROM region)) AS invalid FROM nation")
def rules_of_code_table(spark, d):
    rule = quality.rules_from_codes(table(spark, d, "region"), "r_regionkey", "r_regionkey")
    n = table(spark, d, "nation").select((F.col("n_regionkey") + F.col("n_nationkey") % 2).alias("r_regionkey"))
    return quality.rule_report(n, [rule]).drop("examples")


@query("""
WITH p AS (SELECT (o_orderkey % 1000) * 1000 + o_custkey % 1000 AS code, CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE o_orderpriority END AS prio FROM orders),
k AS (SELECT DISTINCT l_orderkey % 1000 * 1000 + l_suppkey % 1000 AS code FROM lineitem)
SELECT 'code' AS column, count(*) AS checked, count(*) FILTER (code NOT IN (SELECT code FROM k)) AS invalid FROM p UNION ALL SELECT 'prio', count(*), count(*) FILTER (prio NOT IN (SELECT o_orderpriority FROM orders)) FROM p""")
def rules_of_large_code_tables(spark, d):
    """Rules that hold tables of codes, the larger one with as many codes as the line items have."""
    o = table(spark, d, "orders").select((F.col("o_orderkey") % 1000 * 1000 + F.col("o_custkey") % 1000).alias("code"), F.when(F.col("o_orderkey") % 3 == 0, "x").otherwise(F.col("o_orderpriority")).alias("prio"))
    codes = table(spark, d, "lineitem").select((F.col("l_orderkey") % 1000 * 1000 + F.col("l_suppkey") % 1000).alias("code"))
    rules = [quality.rules_from_codes(codes, "code", "code", most=10), quality.rules_from_codes(table(spark, d, "orders"), "o_orderpriority", "prio", most=2)]
    return quality.rule_report(o, rules).drop("examples")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 1000 * 1000 + o_custkey % 1000 IN (SELECT l_orderkey % 1000 * 1000 + l_suppkey % 1000 FROM lineitem) AND o_totalprice < 300000")
def rows_of_large_code_table(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 1000 * 1000 + F.col("o_custkey") % 1000).alias("code"), F.col("o_totalprice").cast("double").alias("price"))
    codes = table(spark, d, "lineitem").select((F.col("l_orderkey") % 1000 * 1000 + F.col("l_suppkey") % 1000).alias("code"))
    return quality.validated(o, [quality.rules_from_codes(codes, "code", "code", most=10), quality.Range("price", 0, 300000)], "remove").select("o_orderkey")


@query("""SELECT 3 AS phase, 'customers without orders' AS problem, count(*) AS rows FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) HAVING count(*) > 0
UNION ALL SELECT 3, 'repeated order keys', count(*) FROM (SELECT o_custkey, o_orderstatus FROM orders GROUP BY ALL HAVING count(*) > 1) HAVING count(*) > 0""")
def phased_check(spark, d):
    tables = {t: table(spark, d, t) for t in ("nation", "customer", "orders")}
    prior = {"nation": [quality.Range("n_nationkey", 0, 25)], "orders": [quality.Values("o_orderstatus", ("O", "F", "P"))]}
    rebuilt = lambda ts: {"customer": [quality.rules_from_codes(ts["nation"], "n_nationkey", "c_nationkey")]}
    orphans = quality.Check("customers without orders", lambda ts: ts["customer"].join(ts["orders"], F.col("c_custkey") == F.col("o_custkey"), "left_anti"))
    twice = quality.Check("repeated order keys", lambda ts: quality.duplicate_keys(ts["orders"], ["o_custkey", "o_orderstatus"]))
    return quality.phased_problems(tables, prior, rebuilt, [orphans, twice])


@query("SELECT 1 AS phase, 'orders.o_orderstatus' AS problem, count(*) AS rows FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT 1, 'nation.n_nationkey', count(*) FROM nation WHERE n_nationkey >= 20")
def phased_check_stops(spark, d):
    tables = {t: table(spark, d, t) for t in ("nation", "orders")}
    prior = {"nation": [quality.Range("n_nationkey", 0, 20)], "orders": [quality.Values("o_orderstatus", ("O", "F"))]}
    return quality.phased_problems(tables, prior, lambda ts: 1 / 0, [])


@query("SELECT 'o_custkey' AS column, 'null' AS problem, count(*) FILTER (o_orderkey % 10 = 0) AS rows FROM orders UNION ALL SELECT 'o_totalprice', 'NaN', count(*) FILTER (o_orderkey % 3 = 0) FROM orders UNION ALL SELECT 'o_orderstatus', 'is VARCHAR, not INTEGER', 0 UNION ALL SELECT 'more', 'absent', 0 UNION ALL SELECT 'o_orderkey', 'unexpected', 0")
def spec_check(spark, d):
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    o = o.select("o_orderkey", F.when(k % 10 != 0, F.col("o_custkey")).alias("o_custkey"), F.when(k % 3 == 0, float("nan")).otherwise(F.col("o_totalprice").cast("double")).alias("o_totalprice"), "o_orderstatus")
    spec = {"o_custkey": ColumnSpec("INTEGER", nulls=False), "o_totalprice": ColumnSpec("DECIMAL"), "o_orderstatus": ColumnSpec("INTEGER"), "more": ColumnSpec("DATE")}
    return special.spec_problems(o, spec)


# tables with an id


@query(f"""
WITH e AS (SELECT o_custkey, o_orderkey, n_regionkey, l_linenumber FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'),
k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {order_of("o_custkey", "o_orderkey", "n_regionkey", "l_linenumber")}) AS pos FROM e)
SELECT r_regionkey AS n_regionkey, count(pos) AS n FROM region LEFT JOIN (SELECT * FROM k WHERE pos <= 5) ON n_regionkey = r_regionkey GROUP BY r_regionkey""")
def count_by_limited_ids(spark, d):
    session = budget.Session(float("inf"), new_folder(spark, "released"))
    session.add_private("orders", table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), id_column="o_custkey")
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    session.add_public("homes", c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(F.col("c_custkey").alias("o_custkey"), "n_regionkey"))
    session.add_public("lines", table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber"))
    q = Steps("orders").filter("o_orderstatus <> 'P'").select("o_custkey", "o_orderkey").join_public("homes", ["o_custkey"]).join_public("lines", ["o_orderkey"], most=7)
    q = q.select("o_custkey", "o_orderkey", "n_regionkey", "l_linenumber").limit_rows_per_id(5)
    regions = keys.keys_from_rows(table(spark, d, "region").select(F.col("r_regionkey").cast("long").alias("n_regionkey")), ["n_regionkey"])
    return session.run(q.groupby(regions).count("n"), float("inf"))


@query("SELECT o_orderkey, p FROM (SELECT o_orderkey, unnest(range(0, least(3, o_orderkey % 5))) AS p FROM orders)")
def flat_map_python(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    return rows.flat_map_rows(o, lambda r: [{"o_orderkey": r["o_orderkey"], "p": i} for i in range(r["o_orderkey"] % 5)], 3, "o_orderkey long, p long")


# characteristics and planned runs


@query("""
WITH c AS (SELECT DISTINCT l_orderkey, p_brand AS code FROM lineitem JOIN part ON l_partkey = p_partkey), n AS (SELECT l_orderkey, count(*) AS n FROM c GROUP BY l_orderkey),
a AS (SELECT l_orderkey, substr(code, 1, 7) AS g, count(*) AS k FROM c GROUP BY ALL)
SELECT l_orderkey, g AS grp FROM a UNION ALL SELECT l_orderkey, g || ' alone' FROM a JOIN n USING (l_orderkey) WHERE k = n
UNION ALL SELECT l_orderkey, 'E' || substr(o_orderpriority, 1, 1) FROM n JOIN orders ON o_orderkey = l_orderkey WHERE o_orderpriority <> '5-LOW'""")
def characteristic_rows(spark, d):
    part = table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("code"))
    line = table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.substring("o_orderpriority", 1, 1).alias("eth"))
    persons = line.groupBy("l_orderkey").agg(F.collect_set("code").alias("codes")).join(o, "l_orderkey")
    brands = part.select("code", F.substring("code", 1, 7).alias("g")).distinct()
    level = lambda df, kind, alone, name: df.select(name.alias("group"), F.lit(kind).alias("kind"), F.lit(alone).alias("alone"), F.lit(False).alias("detailed_only"), F.lit(False).alias("coarse_only"), F.lit("1").alias("level")).distinct()
    eths = o.select("eth").distinct()
    groups = level(brands, "race", False, F.col("g")).union(level(brands, "race", True, F.concat("g", F.lit(" alone")))).union(level(eths.filter("eth <> '5'"), "ethnicity", None, F.concat(F.lit("E"), "eth")))
    mapping = brands.select("code", F.col("g").alias("group")).union(brands.select("code", F.concat("g", F.lit(" alone")))).union(eths.select("eth", F.concat(F.lit("E"), "eth")))
    return characteristics.characteristics(groups, mapping, 25, level="1").of(persons, "codes", "eth").select("l_orderkey", "grp")


PLAN = "(VALUES ('USA', '1', 1.0), ('USA', '2', 1.0), ('STATE', '1', 0.0), ('STATE', '2', 1.0), ('COUNTY', '1', 2.0), ('COUNTY', '2', 0.5))"
KINDS_OF = "(VALUES ('1-URGENT', '1', false, false), ('2-HIGH', '1', true, false), ('3-MEDIUM', '2', false, false), ('4-NOT SPECIFIED', '2', false, true), ('5-LOW', '2', true, false))"
PLANNED = f"""WITH p AS ({PEOPLE}),
q AS (SELECT 'USA' AS REGION_TYPE, WORLD AS REGION_ID, grp, sex, age FROM p UNION ALL SELECT 'STATE', REGION, grp, sex, age FROM p UNION ALL SELECT 'COUNTY', NATION, grp, sex, age FROM p),
g AS (SELECT 'USA' AS REGION_TYPE, 'ALL' AS REGION_ID UNION ALL SELECT 'STATE', r_name FROM region UNION ALL SELECT 'COUNTY', n_name FROM nation),
m AS (SELECT g.REGION_TYPE, REGION_ID, k.grp, k.d AS totals_only FROM g JOIN {PLAN} l(rt, lv, budget) ON g.REGION_TYPE = l.rt AND budget > 0 JOIN {KINDS_OF} k(grp, lv2, d, c) ON lv2 = lv AND CASE WHEN g.REGION_TYPE = 'COUNTY' THEN NOT d ELSE NOT c END),
n AS (SELECT m.*, count(age) AS total FROM m LEFT JOIN q ON q.REGION_TYPE = m.REGION_TYPE AND q.REGION_ID = m.REGION_ID AND q.grp = m.grp GROUP BY ALL),
t AS (SELECT REGION_TYPE, REGION_ID, grp, total, CAST(total >= 100 AS INTEGER) + CAST(total >= 400 AS INTEGER) + CAST(total >= 2000 AS INTEGER) AS level FROM n WHERE NOT totals_only)"""


def planned(spark: SparkSession, d: str, kind: str = "pure", noisy: bool = False) -> tuple[DataFrame, DataFrame]:
    o, c, n, r = (table(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    joined = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    persons = joined.select(F.col("n_name").alias("COUNTY"), F.col("r_name").alias("STATE"), F.lit("ALL").alias("USA"), F.col("o_orderpriority").alias("grp"), F.col("o_orderstatus").alias("sex"), F.least(F.lit(115), F.floor(F.col("o_totalprice") / 4000)).cast("int").alias("age"))
    regions = r.select(F.lit("STATE").alias("REGION_TYPE"), F.col("r_name").alias("REGION_ID")).union(n.select(F.lit("COUNTY"), "n_name")).union(spark.createDataFrame([("USA", "ALL")], "a string, b string"))
    plan = spark.sql(f"SELECT rt AS REGION_TYPE, lv AS level, CAST(budget AS DOUBLE) AS budget, array(100, 400, 2000) AS thresholds, CAST(0 AS DOUBLE) AS chance FROM {PLAN} AS l(rt, lv, budget)")
    groups = spark.sql(f"SELECT grp AS `group`, lv AS level, d AS detailed_only, c AS coarse_only FROM {KINDS_OF} AS k(grp, lv, d, c)")
    domain = characteristics.population_domain(regions, groups, plan)
    return characteristics.planned_tabulation(persons, {"USA": "USA", "STATE": "STATE", "COUNTY": "COUNTY"}, domain, SEXES, kind=kind, noisy=noisy)


@query(f"{PLANNED} SELECT REGION_TYPE, REGION_ID, grp, total AS COUNT FROM n WHERE totals_only UNION ALL SELECT REGION_TYPE, REGION_ID, grp, total FROM t")
def planned_totals(spark, d):
    return planned(spark, d)[0]


@query(f"""{PLANNED}, b(level, sex, low, high) AS (VALUES {bins_sql()}),
x AS (SELECT q.REGION_TYPE, q.REGION_ID, q.grp, q.sex, CASE level WHEN 1 THEN {bin_sql(1)} WHEN 2 THEN {bin_sql(2)} ELSE {bin_sql(3)} END AS low, count(*) AS n FROM q JOIN t ON q.REGION_TYPE = t.REGION_TYPE AND q.REGION_ID = t.REGION_ID AND q.grp = t.grp WHERE level > 0 GROUP BY ALL),
c AS (SELECT t.REGION_TYPE, t.REGION_ID, t.grp, b.sex, CAST(b.low AS VARCHAR) AS low, CAST(b.high AS VARCHAR) AS high, coalesce(n, 0) AS count FROM t JOIN b ON t.level = b.level LEFT JOIN x ON x.REGION_TYPE = t.REGION_TYPE AND x.REGION_ID = t.REGION_ID AND x.grp = t.grp AND x.sex = b.sex AND x.low = b.low)
SELECT * FROM c UNION ALL SELECT REGION_TYPE, REGION_ID, grp, sex, '*', '*', CAST(sum(count) AS BIGINT) FROM c GROUP BY REGION_TYPE, REGION_ID, grp, sex""")
def planned_tables(spark, d):
    return planned(spark, d)[1]


def nested_sql() -> str:
    """(level, table, sex, low, high) of each level's nested cells: of two tables with one bin the coarser has it."""
    out, seen = [], set()
    for at, edges in tabulate.AGE_EDGES.items():
        bins = [b for b in zip([0, *edges], [*[e - 1 for e in edges], tabulate.LAST_AGE], strict=True) if b not in seen]
        seen |= set(bins)
        out += [f"({level}, {at}, '{s}', {a}, {b})" for level in tabulate.AGE_EDGES if level >= at for s in SEXES for a, b in bins]
    return ", ".join(out)


TARGETS = f"""WITH {LEVELS}, b(level, tab, sex, low, high) AS (VALUES {nested_sql()}),
x AS (SELECT t.REGION_TYPE, t.REGION_ID, t.grp, t.level, q.sex, q.age FROM q JOIN t ON q.REGION_TYPE = t.REGION_TYPE AND q.REGION_ID = t.REGION_ID AND q.grp = t.grp),
c AS (SELECT t.REGION_TYPE, t.REGION_ID, t.grp, b.sex, b.low, b.high, count(x.age) AS count FROM t JOIN b ON t.level = b.level
      LEFT JOIN x ON x.REGION_TYPE = t.REGION_TYPE AND x.REGION_ID = t.REGION_ID AND x.grp = t.grp AND x.sex = b.sex AND x.age BETWEEN b.low AND b.high GROUP BY ALL)"""


def targets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    p = people(spark, d)
    return tabulate.target_cells(p, tabulate.levels(p, GROUPS, THRESHOLDS), GROUPS, SEXES)


@query(f"""{TARGETS} SELECT REGION_TYPE, REGION_ID, grp, sex, CAST(low AS VARCHAR) AS low, CAST(high AS VARCHAR) AS high, count FROM c
UNION ALL SELECT t.REGION_TYPE, t.REGION_ID, t.grp, s.sex, '*', '*', count(x.age) FROM t CROSS JOIN (VALUES ('O'), ('F'), ('P')) s(sex) LEFT JOIN x ON x.REGION_TYPE = t.REGION_TYPE AND x.REGION_ID = t.REGION_ID AND x.grp = t.grp AND x.sex = s.sex WHERE t.level > 0 GROUP BY ALL""")
def target_cells(spark, d):
    return targets(spark, d)[1]


@query(f"WITH {LEVELS} SELECT REGION_TYPE, REGION_ID, grp, total AS COUNT FROM t")
def target_totals(spark, d):
    return targets(spark, d)[0]


@query()
def planned_totals_rho(spark, d):
    """The planned run with rho budgets: each group's total with Gaussian noise for its own budget."""
    return planned(spark, d, "zcdp", True)[0]


@query(f"WITH {LONG}, r AS (SELECT * FROM q WHERE sex <> 'P'), t AS (SELECT REGION_TYPE, REGION_ID, grp, count(*) AS n FROM r GROUP BY ALL) SELECT REGION_TYPE, REGION_ID, grp, CAST(n >= 100 AS INTEGER) + CAST(n >= 400 AS INTEGER) + CAST(n >= 2000 AS INTEGER) AS STAT_LEVEL FROM t")
def published_levels(spark, d):
    p = people(spark, d).filter("sex <> 'P'")
    cells = tabulate.with_marginals(tabulate.adaptive_cells(p, tabulate.levels(p, GROUPS, THRESHOLDS), GROUPS, SEXES[:2]), GROUPS)
    alone = F.count(F.lit(1)).over(Window.partitionBy(*GROUPS)) == 1
    table_only = cells.withColumn("alone", alone).filter("alone OR NOT (sex = '*' AND low = '*')").drop("alone")
    return characteristics.published_levels([table_only, table_only.limit(0)], GROUPS)


@query(f"WITH {LONG} SELECT REGION_TYPE, REGION_ID, grp, count(*) AS count FROM q GROUP BY ALL")
def detail_totals(spark, d):
    return tabulate.detail_totals(people(spark, d), GROUPS)


@query(f"WITH {CELLS} SELECT REGION_TYPE, REGION_ID, grp, low AS AGESTART, high AS AGEEND, CASE sex WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE sex END AS SEX, count AS COUNT FROM c")
def shaped_table(spark, d):
    p = people(spark, d)
    cells = tabulate.exact_cells(p, tabulate.levels(p, GROUPS, THRESHOLDS), GROUPS, SEXES)
    return tabulate.shaped(cells, GROUPS, {"O": "open", "F": "filled"})
