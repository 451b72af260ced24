from pyspark.sql import functions as F

from tallyveil.llm.exact_dedup import OP2_SQL, drop_exact_duplicates, exact_groups

ROWS = [(1, "a", "x"), (2, "a", "x"), (3, "", "y"), (4, None, None), (5, "b" * 100_000, "x"), (6, "b" * 100_000, "z"), (6, "b" * 100_000, "z"), (None, "c", "x"), (7, "A", "x"), (8, "a ", "x"), (None, "a", "x")]
SCHEMA = "doc_id long, text string, digest string"


def test_against_sql(spark, same_as_sql):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    same_as_sql(exact_groups(docs), OP2_SQL)


def test_edge_rows(spark, same_as_sql):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    same_as_sql(exact_groups(docs), OP2_SQL, {"documents": docs})


def test_clashing_digests(spark, same_as_sql):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    weak = lambda text: F.length(text)
    same_as_sql(exact_groups(docs, digest=weak, salts=3), OP2_SQL, {"documents": docs})


def test_rows_that_stay(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(True, 2, "a"), (True, 4, ""), (True, 6, "b" * 100_000), (False, 0, "c"), (True, 7, "A"), (True, 8, "a ")])


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_groups(docs).collect() == []
    assert drop_exact_duplicates(docs).collect() == []
