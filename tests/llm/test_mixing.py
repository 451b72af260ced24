from pyspark.sql import functions as F

from tallyveil.llm.mixing import OP7_SQL, mixed_documents, mixture

ROWS = [(1, "a b c", "x", 1), (2, "a", "x", 2), (2, "a", "x", 3), (3, "", "y", 4), (4, None, None, 5), (5, "w " * 50_000, "z", 6), (6, "q q", None, 7), (None, "c d", "x", 8), (None, None, "only empty", 9)]
SCHEMA = "doc_id long, text string, source string, size int"


def test_against_sql(spark, same_as_sql):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    same_as_sql(mixture(docs), OP7_SQL)


def test_edge_rows(spark, same_as_sql):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    same_as_sql(mixture(docs), OP7_SQL, {"documents": docs})


def test_budgets_are_met(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = mixture(docs).alias("m").join(docs.select("doc_id", "source").alias("d"), "doc_id")
    for r in out.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.first("source_size").alias("s"), F.max(F.col("taken") - 2 * F.col("size")).alias("over")).collect():
        assert r.t == int(r.g) and r.g <= 2 * r.s and r.over <= 0


def test_rows_of_the_mix(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumn("mix_words", F.lit("old"))
    out = mixed_documents(docs)
    assert out.columns == ["doc_id", "text", "source", "size", "mix_words"]
    taken = {(r.doc_id, r.taken): 1 for r in mixture(docs).collect() if r.taken}
    assert {(r.doc_id, r.mix_words): 1 for r in out.collect()} == taken


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixture(docs).collect() == []
    assert mixed_documents(docs).collect() == []
