import pytest

import __spark_entry__
from tallyveil.llm import line_dedup
from tallyveil.llm.line_dedup import OP4_SQL, boilerplate, line_spread, lines, without_boilerplate

SCHEMA = "doc_id long, text string, source string"
#: A line on 10 sites, one on 9 sites and a null one, one with many copies on a single site, one on 40 sites, one on 10 sites of which one is empty.
ROWS = [(i, f" ten\t\nown {i}\n\nforty", f"s{i}") for i in range(10)] + [(10 + i, "nine\r\nforty", f"s{i}" if i < 9 else None) for i in range(10)]
ROWS += [(20 + i, "copied\n" * 20, "s0") for i in range(10)] + [(30 + i, f"forty\nempty\n{i}" if i < 10 else "forty", f"t{i}" if i else "") for i in range(40)]
ROWS += [(None, "ten\nx", None), (0, None, "s0"), (1, "", "s1"), (2, "\n\n", "s2"), (3, "é ten\nten", "s3"), (3, "é ten\nten", "s3")]


def test_registered(spark, same_as_sql):
    assert __spark_entry__.oracle_sql()["op4_line_dedup"] == OP4_SQL
    same_as_sql(__spark_entry__.queries()["op4_line_dedup"](spark, "/root/testdata/sf0.001"), OP4_SQL)


@pytest.mark.parametrize("most", [line_dedup.MOST_BROADCAST, 0])
def test_edge_rows(spark, same_as_sql, monkeypatch, most):
    monkeypatch.setattr(line_dedup, "MOST_BROADCAST", most)
    docs = spark.createDataFrame(ROWS, SCHEMA)
    same_as_sql(line_spread(docs), OP4_SQL, {"documents": docs})
    kept = {line for r in without_boilerplate(docs).collect() for line in (r.text or "").split("\n")}
    assert not kept & {" ten\t", "ten", "forty", "empty"} and {"nine\r", "copied", "é ten", "own 3"} <= kept


def test_whole_table(spark, same_as_sql):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    same_as_sql(line_spread(docs), OP4_SQL, {"documents": docs})
    assert line_spread(docs).filter("n_removed > 0").count() > 0


def test_counts_near_a_large_threshold(spark):
    docs = spark.range(40 * 2020).selectExpr("id AS doc_id", "concat('line ', id % 40) AS text", "concat('s', id div 40) AS source").filter("cast(substring(source, 2) as int) < 1980 + cast(substring(text, 6) as int)")
    assert boilerplate(lines(docs), min_sites=2000).count() == 20  # lines 20 to 39 are on 2,000 to 2,019 sites


def test_empty_table(spark):
    assert line_spread(spark.createDataFrame([], SCHEMA)).collect() == []
