import pytest

from tallyveil.llm import decontaminate
from tallyveil.llm.decontaminate import OP9_SQL, clean_documents, contamination, without_spans

LONG = " ".join(f"w{i}" for i in range(30))
ROWS = [
    (1, f"Before, {LONG.upper()} after", 1), (2, "Nothing here", 2), (3, None, 3), (4, "", 4), (5, "Short-Item twice: short item!", 5), (5, "Short-Item twice: short item!", 5),
    (6, "x " * 30_000 + LONG, 6), (None, f"{LONG}", 7), (7, "w0 w1 w2 w3 w4 w5 w6 w7 w8", 8), (8, "ÉTÉ w1", 9), (8, LONG, 9),
]
ITEMS = [(1, LONG), (2, "short item"), (10, "short   ITEM"), (3, None), (4, "..."), (5, "été"), (None, " ".join(f"w{i}" for i in range(5, 18)))]
SCHEMA = "doc_id long, text string, start int"


def tables(spark):
    return spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(ITEMS, "item_id long, text string")


def test_against_sql(spark, same_as_sql):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    same_as_sql(contamination(docs, items), OP9_SQL)


@pytest.mark.parametrize("most", [decontaminate.MOST_BROADCAST, 0])
def test_edge_rows(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", most)
    docs, items = tables(spark)
    got = sorted(((r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in contamination(docs, items).collect()))
    assert got == sorted([(1, 32, 30, 2, True), (2, 2, 0, 0, False), (3, 0, 0, 0, False), (4, 0, 0, 0, False), (5, 5, 4, 2, True), (5, 5, 4, 2, True), (6, 30_030, 30, 2, True), (0, 30, 30, 2, True), (7, 9, 0, 0, False), (8, 2, 0, 0, False), (8, 30, 30, 2, True)])


def test_against_sql_without_null_items(spark, same_as_sql):
    docs, items = tables(spark)
    items = items.filter("item_id IS NOT NULL")
    same_as_sql(contamination(docs, items), OP9_SQL, {"documents": docs, "benchmark": items})


def test_removal(spark):
    docs, items = tables(spark)
    assert sorted(r.start for r in clean_documents(docs, items).collect()) == [2, 3, 4, 8, 9]
    cut = {r.start: r.text for r in without_spans(docs, items).filter("doc_id <> 8").collect()}
    assert cut[1] == "Before after" and cut[2] == "Nothing here" and cut[3] is None and cut[5] == " twice!" and cut[6].strip() == ("x " * 30_000).strip()


def test_empty_tables(spark):
    docs, items = tables(spark)
    assert contamination(docs.limit(0), items).collect() == []
    assert not any(r.contaminated for r in contamination(docs, items.limit(0)).collect())
    assert clean_documents(docs, items.limit(0)).count() == len(ROWS)
