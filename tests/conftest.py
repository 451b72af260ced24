from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "3g")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def normal(rows, columns):
    """Rows as sorted tuples, columns by name; integers, floats and lists in one form."""

    def value(x):
        if isinstance(x, float):
            return repr(round(x, 6) + 0.0)
        if isinstance(x, (list, tuple)):
            return repr([value(y) for y in x])
        if isinstance(x, bool):
            return repr(x)
        if x is not None and type(x).__name__ == "Timestamp":
            return repr(x.to_pydatetime())
        return repr(x)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(value(r[i]) for i in order) for r in rows), sorted(columns)


@pytest.fixture(scope="session")
def same_as_sql(spark):
    """Holds a query against its SQL on the small tables, or on tables given as DataFrames."""

    def run(df, sql, tables=None):
        con = duckdb.connect()
        con.execute("SET TimeZone='UTC'")
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        for name, rows in (tables or {}).items():
            con.execute(f"DROP VIEW IF EXISTS {name}")
            con.register(name, rows.toArrow())
        got = normal([tuple(r) for r in df.collect()], df.columns)
        cur = con.execute(sql)
        want = normal(cur.fetchall(), [c[0] for c in cur.description])
        assert got[1] == want[1]
        assert len(got[0]) == len(want[0])
        assert got[0] == want[0]

    return run
