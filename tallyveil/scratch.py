"""Tables written once into the folder that the whole cluster shares."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; a local folder only where the setting is unset and Spark runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "/tmp/checkpoints"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_root(spark)}/tallyveil/{name}-{uuid.uuid4().hex}"


#: Rows of a file where a table is known to be small.
ROWS_OF_FILE = 50_000


def staged(df: DataFrame, name: str, most_rows: int | None = None) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back.

    Later steps then start from files that outlive executors, and what is
    costly or random in df happens once. most_rows, where it is known, bounds
    the number of tasks and files: each writer holds buffers of its own.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    if most_rows is not None:
        df = df.coalesce(max(1, -(-most_rows // ROWS_OF_FILE)))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """While it is open, Python gets at most so many rows at a time: for rows that are long texts or lists. What runs later has the session's own setting."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
