"""Delimited text output."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_delimited(df: DataFrame, folder: str, *, sep: str = "|", append: bool = False, parts: int | None = None) -> None:
    """Writes text with a header, running the plan once; an empty table still gives a file that has it. parts: files at most (1: a single one)."""
    spark = df.sparkSession
    out = df.coalesce(parts) if parts else df
    out.write.mode("append" if append else "overwrite").option("header", True).option("sep", sep).csv(folder)
    # A task without rows may leave no file, so what was written tells whether the header is there.
    if spark.read.text(folder).isEmpty():
        spark.createDataFrame([], df.schema).coalesce(1).write.mode("append").option("header", True).option("sep", sep).csv(folder)
    header = spark.createDataFrame([(sep.join(df.columns),)], "value string").coalesce(1)
    header.write.mode("overwrite").text(f"{folder.rstrip('/')}_header")
