"""Sinks: split tables and score tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.score import submission


def write_splits(df: DataFrame, path: str, split: str = "split", fmt: str = "parquet") -> None:
    """One folder per part, written in one job.  ``fmt`` is ``parquet`` or ``csv``."""
    writer = df.write.mode("overwrite").partitionBy(split)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}: use 'parquet' or 'csv'")


def write_submission(scored: DataFrame, path: str, id_column: str, score: str = "score",
                     id_name: str = "id", value_name: str = "drafted") -> DataFrame:
    """Write ``(id, score)`` rows as CSV with a header and return the written table."""
    table = submission(scored, id_column, score, id_name, value_name)
    table.write.mode("overwrite").option("header", True).csv(path)
    return table
