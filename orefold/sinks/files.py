"""File outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orefold.session import work_dir

#: How parquet files are written: a lake keeps many copies of long texts and hashes. Pages of version 2 hold numbers as
#: differences, and decimals and texts without the prefix they share with the one before.
FILES = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Delimited text with a header, one file per partition."""
    df.write.mode(mode).option("header", True).csv(path)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes ``df`` to the shared work folder and reads it back: computed once, and safe from lost executors."""
    path = work_dir(df.sparkSession, purpose)
    df.write.options(**FILES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
