"""Named Parquet tables: read, replace, append."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan a named table; a schema prefix is part of the name (``sq.request``)."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path``. Output stays in as many files as the plan has tasks."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def append_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing rows followed by new ones; columns are matched by name, missing ones become NULL."""
    return existing.unionByName(new, allowMissingColumns=True)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
