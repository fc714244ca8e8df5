"""Log of job runs: category, counts, elapsed time, time stamp."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = "category string, message string, metrics map<string,bigint>, elapsed_seconds double, created_at timestamp_ntz"


def run_log_entry(
    spark: SparkSession, category: str, metrics: Mapping[str, int], elapsed: float, as_of: datetime
) -> DataFrame:
    message = "\n".join(f"{name}: {value}" for name, value in metrics.items())
    row = (category, message, {k: int(v) for k, v in metrics.items()}, round(float(elapsed), 3), as_of)
    return spark.createDataFrame([row], SCHEMA)


def append_run_log(
    spark: SparkSession, path: str, category: str, metrics: Mapping[str, int], elapsed: float = 0.0, as_of: datetime | None = None
) -> None:
    """Append one entry to the log table at ``path``."""
    run_log_entry(spark, category, metrics, elapsed, as_of or datetime.now()).write.mode("append").parquet(path)


def write_logged(
    df: DataFrame, write: Callable[[DataFrame], None], log_path: str, category: str, as_of: datetime | None = None
) -> int:
    """Write ``df`` and log the row count, which is observed during the write itself, not counted again."""
    seen = Observation()
    started = time.monotonic()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    rows = int(seen.get["rows"])
    append_run_log(df.sparkSession, log_path, category, {"rows": rows}, time.monotonic() - started, as_of)
    return rows
