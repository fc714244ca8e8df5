"""Report files: one header line per file, as many files as the plan has tasks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from supplyloom.functions.dates import fiscal_year_number, fiscal_year_span


def write_report(df: DataFrame, path: str, header: bool = True) -> str:
    """CSV with the column names on top; an empty report still has its header. Quotes are doubled, as spreadsheets expect."""
    df.write.mode("overwrite").option("header", header).option("escape", '"').csv(path)
    return path


def read_report(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A written report, with line breaks inside its texts kept."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def current_year_rows(df: DataFrame, date_col: str, as_of: date) -> DataFrame:
    """Rows dated in the fiscal year of ``as_of``, by a range the scan can evaluate."""
    start, end = fiscal_year_span(as_of)
    return df.filter((F.col(date_col) >= F.lit(start)) & (F.col(date_col) < F.lit(end)))


def export_full_and_fy(df: DataFrame, date_col: str, path: str, as_of: date) -> tuple[str, str]:
    """Two reports: everything, and the current fiscal year with the year in its name."""
    full = write_report(df, path)
    written = read_report(df.sparkSession, path, df.schema)  # the report is computed once
    return full, write_report(current_year_rows(written, date_col, as_of), f"{path}_{fiscal_year_number(as_of)}")
