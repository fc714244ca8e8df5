"""Changed companies from landed XML documents (``<companies><Company>...</Company></companies>``)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ROW_TAG = "Company"


def changed_since(df: DataFrame, as_of: datetime, days: int = 1) -> DataFrame:
    """Records changed on or after the moment ``days`` before ``as_of``; a time stamp that cannot be read never counts as
    changed."""
    moment = (as_of - timedelta(days=days)).isoformat(sep=" ")
    return df.filter(F.col("updated_at").try_cast("timestamp_ntz") >= F.lit(moment).cast("timestamp_ntz"))


def read_companies_xml(
    spark: SparkSession, path: str, schema: StructType | str, as_of: datetime, days: int = 1
) -> DataFrame:
    """Company records of the XML files under ``path``; a document without companies gives no rows."""
    records = spark.read.format("xml").option("rowTag", ROW_TAG).schema(schema).load(path)
    return changed_since(records, as_of, days)


def parse_companies(documents: DataFrame, xml: Column, schema: str, as_of: datetime, days: int = 1) -> DataFrame:
    """The same for whole documents held in a text column. ``schema`` describes one company."""
    parsed = F.from_xml(xml, f"{ROW_TAG} array<struct<{schema}>>")
    records = documents.select(F.explode(parsed[ROW_TAG]).alias("c")).select("c.*")
    return changed_since(records, as_of, days)
