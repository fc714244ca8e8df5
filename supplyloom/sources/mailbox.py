"""Attachments of the mails of one day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyloom.operators.windows import first_per_key


def todays_attachments(mails: DataFrame, as_of: date) -> DataFrame:
    """First attachment of each mail sent on ``as_of`` that has any.

    ``mails`` has ``sent`` and ``attachments`` (array). All mails of the day count, however many there are.
    """
    start = F.lit(as_of).cast("timestamp_ntz")
    sent_today = (F.col("sent") >= start) & (F.col("sent") < start + F.expr("INTERVAL 1 DAY"))
    return (
        mails.filter(sent_today & (F.size("attachments") > 0))
        .withColumn("attachment", F.get("attachments", F.lit(0)))
        .drop("attachments")
    )


def attachment_files(spark: SparkSession, path: str) -> DataFrame:
    """Content of landed attachment files, one row per file that is not empty."""
    return spark.read.format("binaryFile").load(path)


def file_name(path: Column) -> Column:
    """The last part of a file's path, with the characters that paths escape."""
    return F.url_decode(F.replace(F.substring_index(path, "/", -1), F.lit("+"), F.lit("%2B")))


def with_content(attachments: DataFrame, files: DataFrame, name: Column | None = None) -> DataFrame:
    """Add ``content`` and ``length`` of the landed file of each attachment; NULL where none has landed or it is empty.

    ``name`` tells the attachment of a file, by default its file name. Of several files of one name the one changed last counts.
    Content travels once per file to the rows that name it; a file wanted by many mails is split by AQE.
    """
    named = files.withColumn("_name", file_name(F.col("path")) if name is None else name)
    latest = first_per_key(named, ["_name"], [F.desc("modificationTime"), F.col("path")]).select("_name", "content", "length")
    return attachments.join(latest, F.col("attachment") == F.col("_name"), "left").drop("_name")
