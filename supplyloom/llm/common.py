"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyloom.session import shared_folder, write_rows

_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()  # where ``staged`` put a table
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: computed once, lineage cut.

    The files go when the application ends, or with ``unstaged``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    write_rows(df, path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def unstaged(*tables: DataFrame) -> None:
    """Deletes the files of tables made by ``staged`` that nothing reads any more."""
    for df in tables:
        jvm_path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(_PATHS[df])
        jvm_path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(jvm_path, True)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is. ``lower`` does the same where the text is pure ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def hash_share(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; NULL keys give NULL."""
    return F.crc32(key.cast("string").cast("binary")) % parts
