"""Draw documents that look like a target collection: importance resampling over hashed word runs.

Words are cut by the pre-tokenisation of the ``tokenizers`` library, an untrained regular-expression split over the text in
ASCII lower case, which returns every word with its offsets. Windows of neighbouring offset pairs are the runs of 1 to
``MAX_RUN`` words; the CRC of a run says which of ``BUCKETS`` buckets it falls into. The histograms of both collections give
every bucket a gain, a document weighs the mean gain of its runs, and a keyed Gumbel number makes the highest scores a
draw without replacement.

A document's bucket counts are made once and staged, so that the gains, which need all documents, cost no second pass over the
texts. What the driver sees are the bucket totals of each collection, ``BUCKETS`` rows whatever the size.

Defined cases: a NULL text has no words; a document without words weighs 0. Ties of score go to the smaller id, NULL ids
last, then to the smaller hash of the text; a NULL id is keyed as an empty one. Repeated rows are rows of their own with the
same score. With an empty target the gains still follow the formula (t = T = 0); an empty table gives no rows. Other columns
are not touched. A text of any length is cut in pieces of ``PIECE`` code points at least, between words, so that the lists
of words stay short; a run across two pieces counts like any other.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from supplyloom.llm.common import staged

BUCKETS = 10_000
MAX_RUN = 2
SEED = 7
MIN_WORDS = 20
PERCENT = 25
GAIN_UNIT = 1000
PIECE = 200_000
# everything in ASCII that is neither a digit nor a small letter separates words
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEPARATOR = re.compile(SEPARATORS)

COUNT_SCHEMA = "doc_id long, text_hash long, n_words long, n_features long, buckets binary, counts binary"
TOTAL_SCHEMA = "bucket int, n long"


@cache
def splitter() -> Split:
    return Split(Regex(SEPARATORS), behavior="removed")


def pieces(text: str) -> Iterator[str]:
    """The text in parts that end between words."""
    start = 0
    while len(text) - start > PIECE:
        gap = SEPARATOR.search(text, start + PIECE)
        if gap is None:
            break
        yield text[start : gap.start()]
        start = gap.start()
    yield text[start:] if start else text


def run_sums(text: str) -> Iterator[tuple[int, list[int]]]:
    """Per piece of a text its number of words, and the CRC of each run that ends in it.

    The CRC of a run goes on from that of the run one word shorter, so no run is ever put together as a string.
    """
    lowered = text.encode().lower().decode()
    tails: list[int] = []  # sums of the runs of 1, 2, ... words that end at the word before
    for piece in pieces(lowered):
        offsets = [window for _, window in splitter().pre_tokenize_str(piece)]
        found = []
        for start, end in offsets:
            word = piece[start:end].encode()
            further = b" " + word
            tails = [zlib.crc32(word), *[zlib.crc32(further, s) for s in tails[: MAX_RUN - 1]]]
            found += tails
        yield len(offsets), found


def bucket_counts(text: str | None) -> tuple[int, int, bytes, bytes]:
    """Words, runs, and the buckets of the runs with their counts; at most ``BUCKETS`` of them for a text of any length."""
    n_words, n_runs, total = 0, 0, np.zeros(BUCKETS, dtype=np.int64)
    for words, sums in run_sums(text or ""):
        n_words += words
        n_runs += len(sums)
        total += np.bincount(np.array(sums, dtype=np.uint32) % BUCKETS, minlength=BUCKETS)
    found = np.flatnonzero(total)
    return n_words, n_runs, found.astype("<u2").tobytes(), total[found].astype("<u4").tobytes()


def feature_counts(docs: DataFrame) -> DataFrame:
    """``COUNT_SCHEMA``: the bucket counts of every row of ``docs`` (``doc_id``, ``text``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [bucket_counts(t.as_py()) for t in batch.column("text")]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            counted = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), *counted],
                names=["doc_id", "text_hash", "n_words", "n_features", "buckets", "counts"],
            )

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return named.mapInArrow(count, COUNT_SCHEMA)


def bucket_totals(counted: DataFrame) -> np.ndarray:
    """Runs per bucket over all rows: every task adds up its own rows first, the driver gets one row per bucket."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for found, counts in zip(batch.column("buckets"), batch.column("counts"), strict=True):
                total[np.frombuffer(found.as_py(), "<u2")] += np.frombuffer(counts.as_py(), "<u4")
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], names=["bucket", "n"])

    parts = counted.select("buckets", "counts").mapInArrow(add, TOTAL_SCHEMA)
    totals = np.zeros(BUCKETS, dtype=np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        totals[row["bucket"]] = row["n"]
    return totals


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole-number gain of every bucket, from smoothed shares of target and source."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(GAIN_UNIT * np.log(ratio)).astype(np.int64)


def mean_gain(gain: np.ndarray) -> Column:
    """Mean gain over the runs of a document, rounded down; 0 without runs."""

    @F.pandas_udf("long")
    def weigh(buckets: pd.Series, counts: pd.Series, n_features: pd.Series) -> pd.Series:
        sums = [
            int(np.dot(gain[np.frombuffer(b, "<u2")], np.frombuffer(c, "<u4").astype(np.int64)))
            for b, c in zip(buckets, counts, strict=True)
        ]
        return pd.Series([s // n if n else 0 for s, n in zip(sums, n_features, strict=True)], dtype="int64")

    return weigh("buckets", "counts", "n_features")


def gumbel(key: Column, seed: int) -> Column:
    """A Gumbel number in thousandths, rounded down, from the SHA-256 of seed and key."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share)))


def with_rank(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """Add ``rank``: 1, 2, 3, ... on the ``percent`` of eligible rows with the highest scores, NULL on all others.

    Scores are whole numbers between bounds that grow with the logarithm of the corpus only (gains and Gumbel numbers span
    some 100,000 values), so the list of counts per score stays small; it tells every score how many rows stand above
    it. Rows are numbered within their score, nothing is sorted as a whole.
    """
    eligible = F.col("n_words") >= min_words
    counts = scored.filter(eligible).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    room = F.floor(F.sum("n").over(Window.partitionBy()) * percent / 100)
    levels = counts.select(
        F.col("score").alias("level"), F.coalesce(F.sum("n").over(above), F.lit(0)).alias("above"), room.alias("room")
    ).filter(F.col("above") < F.col("room"))
    placed = scored.join(F.broadcast(levels), eligible & (F.col("score") == F.col("level")), "left")
    within = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "text_hash")
    rank = F.col("above") + F.row_number().over(within)
    drawn = placed.filter(F.col("level").isNotNull()).withColumn("rank", rank)
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= F.col("room"), F.col("rank")))
    rest = placed.filter(F.col("level").isNull()).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).drop("level", "above", "room")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED
) -> DataFrame:
    """Every row of ``docs`` with its weight, score and rank: doc_id, text_hash, n_words, n_features, weight, score, rank.

    ``docs`` has ``doc_id`` and ``text``, ``target`` has ``text``.
    """
    counted = staged(feature_counts(docs))
    wanted = feature_counts(target.select(F.lit(None).cast("long").alias("doc_id"), "text"))
    gain = gains(bucket_totals(counted), bucket_totals(wanted))
    weighed = counted.select("doc_id", "text_hash", "n_words", "n_features", mean_gain(gain).alias("weight"))
    scored = staged(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)))
    return with_rank(scored, percent, min_words)


def drawn_documents(docs: DataFrame, ranked: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``resample`` drew. Rows that repeat id and text come together, if any of them is drawn."""
    drawn = ranked.filter(F.col("rank").isNotNull()).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    return docs.join(drawn, same, "left_semi")
