"""Near-duplicates by SimHash; links are found on a grid of segment bit counts.

A fingerprint of 64 bits is embedded as 16 bit counts, one for each segment of 4 bits. Flipping one bit moves one
count by one, so the Manhattan distance of two embeddings never exceeds the number of differing bits. Two
fingerprints with at most two differing bits therefore have a grid cell at Manhattan distance one or less from
both. Every distinct fingerprint is put into the 33 cells around it, and only cells that hold two different
fingerprints go on. The exact check lists, within such a cell, the values one flip away that lie in the cell:
fingerprints that share a value differ in two bits at most, and those that differ in two bits at most share one.
Groups are chained through the smallest member of a value, so no pairs of a group are listed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyloom.llm.common import staged
from supplyloom.llm.components import components
from supplyloom.session import stable

SEGMENT_BITS = 4
SEGMENTS = 64 // SEGMENT_BITS
COUNT_BITS = 3  # a count of 0 to 4
SEED = 42


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of one text: a bit is set if it is set in over half of the shingle hashes."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, seed=SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):  # bounded memory for very long texts
        block = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(texts: Column, shingle: int = 3) -> Column:
    @F.arrow_udf("long")
    def simhash(batch: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t, shingle) for t in batch.to_pylist()], type=pa.int64())

    return simhash(texts)


def _ones(segment: int) -> Column:
    return F.bit_count(F.shiftrightunsigned("fp", segment * SEGMENT_BITS).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1)))


def links(fps: DataFrame) -> DataFrame:
    """Chains ``a, b`` that connect exactly the fingerprints (column ``fp``, distinct) two or fewer bits apart."""
    home = sum((_ones(s).cast("long") * (1 << (COUNT_BITS * s)) for s in range(1, SEGMENTS)), _ones(0).cast("long"))
    steps = [F.struct(F.lit(-1).alias("segment"), F.lit(0).alias("step"))]
    for s in range(SEGMENTS):
        steps.append(F.when(_ones(s) < SEGMENT_BITS, F.struct(F.lit(s).alias("segment"), F.lit(1).alias("step"))))
        steps.append(F.when(_ones(s) > 0, F.struct(F.lit(s).alias("segment"), F.lit(-1).alias("step"))))
    around = fps.select("fp", home.alias("home"), F.explode(F.array_compact(F.array(*steps))).alias("to")).select(
        "fp",
        F.col("to.segment").alias("segment"),
        F.col("to.step").alias("step"),
        F.when(F.col("to.step") == 0, F.col("home"))
        .otherwise(F.col("home") + F.col("to.step") * F.expr(f"shiftleft(1L, {COUNT_BITS} * greatest(to.segment, 0))"))
        .alias("cell"),
    )
    shared = around.groupBy("cell").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
    near = around.join(shared.filter(F.col("low") < F.col("high")).select("cell"), "cell", "left_semi")
    bit = F.expr(f"shiftleft(1L, segment * {SEGMENT_BITS} + offset)")
    is_set = F.col("fp").bitwiseAND(bit) != 0
    flips = (
        near.filter("step != 0")
        .withColumn("offset", F.explode(F.sequence(F.lit(0), F.lit(SEGMENT_BITS - 1))))
        .filter(F.when(F.col("step") > 0, ~is_set).otherwise(is_set))
        .select("fp", F.col("fp").bitwiseXOR(bit).alias("value"))
    )
    values = stable(flips.union(near.filter("step = 0").select("fp", F.col("fp").alias("value"))))
    first = values.groupBy("value").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low < high")
    return (
        values.join(first, "value").filter(F.col("fp") != F.col("low")).select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()
    )


def _roots(fps: DataFrame) -> DataFrame:
    """``fp, root`` for distinct fingerprints: the smallest fingerprint that is reachable."""
    roots = components(links(fps))
    return fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    A text without words (NULL, empty, only white space) has fingerprint zero and is linked like any other.
    Rows with the same id are rows of their own; the component id is the smallest id, NULL ids last. Extra
    columns of ``docs`` play no part. An empty table gives an empty result.
    """
    rows = staged(docs.select(F.col(id_col).alias("doc_id"), fingerprints(F.col(text_col), shingle).alias("fp")))
    known = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    groups = known.join(_roots(known.select("fp")), "fp")
    lowest = groups.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = groups.join(lowest, "root").select("fp", "component_id")
    return rows.join(of_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns.

    It is the one with the smallest id, NULL ids last, then the smallest text hash (128 bits); of fully repeated rows one stays.
    Rows that share an id but not a group are rows of their own. An empty table gives an empty result.
    """
    node = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    rows = staged(docs.select(F.col(id_col).alias("id"), node.alias("text_hash"), fingerprints(F.col(text_col), shingle).alias("fp")))
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("best")
    of_fp = rows.groupBy("fp").agg(best)
    groups = of_fp.join(_roots(of_fp.select("fp")), "fp")
    kept = groups.groupBy("root").agg(F.min("best").alias("best"))
    kept = kept.select(F.col("best.id").alias("__keep_id"), F.col("best.text_hash").alias("__keep_hash"))
    found = docs.join(kept, F.col(id_col).eqNullSafe(F.col("__keep_id")) & (node == F.col("__keep_hash")), "left_semi")
    one = Window.partitionBy(id_col, node).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    return found.withColumn("__keep_rank", F.row_number().over(one)).filter("__keep_rank = 1").drop("__keep_rank")
