"""Language identification: averaged hashed subword embeddings with a linear softmax and calibrated rejection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.llm import subwords
from supplyloom.llm.common import hash_share

TRAIN_ROWS = 1_000  # bound of the rows of each language that the model is fitted on
UNKNOWN = "und"


def train(docs: DataFrame, rows: int = TRAIN_ROWS, parts: int = 3, held_out: int = 1) -> subwords.Model:
    known = docs.filter(hash_share(F.col("doc_id"), parts) != held_out).select("doc_id", F.col("lang").alias("label"))
    return subwords.fit(*subwords.sample(docs, known, rows), "letters")


def identify(docs: DataFrame, parts: int = 3, held_out: int = 1) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, accepted`` for every row.

    A text that is NULL or has no letter is ``und`` with score 0. ``accepted`` is false where the calibrated
    probability is below the one from which the kept training texts were answered rightly in 99 of 100 cases; the
    best language is given all the same. Ties go to the first language by name.
    """
    model = train(docs, parts=parts, held_out=held_out)
    share = F.coalesce(hash_share(F.col("doc_id"), parts) == held_out, F.lit(False)).alias("held_out")
    if not model.classes:
        return docs.select("doc_id", share, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    some = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("doc_id", share, some.alias("some"), subwords.class_probabilities(model, F.col("text"), docs.sparkSession).alias("p"))
    best = F.array_max("p")
    names = F.array(*(F.lit(c) for c in model.classes))
    return rows.select(
        "doc_id",
        "held_out",
        F.when(F.col("some"), names[F.array_position("p", best).cast("int") - 1]).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("some"), best).otherwise(0.0).alias("score"),
        (F.col("some") & (best >= model.accept)).alias("accepted"),
    )
