"""Quality classifier: supervised subword embeddings over words as they stand, with a softmax output."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.llm import subwords
from supplyloom.llm.common import hash_share

TRAIN_ROWS = 2_500  # bound of the labelled rows of each class that the model is fitted on
GOOD_FROM = 0.3


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, parts: int = 5, held_out: int = 0) -> subwords.Model:
    """Fit on a bounded, balanced sample of the rows that are not held out; the bias then gets the shares of the
    classes among all labelled rows that are not held out."""
    known = labels.filter(hash_share(F.col("doc_id"), parts) != held_out).select("doc_id", F.col("quality").alias("label"))
    texts, marks = subwords.sample(docs, known, rows)
    model = subwords.fit(texts, marks, "raw")
    counts = {r.label: r["count"] for r in known.filter("label is not null").groupBy("label").count().collect()}
    used = {c: max(1, marks.count(c)) for c in model.classes}
    shift = np.array([np.log(counts[c] / used[c]) for c in model.classes])
    model.bias = model.bias + model.temperature * (shift - shift.mean() if len(shift) else shift)
    return model


def judge(docs: DataFrame, labels: DataFrame, parts: int = 5, held_out: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    NULL and empty texts get the score of the bias alone. Without labels of class 1 every score is 0. A NULL id is
    not held out and takes no part in training.
    """
    model = train(docs, labels, parts=parts, held_out=held_out)
    good = model.classes.index(1) if 1 in model.classes else -1
    score = subwords.class_probabilities(model, F.col("text"), docs.sparkSession)[good] if good >= 0 else F.lit(0.0)
    return docs.select(
        "doc_id", F.coalesce(hash_share(F.col("doc_id"), parts) == held_out, F.lit(False)).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= GOOD_FROM).cast("int"))
