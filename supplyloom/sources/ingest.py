"""Incremental pulls of changed records: each change is stored once, however often it is delivered.

A change is a key with its time of change. The table of changes keeps a high-water mark per source, the latest time of change
a run has stored; it is published in the same step as the rows of the run (``versions``). Changes up to ``lateness`` below the mark
are taken if they are not stored yet. What is older and unknown is late; late and unreadable records go to a quarantine
table instead of vanishing. A run that is repeated replaces its own rows and sees the mark that it saw the first time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, StringType, StructField, StructType

from supplyloom.operators.windows import first_per_key
from supplyloom.session import stable
from supplyloom.sources import runlog, versions
from supplyloom.sources.companies import ROW_TAG

CORRUPT_COLUMN = "_corrupt_record"
ACCEPTED, LATE, NO_TIME, CORRUPT = "accepted", "late", "no time of change", "corrupt"
QUARANTINE = "source string, reason string, record string, record_hash string"
MARKS = "marks"


@dataclass(frozen=True)
class Pull:
    """What a pull did: new changes, quarantined records by reason, and the mark it leaves."""

    accepted: int
    quarantined: Mapping[str, int]
    mark: datetime | None


def read_records(spark: SparkSession, path: str, schema: StructType, row_tag: str = ROW_TAG) -> DataFrame:
    """Records of the XML files under ``path``. One with a value that does not fit ``schema`` keeps its texts, as JSON, in
    ``_corrupt_record``; of a document that is no XML that column holds the text.

    Plain values are read as text and cast here, because the reader itself would keep the whole document for every bad value.
    """
    plain = [f.name for f in schema.fields if isinstance(f.dataType, AtomicType)]
    texts = [StructField(f.name, StringType() if f.name in plain else f.dataType) for f in schema.fields]
    reader = spark.read.format("xml").option("rowTag", row_tag).option("mode", "PERMISSIVE")
    read = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN).schema(StructType([*texts, StructField(CORRUPT_COLUMN, StringType())]))
    records = read.load(path)
    typed = {f.name: F.col(f.name).try_cast(f.dataType) if f.name in plain else F.col(f.name) for f in schema.fields}
    misfit = reduce(lambda a, b: a | b, [F.col(n).isNotNull() & typed[n].isNull() for n in plain], F.lit(False))
    corrupt = F.coalesce(CORRUPT_COLUMN, F.when(misfit, F.to_json(F.struct(*schema.names))))
    return records.select(*[c.alias(n) for n, c in typed.items()], corrupt.alias(CORRUPT_COLUMN))


def marks_before(state: Mapping[str, object], source: str, run_id: str) -> list[list[str]]:
    """(run, mark) of the runs of ``source`` that came before ``run_id``; all of them for a new run."""
    seen = state.get(MARKS, {}).get(source, [])
    runs = [run for run, _ in seen]
    return list(seen[: runs.index(run_id)] if run_id in runs else seen)


def high_water_mark(state: Mapping[str, object], source: str, run_id: str) -> datetime | None:
    """The latest time of change that runs of ``source`` before ``run_id`` have stored."""
    marks = [datetime.fromisoformat(mark) for _, mark in marks_before(state, source, run_id) if mark]
    return max(marks, default=None)


def _with_mark(state: Mapping[str, object], source: str, run_id: str, mark: datetime | None) -> dict[str, object]:
    seen = list(state.get(MARKS, {}).get(source, []))
    entry = [run_id, mark.isoformat() if mark else None]
    places = [i for i, (run, _) in enumerate(seen) if run == run_id]
    if places:
        seen[places[0]] = entry
    else:
        seen.append(entry)
    return {**state, MARKS: {**state.get(MARKS, {}), source: seen}}


def judged(records: DataFrame, known: DataFrame, key: Sequence[str], changed: str, horizon: datetime | None) -> DataFrame:
    """Records with their ``_reason``: accepted, late, or why they cannot be read. Known changes and repetitions are gone.

    ``known`` holds the stored changes (``key`` and ``changed`` as time stamp).
    """
    columns = [c for c in records.columns if c != CORRUPT_COLUMN]
    text = F.to_json(F.struct(*columns))
    broken = F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in records.columns else F.lit(False)
    if CORRUPT_COLUMN in records.columns:
        text = F.coalesce(CORRUPT_COLUMN, text)
    when = F.col(changed).try_cast("timestamp_ntz")
    nameless = F.lit(False)
    for k in key:
        nameless = nameless | F.col(k).isNull()
    late = F.lit(False) if horizon is None else when < F.lit(horizon.isoformat(sep=" ")).cast("timestamp_ntz")
    reason = F.when(broken | nameless, CORRUPT).when(when.isNull(), NO_TIME).when(late, LATE).otherwise(ACCEPTED)
    named = records.withColumns({"_record": text, "_when": when, "_reason": reason}).drop(CORRUPT_COLUMN)
    readable, rest = F.col("_reason").isin(ACCEPTED, LATE), ~F.col("_reason").isin(ACCEPTED, LATE)
    once = first_per_key(named.filter(readable), [*key, "_when"], [F.col("_record")])
    stored = known.select(*[F.col(k).alias(f"_k_{k}") for k in key], F.col(changed).alias("_k_when"))
    same = [F.col(k) == F.col(f"_k_{k}") for k in key] + [F.col("_when") == F.col("_k_when")]
    return once.join(stored, same, "left_anti").unionByName(named.filter(rest))


def quarantine_rows(found: DataFrame, source: str, earlier: DataFrame) -> DataFrame:
    """Records that were not accepted, each once; those that ``earlier`` runs put there are left out."""
    rows = found.filter(F.col("_reason") != ACCEPTED).select(
        F.lit(source).alias("source"), F.col("_reason").alias("reason"), F.col("_record").alias("record"), F.sha2("_record", 256).alias("record_hash")
    )
    keys = ["source", "record_hash"]
    return rows.dropDuplicates(keys).join(earlier.select(*keys), keys, "left_anti").select("source", "reason", "record", "record_hash")


def pull(
    records: DataFrame,
    path: str,
    quarantine_path: str,
    source: str,
    run_id: str,
    as_of: datetime,
    key: Sequence[str] = ("id",),
    changed: str = "updated_at",
    lateness: timedelta = timedelta(days=1),
    log_path: str | None = None,
) -> Pull:
    """Store the new changes of ``records`` under ``path``, the unusable ones under ``quarantine_path``, and log the counts.

    ``records`` has the time of change as text. It is stored as a time stamp. A time after ``as_of`` is stored but does not raise
    the mark above ``as_of``. The quarantine is written first; a run that fails in between is simply run again.
    """
    spark, key = records.sparkSession, list(key)
    before = versions.current(spark, path)
    mark = high_water_mark(before.state, source, run_id)
    others = versions.read_runs(spark, path, lambda run: run != run_id)
    if not others.columns:
        others = spark.createDataFrame([], StructType([*[records.schema[k] for k in key]])).withColumn(changed, F.lit(None).cast("timestamp_ntz"))
    found = stable(judged(records, others, key, changed, mark - lateness if mark else None))

    set_aside = versions.read_runs(spark, quarantine_path, lambda run: run != run_id)
    if not set_aside.columns:
        set_aside = spark.createDataFrame([], QUARANTINE)
    versions.append_run(quarantine_rows(found, source, set_aside), quarantine_path, run_id)
    mine = versions.read_runs(spark, quarantine_path, lambda run: run == run_id)
    quarantined = {r["reason"]: r["n"] for r in mine.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}

    new = found.filter(F.col("_reason") == ACCEPTED).withColumn(changed, F.col("_when")).drop("_when", "_reason", "_record")
    latest = new.agg(F.max(changed)).first()[0]
    reached = max((m for m in (min(latest, as_of) if latest else None, mark) if m), default=None)
    version = versions.append_run(new, path, run_id, lambda state: _with_mark(state, source, run_id, reached))
    accepted = version.parts[run_id].rows
    if log_path is not None:
        counts = {ACCEPTED: accepted, **{reason: quarantined.get(reason, 0) for reason in (LATE, NO_TIME, CORRUPT)}}
        runlog.append_run_log(spark, log_path, f"pull of {source}", counts, as_of=as_of)
    return Pull(accepted, quarantined, reached)
