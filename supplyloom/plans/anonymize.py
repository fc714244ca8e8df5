"""Anonymisation of users without activity for a year, and of the mails they created."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyloom.functions.text import render_template
from supplyloom.operators.aggregates import inactive_users
from supplyloom.operators.joins import join_distinct
from supplyloom.session import stable
from supplyloom.sources import versions

# fixed values
USER_FIELDS = (
    "email", "full_name", "gid", "login", "department", "position", "org_unit", "location", "country", "are",
    "phone", "mobile", "department_long",
)
MAIL_FIELDS = ("from", "to", "subject", "cc", "bcc", "message")
MARK = "DELETED_"
LOG_CATEGORY = "gdpr"
AUDIT = "audit"


def anonymize_users(users: DataFrame, inactive: DataFrame) -> DataFrame:
    """Replace the personal fields of inactive users by ``DELETED_<id>`` and flag them."""
    hit = F.col("_inactive").isNotNull()
    mark = F.concat(F.lit(MARK), F.col("id").cast("string"))
    changes = {f: F.when(hit, mark).otherwise(F.col(f)) for f in USER_FIELDS}
    changes["is_anonymized"] = F.when(hit, F.lit(1)).otherwise(F.col("is_anonymized"))
    return join_distinct(users, inactive, "id", "_inactive", "created_by").withColumns(changes).drop("_inactive")


def blank_mails(mails: DataFrame, inactive: DataFrame) -> DataFrame:
    """Empty the texts of mails created by inactive users."""
    hit = F.col("_inactive").isNotNull()
    changes = {f: F.when(hit, F.lit("")).otherwise(F.col(f)) for f in MAIL_FIELDS}
    return join_distinct(mails, inactive, "created_by", "_inactive").withColumns(changes).drop("_inactive")


@dataclass(frozen=True)
class Anonymized:
    users: DataFrame
    mails: DataFrame
    counts: DataFrame  # one row: needs, users, mails


def anonymization_counts(users: DataFrame, mails: DataFrame, inactive: DataFrame) -> DataFrame:
    """Users still to anonymise, users and mails an update touches; no update without a user still to do."""
    ids = inactive.select(F.col("created_by").alias("id"))
    none = F.lit(0).cast("bigint")
    hit_users = users.join(ids, "id", "left_semi").agg(
        F.count_if(F.col("is_anonymized") == 0).alias("needs"), F.count(F.lit(1)).alias("users"), none.alias("mails")
    )
    hit_mails = mails.join(inactive, "created_by", "left_semi").agg(
        none.alias("needs"), none.alias("users"), F.count(F.lit(1)).alias("mails")
    )
    total = hit_users.unionByName(hit_mails).agg(*[F.sum(c).alias(c) for c in ("needs", "users", "mails")])
    return total.select("needs", *[F.when(F.col("needs") > 0, F.col(c)).otherwise(0).alias(c) for c in ("users", "mails")])


def anonymize(users: DataFrame, mails: DataFrame, log: DataFrame, as_of: date | datetime, years: int = 1) -> Anonymized:
    """The whole job. Without a user still to anonymise both tables come back unchanged.

    Users anonymised before are written again with the same values, so the job can be repeated. The inactive users
    are put into the shared folder once, so that users, mails and counts follow the same reading of the log.
    """
    inactive = stable(inactive_users(log, as_of, years))
    counts = stable(anonymization_counts(users, mails, inactive))
    if not counts.first().needs:
        return Anonymized(users, mails, counts)
    return Anonymized(anonymize_users(users, inactive), blank_mails(mails, inactive), counts)


def report_mail(counts: DataFrame, template: Mapping[str, str], as_of: date | datetime, elapsed: float) -> DataFrame:
    """The report to the administrators: ``title`` and ``body`` with the counts filled in.

    A run that found nobody to anonymise leaves the counts blank, as its readers know it.
    """
    done = F.col("needs") > 0
    values = {
        "USERS": F.when(done, F.col("users").cast("string")).otherwise(""),
        "MAILS": F.when(done, F.col("mails").cast("string")).otherwise(""),
        "DATE": F.date_format(F.lit(as_of), "yyyy-MM-dd"),
        "TIME": F.lit(f"{round(elapsed, 3)}s."),
    }
    return render_template(counts, template, values).select(*template)


def log_entry(counts: DataFrame, as_of: datetime, elapsed: float) -> DataFrame:
    """The log row of a run: category, message, created_at."""
    message = F.concat(
        F.lit("Anonymization: \nAnonymized Users: "), F.col("users").cast("string"),
        F.lit("\nAnonymized Emails: "), F.col("mails").cast("string"),
        F.lit(f"<strong>Time:</strong> {round(elapsed, 3)}s."),
    )
    return counts.select(
        F.lit(LOG_CATEGORY).alias("category"), message.alias("message"), F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz").alias("created_at")
    )


@dataclass(frozen=True)
class StoredRun:
    needs: int
    users: int
    mails: int


def anonymize_stored(
    spark: SparkSession, users_path: str, mails_path: str, log: DataFrame, as_of: datetime, run_id: str, years: int = 1
) -> StoredRun:
    """The job over stored tables (``versions``). The audit entry of the run is published with the rows it tells of.

    A run that fails between the two tables is run again under its id: writing a user again changes nothing, the entries
    of the run are replaced, and the counts of the first attempt are kept.
    """
    inactive = stable(inactive_users(log, as_of, years))
    counts = anonymization_counts(versions.read(spark, users_path), versions.read(spark, mails_path), inactive).first()
    began = {e["run"]: e for e in versions.current(spark, users_path).state.get(AUDIT, [])}.get(run_id)
    run = StoredRun(began["needs"], began["users"], began["mails"]) if began else StoredRun(counts["needs"], counts["users"], counts["mails"])
    if not run.needs:
        return run
    entry = {"run": run_id, "as_of": as_of.isoformat(sep=" "), "needs": run.needs, "users": run.users, "mails": run.mails}

    def audited(state: Mapping[str, object]) -> dict[str, object]:
        return {**state, AUDIT: [*[e for e in state.get(AUDIT, []) if e["run"] != run_id], entry]}

    versions.update(spark, users_path, lambda users: anonymize_users(users, inactive), state=audited)
    versions.update(spark, mails_path, lambda mails: blank_mails(mails, inactive), state=audited)
    return run


def audit_rows(spark: SparkSession, path: str) -> DataFrame:
    """What the runs did to a stored table, one row for each."""
    entries = versions.current(spark, path).state.get(AUDIT, [])
    rows = [(e["run"], e["as_of"], e["needs"], e["users"], e["mails"]) for e in entries]
    return spark.createDataFrame(rows, "run string, as_of string, needs long, users long, mails long")
