"""Notification and reminder mails about purchase orders waiting for their quality check."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyloom.functions.dates import add_workdays
from supplyloom.functions.text import render_template, text_key
from supplyloom.operators.updates import transition
from supplyloom.plans.purchase_orders import new_items_by_team
from supplyloom.session import staged

# fixed values
CREATED, IN_PROGRESS = 1, 3
RIGHT_NAME = "POModule"
TARGET_WORKDAYS = 10


def audience(users: DataFrame, team: DataFrame, auth: DataFrame, items: DataFrame) -> DataFrame:
    """Users with the right to the order module, once per period in which their team has items.

    The users of a team are many and their rows short, the mails are the users times the periods. So the few counts are stored
    first, which tells Spark their size, and the users are dealt out over all tasks before they are multiplied.
    """
    entitled = auth.filter(F.lower("item_name").contains(RIGHT_NAME.lower())).select(F.col("user_id").alias("id")).distinct()
    counted = staged(
        items.filter(F.col("team").isNotNull() & (F.col("new_items") > 0)).select(
            text_key(F.col("team")).alias("_team_key"), "period", "new_items"
        )
    )
    tasks = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    teams = team.select(F.col("id").alias("team_id"), F.col("name").alias("team"))
    return (
        users.join(entitled, "id", "left_semi")
        .join(teams, "team_id")
        .select("id", "full_name", "email", "team", text_key(F.col("team")).alias("_team_key"))
        .repartition(tasks, "id")
        .join(counted, "_team_key")
        .select(F.col("id").alias("user_id"), "full_name", "email", "team", "period", "new_items")
    )


def _tokens(signature: str | None, target: bool) -> dict[str, Column]:
    tokens = {"SIGNATURE": F.lit(signature).cast("string"), "AGENT_NAME": F.col("full_name")}
    if target:
        tokens["TARGET_DATE"] = F.col("target")
    return tokens | {"TEAM": F.col("team"), "PERIOD": F.col("period"), "NEW_ITEMS": F.col("new_items")}


def notification_audience(
    users: DataFrame,
    team: DataFrame,
    auth: DataFrame,
    requests: DataFrame,
    record_view: DataFrame,
    as_of: datetime,
    templates: Mapping[str, str],
    signature: str | None = None,
) -> DataFrame:
    """Rendered mails about newly created requests, due ten working days after ``as_of``."""
    items = new_items_by_team(requests.filter(F.col("status_id") == CREATED), record_view)
    mails = audience(users, team, auth, items).withColumn("target", add_workdays(TARGET_WORKDAYS, F.lit(as_of)))
    return render_template(mails, templates, _tokens(signature, target=True))


def overdue(as_of: datetime) -> Column:
    """In progress, not reminded, and created more than ten working days ago."""
    due = add_workdays(TARGET_WORKDAYS, F.col("created_at"))
    not_reminded = F.col("is_reminder_sent").isNull() | (F.col("is_reminder_sent") == 0)
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    return (F.col("status_id") == IN_PROGRESS) & not_reminded & (due.cast("timestamp_ntz") < now)


def reminder_audience(
    users: DataFrame,
    team: DataFrame,
    auth: DataFrame,
    requests: DataFrame,
    record_view: DataFrame,
    as_of: datetime,
    templates: Mapping[str, str],
    signature: str | None = None,
) -> DataFrame:
    """Rendered reminders about overdue requests."""
    items = new_items_by_team(requests.filter(overdue(as_of)), record_view)
    return render_template(audience(users, team, auth, items), templates, _tokens(signature, target=False))


def mark_notified(requests: DataFrame, mails: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Created requests become in progress, provided any mail went out; returns the change count too."""
    sent = not mails.isEmpty()
    return transition(requests, (F.col("status_id") == CREATED) & F.lit(sent), {"status_id": IN_PROGRESS})


def mark_reminded(requests: DataFrame, mails: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All requests in progress are marked as reminded, provided any reminder went out."""
    sent = not mails.isEmpty()
    return transition(requests, (F.col("status_id") == IN_PROGRESS) & F.lit(sent), {"is_reminder_sent": 1})


@dataclass(frozen=True)
class MailRun:
    notifications: DataFrame
    reminders: DataFrame
    requests: DataFrame
    counts: DataFrame  # one row: notifications, notified, reminders


def mail_run(
    users: DataFrame,
    team: DataFrame,
    auth: DataFrame,
    requests: DataFrame,
    record_view: DataFrame,
    as_of: datetime,
    notification: Mapping[str, str],
    reminder: Mapping[str, str],
    signature: str | None = None,
) -> MailRun:
    """The whole run: notify, move the created requests on, and only then look for reminders.

    A request created more than ten working days ago is notified and reminded in the same run. The mails are put into
    the shared folder before anything is marked, so what was sent and what is marked agree. So is what both kinds of mail
    need of the order view.
    """
    people = (users, team, auth)
    record_view = staged(record_view.select("po_number", "period", "team"))
    notifications = staged(notification_audience(*people, requests, record_view, as_of, notification, signature))
    notified, changed = mark_notified(requests, notifications)
    reminders = staged(reminder_audience(*people, notified, record_view, as_of, reminder, signature))
    reminded, _ = mark_reminded(notified, reminders)

    names = ("notifications", "notified", "reminders")

    def part(df: DataFrame, value: Column, name: str) -> DataFrame:
        return df.agg(value.alias(name)).select(*(F.col(n) if n == name else F.lit(0).cast("bigint").alias(n) for n in names))

    rows = F.count(F.lit(1))
    parts = part(notifications, rows, "notifications").union(part(changed, F.sum("n_changed"), "notified"))
    counts = parts.union(part(reminders, rows, "reminders")).agg(*(F.sum(n).alias(n) for n in names))
    return MailRun(notifications, reminders, reminded, counts)
