"""Samples S1-S6 and P8, audiences P9 and P10, anonymisation P11."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.operators import sampling
from supplyloom.operators.aggregates import inactive_users
from supplyloom.operators.joins import not_in
from supplyloom.plans import anonymize as gdpr
from supplyloom.plans import audiences
from supplyloom.plans.quality_sample import percent_sample, quality_sample
from supplyloom.queries.aggregating import INACTIVE_SQL, LOG_AS_OF, NEW_ITEMS_SQL, mails, order_view
from supplyloom.queries.registry import query
from supplyloom.queries.reports import due_sql
from supplyloom.queries.roles import with_roles
from supplyloom.session import shared_folder
from supplyloom.sources import versions

# the columns that identify a record row
ROW_KEY = ["po_number", "number_of_line_item", "ifa_number", "po_created_by", "cents"]
PERIOD = "19980300"
MIN_ROWS = 30
SEED = "check"
NOW = datetime(1998, 4, 1, 12, 0)


def hash_sql(seed: str) -> str:
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in ROW_KEY)
    return f"md5(concat_ws('#', '{seed}', {parts}))"


ORDER = ", ".join(ROW_KEY)


@query("s2_current_period", with_roles("record", "SELECT min(period) AS period FROM r_record"))
def current_period(t):
    return sampling.current_period(t["record"])


@query(
    "s3_sample_percent",
    with_roles(
        "record",
        f"""SELECT {ORDER} FROM (SELECT *, row_number() OVER (ORDER BY {hash_sql('s3')}, {ORDER}) AS rn, count(*) OVER () AS n
        FROM r_record) WHERE rn <= ceil(n * 10 / 100.0)""",
    ),
)
def sample_percent(t):
    return sampling.sample_percent(t["record"], 10, "s3", ROW_KEY).select(*ROW_KEY)


@query(
    "s4_sample_one_per_group",
    with_roles(
        "record",
        f"""SELECT team_id, period, {ORDER} FROM r_record QUALIFY row_number() OVER (PARTITION BY team_id, period
        ORDER BY {hash_sql('s4')}, {ORDER}) = 1""",
    ),
)
def sample_one_per_group(t):
    return sampling.sample_one_per_group(t["record"], ["team_id", "period"], "s4", ROW_KEY).select("team_id", "period", *ROW_KEY)


@query(
    "s5_sample_via_entity",
    with_roles(
        "record po_request",
        f"""SELECT team_id, customer_id, {ORDER} FROM r_record WHERE po_number NOT IN (SELECT po_number FROM r_po_request)
        AND (team_id, customer_id) IN (SELECT (team_id, customer_id) FROM (SELECT * FROM r_record QUALIFY row_number() OVER
        (PARTITION BY team_id ORDER BY {hash_sql('s5-entity')}, {ORDER}) = 1))
        QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY {hash_sql('s5')}, {ORDER}) = 1""",
    ),
)
def sample_via_entity(t):
    free = not_in(t["record"], t["po_request"], "po_number")
    picked = sampling.sample_via_entity(t["record"], free, "team_id", "customer_id", "s5", ROW_KEY)
    return picked.select("team_id", "customer_id", *ROW_KEY)


PERCENT_CTES = f""", rec AS (SELECT * FROM r_record WHERE period = '{PERIOD}'),
        volume AS (SELECT team_id, count(po_number) AS n FROM rec GROUP BY team_id),
        pool AS (SELECT * FROM rec WHERE team_id IN (SELECT team_id FROM volume WHERE n < {MIN_ROWS})
        AND po_number NOT IN (SELECT po_number FROM r_po_request)),
        first_step AS (SELECT po_number, category_id, {', '.join(ROW_KEY[1:])} FROM (SELECT *, row_number() OVER
        (ORDER BY {hash_sql(SEED + '-percent')}, {ORDER}) AS rn, count(*) OVER () AS n FROM pool) WHERE rn <= ceil(n * 10 / 100.0))"""


def drawn_sql(rows: str, entity: str) -> str:
    return f"""SELECT team_id, {entity} FROM {rows} QUALIFY row_number() OVER (PARTITION BY team_id
        ORDER BY {hash_sql(f'{SEED}-{entity}-entity')}, {ORDER}) = 1"""


SAMPLE_CTES = (
    PERCENT_CTES
    + f""", big AS (SELECT * FROM rec WHERE team_id IN (SELECT team_id FROM volume WHERE n >= {MIN_ROWS})),
        by_customer AS (SELECT po_number, category_id FROM big JOIN ({drawn_sql('big', 'customer_id')}) d USING (team_id, customer_id)
        WHERE po_number NOT IN (SELECT po_number FROM r_po_request) AND po_number NOT IN (SELECT po_number FROM first_step)
        QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY {hash_sql(f'{SEED}-customer_id')}, {ORDER}) = 1),
        by_creator AS (SELECT po_number, category_id FROM rec JOIN ({drawn_sql('rec', 'po_created_by')}) d USING (team_id, po_created_by)
        WHERE po_number NOT IN (SELECT po_number FROM r_po_request) AND po_number NOT IN (SELECT po_number FROM first_step)
        AND po_number NOT IN (SELECT po_number FROM by_customer)
        QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY {hash_sql(f'{SEED}-po_created_by')}, {ORDER}) = 1),
        picks AS (SELECT po_number, category_id FROM first_step UNION ALL SELECT * FROM by_customer UNION ALL SELECT * FROM by_creator)"""
)
SAMPLE_SQL = f"""{SAMPLE_CTES} SELECT po_number, category_id, '{PERIOD}' AS period, 'team' AS q_type, 1 AS status_id,
        '1998-04-01 12:00:00' AS created_at, 9 AS created_by FROM picks"""


@query(
    "p8_percent_of_small_teams",
    with_roles("record po_request", PERCENT_CTES + f" SELECT {ORDER} FROM first_step"),
)
def small_teams(t):
    return percent_sample(t["record"], t["po_request"], PERIOD, SEED, ROW_KEY, MIN_ROWS).select(*ROW_KEY)


@query("p8_s6_quality_sample", with_roles("record po_request", SAMPLE_SQL))
def quality_sample_query(t):
    """An order belongs to one team in these tables, so plain SQL can follow the picks."""
    return quality_sample(t["record"], t["po_request"], PERIOD, SEED, NOW, 9, ROW_KEY, MIN_ROWS)


TEMPLATES = {"title": "{NEW_ITEMS} new items for {TEAM}", "body": "Dear {AGENT_NAME}, {TEAM} has {NEW_ITEMS} items of {PERIOD}{TARGET_DATE}. {SIGNATURE}"}


def _audience_sql(where: str, target: str, target_column: str) -> str:
    return with_roles(
        "po_request record po_category team user auth",
        f""", items AS ({NEW_ITEMS_SQL.format(where=where)})
        SELECT u.id AS user_id, full_name, email, t.name AS team, i.period, i.new_items {target_column},
        i.new_items || ' new items for ' || t.name AS title,
        'Dear ' || full_name || ', ' || t.name || ' has ' || i.new_items || ' items of ' || i.period || {target} || '. ' AS body
        FROM r_user u JOIN r_team t ON t.id = u.team_id JOIN items i ON i.team = t.name
        WHERE u.id IN (SELECT user_id FROM r_auth WHERE lower(item_name) LIKE '%pomodule%') AND i.new_items > 0""",
    )


TARGET = due_sql("DATE '1998-04-01'", 10)


@query("p9_notification_audience", _audience_sql("status_id = 1", f"({TARGET})", f", ({TARGET}) AS target"))
def notification_audience(t):
    return audiences.notification_audience(
        t["user"], t["team"], t["auth"], t["po_request"], order_view(t, with_lines=False), NOW, TEMPLATES
    )


@query(
    "p10_reminder_audience",
    _audience_sql(
        "status_id = 3 AND (is_reminder_sent = 0 OR is_reminder_sent IS NULL) AND CAST("
        + due_sql("q.created_at", 10) + " AS TIMESTAMP) < TIMESTAMP '1998-04-01 12:00:00'",
        "'{TARGET_DATE}'",
        "",
    ),
)
def reminder_audience(t):
    return audiences.reminder_audience(
        t["user"], t["team"], t["auth"], t["po_request"], order_view(t, with_lines=False), NOW, TEMPLATES
    )


def _mails_sql(name: str, kind: str) -> str:
    return f"""SELECT '{kind}' AS kind, u.id AS user_id, i.team, i.period, i.new_items FROM {name} i JOIN r_team t ON t.name = i.team
        JOIN r_user u ON u.team_id = t.id WHERE u.id IN (SELECT user_id FROM r_auth WHERE lower(item_name) LIKE '%pomodule%')"""


WAITING = (
    "(is_reminder_sent = 0 OR is_reminder_sent IS NULL) AND CAST("
    + due_sql("q.created_at", 10) + " AS TIMESTAMP) < TIMESTAMP '1998-04-01 12:00:00'"
)


@query(
    "p9_p10_mail_run",
    with_roles(
        "po_request record po_category team user auth",
        f""", fresh AS ({NEW_ITEMS_SQL.format(where="status_id = 1")}),
        waiting AS ({NEW_ITEMS_SQL.format(where="status_id IN (1, 3) AND " + WAITING)})
        {_mails_sql("fresh", "notification")} UNION ALL {_mails_sql("waiting", "reminder")}""",
    ),
)
def mail_run(t):
    """Both kinds of mail of one run; reminders see the state that the notifications leave."""
    run = audiences.mail_run(
        t["user"], t["team"], t["auth"], t["po_request"], order_view(t, with_lines=False), NOW, TEMPLATES, TEMPLATES
    )
    sets = ((run.notifications, "notification"), (run.reminders, "reminder"))
    both = [mails.select(F.lit(kind).alias("kind"), "user_id", "team", "period", "new_items") for mails, kind in sets]
    return both[0].unionByName(both[1])


@query(
    "p9_m4_mark_notified",
    with_roles("po_request", "SELECT po_number, CASE WHEN status_id = 1 THEN 3 ELSE status_id END AS status_id FROM r_po_request"),
)
def mark_notified(t):
    sent = audiences.notification_audience(
        t["user"], t["team"], t["auth"], t["po_request"], order_view(t, with_lines=False), NOW, TEMPLATES
    )
    return audiences.mark_notified(t["po_request"], sent)[0].select("po_number", "status_id")


@query(
    "p10_m4_mark_reminded",
    with_roles(
        "po_request",
        "SELECT po_number, CASE WHEN status_id = 3 THEN 1 ELSE is_reminder_sent END AS is_reminder_sent FROM r_po_request",
    ),
)
def mark_reminded(t):
    sent = audiences.reminder_audience(
        t["user"], t["team"], t["auth"], t["po_request"], order_view(t, with_lines=False), NOW, TEMPLATES
    )
    return audiences.mark_reminded(t["po_request"], sent)[0].select("po_number", "is_reminder_sent")


@query(
    "p11_anonymization_counts",
    with_roles(
        "user mail",
        f"""SELECT (SELECT count(*) FROM r_user WHERE id IN {INACTIVE_SQL} AND is_anonymized = 0) AS needs,
        (SELECT count(*) FROM r_user WHERE id IN {INACTIVE_SQL}) AS users,
        (SELECT count(*) FROM r_mail WHERE created_by IN {INACTIVE_SQL}) AS mails""",
    ),
)
def anonymization_counts(t):
    return gdpr.anonymize(t["user"], mails(t), t["log"], LOG_AS_OF).counts


@query(
    "p11_anonymize_job",
    with_roles(
        "user mail",
        f"""SELECT 'user' AS kind, id AS item, CASE WHEN id IN {INACTIVE_SQL} THEN 'DELETED_' || id ELSE full_name END AS text FROM r_user
        UNION ALL SELECT 'mail', created_by, CASE WHEN created_by IN {INACTIVE_SQL} THEN '' ELSE message END FROM r_mail""",
    ),
)
def anonymize_job(t):
    done = gdpr.anonymize(t["user"], mails(t), t["log"], LOG_AS_OF)
    users = done.users.select(F.lit("user").alias("kind"), F.col("id").alias("item"), F.col("full_name").alias("text"))
    return users.unionByName(
        done.mails.select(F.lit("mail").alias("kind"), F.col("created_by").alias("item"), F.col("message").alias("text"))
    )


REPORT_MAIL = {"title": "Anonymization of {DATE}", "body": "{USERS} users and {MAILS} mails in {TIME}"}
ELAPSED = 1.25


def _long_sql(kind: str, table: str, item: str, values: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{kind}' AS kind, {item}, '{name}' AS field, {sql} AS value FROM {table}" for name, sql in values.items())


WHOLE_JOB_SQL = ", counts AS (SELECT (SELECT count(*) FROM r_user WHERE id IN {0}) AS users, (SELECT count(*) FROM r_mail WHERE created_by IN {0}) AS mails) ".format(INACTIVE_SQL) + " UNION ALL ".join(
    [
        _long_sql(
            "user", "r_user", "id AS item, CAST(0 AS BIGINT) AS turn",
            {f: f"CASE WHEN id IN {INACTIVE_SQL} THEN 'DELETED_' || id ELSE {f} END" for f in gdpr.USER_FIELDS}
            | {"is_anonymized": f"CAST(CASE WHEN id IN {INACTIVE_SQL} THEN 1 ELSE is_anonymized END AS VARCHAR)"},
        ),
        _long_sql(
            "mail", "r_mail", "created_by, CAST(turn AS BIGINT)",
            {
                name: f"CASE WHEN created_by IN {INACTIVE_SQL} THEN '' ELSE {value} END"
                for name, value in zip(gdpr.MAIL_FIELDS, ("sender", "recipient", "subject", "'cc'", "'bcc'", "message"), strict=True)
            },
        ),
        _long_sql(
            "report", "counts", "NULL, NULL",
            {"title": "'Anonymization of 2025-01-30'", "body": "users || ' users and ' || mails || ' mails in 1.25s.'"},
        ),
        _long_sql(
            "log", "counts", "NULL, NULL",
            {
                "category": "'gdpr'",
                "message": "'Anonymization: ' || chr(10) || 'Anonymized Users: ' || users || chr(10) || 'Anonymized Emails: ' || mails"
                " || '<strong>Time:</strong> 1.25s.'",
            },
        ),
        "SELECT 'audit of ' || kind, NULL, NULL, 'run', 'run 1: ' || users || ', ' || mails FROM counts, (VALUES ('users'), ('mails')) k(kind)",
    ]
)


@query("p11_whole_anonymization", with_roles("user mail", WHOLE_JOB_SQL))
def whole_anonymization(t):
    """Every field of users and mails after the job over stored tables, run twice, with report mail, log row and audit rows."""
    users, mails_at = (f"{shared_folder(t.spark)}/{name}-{uuid4().hex}" for name in ("users", "mails"))
    versions.replace(t["user"], users)
    versions.replace(mails(t), mails_at)
    for _ in range(2):
        run = gdpr.anonymize_stored(t.spark, users, mails_at, t["log"], LOG_AS_OF, "run 1")
    counts = t.spark.createDataFrame([(run.needs, run.users, run.mails)], "needs long, users long, mails long")

    def long(df, kind, item, turn, fields):
        texts = df.select(item.cast("long").alias("item"), turn.cast("long").alias("turn"), *[F.col(f).cast("string").alias(f) for f in fields])
        return texts.unpivot(["item", "turn"], list(fields), "field", "value").select(F.lit(kind).alias("kind"), "item", "turn", "field", "value")

    nothing = F.lit(None)
    parts = [
        long(versions.read(t.spark, users), "user", F.col("id"), F.lit(0), (*gdpr.USER_FIELDS, "is_anonymized")),
        long(versions.read(t.spark, mails_at), "mail", F.col("created_by"), F.col("turn"), gdpr.MAIL_FIELDS),
        long(gdpr.report_mail(counts, REPORT_MAIL, LOG_AS_OF, ELAPSED), "report", nothing, nothing, ("title", "body")),
        long(gdpr.log_entry(counts, LOG_AS_OF, ELAPSED), "log", nothing, nothing, ("category", "message")),
    ]
    for kind, path in (("users", users), ("mails", mails_at)):
        told = gdpr.audit_rows(t.spark, path).select(F.concat("run", F.lit(": "), "users", F.lit(", "), "mails").alias("run"))
        parts.append(long(told, f"audit of {kind}", nothing, nothing, ("run",)))
    return reduce(DataFrame.unionByName, parts)


@query(
    "a11_active_and_inactive",
    f"""SELECT CASE WHEN user_id IN {INACTIVE_SQL} THEN 'inactive' ELSE 'active' END AS state, count(*) AS n_events FROM events
        GROUP BY 1""",
)
def active_and_inactive(t):
    idle = inactive_users(t["log"], LOG_AS_OF).select("created_by", F.lit("inactive").alias("state"))
    return (
        t["log"].groupBy("created_by").agg(F.count(F.lit(1)).alias("n")).join(idle, "created_by", "left")
        .groupBy(F.coalesce("state", F.lit("active")).alias("state")).agg(F.sum("n").alias("n_events"))
    )
