"""Sources and sinks IO1-IO9. Sinks write to the shared folder of the session and are read back."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from supplyloom.operators.updates import update_from
from supplyloom.plans.quality_sample import quality_sample
from supplyloom.queries.picking import MIN_ROWS, NOW, PERIOD, ROW_KEY, SAMPLE_CTES, SEED
from supplyloom.queries.registry import query
from supplyloom.queries.roles import with_roles
from supplyloom.session import shared_folder
from supplyloom.sources import companies, ingest, mailbox, reports, runlog, tables, versions


def staged(t, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid4().hex}"


@query("io1_table_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def table_scan(t):
    return tables.load(t.spark, t.folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")


CHANGED = "TIMESTAMP '2001-07-31 12:00:00'"
CHANGED_SQL = f"""SELECT s_suppkey AS id, s_name AS name, strftime(changed, '%Y-%m-%d %H:%M:%S') AS updated_at
        FROM supplier JOIN (SELECT l_suppkey, max(o_orderdate) AS changed FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        GROUP BY l_suppkey) ON l_suppkey = s_suppkey WHERE changed >= {CHANGED}"""
COMPANY = "id bigint, name string, updated_at string"
AS_OF = datetime(2001, 8, 1, 12, 0)


def company_documents(t):
    """Documents of at most 10,000 suppliers with the time of their latest order."""
    changed = (
        t["lineitem"].join(t["orders"], F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("l_suppkey").agg(F.max("o_orderdate").alias("changed"))
    )
    record = F.struct(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.date_format("changed", "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
    )
    listed = changed.join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
    body = F.to_xml(record, {"rowTag": companies.ROW_TAG})
    return listed.groupBy(F.floor(F.col("s_suppkey") / 10_000).alias("document")).agg(
        F.concat(F.lit("<companies>"), F.array_join(F.collect_list(body), "\n"), F.lit("</companies>")).alias("xml")
    )


@query("io2_changed_companies", CHANGED_SQL)
def changed_companies(t):
    return companies.parse_companies(company_documents(t), F.col("xml"), COMPANY, AS_OF)


@query("io2_landed_company_files", CHANGED_SQL)
def landed_company_files(t):
    """The documents are landed first, one file each, and read as one source."""
    path = staged(t, "companies")
    company_documents(t).write.partitionBy("document").text(path)
    return companies.read_companies_xml(t.spark, path, COMPANY, AS_OF).select("id", "name", "updated_at")


# Changes of companies: every order is a change of its customer at the time of the order. The second delivery repeats the first
# and adds what was missing; some records have no time, others no number.
FIRST_UNTIL, SECOND_UNTIL = datetime(1997, 6, 1), datetime(1998, 2, 1)
LATENESS = timedelta(days=90)
DELIVERED = """delivered AS (SELECT o_custkey AS id, o_orderkey AS seen, o_orderdate AS changed, o_orderkey % 89 = 0 AS no_id,
        o_orderkey % 97 = 0 AS no_time, o_orderdate < TIMESTAMP '1997-06-01' AND o_orderkey % 5 <> 0 AS in_first FROM orders
        WHERE o_orderdate < TIMESTAMP '1998-02-01'),
        good AS (SELECT id, changed, bool_or(in_first) AS in_first FROM delivered WHERE NOT no_id AND NOT no_time GROUP BY ALL),
        mark AS (SELECT max(changed) AS m FROM good WHERE in_first),
        bad AS (SELECT CASE WHEN no_id THEN 'corrupt' ELSE 'no time of change' END AS kind, CASE WHEN no_id THEN NULL ELSE id END AS id,
        CASE WHEN no_id THEN seen END AS seen, CASE WHEN no_time THEN NULL ELSE changed END AS changed, bool_or(in_first) AS in_first
        FROM delivered WHERE no_id OR no_time GROUP BY ALL),
        judged AS (SELECT CASE WHEN in_first THEN 'first' ELSE 'second' END AS run, CASE WHEN in_first OR changed >= m - INTERVAL 90 DAY
        THEN 'accepted' ELSE 'late' END AS kind, id, changed FROM good, mark)"""


def company_changes(t, path: str, first: bool):
    """Land one delivery as XML files of at most 10,000 orders and read its records."""
    listed = t["orders"].filter(F.col("o_orderdate") < F.lit(SECOND_UNTIL))
    if first:
        listed = listed.filter((F.col("o_orderdate") < F.lit(FIRST_UNTIL)) & (F.col("o_orderkey") % 5 != 0))
    number = F.when(F.col("o_orderkey") % 89 == 0, F.concat(F.lit("no "), F.col("o_orderkey").cast("string"))).otherwise(F.col("o_custkey").cast("string"))
    time = F.when(F.col("o_orderkey") % 97 == 0, F.lit("unknown")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    body = F.to_xml(F.struct(number.alias("id"), time.alias("updated_at")), {"rowTag": companies.ROW_TAG})
    documents = listed.groupBy(F.floor(F.col("o_orderkey") / 10_000).alias("document")).agg(
        F.concat(F.lit("<companies>"), F.array_join(F.collect_list(body), "\n"), F.lit("</companies>")).alias("xml")
    )
    documents.write.partitionBy("document").text(path)
    return ingest.read_records(t.spark, path, StructType.fromDDL("id bigint, updated_at string"))


@query(
    "io2_incremental_pull",
    f"""WITH {DELIVERED} SELECT kind, run, id, strftime(changed, '%Y-%m-%d %H:%M:%S') AS updated_at, CAST(1 AS BIGINT) AS n FROM judged
        WHERE kind = 'accepted'
        UNION ALL SELECT kind, 'second', NULL, NULL, count(*) FROM judged WHERE kind = 'late' GROUP BY kind
        UNION ALL SELECT kind, CASE WHEN in_first THEN 'first' ELSE 'second' END, NULL, NULL, count(*) FROM bad GROUP BY 1, 2
        UNION ALL SELECT 'log of ' || run, 'accepted', NULL, NULL, count(*) FROM judged WHERE kind = 'accepted' GROUP BY run""",
)
def incremental_pull(t):
    """Two overlapping deliveries, the second pulled twice: changes by run, quarantine and run log."""
    changes, quarantine, log = (staged(t, name) for name in ("changes", "quarantine", "log"))
    first = company_changes(t, staged(t, "delivery"), True)
    second = company_changes(t, staged(t, "delivery"), False)
    for run, records, as_of in (("first", first, FIRST_UNTIL), ("second", second, SECOND_UNTIL), ("second", second, SECOND_UNTIL)):
        ingest.pull(records, changes, quarantine, "companies", run, as_of, lateness=LATENESS, log_path=log)
    empty = F.lit(None)
    parts = []
    for run in ("first", "second"):
        accepted = versions.read_runs(t.spark, changes, lambda key, run=run: key == run)
        aside = versions.read_runs(t.spark, quarantine, lambda key, run=run: key == run)
        time = F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at")
        parts.append(accepted.select(F.lit("accepted").alias("kind"), F.lit(run).alias("run"), "id", time, F.lit(1).cast("long").alias("n")))
        counted = aside.groupBy(F.col("reason").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
        parts.append(counted.select("kind", F.lit(run).alias("run"), empty.cast("long").alias("id"), empty.cast("string").alias("updated_at"), "n"))
    # the repeated pull has logged the same count again
    logged = t.spark.read.parquet(log).select(
        F.when(F.col("created_at") == F.lit(FIRST_UNTIL), "log of first").otherwise("log of second").alias("kind"),
        F.lit("accepted").alias("run"), empty.cast("long").alias("id"), empty.cast("string").alias("updated_at"),
        F.col("metrics")["accepted"].alias("n"),
    ).distinct()
    return reduce(DataFrame.unionByName, [*parts, logged])


@query(
    "io3_todays_attachments",
    """SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS sent, 'first of ' || event_type AS attachment FROM events
        WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16' AND event_type <> 'view'""",
)
def todays_attachments(t):
    """The whole mailbox of the day."""
    files = F.when(F.col("event_type") == "view", F.array().cast("array<string>")).otherwise(
        F.array(F.concat(F.lit("first of "), F.col("event_type")), F.lit("second"))
    )
    box = t["events"].select("user_id", F.col("ts").alias("sent"), files.alias("attachments"))
    found = mailbox.todays_attachments(box, date(2024, 1, 15))
    return found.withColumn("sent", F.date_format("sent", "yyyy-MM-dd HH:mm:ss"))


@query(
    "io3_attachment_contents",
    """SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS sent, 'first of ' || event_type AS attachment,
        CAST(n AS VARCHAR) || chr(10) AS content FROM events JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)
        USING (event_type) WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16' AND event_type <> 'view'""",
)
def attachment_contents(t):
    """Mails of the day with what their attachments hold. A file per kind of event has landed under the name of the attachment."""
    path = staged(t, "attachments")
    landed = t["events"].groupBy(F.concat(F.lit("first of "), F.col("event_type")).alias("name")).agg(F.count(F.lit(1)).cast("string").alias("text"))
    landed.write.partitionBy("name").text(path)
    found = mailbox.with_content(todays_attachments(t), mailbox.attachment_files(t.spark, path), F.col("name"))
    return found.select("user_id", "sent", "attachment", F.decode("content", "UTF-8").alias("content"))


REPORT_SCHEMA = "record_id bigint, customer_name string, received string"
# texts with quotes, separators and line breaks must come back whole
REPORT_SQL = "SELECT record_id, customer_name || chr(10) || '\"known\", as x' AS customer_name, input_received::VARCHAR AS received FROM r_dash"


def _report(t):
    name = F.concat("customer_name", F.lit("\n\"known\", as x"))
    return t["dash"].select("record_id", name.alias("customer_name"), F.col("input_received").alias("received"))


@query("io4_report_with_header", with_roles("dash", REPORT_SQL))
def report_with_header(t):
    path = reports.write_report(_report(t), staged(t, "report"))
    return reports.read_report(t.spark, path, REPORT_SCHEMA)


@query(
    "io5_full_and_current_year_reports",
    with_roles(
        "dash",
        f"""SELECT 'all' AS report, * FROM ({REPORT_SQL}) UNION ALL SELECT '1998', * FROM ({REPORT_SQL}
        WHERE input_received >= DATE '1997-10-01' AND input_received < DATE '1998-10-01')""",
    ),
)
def full_and_current_year_reports(t):
    full, current = reports.export_full_and_fy(_report(t), "received", staged(t, "export"), date(1998, 3, 10))
    everything, year = (reports.read_report(t.spark, p, REPORT_SCHEMA) for p in (full, current))
    return everything.select(F.lit("all").alias("report"), "*").unionByName(
        year.select(F.lit(current.rsplit("_", 1)[1]).alias("report"), "*")
    )


@query("io6_io7_replace_table", with_roles("dash", "SELECT record_id, customer_name, doubles FROM r_dash"))
def replace_table(t):
    path = staged(t, "table")
    rows = t["dash"].select("record_id", "customer_name", "doubles")
    before = t["po_request"].select(F.col("po_number").alias("record_id"), F.lit("old").alias("customer_name"), F.lit(0).alias("doubles"))
    tables.materialize(before, path)
    return tables.materialize(rows, path)


@query(
    "io6_versioned_replace_from_itself",
    with_roles(
        "dash",
        """SELECT record_id, upper(customer_name) AS customer_name, n FROM r_dash JOIN (SELECT customer_name, count(*) AS n FROM r_dash
        WHERE doubles = 0 GROUP BY customer_name) USING (customer_name) WHERE doubles = 0""",
    ),
)
def versioned_replace(t):
    """The table is replaced by a query over its own rows; the last but one version is vacuumed."""
    path = staged(t, "versions")
    versions.replace(t["dash"].select("record_id", "customer_name", "doubles"), path)
    rows = versions.read(t.spark, path).filter("doubles = 0")
    counts = rows.groupBy("customer_name").agg(F.count(F.lit(1)).alias("n"))
    versions.replace(rows.join(counts, "customer_name").select("record_id", F.upper("customer_name").alias("customer_name"), "n"), path)
    versions.vacuum(t.spark, path, keep=1, min_age_hours=0)
    return versions.read(t.spark, path)


@query(
    "io6_m2_stored_updates",
    with_roles(
        "request user escalation",
        """SELECT id, c.full_name AS created_by_name,
        coalesce((SELECT max(e.id) FROM r_escalation e WHERE e.request_id = r.id), -1) AS last_escalation FROM r_request r
        LEFT JOIN (SELECT id AS user_id, full_name FROM r_user) c ON c.user_id = r.created_by""",
    ),
)
def stored_updates(t):
    """A stored report table, updated in place from two other tables, each update a version of its own."""
    path = staged(t, "versions")
    versions.replace(t["request"].select("id", "created_by", F.lit(-1).cast("bigint").alias("last_escalation")), path)
    names = t["user"].select(F.col("id").alias("created_by"), F.col("full_name").alias("created_by_name"))
    versions.update(t.spark, path, lambda rows: update_from(rows, names, ["created_by"], ["created_by_name"]))
    last = t["escalation"].select(F.col("request_id").alias("id"), F.col("id").alias("last_escalation"))
    versions.update(
        t.spark, path, lambda rows: update_from(rows, last, ["id"], ["last_escalation"], "keep", [F.desc("last_escalation")])
    )
    return versions.read(t.spark, path).select("id", "created_by_name", "last_escalation")


@query(
    "io8_p8_repeated_sample",
    with_roles(
        "record po_request",
        f"""{SAMPLE_CTES} SELECT po_number, category_id, period, status_id FROM r_po_request
        UNION ALL SELECT po_number, category_id, '{PERIOD}', 1 FROM picks""",
    ),
)
def repeated_sample(t):
    """The sample of a period is drawn and appended twice; the table holds it once."""
    path = staged(t, "requests")
    versions.append_run(t["po_request"].select("po_number", "category_id", "period", "status_id"), path, "before")
    for _ in range(2):
        prior = versions.read_runs(t.spark, path, lambda run: run != PERIOD)
        sample = quality_sample(t["record"], prior, PERIOD, SEED, NOW, 9, ROW_KEY, MIN_ROWS)
        versions.append_run(sample.select("po_number", "category_id", "period", "status_id"), path, PERIOD)
    return versions.read(t.spark, path)


@query(
    "io8_append_runs",
    with_roles("dash po_request", "SELECT record_id, status FROM r_dash UNION ALL SELECT po_number, CAST(NULL AS VARCHAR) FROM r_po_request"),
)
def append_runs(t):
    """Three runs, one of them first with rows it should not have had; two are then kept as one part."""
    path = staged(t, "runs")
    done = F.col("status") == "Finished"
    versions.append_run(t["po_request"].select(F.col("po_number").alias("record_id")), path, "requests")
    versions.append_run(t["dash"].select("record_id", "status"), path, "finished")
    versions.append_run(t["dash"].filter(~done).select("record_id", "status"), path, "open")
    versions.append_run(t["dash"].filter(done).select("record_id", "status"), path, "finished")
    versions.compact(t.spark, path, ["finished", "open"], "dash")
    return versions.read(t.spark, path)


@query(
    "io8_append_rows",
    with_roles(
        "dash po_request",
        "SELECT record_id, status FROM r_dash UNION ALL SELECT po_number, CAST(NULL AS VARCHAR) FROM r_po_request",
    ),
)
def append_rows(t):
    more = t["po_request"].select(F.col("po_number").alias("record_id"))
    return tables.append_rows(t["dash"].select("record_id", "status"), more)


@query("io8_append_table", with_roles("dash po_request", "SELECT record_id FROM r_dash UNION ALL SELECT po_number FROM r_po_request"))
def append_table(t):
    path = staged(t, "table")
    tables.materialize(t["dash"].select("record_id"), path)
    tables.append_table(t["po_request"].select(F.col("po_number").alias("record_id")), path)
    return t.spark.read.parquet(path)


@query(
    "io9_run_log",
    with_roles(
        "dash",
        """SELECT 'dash export' AS category, count(*) AS n_rows, 'rows: ' || count(*) AS message, '1998-03-10 12:00:00' AS created_at
        FROM r_dash""",
    ),
)
def run_log(t):
    log = staged(t, "log")
    target = staged(t, "table")
    runlog.write_logged(t["dash"], lambda df: tables.append_table(df, target), log, "dash export", datetime(1998, 3, 10, 12, 0))
    return t.spark.read.parquet(log).select("category", F.col("metrics")["rows"].alias("n_rows"), "message", "created_at")
