import random
from datetime import date, datetime
from pathlib import Path
from urllib.parse import urlparse

import duckdb
import pytest
from pyspark.sql import functions as F

from supplyloom.operators.joins import measured
from supplyloom.plans import anonymize as gdpr
from supplyloom.plans import audiences
from supplyloom.plans import kpi_report as kpi
from supplyloom.plans.productivity import module_points
from supplyloom.plans.purchase_orders import new_items_by_team, order_record_view
from supplyloom.queries.aggregating import POINTS_CTES
from supplyloom.sources import versions


def test_points_with_copies_of_modules_and_qualifications(spark):
    rng = random.Random(3)

    def maybe(*values):
        return rng.choice(values)

    requests = [(i, maybe(1, 2, 3, 4, 5, 6), maybe(2, 4, 4, 5, 5), maybe(None, i % 60), i) for i in range(300)]
    modules = [(rng.randrange(300), maybe(1, 4, 5, 9, 9, None)) for _ in range(700)]
    quals = [(rng.randrange(60), maybe(1, 4, 5, 9), maybe(1, 2, 2, None), maybe(None, "2020-01-01"), maybe(0, 1, None), maybe(None, "2020-02-02")) for _ in range(400)]
    procs = [(i, maybe(0, 1, None)) for i in range(60)]
    cocs = [(i, maybe(0, 1, None, 2), maybe(None, "2020-01-01")) for i in range(300)]
    tables = {
        "request": (requests, "id int, type int, status_id int, qualification_process_id int, coc_process_id int"),
        "request_module": (modules, "request_id int, module_id int"),
        "qualification": (quals, "qualification_process_id int, module_id int, is_already_done int, finished string, cap_needed int, cap_finished string"),
        "qualification_process": (procs, "id int, finished_not_qualified int"),
        "coc_process": (cocs, "id int, available int, finished string"),
    }
    frames = {n: spark.createDataFrame(d, s) for n, (d, s) in tables.items()}
    con = duckdb.connect()
    for name, (data, schema) in tables.items():
        con.execute(f"CREATE TABLE r_{name} ({schema})")
        con.executemany(f"INSERT INTO r_{name} VALUES ({', '.join('?' * len(data[0]))})", data)
    expected = con.execute("WITH one AS (SELECT 1)" + POINTS_CTES + " SELECT * FROM points").fetchall()
    got = module_points(*frames.values()).withColumn("points", F.col("points").cast("double")).collect()
    assert sorted(tuple(r) for r in got) == sorted(expected)


def small_orders(spark):
    record = spark.createDataFrame(
        [(1, 1, "20200100", 1, "c1", "u1", 1), (1, 2, "20200100", 2, "c1", "u9", 1), (1, 2, "20200100", 1, "c2", "u1", 1),
         (2, 1, "20200200", None, None, "u9", None), (1, 2, "20200100", 1, "c3", "u1", 1)],
        "po_number int, number_of_line_item int, period string, team_id int, category_id string, po_created_by string, are_id int",
    )
    for name in ("sap_backend", "ifa_number", "ifa_supplier_name", "customer_id", "created_at"):
        record = record.withColumn(name, F.lit("v"))
    category = spark.createDataFrame([("c1", "Cat")], "id string, name string")
    team = spark.createDataFrame([(1, "B team"), (2, "A team")], "id int, name string")
    users = spark.createDataFrame([("u1", "Zoe")], "GID string, Name string")
    are = spark.createDataFrame([(1, "ARE")], "id int, name string")
    return order_record_view(record, category, team, users, are), record


def test_order_view_per_category(spark):
    view, _ = small_orders(spark)
    got = {(r.po_number, r.category_id): r for r in view.collect()}
    assert set(got) == {(1, "c1"), (1, None), (2, None)}
    first = got[(1, "c1")]
    assert (first.team, first.created_by, first.po_items_count, first.category) == ("A team", "Zoe", 2, "Cat")
    assert first.line_items_text == "1\n;2\n;2\n;2\n" == got[(1, None)].line_items_text
    last = got[(2, None)]
    assert (last.team, last.created_by, last.are, last.line_items_text) == (None, "u9", None, None)


def dealt_out_by(df):
    """What the exchanges of a plan deal rows out by, as AQE would plan them before anything ran."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("hashpartitioning(")[1].split("), ")[0] for line in plan.splitlines() if "hashpartitioning(" in line]


def test_order_view_deals_its_lines_out_once(spark):
    """of a record that lies by order, neither lines nor orders are dealt out by user, line or order key again."""
    _, record = small_orders(spark)
    keys = [f.name for f in record.schema if f.name not in ("po_number", "number_of_line_item")]
    known = record.select("po_number", *keys).dropDuplicates(["po_number"])
    lying = record.select("po_number", "number_of_line_item").join(known.hint("merge"), "po_number")
    small = [F.broadcast(spark.createDataFrame([("c1", "Cat")], "id string, name string")), F.broadcast(spark.range(3).withColumn("name", F.lit("A")))]
    users = spark.range(100).select(F.concat(F.lit("u"), "id").alias("GID"), F.lit("Zoe").alias("Name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = dealt_out_by(lying)
        view = dealt_out_by(order_record_view(lying, small[0], small[1], users, small[1]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plain and all("po_number" in keys for keys in plain)
    # once for the orders, once for the text; the rest is the list of users
    assert len(view) == 2 * len(plain) + 2 and sum("GID" in keys for keys in view) == 2
    assert not any(c in keys for keys in view for c in ("po_created_by", "number_of_line_item", "period"))


def test_order_view_counts_a_line_for_every_user_of_its_gid(spark):
    """Also where the users are too many to be broadcast."""
    _, record = small_orders(spark)
    category, team = spark.createDataFrame([("c1", "Cat")], "id string, name string"), spark.range(3).withColumn("name", F.lit("A"))
    users = spark.createDataFrame([("u1", "Zoe"), ("u1", "Ann"), ("u1", None), (None, "Nobody")], "GID string, Name string")
    rows = {(r.po_number, r.category): (r.created_by, r.po_items_count, r.line_items_text) for r in order_record_view(record, category, team, users, team).collect()}
    text = ";".join(["1\n"] * 3 + ["2\n"] * 7)
    assert rows == {(1, "Cat"): ("Ann", 2, text), (1, None): ("Ann", 1, text), (2, None): ("u9", 1, None)}


def test_lookups_are_broadcast_only_below_a_measured_size(spark):
    dim = spark.range(100).select(F.concat(F.lit("u"), "id").alias("GID"), F.lit("x" * 100).alias("Name"))

    def hinted(df):
        return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(measured(dim)) and hinted(measured(dim.limit(0))) and not hinted(measured(dim, most_bytes=10_000))
    assert sorted(measured(dim).collect()) == sorted(dim.collect())


def test_record_joins_orders_to_customers_before_their_lines(spark, tmp_path, rows):
    """lines are dealt out by order only, and the rows of the role are those of its text."""
    from supplyloom.queries import roles

    day = datetime(1997, 5, 1)
    made = {
        "customer": ([(1, 3), (2, 4), (None, 5)], "c_custkey long, c_nationkey int"),
        "orders": ([(1, 1, day, "1-A"), (2, 9, day, "1-A"), (3, None, day, "1-A"), (4, 2, day, None), (4, 1, day, "1-A")], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(k, 7, 8, n, "F", 1.5) for k in (1, 2, 3, 4, None) for n in (1, 3, 3)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_linestatus string, l_extendedprice double"),
    }
    frames = {name: spark.createDataFrame(*table) for name, table in made.items()}
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    record = roles.Roles(spark, str(tmp_path))["record"]
    assert rows(record) == rows(spark.sql(roles.ROLES["record"], **frames)) and record.count() == 9
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # both sides of customers and orders, the orders by their key, the lines by theirs: no line is dealt out by customer
        dealt = dealt_out_by(roles.Roles(spark, str(tmp_path))["record"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [("custkey" in keys) for keys in dealt] == [False, False, True, True]


def test_new_items_count_an_order_once_per_category(spark, rows):
    view, _ = small_orders(spark)
    requests = spark.createDataFrame([(1, "20200100"), (1, "20200100"), (7, "20200100")], "po_number int, period string")
    assert rows(new_items_by_team(requests, view)) == [(None, "20200100", 1), ("A team", "20200100", 2), ("B team", "20200100", 2)]


def test_audience_and_transitions(spark):
    view, _ = small_orders(spark)
    users = spark.createDataFrame([(1, 2, "Ann", "a@x"), (2, 2, "Bob", "b@x"), (3, 1, None, "c@x")], "id int, team_id int, full_name string, email string")
    team = spark.createDataFrame([(1, "B team"), (2, "a TEAM")], "id int, name string")
    auth = spark.createDataFrame([(1, "POModule r"), (1, "POModule w"), (2, "other"), (3, "x pomodule")], "user_id int, item_name string")
    requests = spark.createDataFrame(
        [(1, "20200100", 1, None, datetime(2020, 1, 1)), (1, "20200100", 3, None, datetime(2020, 1, 1)), (1, "20200100", 3, 1, datetime(2020, 1, 1))],
        "po_number int, period string, status_id int, is_reminder_sent int, created_at timestamp_ntz",
    )
    body = {"body": "{AGENT_NAME}|{TEAM}|{NEW_ITEMS}|{TARGET_DATE}|{SIGNATURE}"}
    mails = audiences.notification_audience(users, team, auth, requests, view, datetime(2020, 1, 3), body, "S")
    assert sorted(r.body for r in mails.collect()) == ["Ann|a TEAM|1|2020-01-17|S", "|B team|1|2020-01-17|S"]
    moved, changed = audiences.mark_notified(requests, mails)
    assert changed.first().n_changed == 1 and moved.filter("status_id = 1").count() == 0
    # created Wednesday 1 January: due on the 15th, which is over only after midnight
    due = datetime(2020, 1, 15)
    assert audiences.reminder_audience(users, team, auth, requests, view, due, body).count() == 0
    reminders = audiences.reminder_audience(users, team, auth, requests, view, datetime(2020, 1, 15, 0, 0, 1), body)
    assert sorted(r.new_items for r in reminders.collect()) == [1, 1]
    marked, changed = audiences.mark_reminded(requests, reminders)
    assert changed.first().n_changed == 2 and marked.filter("is_reminder_sent = 1").count() == 2
    nobody = mails.limit(0)
    assert audiences.mark_notified(requests, nobody)[1].first().n_changed == 0


def mail_tables(spark):
    users = spark.range(400).coalesce(1).selectExpr("id", "1 AS team_id", "concat('n', id) AS full_name", "concat(id, '@x') AS email")
    team = spark.createDataFrame([(1, "T")], "id int, name string")
    auth = users.selectExpr("id AS user_id", "'POModule' AS item_name")
    requests = spark.createDataFrame(
        [(i, f"2020{i:02d}00", 1, None, datetime(2020, 1, 1)) for i in range(1, 6)],
        "po_number int, period string, status_id int, is_reminder_sent int, created_at timestamp_ntz",
    )
    view = requests.select("po_number", "period", F.lit("T").alias("team"))
    return users, team, auth, requests, view


def test_mails_of_a_table_in_one_piece_are_written_by_several_tasks(spark):
    """The users lie in one partition and the join meets few counts: the mails are still spread (F11)."""
    mails = audiences.notification_audience(*mail_tables(spark), datetime(2020, 1, 3), {"body": "{AGENT_NAME} {PERIOD}"})
    sizes = [r["count"] for r in mails.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert sum(sizes) == 2_000 and len(sizes) > 1 and max(sizes) < 1_000


def test_mail_run_computes_the_order_view_once(spark):
    """Both kinds of mail read the stored view, and what is sent is computed once (F9)."""
    *tables, view = mail_tables(spark)
    seen = spark.sparkContext.accumulator(0)

    def read(team):
        seen.add(1)
        return team

    view = view.withColumn("team", F.udf(read, "string").asNondeterministic()("team"))
    run = audiences.mail_run(*tables, view, datetime(2020, 2, 1), {"body": "{AGENT_NAME}"}, {"body": "{TEAM}"})
    assert tuple(run.counts.first()) == (2_000, 5, 2_000)
    assert seen.value == 5


def test_anonymisation_can_be_repeated_and_needs_a_pending_user(spark):
    fields = {f: F.lit("v") for f in gdpr.USER_FIELDS}
    users = spark.createDataFrame([(1, 0), (2, 1), (3, 0)], "id int, is_anonymized int").withColumns(fields)
    mails = spark.createDataFrame([(1,), (1,), (3,)], "created_by int").withColumns({f: F.lit("m") for f in gdpr.MAIL_FIELDS})
    log = spark.createDataFrame(
        [(1, datetime(2020, 1, 1)), (2, datetime(2020, 1, 1)), (3, datetime(2024, 1, 1))], "created_by int, created_at timestamp_ntz"
    )
    done = gdpr.anonymize(users, mails, log, datetime(2024, 6, 1))
    assert tuple(done.counts.first()) == (1, 2, 2)
    assert {r.id: (r.email, r.is_anonymized) for r in done.users.collect()} == {1: ("DELETED_1", 1), 2: ("DELETED_2", 1), 3: ("v", 0)}
    assert sorted(r.subject for r in done.mails.collect()) == ["", "", "m"]
    again = gdpr.anonymize(done.users, done.mails, log, datetime(2024, 6, 1))
    assert tuple(again.counts.first()) == (0, 0, 0)
    assert again.users is done.users


def test_kpi_report_invalid_rows_and_case(spark):
    template = spark.createDataFrame(
        [(p, "Team", "Supplier Qualification", k, "Acme", None) for p in ("20200100", "20200200")
         for k in ("Number of received Supplier Qualifications (Input)", "Number of finished Supplier Qualifications (New)", "Other")],
        "period string, team string, product string, kpi string, customer_name string, value double",
    )
    data = spark.createDataFrame(
        [(1, date(2020, 1, 5), date(2020, 2, 1), "New", "finished", "Center", "ACME ", 0), (2, date(2020, 2, 5), None, "New", "x", "Center", "acme", 0),
         (3, date(2020, 2, 5), date(2020, 2, 6), "Odd", "Finished", "Center", None, 0), (4, date(2020, 2, 5), None, "New", "x", "Center", "acme", 1),
         (5, date(2020, 3, 5), None, "New", "x", "Center", "acme", 0)],
        "record_id int, input_received date, finished_date date, request_type string, status string, delivery_center string, customer_name string, doubles int",
    )
    teams = kpi.team_names(
        spark.createDataFrame([(1, "Team", 1), (2, "Else", 1)], "id int, name string, dc_id int"),
        spark.createDataFrame([(1, "center")], "id int, name string"), ["team"],
    )
    periods = ["20200100", "20200200"]
    report = kpi.kpi_report(template, data, teams, periods).collect()
    filled = {(r.period, r.kpi[:19]): r.value for r in report if r.period[0] == "2"}
    assert filled == {
        ("20200100", "Number of received "): 2.0, ("20200200", "Number of received "): 2.0, ("20200100", "Number of finished "): 1.0,
        ("20200200", "Number of finished "): 1.0, ("20200100", "Other"): None, ("20200200", "Other"): None,
    }
    invalid = sorted(((r.product, r.kpi, r.customer_name, r.value) for r in report if r.period[0] == " "), key=str)
    assert invalid == sorted(
        [(" Supplier Qualification", "Number of received Supplier Qualifications (Input)", None, 1.0), ("Supplier Qualification", None, None, 1.0)], key=str
    )
    split = kpi.kpi_report(template, data, teams, periods, per_period=True).collect()
    assert {(r.period, r.value) for r in split if r.kpi and r.kpi.startswith("Number of received") and r.period[0] == "2"} == {("20200100", 1.0), ("20200200", 1.0)}




def test_kpi_template_levels_and_bounds(spark):
    def table(schema, *data):
        return spark.createDataFrame(list(data), schema)

    open_ = (None, None)
    t = {
        "team_customer": table("id int, team_id int, customer_id int, valid_from string, valid_to string", (1, 1, 10, *open_)),
        "customer": table(
            "id int, name string, valid_from string, valid_to string",
            (10, "Root", *open_), (11, "Unit", "20200200", None), (12, "Hidden", *open_), (13, "Gone", None, "20190100"),
        ),
        "team": table("id int, name string", (1, "Team")),
        "service": table("id int, team_customer_id int, service_name_id int, valid_from string, valid_to string", (5, 1, 7, *open_), (6, 1, 8, *open_)),
        "service_name": table("id int, name string", (7, "supplier qualification "), (8, "Other")),
        "kpi": table("service_id int, kpi_name_id int, valid_from string, valid_to string", (5, 1, *open_), (5, 2, *open_), (6, 1, *open_)),
        "kpi_name": table("id int, name string, priority int, kpi_kind int", (1, "K1", 1, 1), (2, "K2", 1, 2)),
        "customer_visibility": table(
            "team_id int, service_name_id int, customer_unit_id int, valid_from string, valid_to string",
            (1, 7, 12, "20200100", "20200100"), (1, 7, 10, None, None),
        ),
    }
    hierarchy = table("id int, root_id int", (10, 10), (11, 10), (12, 10), (13, 10), (99, None))
    periods = ["20200100", "20200200"]
    rows = {(r.period, r.customer_name) for r in kpi.kpi_template(t, hierarchy, periods).collect()}
    assert rows == {("20200100", "Root"), ("20200200", "Root"), ("20200200", "Unit"), ("20200200", "Hidden")}
    level = table(
        "customer_unit_id int, team_id int, service_name_id int, period string, consolidation string",
        (10, 1, 7, "20200100", "Inputed"), (11, 1, 7, "20200200", "calculated"),
    )
    rows = {(r.period, r.customer_name) for r in kpi.kpi_template(t, hierarchy, periods, level).collect()}
    assert rows == {("20200100", "Root")}


def test_dashboard_keeps_rows_multiplied_by_lookups(spark):
    """A customer listed twice as global doubles its rows; one of them is the first of its request."""
    from supplyloom.plans.dashboard import request_dashboard, with_headers
    from supplyloom.plans.prices import price_list
    from supplyloom.queries.aggregating import price_tables
    from supplyloom.queries.reports import dashboard_tables
    from supplyloom.queries.roles import Roles

    roles = Roles(spark, "/root/testdata/sf0.001")
    t = dashboard_tables(roles)
    t["global_customer"] = t["global_customer"].unionByName(t["global_customer"])
    rows = request_dashboard(t, price_list(price_tables(roles)), date(1998, 3, 10), "step_entered")
    per_request = rows.groupBy("record_id").agg(
        F.count_if(F.col("doubles") == 0).alias("firsts"), F.count(F.lit(1)).alias("n"),
        F.count_distinct("escalation_id").alias("escalations"), F.first("customer_type").alias("kind"),
        F.count_if(F.col("doubles_check_escalation") == 0).alias("distinct_rows"),
    ).collect()
    assert per_request and all(r.firsts == 1 for r in per_request)
    for r in per_request:
        once = max(r.escalations, 1)
        assert r.n == once * (2 if r.kind == "global" else 1) and r.distinct_rows == once
    assert {"Record ID", "CoC Available / Migrated", "Company Contact Email"} <= set(with_headers(rows.limit(0)).columns)


def dashboard_folder(spark, folder):
    """The given tables with a few rows of ours, some keys NULL, unknown or there twice."""
    day = datetime(1998, 1, 5)
    orders = [(k, k % 7, "FOP"[k % 3], 10.0 * k, day, "1-URGENT") for k in range(40)]
    made = {
        "region": ([(k, f"R{k}") for k in range(5)], "r_regionkey int, r_name string"),
        "nation": ([(k, f"N{k}", k % 5) for k in range(12)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(k, f"C{k}", k, 900.0 * (k or 0), "AUTO") for k in (1, 2, 2, 3, 4, 5, 8, None)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(k, f"S{k}", k, 1.0) for k in (1, 2, 3)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(k, f"P{k}", "b", "t", k, 1.0) for k in range(4)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": ([*orders, orders[3], orders[4], (None, None, "O", 1.0, day, None)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": (
            [(k, n % 4, n % 3, n, 1.0, 100.0, 0.0, 0.0, "RN"[n % 2], "OF"[n % 2], day) for k in [*range(0, 40, 2), 3, None] for n in (1, 2, 4, 4, 7)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        ),
        "conversations": ([(k, n, "user", f"text {n}") for k in (0, 3, 4, 99) for n in (1, 2, 3)], "conv_id long, turn long, role string, text string"),
    }
    for name, table in made.items():
        spark.createDataFrame(*table).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_dashboard_in_slices_has_the_rows_of_the_whole(spark, tmp_path, rows, monkeypatch):
    """a slice reads its own requests, children and processes alone, and leaves nothing but its rows."""
    from supplyloom.plans import dashboard
    from supplyloom.plans.prices import price_list
    from supplyloom.queries.aggregating import price_tables
    from supplyloom.queries.reports import dashboard_tables
    from supplyloom.queries.roles import Roles
    from supplyloom.session import shared_folder

    roles = Roles(spark, dashboard_folder(spark, tmp_path))
    t, prices = dashboard_tables(roles), price_list(price_tables(roles))
    sliced, sizes = dashboard._slice, []

    def seen(requests, slices, number, t):
        some, found = sliced(requests, slices, number, t)
        assert found["escalation"].count() < t["escalation"].count() and found["coc_process"].count() < t["coc_process"].count()
        sizes.append(some.count())
        return some, found

    monkeypatch.setattr(dashboard, "_slice", seen)
    monkeypatch.setattr(dashboard, "REQUESTS_PER_SLICE", 1_000)
    whole = dashboard.request_dashboard(t, prices, date(1998, 3, 10), "step_entered")
    expected = rows(whole)
    stored = Path(urlparse(shared_folder(spark)).path)
    before = set(stored.iterdir())
    monkeypatch.setattr(dashboard, "REQUESTS_PER_SLICE", 30)
    got = dashboard.request_dashboard(t, prices, date(1998, 3, 10), "step_entered")
    assert sizes and len(sizes) == 2 and all(sizes) and got.dtypes == whole.dtypes
    left = {p.name for p in set(stored.iterdir()) - before}
    assert len(left) == 2 + 2  # the rows of the slices, requests and prices
    assert len(expected) > 40 and rows(got) == expected


def test_stored_anonymisation_that_fails_halfway_is_repeated(spark, tmp_path, monkeypatch):
    fields = {f: F.lit("v") for f in gdpr.USER_FIELDS}
    users = spark.createDataFrame([(1, 0), (2, 1), (3, 0)], "id int, is_anonymized int").withColumns(fields)
    mails = spark.createDataFrame([(1,), (3,), (None,)], "created_by int").withColumns({f: F.lit("v") for f in gdpr.MAIL_FIELDS})
    log = spark.createDataFrame([(1, datetime(2020, 1, 1)), (2, datetime(2020, 1, 1)), (3, datetime(2024, 5, 1))], "created_by int, created_at timestamp_ntz")
    at = [str(tmp_path / name) for name in ("users", "mails")]
    versions.replace(users, at[0])
    versions.replace(mails, at[1])

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(gdpr, "blank_mails", lost)
        with pytest.raises(OSError):
            gdpr.anonymize_stored(spark, *at, log, datetime(2024, 6, 1), "run 1")
    assert versions.read(spark, at[1]).filter("message = ''").count() == 0
    run = gdpr.anonymize_stored(spark, *at, log, datetime(2024, 6, 1), "run 1")
    assert run == gdpr.StoredRun(1, 2, 1)
    assert {r.id: r.email for r in versions.read(spark, at[0]).collect()} == {1: "DELETED_1", 2: "DELETED_2", 3: "v"}
    assert versions.read(spark, at[1]).filter("message = ''").count() == 1
    assert [gdpr.audit_rows(spark, path).collect() for path in at] == [[("run 1", "2024-06-01 00:00:00", 1, 2, 1)]] * 2
    # the next run finds nobody left and publishes nothing
    numbers = [versions.current(spark, path).number for path in at]
    assert gdpr.anonymize_stored(spark, *at, log, datetime(2024, 6, 2), "run 2") == gdpr.StoredRun(0, 0, 0)
    assert [versions.current(spark, path).number for path in at] == numbers
