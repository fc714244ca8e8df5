"""Scalar functions FN1-FN16 and the period generator G1, over dates and texts of the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from supplyloom.functions import dates, text
from supplyloom.queries.registry import query
from supplyloom.queries.roles import with_roles

D = "CAST(o_orderdate AS DATE)"
FY = f"CAST(CASE WHEN month({D}) >= 10 THEN year({D}) + 1 ELSE year({D}) END AS VARCHAR)"
FM = f"lpad(CAST((month({D}) + 2) % 12 + 1 AS VARCHAR), 2, '0')"
HOLIDAYS = (date(1996, 1, 1), date(1996, 5, 1), date(1996, 12, 25), date(1997, 1, 1), date(1997, 5, 1), date(1998, 12, 25))
SQL_HOLIDAYS = "[" + ", ".join(f"DATE '{h}'" for h in HOLIDAYS) + "]"


@query(
    "fn1_fn6_fn15_fiscal_calendar",
    f"""SELECT o_orderkey, {FY} AS fiscal_year, {FM} AS fiscal_month, strftime({D}, '%b') AS month_name,
        'FY' || right({FY}, 2) || ' - ' || {FM} || ' - ' || strftime({D}, '%b') AS fiscal_label,
        CASE WHEN o_orderstatus = 'F' THEN strftime({D}, '%Y-%m') ELSE '-' END AS year_month,
        strftime({D}, '%Y%m') || '00' AS period, strftime({D}, '%d.%m.%Y') AS written FROM orders""",
)
def fiscal_calendar(t):
    d = F.col("o_orderdate").cast("date")
    return t["orders"].select(
        "o_orderkey",
        dates.fiscal_year(d).alias("fiscal_year"),
        dates.fiscal_month(d).alias("fiscal_month"),
        dates.month_name(d).alias("month_name"),
        dates.fiscal_label(d).alias("fiscal_label"),
        dates.year_month(F.when(F.col("o_orderstatus") == "F", d)).alias("year_month"),
        dates.period_of(d).alias("period"),
        F.date_format(d, "dd.MM.yyyy").alias("written"),
    )


@query(
    "fn7_fiscal_year_of_period",
    with_roles(
        "price",
        """SELECT valid_from, valid_to, CAST(CASE WHEN CAST(substr(valid_from, 5, 2) AS INT) >= 10
        THEN CAST(substr(valid_from, 1, 4) AS INT) + 1 ELSE CAST(substr(valid_from, 1, 4) AS INT) END AS VARCHAR) AS from_year,
        CAST(CASE WHEN CAST(substr(valid_to, 5, 2) AS INT) >= 10
        THEN CAST(substr(valid_to, 1, 4) AS INT) + 1 ELSE CAST(substr(valid_to, 1, 4) AS INT) END AS VARCHAR) AS to_year
        FROM r_price""",
    ),
)
def fiscal_year_of_period(t):
    return t["price"].select(
        "valid_from",
        "valid_to",
        dates.fiscal_year_of_period(F.col("valid_from")).alias("from_year"),
        dates.fiscal_year_of_period(F.col("valid_to")).alias("to_year"),
    )


@query(
    "fn8_is_valid_period",
    with_roles(
        "sq_customer",
        """SELECT o_orderkey, CASE WHEN (valid_from IS NULL OR strftime(o_orderdate, '%Y%m%d') >= valid_from)
        AND (valid_to IS NULL OR o_orderdate < strptime(substr(valid_to, 1, 6) || '01', '%Y%m%d') + INTERVAL 1 MONTH)
        THEN 1 ELSE 0 END AS is_valid FROM orders JOIN r_sq_customer ON id = o_custkey""",
    ),
)
def is_valid_period(t):
    return t["orders"].join(t["sq_customer"], F.col("o_custkey") == F.col("id")).select(
        "o_orderkey",
        dates.is_valid_period(F.col("valid_from"), F.col("valid_to"), F.col("o_orderdate").cast("date")).alias("is_valid"),
    )


@query(
    "fn9_add_workdays",
    # checked by listing the days: the n-th working day after the start
    f"""SELECT o_orderkey, CAST(list_filter(generate_series({D} + 1, {D} + 40, INTERVAL 1 DAY), lambda x: isodow(x) < 6)[10] AS DATE)
        ::VARCHAR AS due, CAST(list_filter(generate_series({D} + 1, {D} + 60, INTERVAL 1 DAY),
        lambda x: isodow(x) < 6 AND NOT list_contains({SQL_HOLIDAYS}, CAST(x AS DATE)))[1 + o_orderkey % 20] AS DATE)::VARCHAR AS due_holidays
        FROM orders""",
)
def add_workdays(t):
    d = F.col("o_orderdate")
    return t["orders"].select(
        "o_orderkey",
        dates.add_workdays(10, d).alias("due"),
        dates.add_workdays((1 + F.col("o_orderkey") % 20).cast("int"), d, HOLIDAYS).alias("due_holidays"),
    )


@query(
    "fn10_workdays_between",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
        CASE WHEN e >= s THEN len(list_filter(generate_series(s + 1, e, INTERVAL 1 DAY), lambda x: isodow(x) < 6))
             ELSE -len(list_filter(generate_series(e + 1, s, INTERVAL 1 DAY), lambda x: isodow(x) < 6)) END::INT AS workdays,
        CASE WHEN e >= s THEN len(list_filter(generate_series(s, e, INTERVAL 1 DAY), lambda x: isodow(x) < 6
             AND NOT list_contains({SQL_HOLIDAYS}, CAST(x AS DATE)))) END::INT AS inclusive
        FROM (SELECT *, {D} AS s, CAST(l_shipdate AS DATE) AS e FROM lineitem JOIN orders ON o_orderkey = l_orderkey)""",
)
def workdays_between(t):
    s, e = F.col("o_orderdate"), F.col("l_shipdate")
    inclusive = dates.workdays_between(s, e, inclusive_start=True, holidays=HOLIDAYS)
    return t["lineitem"].join(t["orders"], F.col("o_orderkey") == F.col("l_orderkey")).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        dates.workdays_between(s, e).alias("workdays"),
        F.when(e >= s, inclusive).alias("inclusive"),
    )


@query(
    "fn11_fn12_fn13_arithmetic_and_casts",
    with_roles(
        "request",
        """SELECT id, CAST(CAST(created_at AS DATE) - INTERVAL 2 MONTH AS DATE)::VARCHAR AS two_months_before,
        CAST(CAST(created_at AS DATE) - INTERVAL 1 YEAR AS DATE)::VARCHAR AS year_before,
        strftime(created_at - INTERVAL 30 HOUR, '%Y-%m-%d %H:%M') AS hours_before,
        TRY_CAST(expiration_comment AS INT) AS as_int, CASE WHEN TRY_CAST(expiration_comment AS DOUBLE) IS NULL THEN 0 ELSE 1 END
        AS is_numeric, strftime(created_at, '%Y%m%d') AS converted FROM r_request""",
    ),
)
def arithmetic_and_casts(t):
    created = F.col("created_at")
    return t["request"].select(
        "id",
        F.add_months(created.cast("date"), -2).alias("two_months_before"),
        F.add_months(created.cast("date"), -12).alias("year_before"),
        F.date_format(created - F.expr("INTERVAL 30 HOUR"), "yyyy-MM-dd HH:mm").alias("hours_before"),
        text.as_int(F.col("expiration_comment")).alias("as_int"),
        text.is_numeric(F.col("expiration_comment")).alias("is_numeric"),
        F.date_format(created, "yyyyMMdd").alias("converted"),
    )


@query(
    "fn14_text_functions",
    """SELECT p_partkey, CAST(length(p_name) AS INT) AS len, left(p_name, 4) AS left4, right(p_brand, 2) AS right2,
        substr(p_type, 2, 5) AS mid, substr(p_name, 1, 1) || '--' || substr(p_name, 4) AS stuffed,
        p_brand || CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END || chr(10) AS glued FROM part""",
)
def text_functions(t):
    return t["part"].select(
        "p_partkey",
        text.text_length(F.concat(F.col("p_name"), F.lit("  "))).alias("len"),
        F.left("p_name", F.lit(4)).alias("left4"),
        F.right("p_brand", F.lit(2)).alias("right2"),
        F.substring("p_type", 2, 5).alias("mid"),
        text.stuff(F.col("p_name"), 2, 2, "--").alias("stuffed"),
        text.glue(F.col("p_brand"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")), F.char(F.lit(10))).alias("glued"),
    )


@query(
    "fn16_render_template",
    """SELECT c_custkey, 'Hello ' || c_name || ', ' || CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE '' END || ' / ' || c_name
        AS body, 'To ' || c_custkey AS title FROM customer""",
)
def render_template(t):
    segment = F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment"))
    values = {"NAME": F.col("c_name"), "SEGMENT": segment, "ID": F.col("c_custkey")}
    rendered = text.render_template(t["customer"], {"body": "Hello {NAME}, {SEGMENT} / {NAME}", "title": "To {ID}"}, values)
    return rendered.select("c_custkey", "body", "title")


@query(
    "g1_periods_of_orders",
    """SELECT strftime(date_trunc('month', DATE '2001-07-15') - to_months(CAST(b AS INT)), '%Y%m') || '00' AS period,
        count(o_orderkey) AS n_orders FROM range(1, 25) AS g(b) LEFT JOIN orders
        ON date_trunc('month', o_orderdate) = date_trunc('month', DATE '2001-07-15') - to_months(CAST(b AS INT)) GROUP BY 1""",
)
def periods_of_orders(t):
    """The previous 24 months, with their orders."""
    wanted = dates.periods(t.spark, date(2001, 7, 15), 24)
    names = dates.previous_periods(date(2001, 7, 15), 24)
    counted = (
        t["orders"].filter(dates.in_periods(F.col("o_orderdate"), names))
        .groupBy(dates.period_of(F.col("o_orderdate")).alias("period")).agg(F.count("o_orderkey").alias("n"))
    )
    return wanted.join(counted, "period", "left").select("period", F.coalesce("n", F.lit(0)).alias("n_orders"))
