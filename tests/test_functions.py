from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from supplyloom.functions import dates, labels, text
from supplyloom.plans.dashboard import header

HOLIDAYS = [date(2019, 12, 25), date(2020, 1, 1), date(2020, 1, 2), date(2020, 1, 4)]


def is_workday(d, holidays=()):
    return d.weekday() < 5 and d not in holidays


def count(a, b, holidays=()):
    step = 1 if b >= a else -1
    low, high = min(a, b), max(a, b)
    days = (low + timedelta(i) for i in range(1, (high - low).days + 1))
    return step * sum(is_workday(d, holidays) for d in days)


def add(a, n, holidays=()):
    while n:
        a += timedelta(1)
        n -= is_workday(a, holidays)
    return a


@pytest.mark.parametrize("holidays", [(), HOLIDAYS])
def test_workdays_against_day_by_day_count(spark, holidays):
    starts = [date(2019, 12, 18) + timedelta(i) for i in range(21)]
    pairs = [(a, a + timedelta(k), n) for a in starts for k in range(-12, 25) for n in (1, 3, 10)]
    df = spark.createDataFrame(pairs, "a date, b date, n int").select(
        "a", "b", "n",
        dates.workdays_between(F.col("a"), F.col("b"), holidays=holidays).alias("between"),
        dates.workdays_between(F.col("a"), F.col("b"), inclusive_start=True, holidays=holidays).alias("inclusive"),
        dates.add_workdays(F.col("n"), F.col("a"), holidays).alias("due"),
    )
    for r in df.collect():
        assert r.between == count(r.a, r.b, holidays)
        assert r.due == add(r.a, r.n, holidays)
        if r.b >= r.a:
            assert r.inclusive == count(r.a - timedelta(1), r.b, holidays)


def test_fiscal_calendar_and_null_rules(spark):
    df = spark.createDataFrame([(date(2017, 10, 1),), (date(2018, 9, 30),), (None,)], "d date").select(
        dates.fiscal_year(F.col("d")), dates.fiscal_month(F.col("d")), dates.fiscal_label(F.col("d")), dates.year_month(F.col("d")),
        dates.period_of(F.col("d")),
    )
    assert [tuple(r) for r in df.collect()] == [
        ("2018", "01", "FY18 - 01 - Oct", "2017-10", "20171000"),
        ("2018", "12", "FY18 - 12 - Sep", "2018-09", "20180900"),
        (None, None, None, "-", None),
    ]


def test_odd_numbers_and_periods(spark):
    df = spark.createDataFrame([("NaN", "20181300"), ("5f", "x"), ("inf", None), ("-1.5e3", "20181000"), (None, "20180900"), ("1.", "")], "n string, p string")
    got = df.select(text.is_numeric(F.col("n")).alias("n"), dates.fiscal_year_of_period(F.col("p")).alias("y")).collect()
    assert [(r.n, r.y) for r in got] == [(False, None), (False, None), (False, None), (True, "2019"), (False, "2018"), (True, None)]


def test_periods(spark):
    assert dates.previous_periods(date(2020, 2, 10), 3) == ["20191100", "20191200", "20200100"]
    assert sorted(r.period for r in dates.periods(spark, date(2020, 2, 29), 3).collect()) == ["20191100", "20191200", "20200100"]
    assert dates.periods(spark, date(2020, 2, 29), 0).count() == 0
    assert len(dates.previous_periods(date(2020, 2, 10), 400)) == 400
    with pytest.raises(ValueError):
        dates.previous_periods(date(2020, 2, 10), -1)


def test_period_filter_with_gap(spark):
    df = spark.createDataFrame([(date(2020, m, 28),) for m in (1, 2, 3, 4)], "d date")
    assert [r.d.month for r in df.filter(dates.in_periods(F.col("d"), ["20200100", "20200300"])).collect()] == [1, 3]


def test_valid_period_bounds(spark):
    df = spark.createDataFrame(
        [("20180100", "20180300", date(2018, 3, 31)), ("20180100", "20180300", date(2018, 4, 1)), (None, None, date(2018, 4, 1)),
         ("20180100", None, date(2017, 12, 31))],
        "f string, t string, d date",
    )
    assert [r[0] for r in df.select(dates.is_valid_period(F.col("f"), F.col("t"), F.col("d"))).collect()] == [1, 0, 1, 0]


def test_text_comparison_and_defaults(spark):
    df = spark.createDataFrame([("Out Of Scope  ", " 1 "), ("x ", "$"), (None, "1.5")], "a string, n string")
    got = df.select(
        text.same_text(F.col("a"), "out of scope"), text.text_or(F.col("a"), "none"), text.glue(F.lit("<"), F.col("a"), F.lit(">")),
        text.as_int(F.col("n")), text.is_numeric(F.col("n")),
    ).collect()
    assert [tuple(r) for r in got] == [
        (True, "Out Of Scope  ", "<Out Of Scope  >", 1, True), (False, "none", "<x >", None, False), (None, "none", "<>", None, True),
    ]


def test_templates_replace_in_turn_and_drop_missing_values(spark):
    df = spark.createDataFrame([("{B}", "b")], "a string, b string")
    out = text.render_template(df, {"t": "{A}-{B}-{C}-{D}"}, {"A": F.col("a"), "B": F.col("b"), "C": F.lit(None)})
    assert out.first().t == "b-b--{D}"


def test_bucket_edges(spark):
    days = spark.createDataFrame([(None,), (5,), (6,), (40,), (41,), (99,), (100,)], "d int")
    got = days.select(labels.age_label(F.col("d")), labels.total_time_label(F.col("d"))).collect()
    assert [r[0][:2] for r in got] == ["0)", "a)", "b)", "d)", "e)", "e)", "e)"]
    assert [r[1][:2] for r in got] == ["a)", "b)", "b)", "b)", "b)", "b)", "c)"]


def test_mixed_codes(spark):
    df = spark.createDataFrame([("0",), ("7",), ("see mail",), (None,)], "c string")
    got = df.select(labels.decode_mixed(F.col("c"), labels.EXPIRATION_CODES), labels.mixed_text(F.col("c"), F.lit("t"))).collect()
    assert [tuple(r) for r in got] == [("Unlimited", "t"), (None, "t"), ("see mail", ""), (None, "")]


def test_backlog_step_rules(spark):
    cases = [
        ("Finished", True, "Qualification", None), ("not started", True, "x", "a) Not Started"),
        ("In process", True, "CoC Acceptance", "b) Data Clarification Escalated"), ("in process", None, "coc acceptance", "c) CoC"),
        ("Escalated", None, "CoC Acceptance", "d) CoC Escalated"), ("Escalated", None, "Data Clarification", None),
        (None, None, "Finalization", "g) Finalization"),
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "s string, o boolean, p string")
    got = [r[0] for r in df.select(labels.backlog_step(F.col("s"), F.col("o"), F.col("p"))).collect()]
    assert got == [c[3] for c in cases]


def test_headers():
    assert header("record_id") == "Record ID" and header("supplier_contact_first_name") == "Supplier Contact First Name"
