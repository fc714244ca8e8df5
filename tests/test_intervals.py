"""Calendar rows against the array of windows per key, and against brute force."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from supplyloom.operators import intervals, joins

AS_OF = date(2018, 3, 10)


def price_rows(rng, n, keys, day_bounds=False):
    rows = []
    for _ in range(n):
        day = f"{rng.randrange(0, 32):02d}" if day_bounds else "00"
        low = rng.choice([None, f"{rng.randrange(2016, 2020)}{rng.randrange(1, 13):02d}{day}"])
        high = rng.choice([None, f"{rng.randrange(2016, 2020)}{rng.randrange(1, 13):02d}00", "2018"])
        rows.append((rng.choice(keys), low, high, rng.choice([None, rng.randrange(100)])))
    return rows


def test_price_by_calendar_equals_windows_per_key(spark):
    rng = random.Random(6)
    keys = ["a", "B ", "b", None, "c"]
    for day_bounds in (False, True):
        prices = spark.createDataFrame(price_rows(rng, 300, keys, day_bounds), "k string, valid_from string, valid_to string, price int")
        facts = spark.createDataFrame(
            [(i, rng.choice([*keys, "A", "z"]), rng.choice([None, date(2015, 11, 1) + timedelta(days=rng.randrange(2000))])) for i in range(800)],
            "id int, k string, d date",
        )
        wanted = {r.id: r.price for r in joins.price_at(facts, prices, ["k"], "d", AS_OF).collect()}
        got = intervals.price_by_calendar(facts, prices, ["k"], "d", AS_OF)
        assert got.columns == ["id", "k", "d", "price"]
        rows = got.collect()
        assert len(rows) == 800 and {r.id: r.price for r in rows} == wanted and len(set(wanted.values())) > 20


def test_key_with_100_000_windows(spark):
    day = F.date_add(F.lit(date(2010, 1, 1)), (F.col("id") % 3650).cast("int"))
    windows = spark.range(100_000).select(
        F.lit("hot").alias("k"), F.date_format(day, "yyyyMMdd").alias("valid_from"),
        F.date_format(F.date_add(day, (F.col("id") % 977).cast("int")), "yyyyMMdd").alias("valid_to"), F.col("id").alias("price"),
    )
    facts = spark.range(20_000).select("id", F.lit("hot").alias("k"), F.date_add(F.lit(date(2011, 1, 1)), (F.col("id") * 7 % 3000).cast("int")).alias("d"))
    full, edges = intervals.calendar_rows(windows, ["k"], ["valid_from", "valid_to", "price"], intervals.months_of(facts, "d"))
    # the calendar bounds the rows, not the number of windows
    assert full.count() <= 99 + 1 and edges.count() <= 3100
    got = intervals.attach_valid(facts, windows, ["k"], "d", ["valid_from", "valid_to", "price"])
    sample = {r.id: r["_best"] for r in got.filter("id % 199 = 0").collect()}
    listed = [(r.valid_from, r.valid_to, r.price) for r in windows.collect()]
    for r in facts.filter("id % 199 = 0").collect():
        text = r.d.strftime("%Y%m%d")
        assert tuple(sample[r.id]) == max(w for w in listed if w[0] <= text <= w[1])
    assert got.count() == 20_000


def test_windows_are_cut_for_the_days_asked_only(spark):
    """A key with one fact has rows for one month or day, whatever the calendar of the other keys (F13)."""
    windows = spark.createDataFrame([("a", "20100105", None, 1), ("b", "20110100", None, 2), ("c", None, None, 3)], "k string, low string, high string, price int")
    days = [("a", date(2010, 1, 20)), ("a", date(2010, 1, 3)), ("b", date(2011, 1, 9)), *[("z", date(2010 + i // 12, i % 12 + 1, 1)) for i in range(60)], ("a", None)]
    facts = spark.createDataFrame(days, "k string, d date")
    full, edges = intervals.calendar_rows(windows, ["k"], ["price"], intervals.asked_days(facts, ["k"], "d"), "low", "high")
    assert [(r.k, r["_month"]) for r in full.collect()] == [("b", "201101")]
    assert [(r.k, r["_day"]) for r in edges.collect()] == [("a", "20100120")]
    got = intervals.attach_valid(facts, windows, ["k"], "d", ["price"], "low", "high").filter("_best is not null")
    assert sorted((r.k, str(r.d)) for r in got.collect()) == [("a", "2010-01-20"), ("b", "2011-01-09")]


def test_facts_without_day_key_or_window(spark):
    windows = spark.createDataFrame([("a", "20200100", None, 1)], "k string, valid_from string, valid_to string, price int")
    facts = spark.createDataFrame([(1, None, date(2020, 1, 1)), (2, "a", None), (3, "a", date(2019, 12, 31)), (4, "a", date(2020, 1, 1))], "id int, k string, d date")
    got = intervals.attach_valid(facts, windows, ["k"], "d", ["price"])
    assert {r.id: r["_best"] and r["_best"].price for r in got.collect()} == {1: None, 2: None, 3: None, 4: 1}
    assert intervals.attach_valid(facts.filter("false"), windows, ["k"], "d", ["price"]).count() == 0
    assert intervals.attach_valid(facts, windows.filter("false"), ["k"], "d", ["price"]).count() == 4


def test_hide_by_period_equals_the_condition(spark):
    rng = random.Random(3)
    months = [f"2018{m:02d}00" for m in range(1, 13)]
    bound = [None, *months, "20171200", "20190100"]
    visibility = spark.createDataFrame(
        [(rng.choice([1, 2, None]), rng.choice([1, 2]), rng.choice([1, 2, 3]), rng.choice(bound), rng.choice(bound)) for _ in range(12)],
        "team_id int, service_name_id int, customer_unit_id int, valid_from string, valid_to string",
    )
    template = spark.createDataFrame(
        [(t, s, c, p, i) for i, (t, s, c, p) in enumerate((t, s, c, p) for t in (1, 2, None) for s in (1, 2) for c in (1, 2, 3) for p in months)],
        "team_id int, service_name_id int, customer_unit_id int, period string, n int",
    )
    wanted = {r.n for r in joins.hide_invisible(template, visibility).collect()}
    got = [r.n for r in intervals.hide_by_period(template, visibility, months).collect()]
    assert set(got) == wanted and len(got) == len(wanted) < template.count()
    assert intervals.hide_by_period(template, visibility, []).count() == template.count()
