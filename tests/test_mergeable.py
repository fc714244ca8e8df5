"""Counts that are stored and added up against counting everything at once."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from supplyloom.operators import distinct, windows
from supplyloom.plans import kpi_report as kpi


def test_distinct_counts_merge_exactly(spark):
    rng = random.Random(2)
    ids = [None, -70_000, -1, 0, 5, 32_767, 32_768, 10**12, *range(100, 160)]
    rows = [(rng.choice("ab"), rng.choice([1, 2, None]), rng.choice(ids), rng.choice([None, 7, 8])) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, h int, x long, y int")
    halves = [distinct.id_sets(df.filter(F.col("x") % 2 == r), ["g", "h"], ["x", "y"]) for r in (0, 1, -1)]
    halves.append(distinct.id_sets(df.filter("x IS NULL"), ["g", "h"], ["x", "y"]))
    stored = halves[0].unionByName(halves[1]).unionByName(halves[2]).unionByName(halves[3])
    for groups in (["g", "h"], ["g"], ["h"], []):
        wanted = df.groupBy(*groups).agg(F.count_distinct("x").alias("x"), F.count_distinct("y").alias("y"))
        got = distinct.count_ids(stored, groups, ["x", "y"]).select(*wanted.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
    again = distinct.merge_sets(stored.unionByName(halves[0]), ["g", "h"])
    assert again.count() == distinct.merge_sets(stored, ["g", "h"]).count()
    assert distinct.count_ids(stored.filter("false"), ["g"], ["x"]).count() == 0


def test_ids_far_apart_take_no_more_room_than_they_are(spark):
    """One id in a group costs one number, not a bitmap of 4 KB (F7)."""
    df = spark.range(2_000).select((F.col("id") % 500).alias("g"), (F.col("id") * 40_000).alias("x"))
    sets = distinct.id_sets(df, ["g"], ["x"])
    assert dict(sets.dtypes)["_bits"] == "bigint" and sets.count() == 2_000
    assert {r.x for r in distinct.count_ids(sets, ["g"], ["x"]).collect()} == {4}


def test_report_from_stored_counts_equals_the_whole_report(spark, tmp_path):
    rng = random.Random(9)
    periods = ["20200100", "20200200", "20200300"]
    days = [date(2020, 1, 1) + timedelta(days=i) for i in range(-10, 110)]
    data = spark.createDataFrame(
        [
            (i, rng.choice(["Lisbon", "lisbon ", "Rome", None]), rng.choice(["Acme", "ACME", "Bolt", None]), rng.choice([0, 0, 0, 1]),
             rng.choice(days), rng.choice([None, *days]), rng.choice(["Finished", "Open"]), rng.choice(["New", "check", "Renewal", "odd"]))
            for i in range(600)
        ],
        "record_id int, delivery_center string, customer_name string, doubles int, input_received date, finished_date date, status string, request_type string",
    )
    teams = spark.createDataFrame([("Team A", "lisbon"), ("Team B", "lisbon")], "_team string, _dc string")
    names = [kpi.KPI_RECEIVED, *kpi.REQUEST_TYPE_KPIS.values()]
    template = spark.createDataFrame(
        [(p, t, kpi.PRODUCT, k, c, None) for p in periods for t in ("Team A", "team b", "Rome") for k in names for c in ("Acme", "Bolt")],
        "period string, team string, product string, kpi string, customer_name string, value double",
    )
    path = str(tmp_path / "counts")
    kpi.store_counts(data, teams, path, "winter", periods[:2])
    kpi.store_counts(data.filter("record_id < 50"), teams, path, "march", periods[2:])
    kpi.store_counts(data, teams, path, "march", periods[2:])
    for per_period in (False, True):
        for wanted in (periods, periods[1:]):
            chosen = template.filter(F.col("period").isin(*wanted))
            whole = kpi.kpi_report(chosen, data, teams, wanted, per_period)
            stored = kpi.report_from_counts(chosen, kpi.stored_counts(spark, path, wanted, per_period), per_period)
            rows = [sorted(map(str, df.select("period", F.upper("team"), "product", "kpi", F.upper("customer_name"), "value").collect())) for df in (whole, stored)]
            assert rows[0] == rows[1] and any("None" not in r and "value=0.0" not in r for r in rows[0])


def test_numbers_in_cells_equal_a_global_order(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(-5, 40)]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "p string, c int, _n int")
    order = [F.desc_nulls_last("p"), F.asc_nulls_first("c"), F.col("_n")]
    got = windows.number_in_cells(df, order, [(F.col("p"), True), (F.floor(F.col("c") / 7), False)], "no")
    assert got.columns == ["p", "c", "_n", "no"]
    wanted = sorted(rows, key=lambda r: (r[0] is None, -ord(r[0] or "a"), r[1] is not None, r[1] or 0, r[2]))
    assert [(r.p, r.c, r["_n"]) for r in sorted(got.collect(), key=lambda r: r.no)] == wanted
    assert sorted(r.no for r in got.collect()) == list(range(1, 401))
    assert windows.number_in_cells(df.filter("false"), order, [(F.col("p"), True)]).count() == 0


@pytest.mark.parametrize("per_period", [False, True])
def test_offers_give_the_report_of_their_rows(spark, rows, per_period):
    """An offer with a list of periods meets the counts once; the result is that of one row per period."""
    received, other = kpi.KPI_RECEIVED, "Some other value"
    offers = spark.createDataFrame(
        [
            (["19970300", "19970400"], "T", "P", received, "Ann", None), (["19970400"], "T", "P", received, "Bob", None),
            (["19970300"], "T", "P", other, "Ann", 7.0), (["19970300"], "T", "P", received, None, None), ([], "T", "P", received, "Eve", None),
        ],
        "periods array<string>, team string, product string, kpi string, customer_name string, value double",
    )
    counts = spark.createDataFrame(
        [
            ("t ", "ANN", received, "19970300", 3, "c", "P"), ("T", "Ann", received, "19970400", 4, "c", "P"), ("T", "Ann", received, "19970300", 9, "d", "P"),
            ("T", "Bob", received, "19970300", 5, "c", "P"), ("T", "Cid", received, "19970300", 6, "c", "P"), ("T", None, received, None, 8, "c", "P"),
        ],
        "team string, customer_name string, kpi string, period string, n_records long, center_key string, product string",
    )
    if not per_period:
        counts = counts.filter("not (customer_name = 'Ann' and center_key = 'c')").drop("period")
    template = offers.select(F.explode("periods").alias("period"), *offers.columns[1:])
    got, plain = (kpi.report_from_counts(t, counts, per_period) for t in (offers, template))
    assert got.columns == plain.columns
    assert rows(got) == rows(plain)
    if per_period:
        assert {(r.period, r.value) for r in got.filter("customer_name = 'Ann' and team = 'T'").collect()} >= {("19970300", 3.0), ("19970400", 4.0), ("19970300", 7.0)}
