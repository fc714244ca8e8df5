import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from supplyloom.operators import aggregates, joins, sampling, updates, windows
from supplyloom.operators.hierarchy import top_level
from supplyloom.operators.scope import current_fy_scope
from supplyloom.plans.quality_sample import one_pick_per_step, quality_sample


@pytest.mark.parametrize("limit", [1, 3, 1_000_000])
def test_fan_out_is_a_plain_left_join_whatever_the_salting(spark, rows, limit):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k int, x string")
    right = spark.createDataFrame([(1, 100 + i) for i in range(20)] + [(2, 7), (9, 8), (None, 5), (1, None), (2, None)], "k int, e int")
    got = joins.fan_out(left, right, "k", "e", rows_per_task=limit).select("k", "x", "e")
    assert rows(got) == rows(left.join(right, "k", "left").select("k", "x", "e"))


def test_pivot_children_keeps_duplicates_unless_unique(spark):
    fact = spark.createDataFrame([(1, 10), (2, None)], "id int, p int")
    child = spark.createDataFrame([(10, 1, "a"), (10, 4, "b"), (10, 4, "c")], "p int, m int, v string")
    wide = joins.pivot_children(fact, child, "p", "m", {1: "x", 4: "y"}, ["v"])
    assert sorted((r.id, r.x_v, r.y_v) for r in wide.collect() if r.id == 1) == [(1, "a", "b"), (1, "a", "c")]
    assert wide.filter("id = 2").count() == 1
    assert joins.pivot_children(fact, child, "p", "m", {1: "x", 4: "y"}, ["v"], unique=True).count() == 2


def test_not_in_modes(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    with_null = spark.createDataFrame([(1,), (None,)], "k int")
    without = spark.createDataFrame([(1,)], "k int")
    empty = spark.createDataFrame([], "k int")
    assert rows(joins.not_in(df, with_null, "k")) == [(None,), (2,)]
    assert rows(joins.not_in(df, with_null, "k", null_aware=True)) == []
    assert rows(joins.not_in(df, without, "k", null_aware=True)) == [(2,)]
    assert rows(joins.not_in(df, empty, "k", null_aware=True)) == [(None,), (1,), (2,)]


def test_hide_invisible_bounds(spark, rows):
    t = spark.createDataFrame([(1, 1, c, "20200200") for c in range(5)], "team_id int, service_name_id int, customer_unit_id int, period string")
    v = spark.createDataFrame(
        [(1, 1, 0, "20200100", None), (1, 1, 1, None, None), (1, 1, 2, "20200300", None), (1, 1, 3, "20200100", "20200100")],
        "team_id int, service_name_id int, customer_unit_id int, valid_from string, valid_to string",
    )
    assert [r.customer_unit_id for r in joins.hide_invisible(t, v).orderBy("customer_unit_id").collect()] == [1, 2, 3, 4]


def test_price_at_takes_latest_window_and_never_multiplies(spark):
    facts = spark.createDataFrame([(1, "A ", date(2020, 1, 31)), (2, "a", None), (3, "b", date(2020, 1, 1))], "id int, k string, d date")
    prices = spark.createDataFrame(
        [("a", None, None, 1.0), ("a", "20200100", "20200100", 5.0), ("A", "20200100", "20200100", 4.0), ("a", "20210100", None, 9.0)],
        "k string, valid_from string, valid_to string, price double",
    )
    got = joins.price_at(facts, prices, ["k"], "d", date(2022, 5, 5)).orderBy("id").collect()
    assert [r.price for r in got] == [4.0, 9.0, None]


@pytest.mark.parametrize("descending", [False, True])
def test_flag_duplicates_marks_exactly_one_row(spark, descending):
    data = [(k, o) for k in (1, 2, None) for o in (3, 3, 1, 1, 2)] * 3
    df = spark.createDataFrame(data, "k int, o int")
    got = windows.flag_duplicates(df, ["k"], ["o"], "dup", descending=descending).collect()
    assert len(got) == len(data)
    firsts = [(r.k, r.o) for r in got if r.dup == 0]
    assert sorted(firsts, key=str) == sorted([(k, 3 if descending else 1) for k in (1, 2, None)], key=str)


def test_global_row_number_over_many_partitions(spark):
    values = list(range(1000))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(13)
    got = windows.global_row_number(df, [F.desc("v")]).collect()
    assert all(r.id == 1000 - r.v for r in got) and len(got) == 1000


def test_ordered_text_across_chunks(spark):
    comments = spark.createDataFrame(
        [(1, None, datetime(2020, 1, 1, 8), "old"), (1, 7, datetime(2020, 1, 2, 9), "new"), (1, 7, datetime(2020, 1, 2, 8), "a<b"),
         (2, 8, datetime(2020, 1, 1), None)],
        "request_id int, step_id int, created_at timestamp_ntz, text string",
    )
    steps = spark.createDataFrame([(7, "Check")], "id int, name string")
    plain = {r.request_id: r.comment_history for r in aggregates.comment_history(comments, steps).collect()}
    assert plain[1] == "2020-01-02 09:00 - Check - new\n ;; 2020-01-02 08:00 - Check - a<b\n ;; 2020-01-01 08:00 -  - old\n"
    assert plain[2] == "2020-01-01 00:00 -  - "
    escaped = {r.request_id: r.comment_history for r in aggregates.comment_history(comments, steps, xml_escape=True).collect()}
    assert "a&lt;b" in escaped[1]


def test_line_items_text_counts_copies(spark):
    lines = [(1, 1500), (1, 10), (1, 2), (1, 2), (1, 2), (2, None)]
    record = spark.createDataFrame(lines, "po_number int, number_of_line_item int")
    got = {r.po_number: r.line_items_text for r in aggregates.line_items_text(record).collect()}
    assert got == {1: "2\n;2\n;2\n;10\n;1500\n"}


def test_inactive_cutoff_is_inclusive(spark):
    log = spark.createDataFrame(
        [(1, datetime(2023, 2, 28, 10)), (2, datetime(2023, 2, 28, 10, 0, 1)), (3, datetime(2020, 1, 1)), (3, datetime(2024, 1, 1))],
        "created_by int, created_at timestamp_ntz",
    )
    assert [r.created_by for r in aggregates.inactive_users(log, datetime(2024, 2, 29, 10)).collect()] == [1]


def test_update_from_policies(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (1, "a"), (None, "n")], "k int, v string")
    assert rows(updates.update_from(df, new, ["k"], ["v"])) == [(None, None), (1, "a"), (2, None)]
    assert rows(updates.update_from(df, new, ["k"], ["v"], on_missing="keep")) == [(None, "z"), (1, "a"), (2, "y")]
    latest = updates.update_from(df, new, ["k"], ["v"], on_missing="keep", order=[F.desc("v")], where=F.col("k") < 2)
    assert rows(latest) == [(None, "z"), (1, "b"), (2, "y")]


def test_transition_counts_changes(spark, rows):
    df = spark.createDataFrame([(1,), (3,), (None,)], "s int")
    changed, n = updates.transition(df, F.col("s") == 1, {"s": 3})
    assert rows(changed) == [(None,), (3,), (3,)] and n.first().n_changed == 1


def test_top_level_with_deep_chain_cycle_and_missing_parent(spark):
    chain = [(i, i - 1 if i else None) for i in range(40)]
    nodes = spark.createDataFrame(chain + [(100, 101), (101, 100), (102, 101), (200, 999), (201, 200)], "id int, parent_id int")
    roots = {r.id: r.root_id for r in top_level(nodes).collect()}
    assert all(roots[i] == 0 for i in range(40))
    assert roots[100] is None and roots[101] is None and roots[102] is None
    assert roots[200] == 999 and roots[201] == 999


@pytest.mark.parametrize("n,percent,expected", [(0, 10, 0), (1, 10, 1), (30, 10, 3), (31, 10, 4), (1000, 7, 70), (5, 100, 5)])
def test_sample_size_is_rounded_up(spark, n, percent, expected):
    df = spark.range(n).withColumn("one", F.lit(1))
    picked = sampling.sample_percent(df, percent, "s", ["id"])
    assert picked.count() == expected and picked.select("id").distinct().count() == expected


def test_sample_with_mostly_equal_rows_is_whole(spark):
    df = spark.range(300).select(F.when(F.col("id") < 200, 0).otherwise(F.col("id")).alias("k"))
    assert sampling.sample_percent(df, 50, "s", ["k"]).count() == 150


def test_samples_do_not_depend_on_partitioning(spark, rows):
    df = spark.range(2000).withColumn("g", F.col("id") % 7)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    found = []
    for parts in ("1", "16"):
        spark.conf.set(key, parts)
        shaped = df.repartition(int(parts))
        found.append(
            (rows(sampling.sample_percent(shaped, 10, "s", ["id"])), rows(sampling.sample_one_per_group(shaped, ["g"], "s", ["id"])))
        )
    spark.conf.set(key, before)
    assert found[0] == found[1] and len(found[0][1]) == 7


def test_picks_equal_going_through_the_teams_one_by_one(spark):
    rng = random.Random(5)
    lists = {(t, s): sorted((f"{rng.random():.8f}", po) for po in rng.sample(range(12), 6)) for t in range(8) for s in (1, 2)}
    expected, taken = set(), set()
    for agent in sorted(lists):
        free = [po for _, po in lists[agent] if po not in taken]
        if free:
            expected.add((*agent, free[0]))
            taken.add(free[0])
    data = [(t, s, po, f"c{po}", h) for (t, s), wishes in lists.items() for h, po in wishes]
    df = spark.createDataFrame(data, "team_id int, step int, po_number int, category_id string, _hash string")
    got = {(r.team_id, r.step, r.po_number) for r in one_pick_per_step(df).collect()}
    assert got == expected


def test_quality_sample_shares_orders_between_teams_only_once(spark):
    lines = [(po, line, "20200100", po % 3, po % 4, f"u{po % 2}", "c") for po in range(60) for line in range(3)]
    lines += [(po, 9, "20200100", 2, 0, "u0", "c") for po in range(10)]
    record = spark.createDataFrame(
        lines, "po_number int, number_of_line_item int, period string, team_id int, customer_id int, po_created_by string, category_id string"
    )
    prior = spark.createDataFrame([(po,) for po in range(0, 60, 5)], "po_number int")
    args = ("20200100", "seed", datetime(2020, 2, 1), 7, ["po_number", "number_of_line_item", "team_id"])
    got = quality_sample(record, prior, *args, min_rows=65).collect()
    picked = [r.po_number for r in got]
    assert not set(picked) & set(range(0, 60, 5))
    # teams 0 and 1 have 60 rows, team 2 has 70: ceil(10 % of the free rows of 0 and 1), one customer pick, three creator picks
    free = sum(1 for r in lines if r[3] in (0, 1) and r[0] % 5)
    assert len(picked) == -(-free // 10) + 1 + 3
    assert {r.q_type for r in got} == {"team"} and {r.status_id for r in got} == {1}
    once = quality_sample(record, prior, *args, min_rows=65, unique_po=True)
    assert once.count() == once.select("po_number").distinct().count()


def test_scope_uses_spillover_before_received_year(spark):
    data = [
        (1, 1, date(1990, 1, 1), None), (2, 4, date(1997, 10, 1), None), (3, 4, date(1997, 9, 30), None), (4, 4, date(1990, 1, 1), "1998 "),
        (5, 4, date(1998, 1, 1), "1997"), (6, 6, date(1998, 1, 1), " "), (7, None, date(1998, 1, 1), None), (8, 5, None, None),
    ]
    df = spark.createDataFrame(data, "id int, status_id int, input_received date, spillover_fy_calculated string")
    assert [r.id for r in current_fy_scope(df, date(1998, 3, 10)).orderBy("id").collect()] == [1, 2, 4, 6]


def test_quality_sample_reads_its_record_once(spark):
    rows = [(p, t, f"o{i}", "c", i % 3, str(i % 2), i) for i, (p, t) in enumerate([("1", 1), ("1", 2), ("2", 1), ("1", None)] * 12)]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    plain = spark.createDataFrame(
        rows, "period string, team_id int, po_number string, category_id string, customer_id int, po_created_by string, line int"
    )
    prior = plain.filter("line = 0").select("po_number")
    args = ("1", "s", datetime(1998, 4, 1), 9, ["po_number", "line"], 13)
    got = quality_sample(plain.mapInPandas(counted, plain.schema), prior, *args)
    assert sorted(r.po_number for r in got.collect()) == sorted(r.po_number for r in quality_sample(plain, prior, *args).collect())
    assert seen.value == len(rows)
