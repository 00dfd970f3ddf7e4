"""Life-cycle folds against a row-by-row replay; joins with a hot key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from retailflow.operators import aggregates, joins, lifecycle
from retailflow.operators.snapshots import StateSnapshots
from tests.conftest import rows

ORDERS = (
    "order_id int, customer_id int, order_status string, order_purchase_timestamp timestamp_ntz, "
    "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
    "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
)
BASE = dt.datetime(2017, 1, 1)


def hours(n):
    return None if n is None else BASE + dt.timedelta(hours=n)


def random_orders(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        times = [rng.choice([None, *range(8)]) for _ in range(5)]
        out.append((i, i * 10, rng.choice(["delivered", "canceled"]), *map(hours, times)))
    return out


def replay(orders, at):
    """Apply the events one by one to a table of rows."""
    stages = [(3, "created"), (4, "approved"), (5, "shipped"), (6, "delivered"), (7, None)]
    events = []
    for row in orders:
        if row[3] is None:
            continue
        for ordinal, (column, status) in enumerate(stages):
            if row[column] is not None and row[column] <= at:
                events.append((row[column], ordinal, row, status or row[2]))
    table = {}
    for when, ordinal, row, status in sorted(events, key=lambda e: e[:2]):
        if ordinal == 0:
            table.setdefault(row[0], [row[0], row[1], "created", when, None, None, None, row[7]])
        elif row[0] in table:
            state = table[row[0]]
            state[2] = status
            if ordinal < 4:
                state[3 + ordinal] = when
    return sorted(tuple(v) for v in table.values())


@pytest.mark.parametrize("hour", [0, 3, 5, 9])
def test_state_equals_replay(spark, hour):
    data = random_orders(150, seed=hour)
    orders = spark.createDataFrame(data, ORDERS)
    want = replay(data, hours(hour))
    at = str(hours(hour))
    assert sorted(tuple(r) for r in lifecycle.state_as_of(lifecycle.to_events(orders), at).collect()) == want
    assert sorted(tuple(r) for r in lifecycle.order_state_at(orders, at).collect()) == want


def test_final_state_is_the_recorded_row(spark):
    data = [(1, 10, "delivered", *map(hours, (0, 1, 2, 3, 4)))]
    state = lifecycle.state_as_of(lifecycle.to_events(spark.createDataFrame(data, ORDERS)), "2018-01-01")
    assert [tuple(r) for r in state.collect()] == data


def test_ttl_counts_from_the_first_purchase_of_all_orders(spark):
    data = [(1, 1, "x", None, hours(5), None, None, None), (2, 1, "x", *map(hours, (24, 48, None, None, None)))]
    data.append((3, 1, "x", *map(hours, (0, None, None, None, None))))
    orders = spark.createDataFrame(data, ORDERS)
    events = lifecycle.to_events(orders)
    approved = events.filter("stage = 'approved'")
    origin = orders.selectExpr("order_purchase_timestamp AS purchased_timestamp")
    assert rows(lifecycle.with_ttl(approved, origin=origin), "order_id", "ttl") == [(2, pytest.approx(2.0))]
    ordered = lifecycle.with_ttl(events, sort_by=["order_id"]).select("ttl").collect()
    assert [r[0] for r in ordered] == sorted(r[0] for r in ordered)
    assert rows(lifecycle.stage_counts(events)) == [("approved", 1), ("purchased", 2)]


def test_review_state(spark):
    ddl = (
        "order_id string, review_id string, review_score int, review_comment_title string, review_comment_message string, "
        "review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz"
    )
    data = [
        ("o1", "r1", 5, "t", "m", hours(1), hours(3)),
        ("o2", "r2", 4, "t", "m", hours(5), hours(2)),  # answered before created
        ("o3", "r3", 3, "t", "m", hours(9), hours(10)),
    ]
    events = lifecycle.review_events(spark.createDataFrame(data, ddl))
    fields = ["review_id", "review_score", "review_answer_timestamp"]
    assert rows(lifecycle.review_state(events, str(hours(2))), *fields) == [("r1", None, None), ("r2", 4, hours(2))]
    assert rows(lifecycle.review_state(events, str(hours(6))), *fields) == [("r1", 5, hours(3)), ("r2", None, None)]


ITEM = "order_id int, item int"


def test_day_children(spark):
    orders = spark.createDataFrame([(1, hours(0)), (2, hours(1)), (3, hours(30))], "order_id int, order_purchase_timestamp timestamp_ntz")
    items = spark.createDataFrame([(1, 1), (1, 2), (3, 1), (9, 1)], ITEM)
    inner = [(1, 1), (1, 2)]
    assert rows(joins.day_children(orders, items, "2017-01-01")) == inner
    assert rows(joins.day_children(orders, items, "2017-01-01", keep_empty=True)) == [*inner, (None, None)]
    assert rows(joins.children_right(orders, items, "2017-01-01")) == [*inner, (None, None)]
    assert rows(joins.children_of_selected(orders, items, "2017-01-01")) == inner
    assert rows(joins.orders_without(orders, items), "order_id") == [(2,)]


def test_fan_out_equals_left_joins(spark):
    orders = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "order_id int, s string")
    # One order holds most of the items.
    items = spark.createDataFrame([(1, i) for i in range(200)] + [(3, 1), (None, 5), (9, 9)], ITEM)
    payments = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "order_id int, p string")
    want = orders.join(items, "order_id", "left").join(payments, "order_id", "left")
    got = joins.order_fan_out(orders, items, payments)
    assert got.columns == want.columns and rows(got) == rows(want)
    for hot_rows in (0, 1, 100):
        split = joins.order_fan_out(orders, items, payments, hot_rows)
        assert split.columns == want.columns and rows(split) == rows(want)


def test_parent_time(spark):
    orders = spark.createDataFrame([(1, hours(0)), (2, None)], "order_id int, order_purchase_timestamp timestamp_ntz")
    items = spark.createDataFrame([(1, 1), (2, 1), (9, 1)], ITEM)
    assert rows(joins.with_parent_time(items, orders, "2017-01")) == [(1, 1, hours(0))]
    assert rows(joins.with_parent_time(items, orders, "2017-02")) == []


def test_key_probe_and_distinct_on(spark):
    df = spark.createDataFrame([(1, 3, "a"), (1, 2, "b"), (2, 1, "c")], "n int, v int, s string")
    assert rows(aggregates.key_probe(df, ["n"])) == [(3, 2, 1)]
    assert rows(aggregates.distinct_on(df, ["n"], ["v"])) == [(1, 2, "b"), (2, 1, "c")]
    assert rows(aggregates.key_probe(df.limit(0), ["n"])) == [(0, 0, 0)]


def test_heavy_ids_are_found_among_many(spark):
    heavy = "CASE WHEN id % 50 = 0 THEN 7 WHEN id % 200 = 1 THEN 11 WHEN id % 9 = 2 THEN NULL ELSE 1000 + id END"
    df = spark.range(0, 300_000, 1, 6).selectExpr(f"{heavy} AS i")
    assert sorted(joins.heavy_ids(df, "i", 1000)) == [7, 11]
    assert joins.heavy_ids(df, "i", 6000) == []
    assert joins.heavy_ids(df.limit(0), "i", 0) == []
    texts = df.selectExpr("CAST(i AS STRING) AS i")
    assert sorted(joins.heavy_ids(texts, "i", 1000)) == ["11", "7"]


def test_no_shuffle_of_ids_before_the_join(spark, capsys):
    parent, child = spark.range(100).toDF("order_id"), spark.range(1000).selectExpr("id % 90 AS order_id", "id AS v")
    joined = joins.left_join_spread(parent.hint("merge"), child)
    joined.explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 2  # one of each side


def test_sample_size(spark):
    df = spark.createDataFrame([(i, "x" if i % 2 else None) for i in range(50)], "i int, t string")
    picked = rows(aggregates.sample_rows(df, 5, "t", ["i"], seed=3))
    assert len(picked) == 5 and all(t == "x" for _, t in picked)
    assert rows(aggregates.sample_rows(df, 5, "t", ["i"], seed=4)) != picked


def test_sample_is_the_same_on_any_layout_and_mergeable(spark):
    df = spark.range(400).selectExpr("id AS i", "CASE WHEN id % 3 > 0 THEN CAST(id AS STRING) END AS t")
    one = rows(aggregates.sample_rows(df.repartition(1), 9, "t", ["i"], seed=3))
    assert one == rows(aggregates.sample_rows(df.repartition(7, "t").sort(F.desc("i")), 9, "t", ["i"], seed=3))
    parts = [aggregates.sample_rows(df.filter(f"i % 4 = {n}"), 9, "t", ["i"], seed=3) for n in range(4)]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    assert rows(aggregates.sample_rows(union, 9, "t", ["i"], seed=3)) == one


def test_distinct_on_takes_nulls_last(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (2, None, "c")], "n int, v int, s string")
    assert rows(aggregates.distinct_on(df, ["n"], ["v"])) == [(1, 2, "b"), (2, None, "c")]


def spread_events(spark, n=120):
    """Events of random orders, their hours dealt over two years."""
    orders = spark.createDataFrame(random_orders(n, 11), ORDERS)
    events = lifecycle.to_events(orders)
    wide = F.expr("timestamp + make_dt_interval(90 * hour(timestamp) + order_id % 5)")
    return events.withColumn("timestamp", wide)


def test_snapshots_equal_the_whole_log(spark, tmp_path):
    events = spread_events(spark)
    table = StateSnapshots(spark, str(tmp_path / "s"), every=3)
    late = F.col("order_id") % 3 == 0
    first = table.append(events.filter(~late))
    assert first == table.snapshots() and len(first) >= 5
    again = table.append(events.filter(late | (F.col("stage") == "approved")))
    assert again == table.snapshots() == first
    for at in ("2016-12-31", "2017-01-01 03:00:00", "2017-04-01", "2017-09-30 23:59:59", "2018-02-11 07:00:00", "2100-01-01"):
        assert rows(table.as_of(at)) == rows(lifecycle.state_as_of(events, at)), at
    assert table.append(events.limit(0)) == [] and table.refresh() == []


def test_snapshot_reads_the_tail_only(spark, tmp_path):
    table = StateSnapshots(spark, str(tmp_path / "s"), every=6)
    table.append(spread_events(spark))
    assert len(table.months()) > 6
    files = table.as_of("2018-03-05").inputFiles()
    months = {int(f.split("month=")[1].split("/")[0]) for f in files if "month=" in f}
    assert months and months <= {0, 201801, 201802, 201803}
    assert any("/snapshots/201712/" in f for f in files)


def test_snapshots_come_from_one_pass(spark, tmp_path):
    """All due snapshots are folds of the log, orders without a new event and without an id too, and the log is read once."""
    events = spread_events(spark).withColumn("order_id", F.expr("CASE WHEN order_id % 11 <> 5 THEN order_id END"))
    table = StateSnapshots(spark, str(tmp_path / "s"), every=3)
    read = []
    parts = table._parts
    table._parts = lambda *asked: read.append(asked) or parts(*asked)
    table.append(events.filter("stage <> 'approved'"))
    table.append(events.filter("stage = 'approved' AND timestamp >= '2017-08-01'"))
    table.append(events.filter("stage = 'approved'"))
    assert len(table.snapshots()) >= 5 and len(read) == 3
    for end in table.snapshots():
        year, month = divmod(end, 100)
        until = dt.datetime(year + month // 12, month % 12 + 1, 1)
        want = lifecycle.fold_events(events.filter(F.col("timestamp") < F.lit(until)))
        got = spark.read.parquet(str(tmp_path / "s" / "snapshots" / str(end)))
        assert got.dtypes == want.dtypes and rows(got) == rows(want), end
    assert not [p for p in (tmp_path / "s").rglob("_staged*")]


def test_snapshots_after_a_load_that_stopped(spark, tmp_path):
    """Snapshots are missing, the log is whole: reads are right, and the next load takes them."""
    events = spread_events(spark, 40)
    table = StateSnapshots(spark, str(tmp_path / "s"), every=12)
    table.refresh = lambda: []
    table.append(events)
    assert table.snapshots() == []
    assert rows(table.as_of("2018-03-05")) == rows(lifecycle.state_as_of(events, "2018-03-05"))
    again = StateSnapshots(spark, str(tmp_path / "s"), every=12)
    assert again.refresh() == [201712]
    assert rows(again.as_of("2018-03-05")) == rows(lifecycle.state_as_of(events, "2018-03-05"))
    with pytest.raises(ValueError):
        StateSnapshots(spark, str(tmp_path / "t"), every=5)
    empty = StateSnapshots(spark, str(tmp_path / "t"))
    assert empty.append(events.limit(0)) == [] and empty.as_of("2018-03-05").count() == 0
