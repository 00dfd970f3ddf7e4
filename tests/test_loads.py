"""Files, tables, day loads, database statements and the command line."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from retailflow import session
from retailflow.model import FACTS, ORDER_REVIEWS_DDL, ORDERS_DDL
from retailflow.operators.layout import bucketed
from retailflow.operators import merge as merge_module
from retailflow.operators.merge import MergeConflict
from retailflow.plans import bi, lake as lakes
from retailflow.quality.checks import CheckFailed
from retailflow.sinks import jdbc as jdbc_sink, keyindex, landing
from retailflow.sinks import tables as tables_module
from retailflow.sinks.keyindex import open_index
from retailflow.sinks.landing import write_csv, write_landing
from retailflow.sinks.tables import (
    clear_target,
    create_table,
    create_table_ddl,
    merge_into_path,
    path_exists,
    refresh_table,
    replicate,
)
from retailflow.sources import files, jdbc, tables
from tests.conftest import rows

D1, D2 = "2017-01-01", "2017-01-02"


def at(day, hour=0):
    return dt.datetime.fromisoformat(day) + dt.timedelta(hours=hour)


def order(i, day, status="created", approved=None):
    return (i, f"c{i}", status, at(day, 1), approved, None, None, at(day, 700))


def make_tables(spark, orders, items=(), payments=(), reviews=()):
    return {
        "orders": spark.createDataFrame(list(orders), ORDERS_DDL),
        "order_items": spark.createDataFrame(
            list(items), FACTS["order_items"].ddl.replace("decimal(10,2)", "double")
        ),
        "order_payments": spark.createDataFrame(
            list(payments), FACTS["order_payments"].ddl.replace("decimal(10,2)", "double")
        ),
        "order_reviews": spark.createDataFrame(list(reviews), ORDER_REVIEWS_DDL),
    }


def run_day(spark, tabs, lake, name, day):
    lakes.extract_day(tabs, name, day, lake.root)
    return lakes.lakehouse_day(spark, lake, name, day)


def test_orders_day_by_day(spark, tmp_path):
    lake = lakes.Lake(str(tmp_path))
    tabs = make_tables(spark, [order("a", D1), order("b", D1), order("c", D2)])
    assert lakes.warehouse_day(spark, lake, "orders", D1) is False
    for day in (D1, D2, D1):
        assert run_day(spark, tabs, lake, "orders", day)
    table = spark.read.parquet(lake.table("orders"))
    assert rows(table, "order_id", "year", "month", "day") == [("a", 2017, 1, 1), ("b", 2017, 1, 1), ("c", 2017, 1, 2)]

    # A known order changes: status is updated, the customer is not; the other day stays.
    changed = make_tables(spark, [(*order("a", D1, "approved", at(D1, 5))[:1], "other", *order("a", D1, "approved", at(D1, 5))[2:])])
    run_day(spark, changed, lake, "orders", D1)
    table = spark.read.parquet(lake.table("orders"))
    assert rows(table, "order_id", "customer_id", "order_status") == [
        ("a", "ca", "approved"), ("b", "cb", "created"), ("c", "cc", "created"),
    ]
    assert run_day(spark, tabs, lake, "orders", "2017-01-09") == 0
    assert rows(lakes.post_check(spark, lake, "orders")) == [("orders", "Error", True, 0)]

    assert lakes.warehouse_day(spark, lake, "orders", D1)
    assert lakes.warehouse_day(spark, lake, "orders", D1)
    assert lakes.warehouse_day(spark, lake, "orders", "2017-01-09") is False
    assert spark.read.parquet(lake.warehouse("orders")).count() == 2


def test_failed_check_stops_the_load(spark, tmp_path):
    lake = lakes.Lake(str(tmp_path))
    tabs = make_tables(spark, [order("a", D1), order("a", D1), order("b", D1, "lost")])
    lakes.extract_day(tabs, "orders", D1, lake.root)
    with pytest.raises(CheckFailed, match="Uniqueness"):
        lakes.lakehouse_day(spark, lake, "orders", D1)
    with pytest.raises(Exception):
        spark.read.parquet(lake.table("orders"))
    assert spark.read.json(lake.metrics).filter("constraint_status = 'Failure'").count() == 2


def test_cursor_moves_only_after_success(spark, tmp_path):
    lake = lakes.Lake(str(tmp_path))
    assert lakes.read_cursor(spark, lake, "orders") == D1
    with pytest.raises(RuntimeError):
        lakes.run_next_day(spark, lake, "orders", lambda day: (_ for _ in ()).throw(RuntimeError(day)))
    assert lakes.read_cursor(spark, lake, "orders") == D1
    seen = []
    for _ in range(3):
        lakes.run_next_day(spark, lake, "orders", seen.append)
    assert seen == [D1, D2, "2017-01-03"] and lakes.read_cursor(spark, lake, "orders") == "2017-01-04"


def test_children_follow_the_day_of_their_order(spark, tmp_path):
    lake = lakes.Lake(str(tmp_path))
    items = [("a", 1, "p", "s", at(D2, 50), 10.5, 1.0), ("c", 1, "p", "s", at(D1), 3.0, 1.0)]
    payments = [("a", 1, "boleto", 1, 10.5), ("b", 1, "voucher", 2, 1.0), ("c", 1, "boleto", 1, 3.0)]
    tabs = make_tables(spark, [order("a", D1), order("b", D1), order("c", D2)], items, payments)
    assert rows(lakes.extract_days(tabs, "order_items", D1, D2), "order_id") == [("a",)]
    assert rows(lakes.extract_days(tabs, "order_items", D1, D2, keep_empty=True), "order_id") == [("a",), (None,)]
    for day in (D1, D2, D1):
        run_day(spark, tabs, lake, "order_items", day)
    assert rows(spark.read.parquet(lake.table("order_items")), "order_id", "price", "day") == [
        ("a", pytest.approx(10.5), 1), ("c", pytest.approx(3.0), 2),
    ]
    with pytest.raises(ValueError):
        lakes.extract_day(tabs, "order_items", D2, lake.root, lookback_days=1)
    assert lakes.backfill(tabs, lake, "order_payments", D1, "2017-01-03") == 3
    assert lakes.backfill(tabs, lake, "order_payments", D1, "2017-01-03")
    assert rows(spark.read.parquet(lake.table("order_payments")), "order_id", "day") == [("a", 1), ("b", 1), ("c", 2)]


def test_reviews_with_line_breaks_and_bad_rows(spark, tmp_path):
    lake = lakes.Lake(str(tmp_path))
    good = ("a", "r" * 32, at(D2), 'line one\nline "two", ok', "", at(D1, 3), 5)
    reviews = [good, ("b", "short", at(D2), "m", "t", at(D1), 5), ("c", "q" * 32, at(D2), "m", "t", at(D1), None)]
    tabs = make_tables(spark, [], reviews=reviews)
    assert run_day(spark, tabs, lake, "order_reviews", D1)
    table = spark.read.parquet(lake.table("order_reviews"))
    assert rows(table, "order_id", "review_comment_message", "review_comment_title") == [("a", good[3], "")]


def test_landing_columns_bind_by_name(spark, tmp_path):
    df = spark.createDataFrame([("x", 1, None)], "b string, a int, c string")
    write_csv(df, str(tmp_path / "t"))
    assert rows(files.read_csv_table(spark, str(tmp_path / "t"), "a int, b string, c string, d int")) == [(1, "x", None, None)]
    texts = [(1, None, "x"), (2, "", "x"), (3, '  "a",\\ \n\r\n\tb ', "x"), (4, "\\", "x"), (5, '"', "x"), (6, "#", "x")]
    write_csv(spark.createDataFrame(texts, "id int, t string, u string"), str(tmp_path / "u"))
    assert rows(files.read_csv_table(spark, str(tmp_path / "u"), "id int, t string, u string")) == texts
    assert files.landing_path("/r", "orders", " 2017-01-01 ") == "/r/landing/orders/orders.2017-01-01.csv"


def test_files_with_different_headers(spark, tmp_path):
    path = tmp_path / "t"
    path.mkdir()
    (path / "1.csv").write_text("a,b\n1,x\n")
    (path / "2.csv").write_text('"b",a\ny,2\n')
    (path / "3.csv").write_text("b\nz\n")
    (path / "4 5.csv").write_text("c,a,b\nc,4,w\n")
    (path / "6.csv").write_text("")
    want = [(1, "x"), (2, "y"), (4, "w"), (None, "z")]
    for multiline in (True, False):
        assert rows(files.read_csv_table(spark, str(path), "a int, b string", multiline=multiline)) == want
    stack = files.read_text_stack(spark, str(path))
    assert rows(stack, "a", "b", "c") == [("1", "x", None), ("2", "y", None), ("4", "w", "c"), (None, "z", None)]


def test_files_of_line_spanning_records_are_cut(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "WHOLE_FILE_BYTES", 20_000)
    df = spark.range(0, 500, 1, 1).selectExpr("CAST(id AS STRING) AS k", "repeat('a\nb', 100) AS t")
    write_csv(df, str(tmp_path / "t"), line_breaks=True)
    written = list((tmp_path / "t").glob("*.csv"))
    assert len(written) > 5 and max(p.stat().st_size for p in written) < 40_000
    assert files.read_csv_table(spark, str(tmp_path / "t"), "k string, t string").distinct().count() == 500


def test_csv_forms(spark, tmp_path):
    path = str(tmp_path / "t")
    write_csv(spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string"), path)
    assert files.read_csv_table(spark, path).dtypes == [("id", "string"), ("s", "string")]
    assert files.read_csv_table(spark, path, infer=True).dtypes == [("id", "int"), ("s", "string")]
    assert files.read_csv_table(spark, path, header=False).columns == ["_c0", "_c1"]
    assert files.read_text_stack(spark, [path, path]).count() == 4
    assert rows(files.crawl_schema(spark, path)) == [(0, "id", "int"), (1, "s", "string")]
    ddl = files.crawl_ddl(spark, path, "crawled")
    assert "`id` int" in ddl and path in ddl
    assert rows(files.sequence_source(spark, 3), "id") == [(1,), (2,), (3,)]


def test_merge_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, day int")
    merge_into_path(first, path, ["k"], "*", ["day"])
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t" / "day=2").iterdir()}
    merge_into_path(spark.createDataFrame([(1, "z", 1), (3, "c", 1)], "k int, v string, day int"), path, ["k"], "*", ["day"])
    assert rows(spark.read.parquet(path), "k", "v", "day") == [(1, "z", 1), (2, "b", 2), (3, "c", 1)]
    assert before == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t" / "day=2").iterdir()}
    twice = spark.createDataFrame([(1, "x", 1), (1, "y", 1)], "k int, v string, day int")
    with pytest.raises(MergeConflict):
        merge_into_path(twice, path, ["k"], "*", ["day"])
    assert rows(spark.read.parquet(path), "k") == [(1,), (2,), (3,)]


PARTS = "k string, v string, year int, day int"


def table_rows(spark, path):
    return rows(spark.read.parquet(path), "k", "v", "year", "day")


@pytest.mark.parametrize("small", [True, False])
def test_merge_moves_rows_between_partitions(spark, tmp_path, monkeypatch, small):
    if not small:
        monkeypatch.setattr(session, "BROADCAST_ROWS", -1)
        monkeypatch.setattr(merge_module, "BROADCAST_ROWS", -1)
    path = str(tmp_path / "t")
    start = [("a", "old", 1, 1), ("b", "old", 1, 1), ("c", "old", 1, 2), ("d", "old", None, 3), ("e", "old", 2, 5)]
    merge_into_path(spark.createDataFrame(start, PARTS), path, ["k"], "*", ["year", "day"])
    kept = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t" / "year=2" / "day=5").iterdir()}
    # a moves to a new partition, c leaves its partition empty, d leaves the null partition, z enters it.
    batch = [("a", "new", 1, 9), ("c", "new", 1, 1), ("d", "new", 1, 3), ("z", "new", None, 3)]
    merge_into_path(spark.createDataFrame(batch, PARTS), path, ["k"], "*", ["year", "day"])
    want = [("a", "new", 1, 9), ("b", "old", 1, 1), ("c", "new", 1, 1), ("d", "new", 1, 3), ("e", "old", 2, 5), ("z", "new", None, 3)]
    assert table_rows(spark, path) == want
    assert not (tmp_path / "t" / "year=1" / "day=2").exists()
    assert kept == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t" / "year=2" / "day=5").iterdir()}
    # Only the value is updated: rows stay where they are.
    back = [("a", "third", 1, 1), ("z", "third", 7, 7)]
    merge_into_path(spark.createDataFrame(back, PARTS), path, ["k"], ["v"], ["year", "day"])
    assert table_rows(spark, path)[0] == ("a", "third", 1, 9) and table_rows(spark, path)[-1] == ("z", "third", None, 3)
    merge_into_path(spark.createDataFrame([("y", "x", None, 3)], PARTS), path, ["k"], "*", ["year", "day"], keys_stay=True)
    assert {r[0] for r in table_rows(spark, path)} == set("abcdeyz")
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith("_") and p.name != "_SUCCESS"]


def index_pairs(spark, path):
    index = open_index(spark, path, ["k"], ["year", "day"])
    return rows(index.entries()), rows(index.pairs(spark.read.parquet(path)))


def test_key_index_follows_every_merge(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyindex, "FOLD_LOADS", 1000)
    path, parts = str(tmp_path / "t"), ["year", "day"]
    rng = random.Random(3)
    model = {}
    for load in range(7):
        names = rng.sample("abcdefghijklmnop", 6)
        batch = {k: (f"v{load}", rng.choice([1, 2, None]), rng.randint(1, 4)) for k in names}
        loose = [(None, f"loose{load}", 1, 1)]
        columns = "*" if load % 3 else ["v"]
        frame = spark.createDataFrame([(k, *v) for k, v in batch.items()] + loose, PARTS)
        merge_into_path(frame, path, ["k"], columns, parts, index_buckets=3)
        for k, v in batch.items():
            model[k] = v if columns == "*" or k not in model else (v[0], *model[k][1:])
        have, want = index_pairs(spark, path)
        assert have == want
        assert {r[0]: r[1:] for r in table_rows(spark, path) if r[0]} == model
    index = open_index(spark, path, ["k"], parts)
    assert len(index.folders.names(index.root)) > 4 and not index.fold(1000)
    assert index.fold(2) and len(index.folders.names(index.root)) == 1
    assert index_pairs(spark, path)[0] == index_pairs(spark, path)[1]
    assert {p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("_")} <= {"_keys", "_SUCCESS"}


def test_key_index_survives_a_stop_before_the_swap(spark, tmp_path, monkeypatch):
    path, parts = str(tmp_path / "t"), ["year", "day"]
    merge_into_path(spark.createDataFrame([("a", "old", 1, 1), ("b", "old", 1, 2)], PARTS), path, ["k"], "*", parts, index_buckets=2)
    batch = spark.createDataFrame([("a", "new", 5, 5)], PARTS)
    with monkeypatch.context() as m:
        m.setattr(tables_module, "replace_partitions", lambda *_: 1 // 0)
        with pytest.raises(ZeroDivisionError):
            merge_into_path(batch, path, ["k"], "*", parts)
    assert table_rows(spark, path) == [("a", "old", 1, 1), ("b", "old", 1, 2)]
    merge_into_path(batch, path, ["k"], "*", parts)
    assert table_rows(spark, path) == [("a", "new", 5, 5), ("b", "old", 1, 2)]
    have, want = index_pairs(spark, path)
    assert set(want) <= set(have)


def test_merge_reads_the_files_of_touched_partitions_only(spark, tmp_path, monkeypatch):
    path, parts = str(tmp_path / "t"), ["year", "day"]
    first = spark.range(240).selectExpr("CAST(id AS STRING) AS k", "'a' AS v", "CAST(id % 12 AS INT) AS year", "CAST(id % 4 AS INT) AS day")
    merge_into_path(first, path, ["k"], "*", parts, index_buckets=4)
    read = []
    monkeypatch.setattr(tables_module, "merge", lambda t, *a: read.append(t.inputFiles()) or merge_module.merge(t, *a))
    batch = spark.createDataFrame([("1", "b", 11, 3), ("240", "b", 0, 0)], PARTS)
    merge_into_path(batch, path, ["k"], "*", parts)
    assert {"/".join(f.split("/")[-3:-1]) for f in read[0]} == {"year=0/day=0", "year=1/day=1", "year=11/day=3"}
    index = open_index(spark, path, ["k"], parts)
    plan = index.look_up(index.wanted(batch))._jdf.queryExecution().executedPlan().toString()
    wanted = sorted({r["__bucket"] for r in index.wanted(batch).collect()})
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)[1]
    assert len(wanted) <= 2 and [int(n) for n in re.findall(r"\d+", filters.split("bucket", 1)[1].split("#", 1)[1])[1:]] == wanted
    assert index_pairs(spark, path)[0] == index_pairs(spark, path)[1]


def test_merge_of_no_rows_keeps_the_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    nothing = spark.createDataFrame([], PARTS)
    assert merge_into_path(nothing, path, ["k"], "*", ["year", "day"], index_buckets=2) == 0
    assert spark.read.parquet(path).dtypes == nothing.dtypes
    merge_into_path(spark.createDataFrame([("a", "x", 1, 1)], PARTS), path, ["k"], "*", ["year", "day"], index_buckets=2)
    assert merge_into_path(nothing, path, ["k"], "*", ["year", "day"]) == 0
    assert table_rows(spark, path) == [("a", "x", 1, 1)]


def test_merge_into_very_many_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.range(300).selectExpr("CAST(id AS STRING) AS k", "'a' AS v", "1 AS year", "CAST(id AS INT) AS day")
    merge_into_path(first, path, ["k"], "*", ["year", "day"])
    second = spark.range(150, 450).selectExpr("CAST(id AS STRING) AS k", "'b' AS v", "1 AS year", "CAST(id AS INT) AS day")
    merge_into_path(second, path, ["k"], "*", ["year", "day"])
    got = spark.read.parquet(path).groupBy("v").count()
    assert rows(got) == [("a", 150), ("b", 300)]


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    fail = F.udf(lambda v: 1 // 0, "string")
    path, dim = str(tmp_path / "t"), str(tmp_path / "d")
    merge_into_path(spark.createDataFrame([("a", "old", 1, 1)], PARTS), path, ["k"], "*", ["year", "day"])
    bad = spark.createDataFrame([("a", "new", 1, 1)], PARTS).withColumn("v", fail("v"))
    with pytest.raises(Exception):
        merge_into_path(bad, path, ["k"], "*", ["year", "day"])
    assert table_rows(spark, path) == [("a", "old", 1, 1)]
    assert [p.name for p in (tmp_path / "t").iterdir() if p.is_dir()] == ["year=1"]
    refresh_table(spark.createDataFrame([("a",)], "v string"), dim)
    with pytest.raises(Exception):
        refresh_table(spark.createDataFrame([("b",)], "v string").withColumn("v", fail("v")), dim)
    assert rows(spark.read.parquet(dim)) == [("a",)]


def test_a_day_is_written_by_many_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        day = spark.range(0, 60000, 1, 8).selectExpr("sha2(CAST(id AS STRING), 256) AS k", "'a' AS v", "1 AS year", "1 AS day")
        merge_into_path(day, str(tmp_path / "t"), ["k"], "*", ["year", "day"])
        files_written = list((tmp_path / "t" / "year=1" / "day=1").glob("*.parquet"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files_written) > 4


def test_only_a_missing_path_is_no_table(spark, tmp_path):
    assert not path_exists(spark, str(tmp_path / "none"))
    (tmp_path / "empty").mkdir()
    assert not path_exists(spark, str(tmp_path / "empty"))
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        path_exists(spark, str(tmp_path / "broken"))


def test_broadcasts_are_measured_without_a_limit(spark):
    df = spark.range(100)
    seen = df.agg(F.count(F.lit(1)), F.sum(session.row_bytes(df)))
    assert "Limit" not in seen._jdf.queryExecution().executedPlan().toString()
    assert session.fits_broadcast(df.limit(0))


def test_scratch_is_cleared(spark, tmp_path):
    path, name = session.scratch_path(spark, "gone"), session.scratch_name(spark, "gone")
    spark.range(3).write.parquet(path)
    spark.range(3).createOrReplaceTempView(name)
    kept = session._scratch[spark.sparkContext.applicationId], session._names[spark.sparkContext.applicationId]
    mine = ([path], [name])
    for bag, own in zip((session._scratch, session._names), mine):
        bag[spark.sparkContext.applicationId] = own
    assert session.clear_scratch(spark) == 2
    for bag, old in zip((session._scratch, session._names), kept):
        bag[spark.sparkContext.applicationId] = old
    assert not path_exists(spark, path) and not spark.catalog.tableExists(name)


def test_table_helpers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    path = str(tmp_path / "t1")
    assert create_table(df, "t1", ["k"], path=path)
    assert not create_table(df, "t1")
    with pytest.raises(ValueError):
        create_table(df, "t1", if_absent=False)
    assert rows(tables.describe_table(spark, "t1")) == [("k", "int"), ("v", "string")]
    assert "t1" in tables.list_tables(spark, like="t%")
    assert tables.read_table_or_empty(spark, "nope", "k int").columns == ["k"]
    spark.sql(create_table_ddl("t2", {"k": "int", "day": "int"}, ["k"], ["day"], {"x": "y"}) + f" LOCATION '{tmp_path}/t2'")
    assert "t2" in tables.list_tables(spark)
    spark.sql("CREATE TABLE t3 (k INT) USING parquet")
    spark.sql("INSERT INTO t3 VALUES (1)")
    clear_target(spark, "t3", "delete")
    assert spark.table("t3").count() == 0
    clear_target(spark, "t1", "delete")
    assert spark.table("t1").count() == 0
    for name in ("t1", "t2", "t3"):
        clear_target(spark, name, "drop")
        assert not spark.catalog.tableExists(name)
    with pytest.raises(ValueError):
        clear_target(spark, "t1", "burn")


def test_refresh_skips_an_empty_source(spark, tmp_path):
    path = str(tmp_path / "dim")
    df = spark.createDataFrame([(1,), (2,)], "k int")
    assert refresh_table(df, path) and not refresh_table(df.limit(0), path)
    assert refresh_table(df.filter("k = 1"), path)
    assert rows(spark.read.parquet(path)) == [(1,)]
    lake = lakes.Lake(str(tmp_path / "lake"))
    assert lakes.refresh_dimension(df, lake, "sellers")
    assert spark.read.parquet(lake.warehouse("sellers")).count() == 2


def test_replicate_logs_a_bad_table_and_goes_on(spark):
    copied = []

    def read(name):
        if name == "public.bad":
            raise IOError("broken")
        return spark.range(3)

    done = replicate(read, ["public.a", "public.bad", "public.b", "other.c"], lambda df, t: copied.append(t), "public.%")
    assert done == {"public.a": "ok", "public.bad": "OSError: broken", "public.b": "ok"}
    assert sorted(copied) == ["public.a", "public.b"]
    with pytest.raises(IOError):
        replicate(read, ["public.bad"], lambda df, t: None, stop_on_error=True)


def test_bucketed_join_has_no_exchange(spark, tmp_path):
    a = bucketed(spark.range(100).withColumnRenamed("id", "k"), "buck_a", "k", 4, str(tmp_path / "a"))
    b = bucketed(spark.range(50).withColumnRenamed("id", "k"), "buck_b", "k", 4, str(tmp_path / "b"))
    joined = a.hint("merge").join(b, "k")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 50


def test_jdbc_options():
    plain = jdbc.jdbc_options("jdbc:x", "orders", {"user": "u"})
    assert plain["dbtable"] == "orders" and plain["prepareThreshold"] == "0" and plain["user"] == "u"
    query = jdbc.jdbc_options("jdbc:x", "SELECT 1;", {}, ("id", 0, 100, 8))
    assert query["dbtable"] == "(SELECT 1) AS t" and query["numPartitions"] == "8" and query["upperBound"] == "100"
    assert ">= TIMESTAMP '2017-01-01'" in jdbc.day_query("orders", "ts", D1, D2)
    assert "LEFT JOIN" in jdbc.day_children_query("order_items", "orders", "ts", D1, D2, keep_empty=True)


def test_staged_merge_statements(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    calls, executed = [], []

    def write(frame, url, table, mode, properties):
        calls.append((frame.count(), table, mode))

    names = set()
    for _ in range(2):
        statements = jdbc_sink.staged_merge(df, "jdbc:x", "orders", ["k"], {}, executed.append, write=write)
        names.add(statements[1].removeprefix("DROP TABLE "))
    assert len(names) == 2 and executed[-1] == statements
    assert calls[0] == (0, "orders", "ignore") and calls[1][0] == 1 and calls[1][2] == "overwrite"
    assert statements[0].startswith("MERGE INTO orders t") and '"v" = s."v"' in statements[0]
    with pytest.raises(ValueError):
        jdbc_sink.write_jdbc(df, "jdbc:x", "t", "upsert", {})


def test_command_line(spark, tmp_path):
    from retailflow.plans import cli

    root = str(tmp_path)
    tabs = make_tables(spark, [order("a", D1)])
    lakes.extract_day(tabs, "orders", D1, root)
    day = ["--table-name", "orders", "--date-cursor", D1, "--root", root]
    assert cli.run(spark, ["lakehouse", *day, "--test"]) == 0
    assert cli.run(spark, ["lakehouse", *day, "--test", "--ingest", "--profile"]) == 1
    assert cli.run(spark, ["warehouse", *day, "--ingest"]) == 1
    assert spark.read.parquet(f"{root}/warehouse/orders").count() == 1
    assert spark.read.json(f"{root}/metrics").select("task").distinct().count() == 2
    spark.createDataFrame([("s1",)], "seller_id string").write.parquet(f"{root}/lakehouse/sellers")
    assert cli.run(spark, ["warehouse", "--table-name", "sellers", "--root", root, "--ingest"]) == 1
    with pytest.raises(SystemExit):
        cli.run(spark, ["lakehouse", "--table-name", "nope", "--root", root])


def test_transaction_rolls_back():
    log = []

    class Connection:
        def cursor(self):
            return self

        def execute(self, statement):
            log.append(statement)
            if statement == "bad":
                raise ValueError(statement)

        def commit(self):
            log.append("commit")

        def rollback(self):
            log.append("rollback")

        def close(self):
            log.append("close")

    jdbc_sink.transaction(Connection)(["a", "b"])
    with pytest.raises(ValueError):
        jdbc_sink.transaction(Connection)(["a", "bad"])
    assert log == ["a", "b", "commit", "close", "a", "bad", "rollback", "close"]


def test_bi_range_and_dashboard(spark, tmp_path):
    tabs = make_tables(spark, [order("a", "2016-12-31"), order("b", D1), order("c", "2018-08-31")])
    tabs["geolocation"] = spark.createDataFrame([("são paulo",)], "geolocation_city string")
    built = bi.build_bi_tables(tabs)
    assert rows(built["orders"], "order_id") == [("b",)]
    root = str(tmp_path)
    for _ in range(2):
        lakes.full_load(built, lambda name: f"{root}/{name}")
    assert spark.read.parquet(f"{root}/orders").count() == 1
    boards = bi.dashboard(built)
    assert rows(boards["orders_by_month"]) == [("2017-01", 1)]
    assert rows(boards["order_status"]) == [("1-created", 1)]
    assert rows(boards["cities"]) == [("Sao Paulo", 1)]


def test_translate_month(spark, tmp_path):
    reviews = spark.createDataFrame(
        [("a", "r1", at(D2), "oi", None, at(D1), 5), ("b", "r2", at(D2), "x", "y", at("2017-03-01"), 5)], ORDER_REVIEWS_DDL
    )
    path = str(tmp_path / "t")
    assert bi.translate_month(reviews, "2017-01", path, translate=lambda ts: [t.upper() for t in ts]) == 1
    assert rows(files.read_csv_table(spark, path), "review_comment_message", "review_comment_title") == [("<2EN> OI", None)]


def test_scratch_and_broadcast_bounds(spark):
    root = session.scratch_root(spark)
    assert session.scratch_root(spark) == root and session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
    df = spark.range(100).withColumn("t", F.repeat(F.lit("x"), 100))
    assert session.fits_broadcast(df)
    assert not session.fits_broadcast(df, max_rows=99)
    assert not session.fits_broadcast(df, max_bytes=1000)
    assert session.widen(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_write_landing_replaces_a_day(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "k int")
    for _ in range(2):
        path = write_landing(df, str(tmp_path), "t", D1)
    assert files.read_csv_table(spark, path).count() == 1


def broken_files(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('k,v,t\n1,a,2017-01-01 00:00:00\n2,b\n3,c,2017-01-01 00:00:00,9\nx,"d, e",never\n4,"",\n')
    (tmp_path / "in" / "b.csv").write_text("v,k\nf,5\ng,5.5\n")
    (tmp_path / "in" / "c.csv").write_text("k,v,t\n")
    return str(tmp_path / "in"), "k int, v string, t timestamp_ntz"


def test_rejected_records(spark, tmp_path):
    path, ddl = broken_files(tmp_path)
    good, rejects = files.read_csv_checked(spark, path, ddl, multiline=False)
    assert rows(good, "k", "v") == [(1, "a"), (4, ""), (5, "f")]
    found = {(r["file"].rsplit("/", 1)[1], r["reason"], r["record"]) for r in rejects.collect()}
    assert found == {
        ("a.csv", "fields", "2,b"),
        ("a.csv", "fields", "3,c,2017-01-01 00:00:00,9"),
        ("a.csv", "type: k, t", 'x,"d, e",never'),
        ("b.csv", "type: k", "g,5.5"),
    }
    kept, again = files.read_csv_checked(spark, path, ddl, policy="null", multiline=False)
    assert again.count() == 4
    assert sorted((r["k"] or 0, r["v"]) for r in kept.collect()) == [(0, "d, e"), (0, "g"), (1, "a"), (2, "b"), (3, "c"), (4, ""), (5, "f")]
    strict, _ = files.read_csv_checked(spark, path, ddl, policy="raise", multiline=False)
    with pytest.raises(Exception, match="malformed record"):
        strict.collect()
    with pytest.raises(ValueError):
        files.read_csv_checked(spark, path, ddl, policy="drop")


def test_records_over_lines_are_checked_whole(spark, tmp_path):
    (tmp_path / "m.csv").write_text('k,v\n1,"a\nb"\nx,"c\nd"\n2,e,f\n')
    good, rejects = files.read_csv_checked(spark, str(tmp_path / "m.csv"), "k int, v string")
    assert rows(good) == [(1, "a\nb")]
    assert rows(rejects, "reason") == [("fields",), ("type: k",)]
    strict, _ = files.read_csv_checked(spark, str(tmp_path / "m.csv"), "k int, v string", policy="raise")
    with pytest.raises(Exception, match="malformed record"):
        strict.count()
