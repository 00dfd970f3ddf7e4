"""Merge semantics, against a row-by-row model."""

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import retailflow.operators.merge as merge_module
from retailflow.operators.merge import (
    MergeConflict,
    field_upsert,
    insert_new,
    keyed_update,
    merge,
    merge_sql,
)
from tests.conftest import rows

DDL = "k string, j int, a int, b string"
KEYS = ["k", "j"]

key_rows = st.tuples(st.sampled_from(["x", "y", "z", None]), st.sampled_from([1, 2, None]))
any_rows = st.lists(
    st.tuples(key_rows, st.sampled_from([1, 2, None]), st.sampled_from(["p", None])).map(lambda t: (*t[0], *t[1:])),
    max_size=7,
)


def model(target, source, update, insert=True):
    """Merged rows, or None where two source rows match one target row."""
    out, matched = [], set()
    for t in target:
        hits = [i for i, s in enumerate(source) if None not in t[:2] and s[:2] == t[:2]]
        if len(hits) > 1 and update:
            return None
        matched.update(hits)
        if hits and update:
            s = dict(zip("kjab", source[hits[0]]))
            t = tuple(s[c] if c in update else v for c, v in zip("kjab", t))
        out.append(t)
    if insert:
        out += [s for i, s in enumerate(source) if i not in matched]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(params=["broadcast", "shuffle"])
def plan(request, monkeypatch):
    if request.param == "shuffle":
        monkeypatch.setattr(merge_module, "BROADCAST_ROWS", -1)
    return request.param


@pytest.mark.parametrize("update", ["*", ["a"], None])
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=any_rows, source=any_rows)
def test_merge_equals_model(spark, plan, update, target, source):
    columns = {"*": ["a", "b"], None: []}.get(update if not isinstance(update, list) else "", update)
    t, s = spark.createDataFrame(target, DDL), spark.createDataFrame(source, DDL)
    want = model(target, source, columns)
    if want is None:
        with pytest.raises(MergeConflict):
            merge(t, s, KEYS, update).collect()
    else:
        assert rows(merge(t, s, KEYS, update)) == want


def test_merge_is_idempotent(spark):
    t = spark.createDataFrame([("x", 1, 1, "p")], DDL)
    s = spark.createDataFrame([("x", 1, 2, "q"), ("y", 1, 3, "r")], DDL)
    once = merge(t, s, KEYS)
    assert rows(once) == rows(merge(once, s, KEYS)) == [("x", 1, 2, "q"), ("y", 1, 3, "r")]


def test_null_key_is_inserted_on_every_run(spark):
    s = spark.createDataFrame([("x", None, 2, "q")], DDL)
    once = merge(s.limit(0), s, KEYS)
    assert merge(once, s, KEYS).count() == 2


def test_unmatched_duplicates_are_all_inserted(spark, plan):
    t = spark.createDataFrame([("x", 1, 1, "p")], DDL)
    s = spark.createDataFrame([("y", 1, 3, "r")] * 40 + [("x", 1, 9, "n")], DDL)
    merged = merge(t, s, KEYS)
    assert merged.count() == 41
    assert rows(merged.filter("k = 'x'")) == [("x", 1, 9, "n")]


def test_partial_update_keeps_other_columns(spark):
    t = spark.createDataFrame([("x", 1, 1, "keep")], DDL)
    s = spark.createDataFrame([("x", 1, 2, "lose")], DDL)
    assert rows(merge(t, s, KEYS, ["a"])) == [("x", 1, 2, "keep")]


def test_insert_new_keeps_the_first_of_a_key(spark):
    t = spark.createDataFrame([("x", 1, 1, "p")], DDL)
    s = spark.createDataFrame(
        [("x", 1, 0, "no"), ("y", 1, 5, "late"), ("y", 1, 4, "first"), (None, 1, 7, "n"), (None, 1, 7, "n")], DDL
    )
    got = rows(insert_new(t, s, KEYS, ["a"]))
    assert got == [("x", 1, 1, "p"), ("y", 1, 4, "first"), (None, 1, 7, "n"), (None, 1, 7, "n")]


def test_keyed_update_ignores_missing_keys(spark):
    t = spark.createDataFrame([("x", 1, 1, "p"), ("y", 1, 1, "p")], DDL)
    s = spark.createDataFrame([("x", 1, 9), ("z", 1, 9)], "k string, j int, a int")
    assert rows(keyed_update(t, s, KEYS, ["a"])) == [("x", 1, 9, "p"), ("y", 1, 1, "p")]


def test_field_upsert_sets_present_fields_only(spark):
    t = spark.createDataFrame([("x", 1, 1, "p")], DDL)
    s = spark.createDataFrame([("x", 1, None), ("y", 1, 2)], "k string, j int, a int")
    assert rows(field_upsert(t, s, KEYS)) == [("x", 1, None, "p"), ("y", 1, 2, None)]


@pytest.mark.parametrize("update", ["*", ["a"], None])
def test_merge_sql_runs_and_agrees(spark, update):
    target = [("x", 1, 1, "p"), ("y", 1, 1, "p"), (None, 1, 1, "p")]
    source = [("x", 1, 2, "q"), ("z", 1, 3, "r"), (None, 1, 4, "s")]
    con = duckdb.connect()
    for name, data in (("target", target), ("staging", source)):
        con.execute(f"CREATE TABLE {name} (k VARCHAR, j INTEGER, a INTEGER, b VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?, ?, ?)", data)
    con.execute(merge_sql("target", "staging", ["k", "j", "a", "b"], KEYS, update))
    want = sorted(con.execute("SELECT * FROM target").fetchall(), key=lambda r: tuple((v is None, str(v)) for v in r))
    t, s = spark.createDataFrame(target, DDL), spark.createDataFrame(source, DDL)
    assert rows(merge(t, s, KEYS, update)) == want


def test_small_source_leaves_the_target_unshuffled(spark):
    t = spark.range(1000).selectExpr("id AS k", "1 AS a")
    s = spark.range(10).selectExpr("id AS k", "2 AS a")
    plan = merge(t, s, ["k"], ["a"], insert=False)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def count_in_plan(df, what):
    return df._jdf.queryExecution().executedPlan().toString().count(what)


def test_large_source_scans_and_shuffles_each_side_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merge_module, "BROADCAST_ROWS", -1)
    spark.range(1000).selectExpr("id AS k", "1 AS a", "'t' AS b").write.parquet(str(tmp_path / "t"))
    spark.range(500, 1500).selectExpr("id AS k", "2 AS a", "'s' AS b").write.parquet(str(tmp_path / "s"))
    t, s = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s"))
    for update in ("*", ["a"], None):
        df = merge(t, s, ["k"], update).hint("merge")
        assert count_in_plan(df, "FileScan") <= 2 and count_in_plan(df, "Exchange hashpartitioning") <= 2
        assert df.count() == 1500


def test_null_keys_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(merge_module, "BROADCAST_ROWS", -1)
    t = spark.range(2000).selectExpr("CASE WHEN id < 0 THEN 'x' END AS k", "1 AS j", "1 AS a", "'t' AS b")
    s = spark.range(2000).selectExpr("CASE WHEN id < 0 THEN 'x' END AS k", "1 AS j", "2 AS a", "'s' AS b")
    merged = merge(t, s, KEYS)
    sizes = merged.groupBy(F.spark_partition_id()).count().collect()
    assert merged.count() == 4000 and merged.filter("a = 1").count() == 2000
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in merge(t, s, KEYS).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == int(parts) and max(sizes) < 2000


def test_a_hot_source_key_is_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merge_module, "BROADCAST_ROWS", -1)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    spark.range(200).selectExpr("CAST(id AS STRING) AS k", "1 AS a", "'t' AS b").write.parquet(str(tmp_path / "t"))
    hot = spark.range(0, 40000, 1, 8).selectExpr("'hot' AS k", "1 AS a", "sha2(CAST(id AS STRING), 256) AS b")
    hot.union(spark.range(100).selectExpr("CAST(id + 1000 AS STRING)", "1", "'s'")).write.parquet(str(tmp_path / "s"))
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = merge(spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s")), ["k"], None)
        assert len(df.collect()) == 40300
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
