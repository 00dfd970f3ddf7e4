"""Checks, profiles and suggestions on small dirty frames."""

import pytest
from pyspark.sql import functions as F

from retailflow.model import REVIEW_IS_VALID
from retailflow.operators.slices import split_valid
from retailflow.plans import queries_quality
from retailflow.quality import checks as c
from retailflow.quality import partials
from retailflow.quality.profile import analyze, profile, profile_with_histogram, suggest
from retailflow.quality.repository import load_metrics, save_metrics
from retailflow.sinks.tables import merge_into_path
from tests.conftest import rows


def status(df, check):
    return {r["constraint"]: r["constraint_status"] for r in c.run_checks(df, check).collect()}


def test_each_constraint_passes_and_fails(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0, "created", "5"), ("a", 0, 2.0, "lost", "x"), (None, None, None, None, None)],
        "id string, n int, f double, status string, text string",
    )
    check = (
        c.Check("t")
        .is_complete("id")
        .is_unique("id")
        .is_unique("n")
        .is_positive("n")
        .is_non_negative("n")
        .is_positive("f")
        .is_contained_in("status", ["created"])
        .is_contained_in("status", ["created", "lost"])
        .has_data_type("n", c.INTEGRAL)
        .has_data_type("f", c.FRACTIONAL)
        .has_data_type("f", c.NUMERIC)
        .has_data_type("f", c.INTEGRAL)
        .has_data_type("text", c.INTEGRAL)
    )
    assert list(status(df, check).values()) != []
    assert status(df, check) == {
        "Completeness(id)": "Failure",
        "Uniqueness(id)": "Failure",
        "Uniqueness(n)": "Success",
        "Positive(n)": "Failure",
        "NonNegative(n)": "Success",
        "Positive(f)": "Success",
        "Containment(status,created)": "Failure",
        "Containment(status,created,lost)": "Success",
        "DataType(n,Integral)": "Success",
        "DataType(f,Fractional)": "Success",
        "DataType(f,Numeric)": "Success",
        "DataType(f,Integral)": "Failure",
        "DataType(text,Integral)": "Failure",
    }


def test_missing_column_fails_without_raising(spark):
    result = c.run_checks(spark.range(3), c.Check("t").is_complete("id").is_complete("nope")).collect()
    by_name = {r["constraint"]: r for r in result}
    assert by_name["Completeness(id)"]["constraint_status"] == "Success"
    assert by_name["Completeness(nope)"]["constraint_status"] == "Failure"
    assert "does not include column nope" in by_name["Completeness(nope)"]["constraint_message"]
    assert {r["check_status"] for r in result} == {"Error"}


def test_check_status_is_the_level_when_anything_fails(spark):
    df = spark.range(3)
    assert {r["check_status"] for r in c.run_checks(df, c.Check("t").is_unique("id")).collect()} == {"Success"}
    warned = c.run_checks(df, c.Check("t", c.WARNING).is_positive("id"))
    assert {r["check_status"] for r in warned.collect()} == {"Warning"}
    assert not c.has_errors(warned)


def test_gate(spark):
    df = spark.range(3)
    failed = c.run_checks(df, c.Check("t").is_positive("id"))
    with pytest.raises(c.CheckFailed, match="Positive"):
        c.gate(failed, df)
    empty = df.limit(0)
    c.gate(c.run_checks(empty, c.Check("t").is_complete("id")), empty)
    c.gate(c.run_checks(df, c.Check("t", c.WARNING).is_positive("id")), df)


def test_empty_frame_fails_every_constraint(spark):
    empty = spark.createDataFrame([], "order_id string, payment_type string")
    check = c.Check("t").is_complete("order_id").is_unique("order_id").is_contained_in("payment_type", ["a"])
    assert set(status(empty, check).values()) == {"Failure"}


def test_profile_infers_types_of_text(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "true", "a", 10), ("2", "2", "false", "b", 20), (None, None, None, None, None)],
        "i string, f string, b string, s string, n int",
    )
    got = {r["column"]: r for r in profile(df).collect()}
    assert {k: r["data_type"] for k, r in got.items()} == {
        "i": "Integral", "f": "Fractional", "b": "Boolean", "s": "String", "n": "Integral",
    }
    assert got["n"]["completeness"] == pytest.approx(2 / 3)
    assert (got["n"]["min"], got["n"]["max"], got["n"]["mean"], got["n"]["sum"], got["n"]["std_dev"]) == (10, 20, 15, 30, 5)
    assert got["f"]["sum"] == 3.5 and got["s"]["sum"] is None
    assert len(got["n"]["percentiles"]) == 100


def test_percentiles_are_within_one_percent(spark):
    rows_in = spark.range(100_000, numPartitions=8).selectExpr("cast(id AS double) AS v", "cast(NULL AS int) AS nothing")
    got = {r["column"]: r["percentiles"] for r in profile(rows_in).collect()}
    assert all(abs(value / 1000 - p) <= 1 for p, value in enumerate(got["v"], start=1))
    assert got["nothing"] is None
    assert [r["percentiles"] for r in profile(rows_in.limit(0)).collect()] == [None, None]


def test_histogram_of_low_cardinality_columns(spark):
    df = spark.range(1000).selectExpr("id", "id % 2 = 0 AS even", "if(id < 10, NULL, 'x') AS s")
    _, histogram = profile_with_histogram(df)
    assert rows(histogram) == [
        ("even", "false", 500, 0.5), ("even", "true", 500, 0.5), ("s", "NullValue", 10, 0.01), ("s", "x", 990, 0.99),
    ]


def test_suggestions(spark):
    df = spark.range(1000).selectExpr(
        "id", "if(id % 10 = 0, NULL, 'v' || id % 3) AS part", "cast(id AS string) AS text", "-id AS neg",
        "if(id < 960, 'main', 'rare' || id % 4) AS mostly",
    )
    got = {(r["column"], r["rule"]) for r in suggest(df).collect()}
    assert {
        ("id", "CompleteIfComplete"), ("id", "NonNegativeNumbers"), ("part", "RetainCompleteness"),
        ("part", "CategoricalRange"), ("text", "RetainType"), ("mostly", "FractionalCategoricalRange"),
    } <= got
    assert ("neg", "NonNegativeNumbers") not in got and ("text", "CategoricalRange") not in got


def test_analyze_and_history(spark, tmp_path):
    df = spark.createDataFrame([("a",), (None,)], "x string")
    metrics = analyze(df, ["x"])
    assert rows(metrics) == [("Column", "x", "Completeness", 0.5), ("Dataset", "*", "Size", 2.0)]
    root = str(tmp_path / "metrics")
    save_metrics(metrics, root, "t", "metrics", day="2017-01-01", at_ms=1)
    save_metrics(metrics, root, "t", "metrics", day="2017-01-02", at_ms=2)
    save_metrics(metrics, root, "u", "metrics", at_ms=3)
    schema = "entity string, instance string, name string, value double"
    history = load_metrics(spark, root, "t", "metrics", schema)
    assert rows(history, "name", "result_time_ms", "result_day") == [
        ("Completeness", 1, "2017-01-01"), ("Completeness", 2, "2017-01-02"),
        ("Size", 1, "2017-01-01"), ("Size", 2, "2017-01-02"),
    ]


def test_review_validity(spark):
    good_id = "a" * 32
    data = [
        ("o", good_id, 5, "2017-01-01"), ("o", "short", 5, "2017-01-01"), ("o", good_id, None, "2017-01-01"),
        ("o", good_id, 5, None), (None, good_id, 5, "2017-01-01"), ("o", None, 5, "2017-01-01"),
    ]
    df = spark.createDataFrame(data, "order_id string, review_id string, review_score int, review_creation_date string")
    good, bad = split_valid(df, REVIEW_IS_VALID)
    assert rows(good) == [data[0]]
    assert bad.count() == 5


def exact_rows(profiled):
    measures = [F.round(m, 6).alias(m) for m in ("completeness", "min", "max", "mean", "sum", "std_dev")]
    return rows(profiled.select("column", "data_type", "n_rows", "n_non_null", *measures))


def test_merged_partials_equal_the_whole(spark):
    data = [(n % 4, None if n % 5 == 0 else n, 1e6 + n / 7, "x" if n % 3 else str(n), str(n / 2), n % 2 == 0, None) for n in range(90)]
    ddl = "part int, n int, f double, text string, `num.text` string, b boolean, nothing double"
    df = spark.createDataFrame(data, ddl).withColumn("t", F.timestamp_seconds("part"))
    merged = partials.merge_partials(partials.partial_profiles(df, ["part"]))
    assert exact_rows(merged) == exact_rows(profile(df))
    got = {r["column"]: r["percentiles"] for r in merged.collect()}
    assert got["n"][49] == pytest.approx(45, abs=2) and got["num.text"][99] == 44.5
    assert got["text"] is None and got["nothing"] is None
    distinct = {r["column"]: r["approx_distinct"] for r in merged.collect()}
    assert (distinct["f"], distinct["n"], distinct["t"], distinct["b"], distinct["nothing"]) == (90, 72, 4, 2, 0)
    assert merged.count() == 8


def test_store_follows_rewritten_partitions(spark, tmp_path):
    path, store, parts = str(tmp_path / "t"), str(tmp_path / "s"), ["year", "day"]
    ddl = "k string, v int, year int, day int"

    def load(batch):
        folders = []
        merge_into_path(spark.createDataFrame(batch, ddl), path, ["k"], "*", parts, rewritten=folders)
        partials.refresh_partials(spark, path, store, parts, folders)
        assert exact_rows(partials.stored_profile(spark, store)) == exact_rows(profile(spark.read.parquet(path)))
        return folders

    assert load([("a", 1, 1, 1), ("b", 2, 1, 2), ("c", 3, None, 3)]) != []
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "s" / "year=1" / "day=2").iterdir()}
    assert load([("a", 10, 2, 1), ("c", 4, None, 3), ("d", 5, None, 3)]) == [
        "year=1/day=1", "year=2/day=1", "year=__HIVE_DEFAULT_PARTITION__/day=3",
    ]
    assert not (tmp_path / "s" / "year=1" / "day=1").exists()  # its only row moved
    assert before == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "s" / "year=1" / "day=2").iterdir()}


def test_exact_figures_come_from_values(spark):
    """Each column is grouped alone, no row is copied for every column; sketched figures off by too much are found."""
    data = [(None if n % 5 == 0 else n % 40, float(n % 7) if n % 3 else None, "x" if n % 2 else None) for n in range(400)]
    df = spark.createDataFrame(data, "i int, f double, s string")
    sketched = profile(df)
    within = queries_quality._within(df, sketched, 0.15)
    assert rows(within) == [(c, True, True) for c in ("f", "i", "s")]
    plan = within._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    shifted = sketched.withColumn("percentiles", F.transform("percentiles", lambda q: q + 9))
    doubled = sketched.withColumn("approx_distinct", 2 * F.col("approx_distinct"))
    assert rows(queries_quality._within(df, shifted, 0.15)) == [("f", True, False), ("i", True, False), ("s", True, True)]
    assert rows(queries_quality._within(df, doubled, 0.15)) == [(c, False, True) for c in ("f", "i", "s")]
    empty = df.limit(0)
    assert rows(queries_quality._within(empty, profile(empty), 0)) == [(c, True, True) for c in ("f", "i", "s")]
