"""Time and text expressions, slices."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from retailflow.functions import text, time
from retailflow.operators import slices
from retailflow.operators.lifecycle import month_list
from tests.conftest import rows


def values(spark, sql_type, data, column):
    return [r[0] for r in spark.createDataFrame([(v,) for v in data], f"x {sql_type}").select(column).collect()]


def test_session_edges(spark):
    at = ["00:00:00", "06:00:00", "06:00:01", "12:00:00", "18:00:00", "23:59:00", "23:59:30", "05:59:59.999999"]
    df = spark.createDataFrame([(f"2017-01-05 {t}",) for t in at], "x string")
    got = [r[0] for r in df.select(time.session_of_day(F.col("x").cast("timestamp"))).collect()]
    assert got == ["1-Dawn", "1-Dawn", "2-Morning", "2-Morning", "3-Afternoon", "4-Evening", None, "1-Dawn"]


def test_epoch_micros_truncate_to_milliseconds(spark):
    got = values(spark, "bigint", [1483228800123456, -1, None], time.micros_to_timestamp("x").cast("timestamp_ntz"))
    assert got == [dt.datetime(2017, 1, 1, 0, 0, 0, 123000), dt.datetime(1969, 12, 31, 23, 59, 59, 999000), None]


def test_iso_text(spark):
    got = values(spark, "string", ["2017-01-01T10:00:00Z", "2017-01-01T10:00:00.250Z", "x", None], time.iso_to_timestamp("x"))
    assert got == [dt.datetime(2017, 1, 1, 10), dt.datetime(2017, 1, 1, 10, 0, 0, 250000), None, None]


def test_cursor():
    assert time.next_day("2017-02-28") == "2017-03-01"
    assert time.next_day(" 2017-01-01 ", -1) == "2016-12-31"
    assert time.cursor_parts("2017-01-05") == (2017, 1, 5)
    assert time.month_bounds("2017-12") == ("2017-12-01", "2018-01-01")
    with pytest.raises(ValueError):
        time.next_day("2017-13-01")


def test_words(spark):
    df = spark.createDataFrame([(1, "São João, ok"), (2, None), (3, "...")], "id int, t string")
    assert rows(text.split_words(df, "t", ["id"])) == [(1, "joão"), (1, "ok"), (1, "são")]


def test_city_spelling(spark):
    got = values(spark, "string", ["são paulo", "sao paulo", "santa bárbara d'oeste", "x-y z", None], text.normal_city("x"))
    assert got == ["Sao Paulo", "Sao Paulo", "Santa Bárbara D'Oeste", "X-Y Z", None]


def test_number_text_and_prompt(spark):
    assert values(spark, "string", ["5", "5 stars", None], text.is_number_text("x")) == [True, False, False]
    assert values(spark, "string", ["oi", "", None], text.prompt("x")) == ["<2en> oi", "", None]


def test_translate_passes_nulls_and_batches(spark):
    data = [(i, f"t{i}" if i % 3 else None, "") for i in range(10)]
    df = spark.createDataFrame(data, "id int, a string, b string").repartition(2)

    def connect():
        def call(prompts):
            assert 0 < len(prompts) <= 2
            return [p.removeprefix("<2en> ").upper() for p in prompts]

        return call

    in_place = text.translate_columns(df, ["a", "b"], connect=connect, batch=2)
    assert rows(in_place) == sorted([(i, a and a.upper(), b) for i, a, b in data], key=lambda r: str(r[0]))
    added = text.translate_columns(df, ["a"], connect=connect, prefix="en_", batch=2)
    assert added.columns == ["id", "a", "b", "en_a"]
    assert rows(added, "a", "en_a") == sorted(
        [(a, a and a.upper()) for _, a, _ in data], key=lambda r: tuple((v is None, str(v)) for v in r)
    )
    with pytest.raises(ValueError):
        text.translate_columns(df, ["a"])


def test_translation_gets_bounded_batches(spark):
    """A partition of many or of long texts comes to the worker piece by piece."""
    for n, width, rows_at_most in ((5000, 10, 1000), (400, 100_000, 100)):
        df = spark.range(n, numPartitions=1).select(F.repeat(F.lit("x"), width).alias("t"))
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        done = text.translate_columns(df, ["t"], translate=lambda ts: [t.removeprefix("<2en> ").upper() for t in ts])
        assert done.filter(F.col("t") == "X" * width).count() == n
        held = df.select(F.pandas_udf(lambda t: t.map(lambda _: len(t)), "long")("t").alias("n"))
        assert held.agg(F.max("n")).first()[0] <= rows_at_most


def test_translation_leaves_other_columns_alone(spark, tmp_path):
    schema = "id bigint, at timestamp_ntz, t string, rest string"
    far = dt.datetime(9999, 12, 31, 23, 59)
    data = [(9007199254740993, far, "oi", "x"), (None, None, None, None)]
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = text.translate_columns(df, ["t"], translate=lambda ts: [t.upper() for t in ts])
    assert rows(out) == [(9007199254740993, far, "<2EN> OI", "x"), (None, None, None, None)]
    assert out.dtypes == df.dtypes
    plan = out.select("t")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<t:string>" in plan


@pytest.fixture
def stamped(spark):
    at = ["2016-12-31 23:59:59", "2017-01-01 00:00:00", "2017-01-01 23:59:59", "2017-01-02 00:00:00", "2017-02-01 00:00:00"]
    return spark.createDataFrame([(i, t) for i, t in enumerate(at)], "id int, t string").withColumn(
        "ts", F.col("t").cast("timestamp_ntz")
    )


def test_slices(stamped):
    def ids(df):
        return [r[0] for r in rows(df, "id")]

    assert ids(slices.day_slice(stamped, "ts", "2017-01-01")) == [1, 2]
    assert ids(slices.day_slice(stamped, "ts", "2017-01-01", lookback_days=1)) == [0, 1, 2]
    assert ids(slices.month_slice(stamped, "ts", "2017-01")) == [1, 2, 3]
    assert ids(slices.between_slice(stamped, "ts", "2017-01-01", "2017-01-02")) == [1, 2, 3]
    parts = slices.add_date_parts(stamped, "ts")
    assert ids(slices.partition_slice(parts, "2017-01-01")) == [1, 2]
    assert ids(slices.partition_range(parts, "2016-12-31", "2017-01-02")) == [0, 1, 2]
    cursor = slices.add_cursor_parts(stamped, "2017-01-05")
    assert cursor.select("year", "month", "day").distinct().collect() == [(2017, 1, 5)]
    assert dict(cursor.dtypes)["year"] == "int"


def test_day_slice_reaches_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    plan = slices.day_slice(orders, "o_orderdate", "1998-10-03")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters:"):]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


def test_complete_fields(spark):
    out = slices.complete_fields(spark.range(1), {"id": "bigint", "score": "int"})
    assert out.dtypes == [("id", "bigint"), ("score", "int")] and out.collect() == [(0, None)]


def test_month_list(spark):
    df = spark.createDataFrame([("2017-11-20",), ("2018-02-03",)], "t string").select(F.col("t").cast("timestamp").alias("ts"))
    assert rows(month_list(df, "ts")) == [("2017-11",), ("2017-12",), ("2018-01",), ("2018-02",)]
    assert rows(month_list(df, "ts", compat=True)) == [("2017-11",), ("2017-12",), ("2018-01",)]
    assert rows(month_list(df.limit(0), "ts")) == []
