"""Streams against batch results, re-delivery and malformed rows."""

import json

import pytest
from pyspark.sql import functions as F

from retailflow.plans import queries_batch, queries_streams
from retailflow.streaming import decode, monitor, sinks, state
from retailflow.streaming.handover import record_position, snapshot_then_tail
from retailflow.streaming.sources import kafka_options, read_change_stream
from tests.conftest import rows

ROW = "user int, v string, pos int"


def write_lines(path, lines):
    path.mkdir(parents=True, exist_ok=True)
    (path / f"part-{len(list(path.iterdir()))}.txt").write_text("\n".join(lines))


def test_unwrap_drops_deletes_and_tombstones(spark):
    def envelope(op, after, table="t"):
        return json.dumps({"op": op, "before": None, "after": after, "source": {"table": table}})

    row = {"user": 1, "v": "a", "pos": 1}
    lines = [envelope(op, row) for op in "cur"] + [envelope("d", None), envelope("u", row, "other"), None, "junk"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert decode.unwrap_cdc(df, ROW).count() == 4
    assert decode.unwrap_cdc(df, ROW, table="t").count() == 3
    assert decode.unwrap_cdc(df, ROW).columns == ["user", "v", "pos"]


def test_filter_changes(spark):
    lines = [
        json.dumps({"operationType": op, "fullDocument": {"user": i, "v": op, "pos": i}})
        for i, op in enumerate(["insert", "update", "replace", "delete", "drop"])
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert rows(decode.filter_changes(df, ROW), "v") == [("insert",), ("replace",), ("update",)]


def test_review_payload_is_lenient(spark):
    payload = {"order_id": "o", "review_id": "r", "review_score": "x", "review_comment_title": None,
               "review_comment_message": "oi", "review_creation_date": "2017-01-01T10:00:00Z",
               "review_answer_timestamp": "bad"}
    df = spark.createDataFrame([(json.dumps(payload),)], "payload string")
    row = decode.reviews_rows(df).first()
    assert row["review_score"] is None and row["review_comment_title"] is None
    assert str(row["review_creation_date"]) == "2017-01-01 10:00:00" and row["review_answer_timestamp"] is None


def test_item_money(spark):
    df = spark.createDataFrame([("o", "s", "p", 1, 0, 58.9, 10.125)], decode.ITEMS_CHANGE_DDL)
    row = decode.items_rows(df).first()
    assert str(row["freight_value"]) == "58.90"
    assert str(decode.items_rows(df, compat=True).first()["freight_value"]) == "59"


def test_json_kafka_value(spark):
    df = spark.createDataFrame([(bytearray(b'{"payload": "{}"}'),)], "value binary")
    assert rows(decode.decode_kafka(df, "json", "payload string")) == [("{}",)]
    with pytest.raises(ValueError):
        decode.decode_kafka(df, "xml", "")
    assert kafka_options("host:9092", "t")["startingOffsets"] == "earliest"


def test_snapshot_then_tail(spark, tmp_path):
    feed, out, checkpoint = tmp_path / "feed", str(tmp_path / "out"), str(tmp_path / "cp")
    lines = [json.dumps({"user": i, "v": "a", "pos": i}) for i in range(6)]

    def run():
        stream = read_change_stream(spark, str(feed), "json", ROW, files_per_batch=1)
        sinks.start_files(stream, out, checkpoint).awaitTermination()
        return rows(spark.read.parquet(out), "user")

    write_lines(feed, lines[:2])
    write_lines(feed, lines[2:4])
    assert run() == [(0,), (1,), (2,), (3,)]
    write_lines(feed, lines[4:])
    assert run() == [(i,) for i in range(6)]
    assert run() == [(i,) for i in range(6)]


def test_upsert_keeps_the_last_change_and_survives_redelivery(spark, tmp_path):
    log, bad = str(tmp_path / "log"), str(tmp_path / "bad")
    sink = sinks.upsert_sink(["user"], ["pos"], sinks.version_writer(log), sinks.json_writer(bad))
    first = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (2, "c", 2), (None, "n", 9)], ROW)
    second = spark.createDataFrame([(1, "old", 2), (2, "d", 5), (3, "e", 6)], ROW)
    for batch_id, df in ((0, first), (1, second), (1, second)):
        sink(df, batch_id)
    state = sinks.read_state(spark, log, ["user"], ["pos"])
    assert rows(state) == [(1, "b", 3), (2, "d", 5), (3, "e", 6)]
    assert spark.read.json(bad).filter("v IS NOT NULL").count() == 1


def test_index_append_is_idempotent_per_batch(spark, tmp_path):
    root = str(tmp_path / "index")
    sink = sinks.index_sink(sinks.json_writer(root))
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], ROW)
    for batch_id in (0, 0, 1):
        sink(df, batch_id)
    assert spark.read.json(root).count() == 4


def test_index_documents_are_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "DOCUMENTS_PER_FILE", 300)
    data = [(n, f"naïve\n\"text\" {n}", None if n % 5 else n) for n in range(1000)]
    sinks.json_writer(str(tmp_path / "index"))(spark.createDataFrame(data, ROW).coalesce(1), 7)
    files = list((tmp_path / "index" / "batch_id=7").glob("part-*"))
    assert len(files) == 4 and all(f.name.endswith(".json.gz") for f in files)
    assert sum(f.stat().st_size for f in files) < 20_000
    assert rows(spark.read.schema(ROW).json(str(tmp_path / "index" / "batch_id=7"))) == rows(spark.createDataFrame(data, ROW))


def test_latest_state_spreads_a_hot_key(spark):
    hot = spark.range(5000).select(F.lit(1).alias("user"), F.col("id").cast("string").alias("v"), F.col("id").cast("int").alias("pos"))
    latest = sinks.latest_state(hot, ["user"], ["pos"])
    assert rows(latest) == [(1, "4999", 4999)]
    assert "partial_max" in latest._jdf.queryExecution().executedPlan().toString()


def test_preview_and_progress(spark, tmp_path):
    feed = tmp_path / "feed"
    write_lines(feed, [json.dumps({"user": i, "v": "a", "pos": i}) for i in range(20)])
    stream = read_change_stream(spark, str(feed), "json", ROW)
    assert sinks.stream_preview(stream, 10, "preview").count() == 10
    query = sinks.start_files(stream, str(tmp_path / "o"), str(tmp_path / "c"))
    query.awaitTermination()
    assert sinks.input_rows(query) == 20


def test_start_all_runs_every_stream(spark, tmp_path):
    feed = tmp_path / "feed"
    write_lines(feed, [json.dumps({"user": 1, "v": "a", "pos": 1})])
    stream = read_change_stream(spark, str(feed), "json", ROW)
    streams = {n: (stream, sinks.index_sink(sinks.json_writer(str(tmp_path / n)))) for n in ("a", "b")}
    for query in sinks.start_all(streams, str(tmp_path / "cp")).values():
        query.awaitTermination()
    assert all(spark.read.json(str(tmp_path / n)).count() == 1 for n in ("a", "b"))


def test_version_log_is_compacted(spark, tmp_path):
    log, keys, position = str(tmp_path / "log"), ["k"], ["at"]
    writer = sinks.version_writer(log)
    for batch in range(5):
        writer(spark.createDataFrame([(1, batch, "x"), (10 + batch, 0, "y")], "k int, at int, v string"), batch)
    state = rows(sinks.read_state(spark, log, keys, position))
    assert sinks.compact_versions(spark, log, keys, position) == 4
    assert sorted(p.name for p in tmp_path.joinpath("log").iterdir()) == ["batch_id=-1", "batch_id=4"]
    assert rows(sinks.read_state(spark, log, keys, position)) == state
    assert sinks.compact_versions(spark, log, keys, position) == 0
    # The last batch comes again, then two more; a second snapshot replaces the first.
    writer(spark.createDataFrame([(1, 4, "x"), (14, 0, "y")], "k int, at int, v string"), 4)
    for batch in (5, 6):
        writer(spark.createDataFrame([(1, batch, "z")], "k int, at int, v string"), batch)
    assert sinks.compact_versions(spark, log, keys, position) == 3
    assert sorted(p.name for p in tmp_path.joinpath("log").iterdir()) == ["batch_id=-2", "batch_id=6"]
    got = rows(sinks.read_state(spark, log, keys, position))
    assert got == sorted([(1, 6, "z")] + [r for r in state if r[0] != 1])


def test_rejected_rows_are_released_when_a_writer_fails(spark):
    def fail(df, batch_id):
        raise RuntimeError("down")

    df = spark.createDataFrame([(1, 1)], "k int, at int")
    with pytest.raises(RuntimeError):
        sinks.upsert_sink(["k"], ["at"], fail, rejected=fail)(df, 0)
    assert not df.is_cached


def test_row_counts_beyond_the_kept_reports(spark, sf_dir):
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(kept, "1")
    try:
        got = dict(rows(queries_streams.stream_row_counts(spark, sf_dir)))
    finally:
        spark.conf.unset(kept)
    assert got == {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("orders", "events")}


def test_next_cursor_of_a_null_time(spark, monkeypatch):
    orders = spark.sql("SELECT timestamp '1996-02-28 23:59:59' AS order_purchase_timestamp UNION ALL SELECT null")
    monkeypatch.setattr(queries_batch.src, "orders", lambda spark, d: orders)
    assert rows(queries_batch.next_cursor_days(spark, "")) == [("1996-02-28", "1996-02-29", 1), (None, None, 1)]


def test_state_is_kept_over_late_repeated_and_restarted_batches(spark, tmp_path):
    ddl = "k string, at int, v string"
    feed, table, checkpoint = (str(tmp_path / n) for n in ("feed", "table", "checkpoint"))
    batches = [
        [("a", 5, "five"), ("b", 1, "one"), (None, 9, "no key")],
        [("a", 3, "late"), ("b", 2, "two")],
        [("a", 5, "five"), ("c", 1, "first"), ("b", 2, "two")],
        [("c", 0, "late")],
    ]
    touched = []
    for batch in batches:
        spark.createDataFrame(batch, ddl).coalesce(1).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(ddl).parquet(feed)
        query = state.start_state(stream, ["k"], ["at"], table, checkpoint, buckets=3)  # a restart each time
        query.awaitTermination()
        touched.append(query.lastProgress["stateOperators"][0]["numRowsUpdated"])
    assert rows(state.read_state_table(spark, table)) == [("a", 5, "five"), ("b", 2, "two"), ("c", 1, "first")]
    assert touched == [2, 2, 3, 1]
    assert spark.conf.get(state.PROVIDER, None) != state.ROCKS_DB


def test_state_sink_takes_a_batch_again(spark, tmp_path):
    path = str(tmp_path / "t")
    sink = state.state_table_sink(path, ["k"], 2)
    first = spark.createDataFrame([("a", 1), ("b", 1)], "k string, at int")
    for df in (first, first, spark.createDataFrame([("a", 2)], "k string, at int"), first.limit(0)):
        sink(df, 0)
    assert rows(state.read_state_table(spark, path), "k", "at") == [("a", 2), ("b", 1)]


def watch(spark, folder, log, files_per_batch=1):
    stream = read_change_stream(spark, str(folder / "feed"), "parquet", "k long, at timestamp_ntz", files_per_batch=files_per_batch)
    out = monitor.watched(stream, "at").writeStream.queryName("feed").trigger(availableNow=True)
    running = out.option("checkpointLocation", str(folder / "checkpoint")).format("parquet").start(str(folder / "out"))
    running.awaitTermination()
    log.drain(running)


def test_reports_of_more_than_a_hundred_batches(spark, tmp_path):
    """Progress reports are kept for a hundred batches; the log has all, also over a restart."""
    feed = spark.range(1100).selectExpr("id AS k", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) AS at")
    feed.repartition(105, "k").write.parquet(str(tmp_path / "feed"))
    root = str(tmp_path / "reports")
    assert monitor.read_reports(spark, root).count() == 0
    with monitor.BatchLog(spark, root) as log:
        watch(spark, tmp_path, log)
        feed.limit(7).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
        watch(spark, tmp_path, log)
    reports = monitor.read_reports(spark, root)
    assert reports.count() > 100 and reports.filter("millis >= 0 AND started IS NOT NULL").count() == reports.count()
    total = monitor.stream_totals(reports).collect()
    last = feed.agg(F.max("at")).first()[0]
    assert [tuple(r) for r in total] == [("feed", 1107, last, True)]
    lost = monitor.stream_totals(reports.filter("batch <> 50")).first()
    assert not lost["complete"] and lost["n_rows"] < 1107


def test_hand_over_from_snapshot_to_tail(spark, tmp_path):
    ddl = "user int, v string, pos long"
    log, root, table = (str(tmp_path / n) for n in ("log", "root", "table"))
    calls = []

    def arrive(*changes):
        spark.createDataFrame(changes, ddl).coalesce(1).write.mode("append").parquet(log)

    def snapshot():
        calls.append(1)
        arrive((1, "during", 4), (3, "new", 5))  # one change is seen by the snapshot, the other is not
        return spark.createDataFrame([(1, "during", 4), (2, "old", 2)], ddl)

    def run():
        stream = snapshot_then_tail(spark, snapshot, log, ddl, "pos", root)
        state.start_state(stream, ["user"], ["pos"], table, f"{root}/checkpoint", buckets=2).awaitTermination()
        return rows(state.read_state_table(spark, table))

    arrive((1, "first", 1), (2, "old", 2), (4, "gone from the table", 3))
    assert run() == [(1, "during", 4), (2, "old", 2), (3, "new", 5)]
    assert run() == [(1, "during", 4), (2, "old", 2), (3, "new", 5)]
    arrive((2, "again", 6), (1, "during", 4), (3, "late", 4))
    assert run() == [(1, "during", 4), (2, "again", 6), (3, "new", 5)]
    assert len(calls) == 1 and record_position(spark, log, ddl, "pos", root) == 3


def test_hand_over_without_a_log(spark, tmp_path):
    ddl = "user int, v string, pos long"
    assert record_position(spark, str(tmp_path / "none"), ddl, "pos", str(tmp_path / "a")) is None
    spark.createDataFrame([], ddl).write.parquet(str(tmp_path / "log"))
    assert record_position(spark, str(tmp_path / "log"), ddl, "pos", str(tmp_path / "b")) is None
