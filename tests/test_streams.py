"""Streams on small hand-made deliveries."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.streaming import messages as M, panes as P, runs, windows as W


def message(at, store="A", total="1.0", sale_id=None, message_id=None):
    body = '{"store_id": "%s", "lane": 1, "total": %s}' % (store, total)
    return (body, {"event_ts": f"2026-09-27 {at}", "sale_id": sale_id or f"S-{at}-{store}-{total}"},
            message_id or f"M-{at}-{store}-{total}")


def run(spark, deliveries, build, save=runs.save_batch):
    inbox, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    watch = []
    with runs.progress(spark) as progress:
        for delivery in deliveries:
            runs.deliver(spark.createDataFrame(delivery, M.MESSAGE_SCHEMA), inbox)
            stream = build(M.parse_sales(M.with_event_time(M.read_feed(spark, inbox))))
            query = runs.start(stream, save(out), state, state_partitions=2)
            query.awaitTermination()
            watch.append(progress.rows(query))
    return out, watch


def shown(df):
    return sorted((r["window_start"].strftime("%H:%M"), r["store_id"], r["sales"], r["revenue"], r["pane"])
                  for r in df.collect())


FLUSH = [message("23:59:00", "flush", "0")]


def test_late_panes(spark):
    """On time, two late records, one window that is only late, one record beyond the lateness."""
    deliveries = [
        [message("15:00:10", "A", "1.0"), message("15:00:50", "A", "2.0")],
        [message("15:05:00", "B", "1.0")],
        [message("15:00:20", "A", "4.0"), message("15:01:00", "C", "9.0")],
        [message("15:00:30", "A", "4.5")],
        [message("16:30:00", "B", "1.0")],
        [message("15:02:00", "A", "8.0")],
        FLUSH]
    out, _ = run(spark, deliveries, M.sales, lambda out: P.save_late_panes(out, f"{out}-open", 60, 3600))
    stored = runs.read_batches(spark, out)
    got = [r for r in shown(stored) if r[1] != "flush"]
    assert got == [("15:00", "A", 2, 3.0, "1"), ("15:00", "A", 3, 7.0, "2"), ("15:00", "A", 4, 11.5, "2"),
                   ("15:01", "C", 1, 9.0, "2"), ("15:05", "B", 1, 1.0, "1"), ("16:30", "B", 1, 1.0, "1")]
    last = [r for r in shown(P.last_pane(stored)) if r[1] != "flush"]
    assert ("15:00", "A", 4, 11.5, "2") in last and len(last) == 4


def test_late_record_is_dropped_without_lateness(spark):
    deliveries = [[message("15:00:10")], [message("15:05:00")], [message("15:00:20", "A", "4.0")], FLUSH]
    out, watch = run(spark, deliveries, lambda p: W.window_totals(M.sales(p)))
    assert shown(runs.read_batches(spark, out)) == [("15:00", "A", 1, 1.0, "1"), ("15:05", "A", 1, 1.0, "1")]
    dropped = [sum(r[5] for r in rows) for rows in watch]
    assert sum(dropped) == 1


def test_open_windows_wait_for_a_flush(spark):
    out, _ = run(spark, [[message("15:00:10"), message("15:03:00")]], lambda p: W.window_totals(M.sales(p)))
    assert [r[0] for r in shown(runs.read_batches(spark, out))] == ["15:00"]


def test_copies_of_a_sale_count_once(spark):
    copies = [message("15:00:10", "A", "3.0", "S-1", f"M-{i}") for i in range(50)]
    deliveries = [copies[:25], [*copies[25:], message("15:00:20", "A", "1.0")], FLUSH]
    out, _ = run(spark, deliveries, lambda p: W.window_totals(W.once_per_sale(M.sales(p)), delay=None))
    assert shown(runs.read_batches(spark, out)) == [("15:00", "A", 2, 4.0, "1")]


@pytest.mark.parametrize("body,error", [
    ('{"store_id": "A", "total": "$3.49"}', "ValueError: could not convert string to float: '$3.49'"),
    ('{"total": 3}', "KeyError: 'store_id'"), ('{"store_id": "A"}', "KeyError: 'total'"),
    ("not json", "JSONDecodeError: the body is not a JSON object"),
    ('{"store_id": "A", "total": "' + "x" * 900 + '"}', None)])
def test_dead_letters(spark, body, error):
    frame = spark.createDataFrame([(body, {"sale_id": "S", "event_ts": "2026-09-27 15:00:00"}, "M")], M.MESSAGE_SCHEMA)
    dead = M.dead_letters(M.parse_sales(M.with_event_time(frame))).collect()
    assert len(dead) == 1 and dead[0]["body"] == body and dead[0]["attributes"]["sale_id"] == "S"
    if error:
        assert dead[0]["attributes"]["error"] == error
    assert len(dead[0]["attributes"]["error"]) <= 500


def test_numeric_text_is_a_total(spark):
    frame = spark.createDataFrame([('{"store_id": "A", "total": "12.5"}', {"event_ts": "2024-01-01 00:00:00"}, "M")], M.MESSAGE_SCHEMA)
    assert M.sales(M.parse_sales(M.with_event_time(frame))).first()["total"] == 12.5


def test_cancel_leaves_the_rest_for_the_next_start(spark):
    inbox, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    runs.deliver(spark.createDataFrame([message("15:00:10"), message("15:03:00")], M.MESSAGE_SCHEMA), inbox)

    def stream():
        return W.window_totals(M.sales(M.parse_sales(M.with_event_time(M.read_feed(spark, inbox)))))

    query = runs.start_continuous(stream(), runs.save_batch(out), state, every="0 seconds", state_partitions=2)
    query.processAllAvailable()
    query.stop()
    assert len(shown(runs.read_batches(spark, out))) == 1
    runs.deliver(spark.createDataFrame(FLUSH, M.MESSAGE_SCHEMA), inbox)
    runs.start(stream(), runs.save_batch(out), state).awaitTermination()
    assert [r[0] for r in shown(runs.read_batches(spark, out))] == ["15:00", "15:03"]


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with runs._stream_conf(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_totals_and_band(spark):
    windows = spark.createDataFrame([("2026-09-27 15:00:00", "A", 2, 3.0), ("2026-09-27 15:01:00", "A", 1, 0.1),
                                     ("2026-09-27 15:05:00", "A", 1, 0.2)], "t string, store_id string, sales long, revenue double"
                                    ).select(F.col("t").cast("timestamp").alias("window_start"), "store_id", "sales", "revenue")
    assert tuple(W.totals_since(windows, "2026-09-27 15:01:00").first()) == (2, 0.3, 2)
    assert W.around(windows, "A", "2026-09-27 15:01:00").count() == 2


def test_kafka_records_and_back(spark):
    records = spark.createDataFrame(
        [(bytearray(b'{"store_id": "A", "total": 1}'), [("event_ts", bytearray(b"2026-09-27 15:00:00"))], "t", 0, 7),
         (bytearray(b"x"), None, "t", 1, 8)],
        "value binary, headers array<struct<key: string, value: binary>>, topic string, partition int, offset long")
    got = M.from_kafka(records).orderBy("message_id").collect()
    assert got[0]["attributes"] == {"event_ts": "2026-09-27 15:00:00"} and got[0]["message_id"] == "t-0-7"
    assert got[1]["attributes"] == {}
    back = M.to_kafka(M.from_kafka(records)).collect()
    assert back[0]["headers"][0]["value"] == bytearray(b"2026-09-27 15:00:00")


def test_worker_code_needs_no_package_on_the_executors():
    """A Python without this package on its path can load and run the pickled function."""
    import subprocess
    import sys

    from pyspark import cloudpickle
    data = cloudpickle.dumps(W._first_of_each).hex()
    code = (f"import pickle, pyarrow as pa; f = pickle.loads(bytes.fromhex('{data}'));"
            "print(next(f([pa.RecordBatch.from_pydict({'_sale': ['b', 'a', 'b'], 'n': [1, 2, 3]})])).column(1).to_pylist())")
    done = subprocess.run([sys.executable, "-c", code], cwd="/", capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "[1, 2]", done.stderr[-300:]


def pane_batch(spark, rows):
    """Sales of one store: (second, amount)."""
    frame = spark.createDataFrame([("A", s, float(v), f"m{i}") for i, (s, v) in enumerate(rows)], "store_id string, s long, total double, message_id string")
    return P.timed(frame.withColumn("ts", F.timestamp_seconds("s")), 60_000)


def test_panes_of_a_hot_store_stay_in_spark(spark):
    """Most sales of a batch are of one store; they are added up before the shuffle and no row reaches Python."""
    known = spark.createDataFrame([("A", 0, 2, 3_000_000, 1)], P.OPEN_SCHEMA)
    batch = pane_batch(spark, [(120 + i % 50, 1) for i in range(5000)] + [(5, 4), (7, 5)])
    panes, still_open = P.advance(batch, known, 90_000, 200_000, 60_000, 3_600_000)
    got = sorted((r["pane"], r["pane_index"], r["sales"], r["revenue"]) for r in panes.collect())
    assert got == [("1", 0, 5000, 5000.0), ("2", 1, 3, 7.0), ("2", 2, 4, 12.0)]
    assert sorted(map(tuple, still_open.collect())) == [("A", 0, 4, 12_000_000, 3), ("A", 120_000, 5000, 5_000_000_000, 1)]
    for frame in (panes, still_open):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "partial_sum" in plan and not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_a_replayed_batch_of_panes_writes_the_same(spark, tmp_path):
    save = P.save_late_panes(str(tmp_path / "out"), str(tmp_path / "open"))
    frame = spark.createDataFrame([("A", s, 1.0, f"m{s}") for s in (1, 2, 70)], "store_id string, s long, total double, message_id string")
    late = spark.createDataFrame([("A", 3, 1.0, "m3")], "store_id string, s long, total double, message_id string")
    for _ in range(2):
        save(frame.withColumn("ts", F.timestamp_seconds("s")), 0)
    for _ in range(3):
        save(late.withColumn("ts", F.timestamp_seconds("s")), 1)
    got = sorted((r["pane"], r["sales"]) for r in runs.read_batches(spark, str(tmp_path / "out")).collect())
    assert got == [("1", 2), ("2", 3)]


def test_copies_of_a_hot_sale_are_reduced_where_they_are_read(spark):
    """One state, and before it one row for each batch of rows."""
    copies = spark.createDataFrame([("s1", f"m{i}") for i in range(5000)] + [(None, "m1"), (None, "m2")], "sale_id string, message_id string")
    reduced = copies.withColumn("ts", F.lit("2024-01-01").cast("timestamp")).coalesce(2)
    named = reduced.withColumn("_sale", F.coalesce(F.concat(F.lit("s"), "sale_id"), F.concat(F.lit("m"), "message_id")))
    left = named.mapInArrow(W._first_of_each, named.schema)
    assert left.count() <= 2 + 2 and {r["message_id"] for r in left.where("sale_id IS NULL").collect()} == {"m1", "m2"}


def test_sales_without_time_or_id_are_not_lost(spark):
    from millrace.streaming import messages as M
    body = '{"store_id": "s", "total": 1}'
    rows = [(body, {"event_ts": "2024-01-01 00:00:01", "sale_id": "a"}, "m1"), (body, {"event_ts": "soon", "sale_id": "b"}, "m2"),
            (body, {"sale_id": "c"}, "m3"), (body, None, "m4"), (body, {"event_ts": "2024-01-01 00:00:02"}, "m5")]
    parsed = M.parse_sales(M.with_event_time(spark.createDataFrame(rows, M.MESSAGE_SCHEMA)))
    assert {r["message_id"] for r in M.sales(parsed).collect()} == {"m1", "m5"}
    assert {r["message_id"] for r in M.dead_letters(parsed).collect()} == {"m2", "m3", "m4"}


def test_sales_without_an_id_stand_for_themselves(spark, tmp_path):
    import json
    from millrace.streaming import messages as M, windows as W
    body = json.dumps({"store_id": "s", "total": 1})
    inbox = tmp_path / "in"
    inbox.mkdir()
    rows = [{"body": body, "attributes": {"event_ts": f"2024-01-01 00:00:0{i}"} | ({"sale_id": "a"} if i > 2 else {}), "message_id": f"m{i}"} for i in range(6)]
    (inbox / "f.json").write_text("\n".join(map(json.dumps, rows)))
    feed = W.once_per_sale(M.sales(M.parse_sales(M.with_event_time(M.read_feed(spark, str(inbox))))))
    query = feed.writeStream.format("memory").queryName("own_ids").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert {r["message_id"] for r in spark.table("own_ids").collect()} >= {"m0", "m1", "m2"}
    assert spark.table("own_ids").count() == 4


def test_alerts_of_a_stream_close_without_another_red_entry(spark, tmp_path):
    from millrace.operators import checks
    schema = "ts timestamp, signal string, status string"

    def arrive(*rows):
        spark.createDataFrame(rows, "t string, signal string, status string").select(
            F.col("t").cast("timestamp").alias("ts"), "signal", "status").write.mode("append").parquet(str(tmp_path / "in"))
        log = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        runs.start(checks.red_alerts(log), runs.save_batch(str(tmp_path / "out")), str(tmp_path / "state")).awaitTermination()
        stored = runs.read_batches(spark, str(tmp_path / "out"))
        return sorted((r["window_start"].strftime("%H:%M"), r["signal"], r["reds"]) for r in stored.collect())

    assert arrive(("2024-01-01 10:01:00", "volume", "RED"), ("2024-01-01 10:04:00", "volume", "RED"), ("2024-01-01 10:02:00", "schema", "GREEN")) == []
    assert arrive(("2024-01-01 10:03:00", "volume", "RED"), ("2024-01-01 10:07:00", "volume", "GREEN")) == []
    first = ("10:00", "volume", 3)
    assert arrive(("2024-01-01 10:30:00", "schema", "GREEN")) == [first]
    assert arrive(("2024-01-01 10:04:00", "volume", "RED")) == [first]  # too late
    assert arrive(("2024-01-01 10:31:00", "volume", "RED"), ("2024-01-01 11:00:00", "volume", "GREEN")) == [first, ("10:30", "volume", 1)]


def test_lag_report_counts_dropped_rows_and_backlog(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    seen = []
    with runs.progress(spark) as progress:
        for delivery in ([message("15:00:10")], [message("15:05:00")], [message("15:00:20", "A", f"{i}.0", message_id=f"m{i}") for i in range(40)]):
            runs.deliver(spark.createDataFrame(delivery, M.MESSAGE_SCHEMA).coalesce(1), inbox)
            parsed = M.parse_sales(M.with_event_time(runs.watched_feed(spark, inbox)))
            query = runs.start(W.window_totals(runs.watched_rows(M.sales(parsed))), runs.save_batch(out), state, state_partitions=2)
            query.awaitTermination()
            seen += progress.rows(query)
        assert not progress._rows and not progress._ended
    runs.deliver(spark.createDataFrame([message("15:10:00")] * 3, M.MESSAGE_SCHEMA).coalesce(1), inbox)
    report = runs.lag_report(spark, seen, inbox, out, state, "sales").where("input_rows > 0").orderBy("batch_id").collect()
    assert [(r["input_rows"], r["dropped_rows"], r["backlog_rows"], r["backlog_files"]) for r in report] == [(1, 0, 44, 3), (1, 0, 43, 2), (40, 40, 3, 1)]
