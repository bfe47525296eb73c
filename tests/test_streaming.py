"""Streams: same result as batch, nothing lost, nothing twice."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from scorewatch.operators import model
from scorewatch.sources.streams import read_scored, read_stream
from scorewatch.spec import FeatureSpec
from scorewatch.streaming import live, monitor
from scorewatch.streaming.score import score_stream, scored_message
from scorewatch.streaming.sinks import (
    append_table,
    fan_out,
    history_sink,
    message_sink,
    quarantine_sink,
    read_appended,
    write_batch,
    write_stream,
)

SPEC = FeatureSpec(("a", "b"), "label")
WAIT = 120


@pytest.fixture(scope="module")
def fitted(spark):
    rows = [(i / 50, (i * 7 % 50) / 50, int(i + i * 7 % 50 > 50)) for i in range(50)]
    return model.train(spark.createDataFrame(rows, "a double, b double, label int"), SPEC)


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def messages(start, n):
    return [json.dumps({"a": i / 100, "b": 0.5}) for i in range(start, start + n)]


def text_stream(spark, folder, **options):
    return read_stream(spark, "files", str(folder), "text", **options)


def sinks(root):
    return {
        "history": history_sink(f"{root}/history", SPEC),
        "messages": message_sink(f"{root}/messages", SPEC),
        "quarantine": quarantine_sink(f"{root}/quarantine"),
    }


def run(spark, tmp_path, fitted, extra=None, **options):
    scored = score_stream(text_stream(spark, tmp_path / "in", **options), SPEC, fitted)
    all_sinks = sinks(tmp_path) | (extra or {})
    q = fan_out(scored, all_sinks, str(tmp_path / "checkpoint"), trigger=None)
    monitor.wait_for([q], WAIT)
    return q


def test_stream_equals_batch_and_restart_adds_only_new_rows(spark, tmp_path, fitted):
    put(tmp_path / "in", "1.txt", messages(0, 20) + ["junk", '{"a": NaN}', '{"a": "x"}'])
    run(spark, tmp_path, fitted)
    put(tmp_path / "in", "2.txt", messages(20, 10))
    run(spark, tmp_path, fitted)
    run(spark, tmp_path, fitted)

    history = read_appended(spark, str(tmp_path / "history"))
    assert history.count() == 30
    raw = spark.read.text(str(tmp_path / "in"))
    batch = score_stream(raw, SPEC, fitted).filter("is_valid")
    columns = ["a", "b", "predicted_label", "malignant_probability"]
    assert sorted(map(tuple, history.select(columns).collect())) == sorted(
        map(tuple, batch.select(columns).collect())
    )
    bad = {r.raw_value for r in read_appended(spark, str(tmp_path / "quarantine")).collect()}
    assert bad == {"junk", '{"a": NaN}', '{"a": "x"}'}
    sent = read_scored(read_appended(spark, str(tmp_path / "messages")).select("value"), SPEC)
    assert sent.count() == 30
    assert sent.filter(F.col("benign_probability") + F.col("malignant_probability") < 0.999).count() == 0


def test_a_failing_sink_stops_the_query_and_a_rerun_does_not_double_rows(spark, tmp_path, fitted):
    put(tmp_path / "in", "1.txt", messages(0, 10))

    def broken(batch, batch_id):
        raise OSError("database is down")

    with pytest.raises(Exception, match="database is down"):
        run(spark, tmp_path, fitted, {"broken": broken})
    assert read_appended(spark, str(tmp_path / "history")).count() == 10
    run(spark, tmp_path, fitted)
    assert read_appended(spark, str(tmp_path / "history")).count() == 10


def test_zero_fill_policy_scores_bad_messages_as_zeros(spark, fitted):
    raw = spark.createDataFrame([("junk",), ('{"a": 0.0, "b": 0.0}',)], "value string")
    rows = score_stream(raw, SPEC, fitted, policy="zero_fill").collect()
    assert len(rows) == 2 and rows[0] == rows[1]


def test_quarantined_rows_have_no_score(spark, fitted):
    raw = spark.createDataFrame([("junk",), (None,)], "value string")
    for r in score_stream(raw, SPEC, fitted).collect():
        assert not r.is_valid and r.predicted_label is None and r.malignant_probability is None


def test_intake_limit_makes_batches(spark, tmp_path, fitted):
    for i in range(3):
        put(tmp_path / "in", f"{i}.txt", messages(i, 1))
    run(spark, tmp_path, fitted, max_files=1)
    history = read_appended(spark, str(tmp_path / "history"))
    assert history.select("batch_id").distinct().count() == 3


def test_empty_batch(spark, tmp_path, fitted):
    put(tmp_path / "in", "1.txt", ["junk"])
    run(spark, tmp_path, fitted)
    assert read_appended(spark, str(tmp_path / "history")).count() == 0


def test_built_in_sink_and_progress(spark, tmp_path, fitted):
    log = monitor.ProgressLog()
    spark.streams.addListener(log)
    try:
        put(tmp_path / "in", "1.txt", messages(0, 5))
        scored = score_stream(text_stream(spark, tmp_path / "in"), SPEC, fitted, policy="zero_fill")
        q = write_stream(
            scored_message(scored, SPEC), "text", str(tmp_path / "cp"), None, path=str(tmp_path / "out")
        )
        monitor.wait_for([q], WAIT)
        assert spark.read.text(str(tmp_path / "out")).count() == 5
        assert not monitor.status([q])[0]["active"]
        for _ in range(50):
            if log.events:
                break
            __import__("time").sleep(0.1)
        assert sum(e["rows"] for e in log.events) == 5 and not log.failures
        assert monitor.totals_of(log, q) == {"rows": 5, "batches": 1, "largest": 5}
    finally:
        spark.streams.removeListener(log)


def test_wait_stops_what_still_runs(spark, tmp_path):
    put(tmp_path / "in", "1.txt", ["x"])
    q = write_stream(
        text_stream(spark, tmp_path / "in"), "parquet", str(tmp_path / "cp"), "500 milliseconds",
        path=str(tmp_path / "out"),
    )
    with pytest.raises(TimeoutError):
        monitor.wait_for([q], 2)
    assert not q.isActive


def event_files(spark, folder, batches):
    """One parquet file per batch, in order."""
    schema = "user string, id int, ts timestamp_ntz, predicted_label int"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/part={i}")
    return read_stream(
        spark, "files", f"{folder}/part=*", "parquet", schema, max_files=1
    )


T0 = datetime(2024, 1, 1)


def test_live_counts_over_batches(spark, tmp_path):
    stream = event_files(
        spark, tmp_path / "in", [[("u", 1, T0, 0), ("u", 2, T0, 1)], [("u", 3, T0, 1), ("u", 4, T0, None)]]
    )
    out = str(tmp_path / "out")
    q = fan_out(
        live.live_counts(stream), {"t": live.table_sink(out)}, str(tmp_path / "cp"), None, "complete"
    )
    monitor.wait_for([q], WAIT)
    found = {(r.predicted_label, r.n) for r in live.read_newest(spark, out).collect()}
    assert found == {(0, 1), (1, 2), (None, 1)}


def test_live_window_writes_closed_periods_once(spark, tmp_path):
    at = lambda s: T0 + timedelta(seconds=s)
    stream = event_files(
        spark,
        tmp_path / "in",
        [
            [("u", 1, at(1), 0), ("u", 2, at(4), 0)],
            [("u", 3, at(20), 1)],
            [("u", 4, at(21), 1)],
            [("u", 5, at(2), 0), ("u", 6, at(40), 1)],
        ],
    )
    periods = live.live_window(stream, "ts", "5 seconds", "10 seconds")
    q = write_stream(periods, "parquet", str(tmp_path / "cp"), None, path=str(tmp_path / "out"))
    monitor.wait_for([q], WAIT)
    found = spark.read.parquet(str(tmp_path / "out")).sort("start").collect()
    # The row at second 2 of the last batch comes after its period was closed.
    assert [(r.start, r.predicted_label, r.n) for r in found] == [(at(0), 0, 2), (at(20), 1, 2)]


def test_live_last_n_over_batches(spark, tmp_path):
    rows = [(u, i, T0 + timedelta(minutes=i), 0) for i in range(30) for u in ("hot", "hot", "b")[i % 3 :: 3]]
    stream = event_files(spark, tmp_path / "in", [rows[20:], rows[:10], rows[10:20]])
    out, order, by = str(tmp_path / "out"), ["ts", "id"], ["user"]
    sink = {"n": live.last_n_sink(out, 4, order, by)}
    monitor.wait_for([fan_out(stream, sink, str(tmp_path / "cp"), None)], WAIT)
    expected = {
        (u, i) for u in ("hot", "b") for i in sorted((r[1] for r in rows if r[0] == u), reverse=True)[:4]
    }
    found = live.read_last_n(spark, out, 4, order, by)
    assert {(r.user, r.id) for r in found.collect()} == expected


WINDOWED = "user string, id int, ts timestamp_ntz, predicted_label int"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def windows_of(spark, out):
    return {(r.start, r.predicted_label): (r.n, r.closed) for r in live.read_windows(spark, out).collect()}


def test_window_sink_keeps_open_periods_and_late_rows(spark, tmp_path):
    batches = [
        [("u", 1, at(1), 0), ("u", 2, at(4), 0)],
        [("u", 3, at(20), 1), ("u", 7, None, 1)],
        [("u", 4, at(21), 1)],
        [("u", 5, at(2), 0), ("u", 6, at(40), 1), ("u", 8, at(12), None)],
    ]
    stream, out = event_files(spark, tmp_path / "in", batches), str(tmp_path / "out")
    sink = {"w": live.window_sink(out, "ts", "5 seconds", "10 seconds")}
    monitor.wait_for([fan_out(stream, sink, str(tmp_path / "cp"), None)], WAIT)
    assert windows_of(spark, out) == {
        (at(0), 0): (2, True), (at(20), 1): (2, True), (at(40), 1): (1, False), (at(10), None): (1, True),
    }
    # Second 2 comes after its period was closed by second 20; one row has no time.
    assert {r.id for r in live.read_late(spark, out).collect()} == {5, 7}


def test_a_batch_run_again_decides_as_it_did(spark, tmp_path):
    out = str(tmp_path / "out")
    write = live.window_sink(out, "ts", "5 seconds", "10 seconds")
    frames = [spark.createDataFrame(rows, WINDOWED) for rows in ([("u", 1, at(1), 0)], [("u", 2, at(30), 0)], [("u", 3, at(2), 0)])]
    for batch_id in (0, 0, 1, 1, 2, 2):
        write(frames[batch_id], batch_id)
    assert windows_of(spark, out) == {(at(0), 0): (1, True), (at(30), 0): (1, False)}
    assert [r.id for r in live.read_late(spark, out).collect()] == [3]


def folders(path):
    return sorted(str(p.parent.relative_to(path)) for p in path.rglob("part-*.parquet"))


def test_fifty_batches_leave_few_folders(spark, tmp_path):
    """Newest rows, counts, history and complete results: none grows by a folder a batch."""
    order, by = ["ts", "id"], ["user"]
    newest = live.last_n_sink(str(tmp_path / "newest"), 3, order, by)
    periods = live.window_sink(str(tmp_path / "periods"), "ts", "5 seconds", "10 seconds")
    totals = live.table_sink(str(tmp_path / "totals"))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for b in range(50):
            first, second = (f"timestamp_ntz'{at(t)}'" for t in (b, b // 2))
            rows = spark.sql(
                f"SELECT * FROM VALUES ('hot', {b}, {first}, 0), ('hot', {100 + b}, {second}, 1) t(user, id, ts, predicted_label)"
            )
            newest(rows, b)
            if b < 20:
                periods(rows, b)
                totals(rows, b)
    finally:
        spark.conf.unset("spark.sql.shuffle.partitions")
    # Seven folders at most of each level, and what the commit before the last one lists.
    for name in ("newest", "periods/counts", "periods/late"):
        assert len(set(folders(tmp_path / name))) <= 7 + 6 + 1, folders(tmp_path / name)
    assert len(set(folders(tmp_path / "totals"))) == 2
    assert len(list((tmp_path / "newest" / "commits").glob("[0-9]*"))) == 2
    assert {r.id for r in live.read_last_n(spark, str(tmp_path / "newest"), 3, order, by).collect()} == {49, 48, 47}
    assert {r.id for r in live.read_newest(spark, str(tmp_path / "totals")).collect()} == {19, 119}
    counted = sum(n for n, _ in windows_of(spark, str(tmp_path / "periods")).values())
    assert counted + live.read_late(spark, str(tmp_path / "periods")).count() == 40


def test_history_is_merged_by_day_and_replayed(spark, tmp_path):
    table = append_table(str(tmp_path), ["date"])
    days = [f"2024-01-0{1 + b % 2}" for b in range(10)]
    for b, day in enumerate(days):
        for _ in range(2 if b in (7, 8, 9) else 1):
            table.commit(spark.createDataFrame([(b, day)], "id int, date string"), b)
    assert sorted((r.id, r.date) for r in table.read(spark).collect()) == list(enumerate(days))
    # Eight batches have become one folder with a folder a day, two are as they came.
    assert {f for f in folders(tmp_path) if f.startswith("table_level=1")} == {f"table_level=1/table_batch=7/date=2024-01-0{d}" for d in (1, 2)}
    assert len(table.last_commit(spark).folders) == 3
    with pytest.raises(FileNotFoundError):
        read_appended(spark, str(tmp_path / "nothing"))


def test_batch_folder_is_replaced_on_replay(spark, tmp_path):
    for n in (3, 5):
        write_batch(spark.range(n), str(tmp_path), 7)
    assert spark.read.parquet(str(tmp_path)).count() == 5


def test_unknown_stream_kind(spark):
    with pytest.raises(ValueError):
        read_stream(spark, "socket")
