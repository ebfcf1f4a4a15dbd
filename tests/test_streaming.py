"""Streams over several files give what the batch functions give on the same rows."""

import datetime

import pytest
from pyspark.sql import functions as F, types as T

from orderflow import fixtures as X
from orderflow.operators import normalize as N, state as S
from orderflow.registry import streams
from orderflow.streaming import pipelines as P, store

FOLDER = "/root/testdata/sf0.001"


def _raw_files(spark, path):
    """Payloads cut into files by time, so that each is one micro-batch."""
    raw = X.raw_events(X.events(spark, FOLDER))
    for n in range(4):
        raw.where(F.expr(f"(day(arrival_ts) - 1) div 10 = {n}")).coalesce(1).write.mode("append").parquet(path)
    return raw


def _stream(spark, path, schema):
    events = N.normalize(P.read_stream(spark, path, schema, maxFilesPerTrigger="1"))
    return events.withColumn("seq", F.col("event_id"))


def _bag(df):
    return sorted(map(str, df.collect()))


def _run(stream, path, add):
    P.run_available(P.merge_into(stream, str(path / "cp"), add))


def test_keyed_state_over_micro_batches(spark, tmp_path):
    raw = _raw_files(spark, str(tmp_path / "in"))
    table = P.status_table(spark, str(tmp_path / "table"))
    _run(_stream(spark, str(tmp_path / "in"), raw.schema), tmp_path, P.add_statuses(table))
    events = N.normalize(raw).withColumn("seq", F.col("event_id"))
    want = S.latest_orders(events).where(F.col("status").isNotNull()).select("order_id", "status")
    assert _bag(table.read().select("order_id", "status")) == _bag(want)
    assert table.manifest()["batch"] >= 3


def test_courier_signals_over_micro_batches(spark, tmp_path):
    raw = _raw_files(spark, str(tmp_path / "in"))
    holders, signals = P.holder_table(spark, str(tmp_path / "holders")), P.signal_table(spark, str(tmp_path / "signals"))
    _run(_stream(spark, str(tmp_path / "in"), raw.schema), tmp_path, P.add_signals(holders, signals))
    events = N.normalize(raw).withColumn("seq", F.col("event_id"))
    assert _bag(signals.read().select("courier_id", "available")) == _bag(S.courier_state(events))
    newest = S.courier_signals(events).groupBy("courier_id").agg(F.max(F.unix_micros("arrival_ts")).alias("arrival_us"))
    assert _bag(signals.read().select("courier_id", "arrival_us")) == _bag(newest)


def test_quarantine_splits_every_batch(spark, tmp_path):
    raw = _raw_files(spark, str(tmp_path / "in"))
    stream = P.read_stream(spark, str(tmp_path / "in"), raw.schema, maxFilesPerTrigger="1")
    out = str(tmp_path / "out")
    P.run_available(P.with_quarantine(stream, out, str(tmp_path / "cp")))
    good, bad = P.read_quarantined(spark, out, False), P.read_quarantined(spark, out, True)
    assert good.count() + bad.count() == raw.count()
    assert {r.event_type for r in bad.select("event_type").distinct().collect()} == {"UNKNOWN"}
    assert good.where(F.col("event_type") == "UNKNOWN").isEmpty()


def _orders(spark, rows):
    schema = "event_type string, order_id long, status string, courier_id long, courier_available boolean, at long, seq long"
    at = F.timestamp_seconds("at")
    return spark.createDataFrame(rows, schema).select("*", at.alias("event_ts"), at.alias("arrival_ts")).drop("at")


def test_holders_outlive_a_micro_batch(spark, tmp_path):
    """Assigned in one micro-batch, delivered in a later one; ids beyond 2^53 stay whole; a replayed batch changes nothing."""
    big = 2**53 + 1
    holders, signals = P.holder_table(spark, str(tmp_path / "holders")), P.signal_table(spark, str(tmp_path / "signals"))
    add = P.add_signals(holders, signals)
    batches = [
        [("COURIER_ASSIGNED", 1, None, big, None, 1, 1), ("COURIER_ASSIGNED", 2, None, 5, None, 1, 2)],
        [("STATUS_CHANGE", 3, "DELIVERED", None, None, 2, 3), ("COURIER_ASSIGNED", 2, None, 6, None, 3, 4)],
        [("STATUS_CHANGE", 1, "DELIVERED", None, None, 4, 5), ("STATUS_CHANGE", 2, "DELIVERED", None, None, 4, 6)],
    ]
    for n, rows in enumerate(batches):
        for _ in range(2):
            add(_orders(spark, rows), n)
    assert {r.courier_id: r.available for r in signals.read().collect()} == {big: True, 5: False, 6: True}
    assert {r.order_id: r.courier_id for r in holders.read().collect()} == {1: big, 2: 6}


def _numbers(spark, path, lifetime=None):
    schema = T.StructType.fromDDL("k long, n long, at long")
    return store.Table(spark, path, schema, ["k"], store.summed(["k"], at=F.max), "at", lifetime)


def _rows(spark, *rows):
    return spark.createDataFrame(rows, "k long, n long, at long")


def test_store_stays_small_and_whole(spark, tmp_path):
    table, want = _numbers(spark, str(tmp_path / "t")), {}
    for b in range(store.FAN**2 + 3):
        rows = [(k, b, b) for k in (b % 5, 100 + b, None)]
        for k, n, _ in rows:
            want[k] = want.get(k, 0) + n
        table.add(_rows(spark, *rows), b, counts={"rows": F.count("*")}, marks={"top": F.max("at")})
        if b % 10 == 0:
            table.add(_rows(spark, *rows), b, counts={"rows": F.count("*")})  # replayed after its commit
    assert {r.k: r.n for r in table.read().collect()} == want
    manifest = table.manifest()
    assert manifest["facts"] == {"rows": 3 * (store.FAN**2 + 3), "top": store.FAN**2 + 2}
    assert sorted(r["level"] for r in manifest["runs"]) == [0, 0, 0, 2]
    kept = {p.name for p in (tmp_path / "t/runs").iterdir()}
    assert kept == {r["name"] for r in manifest["runs"]} | set(manifest["gone"])


def test_store_after_a_failure(spark, tmp_path):
    """A batch that was written but not committed is written again; a lost newer manifest leaves the one before."""
    table = _numbers(spark, str(tmp_path / "t"))
    table.add(_rows(spark, (1, 10, 1)), 0)
    table._commit = None
    with pytest.raises(TypeError):
        table.add(_rows(spark, (1, 5, 2)), 1)
    table.__dict__.pop("_commit")
    assert [tuple(r) for r in table.read().collect()] == [(1, 10, 1)]
    table.add(_rows(spark, (1, 5, 2)), 1)
    assert [tuple(r) for r in table.read().collect()] == [(1, 15, 2)]


def test_store_lifetime_pruning_and_empty_batches(spark, tmp_path):
    table = _numbers(spark, str(tmp_path / "t"), lifetime=10)
    assert table.read().count() == 0
    for b in range(22):
        rows = _rows(spark, (b, 1, b), (500, 1, 0)) if b < 3 or b > 11 else _rows(spark, (1, 1, 1)).limit(0)
        table.add(rows, b)
    assert sorted(r.k for r in table.read().collect()) == list(range(12, 22))
    assert sorted(r.k for r in table.read(since=20).collect()) == [20, 21]
    held = spark.read.parquet(*[f"{tmp_path}/t/runs/{r['name']}" for r in table.manifest()["runs"] if r["rows"]])
    assert held.where("k < 3").isEmpty()  # what is too old has left with the merge of its run
    # only runs that reach the time are opened
    opened = table.read(since=20).inputFiles()
    assert 0 < len(opened) < len(held.inputFiles())


def test_late_rows_correct_their_window(spark, tmp_path):
    table = P.window_table(spark, str(tmp_path / "t"), {"event_type": "string"})
    add = P.add_windows(table, "1 hour", None, 3600)
    add(_orders(spark, [("A", 1, None, None, None, 100, 1), ("A", 1, None, None, None, 9000, 2)]), 0)
    add(_orders(spark, [("A", 1, None, None, None, 200, 3), ("A", 1, None, None, None, 5500, 4), ("B", 1, None, None, None, 20000, 5)]), 1)
    add(_orders(spark, [("B", 1, None, None, None, 16500, 6)]).where("seq < 0"), 2)
    add(_orders(spark, [("B", 1, None, None, None, 16300, 7)]), 3)
    got = sorted(tuple(r) for r in table.read().select("window_start", "event_type", "events", "late_events").collect())
    assert got == [(0, "A", 2, 1), (3600, "A", 1, 0), (7200, "A", 1, 0), (14400, "B", 1, 1), (18000, "B", 1, 0)]
    assert table.manifest()["facts"]["late"] == 2


def test_state_with_a_lifetime_is_bounded(spark, tmp_path):
    """Every key is seen for one hour only: its life comes out once and its state is gone, all but those still alive."""
    path = str(tmp_path / "in")
    schema = T.StructType.fromDDL("order_id long, status string, arrival_ts timestamp, seq long")
    for hour in range(12):
        rows = spark.range(40).select((F.col("id") + hour * 40).alias("order_id"), F.lit("S").alias("status"), F.timestamp_seconds(F.lit(hour * 3600) + F.col("id")).alias("arrival_ts"), F.col("id").alias("seq"))
        rows.coalesce(1).write.mode("append").parquet(path)
    P.end_input(spark, path, schema, arrival_ts=datetime.datetime(1970, 1, 3), order_id=-1)
    stream = P.read_stream(spark, path, schema, maxFilesPerTrigger="1")
    lives = P.sessions(stream, "order_id", "30 minutes", "0 seconds", status=F.col("status"))
    query = P.append_to(lives, str(tmp_path / "out"), str(tmp_path / "cp"))
    P.run_available(query)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) <= 3 * 40 and held[-1] == 1
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.order_id for r in got) == list(range(480)) and {r.status for r in got} == {"S"}
    assert all(r.end_us - r.first_us == 1800 * 10**6 and r.events == 1 for r in got)


def test_sketches_merge_over_micro_batches(spark, tmp_path):
    """The standard error of the default sketch is below 2 %; three of them bound the guess."""
    table = P.hourly_orders(spark, str(tmp_path / "t"))
    add = P.add_orders(table)
    for b in range(3):
        add(spark.range(20000).select((F.col("id") + 10000 * b).alias("order_id"), F.timestamp_seconds(F.lit(10)).alias("arrival_ts")), b)
    guess = table.read().select(F.hll_sketch_estimate("orders")).first()[0]
    assert abs(guess - 40000) <= 0.06 * 40000


def test_restart_continues_from_the_checkpoint(spark, tmp_path):
    raw = X.raw_events(X.events(spark, FOLDER)).select("event_id", "arrival_ts")
    raw.where("event_id < 500").write.parquet(str(tmp_path / "in"))

    def run():
        stream = P.read_stream(spark, str(tmp_path / "in"), raw.schema)
        P.run_available(P.append_to(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
        return spark.read.parquet(str(tmp_path / "out")).count()

    assert run() == 500
    raw.where("event_id >= 500").write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == raw.count()


def test_snapshots_per_micro_batch(spark, tmp_path):
    raw = _raw_files(spark, str(tmp_path / "in"))
    stream = _stream(spark, str(tmp_path / "in"), raw.schema)
    made = P.on_snapshot(stream, lambda b: b.groupBy("status").count(), str(tmp_path / "out"), str(tmp_path / "cp"), availableNow=True)
    P.run_available(made)
    assert spark.read.parquet(str(tmp_path / "out")).select("batch_id").distinct().count() >= 3


def _events(spark, folder, days, per_day=12):
    """An events table with so many events on each of the days of a month."""
    rows = [
        (n, datetime.datetime(2024, 1, day, i % 24, 0, 1), n % 9, ["signup", "view", "click", "purchase", "error"][n % 5], 1.0, '{"k": %d}' % (n % 90))
        for n, (day, i) in enumerate((d, i) for d in days for i in range(per_day))
    ]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/events.parquet")


def test_a_micro_batch_of_many_files(spark, tmp_path, monkeypatch):
    """Many rows are dealt to many files; a micro-batch has the same rows as with one file, also where there are few or none."""
    monkeypatch.setattr(streams, "FILE_ROWS", 10)
    _events(spark, str(tmp_path), [1, 2, 3, 4, 5, 11, 16, 17, 31])
    got, files = {}, {}

    def see(batch, batch_id):
        rows = batch.select("event_id", F.input_file_name().alias("file")).collect()
        got[batch_id], files[batch_id] = sorted(r.event_id for r in rows), len({r.file for r in rows})

    _run(streams.arrivals(spark, str(tmp_path), late=False), tmp_path, see)
    assert got == {0: list(range(60)), 1: [], 2: list(range(60, 72)), 3: list(range(72, 96)), 4: [], 5: [], 6: list(range(96, 108))}
    assert files[0] == 6


def test_pipelines_share_normalised_events(spark, tmp_path, monkeypatch):
    """The payloads are parsed before the pipelines part, and the samples are those of all events."""
    monkeypatch.setattr(streams, "FILE_ROWS", 10)
    _events(spark, str(tmp_path), range(1, 31))
    plans, fan_out = [], P.fan_out
    monkeypatch.setattr(P, "fan_out", lambda stream, *rest: plans.append(stream._jdf.queryExecution().analyzed().toString()) or fan_out(stream, *rest))
    got = streams.stream_pipeline_latency(spark, str(tmp_path)).collect()
    assert len(plans) == 1 and "payload" not in plans[0]
    batch = N.normalize(X.raw_events(X.events(spark, str(tmp_path))))
    latencies = batch.select(X.X.latency_ms(F.col("event_ts"), F.col("arrival_ts")).alias("ms"))
    most = latencies.agg(F.max("ms")).first()[0]
    assert {(r.pipeline, r.samples, r.max) for r in got} == {(p, latencies.count(), most) for p in ("status", "windows", "orders")}
