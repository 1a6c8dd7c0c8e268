"""Live totals, quantile sketches and the record log: restarts, late and repeated rows, bad records."""

from __future__ import annotations

import datetime as dt
import math
import os
import random

import pytest

from storelens.sources.record_log import RecordLog, RecordLogReader, lines_of, whole_lines
from storelens.streaming import streams
from tests.frames import rows, si_row, ts, world


def test_one_late_basket_reads_its_own_day(spark, tmp_path):
    base = str(tmp_path)
    days = [0, 1, 2, 3, 40, 70]
    si = [si_row(i, 1, i, ts(days[i % 6], 9), 10 * i) for i in range(1, 61)]
    late = [si_row(900, 1, 900, ts(2, 23), 5)]
    schema = world(spark, si).interactions().schema
    steps = []
    for k, batch in enumerate((si[:30], si[30:], late, si[:7] + late, [])):
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(f"{base}/src/{k}")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/src/*")
        steps += streams.live_kpis_job(stream, f"{base}/lake", f"{base}/sink", f"{base}/ck", f"late_day_{k}")
    assert [s["new"] for s in steps[:4]] == [30, 30, 1, 0]
    of_day = sum(ts(2).date() == r[3].date() for r in si)
    assert steps[2]["days"] == [ts(2).date()] and steps[2]["rows_read"] == of_day + 3  # its day's ids, its day's three sums
    assert steps[3]["baskets"] == 8 and steps[3]["new"] == 0
    got = rows(streams.latest_rows(spark, f"{base}/sink", ["day"]))
    assert got == rows(streams.live_kpis(world(spark, si + late).interactions(), None))


def test_shuffled_files_with_repeats_equal_the_batch(spark, tmp_path):
    base, rng = str(tmp_path), random.Random(4)
    si = [si_row(i, 1, i, ts(rng.randrange(50), 9), None if i % 13 == 0 else i) for i in range(200)]
    sent = si + rng.sample(si, 80)
    rng.shuffle(sent)
    schema = world(spark, si).interactions().schema
    for k in range(4):
        spark.createDataFrame(sent[k::4], schema).coalesce(1).write.parquet(f"{base}/src/{k}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/src/*")
    steps = streams.live_kpis_job(stream, f"{base}/lake", f"{base}/sink", f"{base}/ck", "shuffled")
    assert len(steps) == 4 and sum(s["new"] for s in steps) == 200
    assert rows(streams.latest_rows(spark, f"{base}/sink", ["day"])) == rows(streams.live_kpis(world(spark, si).interactions(), None))


EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def test_sketches_of_a_stream_answer_near_the_exact_rank(spark, tmp_path):
    base, rng, day = str(tmp_path), random.Random(3), dt.datetime(2024, 1, 1)
    data = [(k, day + dt.timedelta(seconds=rng.randrange(3 * 86400)), 1, "x",
             None if k % 19 == 0 else rng.choice([7.0, rng.gauss(0, 50), float(k)]), "{}") for k in range(30000)]
    data += [(99999, day + dt.timedelta(days=8), 1, "x", None, "{}")]
    for k in range(3):
        spark.createDataFrame(data[k::3], EVENTS).coalesce(1).write.parquet(f"{base}/src/{k}")
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{base}/src/*")
    streams.latency_sketch_job(stream, f"{base}/sink", f"{base}/ck", "sketches")
    sketches = spark.read.parquet(f"{base}/sink")
    assert sketches.count() >= 9  # a row a batch and day
    exact = {r.window_start: r for r in streams.latency_p95(spark.createDataFrame(data, EVENTS)).collect()}
    for r in streams.latency_from_sketches(sketches).collect():
        values = sorted(v for _, t, _, _, v, _ in data if t.date() == r.window_start.date() and v is not None)
        assert r.samples == exact[r.window_start].samples
        if not values:
            assert r.p95_value is None and exact[r.window_start].p95_value is None
            continue
        rank, slack = math.ceil(0.95 * len(values)), 0.02 * len(values)
        assert sum(v < r.p95_value - 1e-5 for v in values) < rank + slack
        assert sum(v <= r.p95_value + 1e-5 for v in values) >= rank - slack
        assert round(values[(95 * len(values) + 99) // 100 - 1], 6) == exact[r.window_start].p95_value


def test_p95_of_one_window_over_many_tasks(spark):
    """All values of one window share their whole part: they are spread over tasks, and the answer is exact."""
    t = dt.datetime(2024, 1, 1)
    events = spark.range(20000).selectExpr("timestamp_ntz '2024-01-01 00:00:00' as ts", "0.5 + (id * 7919 % 20000) / 100000.0D as value")
    got = streams.latency_p95(events).collect()
    assert [(r.window_start, r.p95_value, r.samples) for r in got] == [(t, round(0.5 + 18999 / 100000, 6), 20000)]
    assert streams.latency_p95(events.limit(0)).count() == 0


# ---------------------------------------------------------------- record log
def test_lines_by_stretches_are_each_read_once(tmp_path):
    rng = random.Random(1)
    text = b"".join(b"x" * rng.randrange(0, 30) + rng.choice([b"\n", b"\r\n"]) for _ in range(200)) + b"torn"
    path = tmp_path / "a.log"
    path.write_bytes(text)
    end = whole_lines(str(path), 0)
    assert end == text.rindex(b"\n") + 1
    whole = list(lines_of(str(path), 0, end))
    assert [x for _, x in whole] == text[:end].decode().replace("\r\n", "\n").split("\n")[:-1]
    for chunk in (1, 7, 64):
        reader = RecordLogReader({"path": str(tmp_path), "chunkBytes": str(chunk)})
        parts = reader.partitions({}, reader.latestOffset())
        assert [x for p in parts for x in lines_of(str(path), p.begin, p.end)] == whole
    assert whole_lines(str(path), end) == end


def test_restart_from_a_checkpoint_loses_and_repeats_nothing(spark, tmp_path):
    spark.dataSource.register(RecordLog)
    log, out = tmp_path / "log", {k: str(tmp_path / k) for k in ("sink", "bad", "ck")}
    log.mkdir()
    good = lambda k: f'{{"event_id": {k}, "ts": "2024-01-01T00:00:{k % 60:02d}.000000", "value": {k}.5}}'
    bad = ["no json", "", "[1, 2]", '{"event_id": "x"}', '{"ts": "2024-01-01T00:00:00.000000"}', '{"event_id": 5, "ts": null}', '"text"']
    schema = "event_id long, ts timestamp_ntz, value double"

    def run(k):
        lines = spark.readStream.format("record_log").option("chunkBytes", 100).load(str(log))
        return streams.ingest_records(lines, schema, out["sink"], out["bad"], out["ck"], ("event_id", "ts"), f"restart_{k}")

    (log / "a").write_text("\n".join([*map(good, range(20)), *bad]) + "\n" + good(20)[:15])
    assert run(0) == {"stored": 20, "quarantined": len(bad)}
    with open(log / "a", "a") as f:
        f.write(good(20)[15:] + "\n" + good(21) + "\n")
    (log / "b").write_text(good(22) + "\nbroken again\n")
    os.makedirs(log / "more")
    (log / "more" / "c").write_text(good(23) + "\n")
    assert run(1) == {"stored": 4, "quarantined": 1}
    assert sum(run(2).values()) == 0
    stored = spark.read.schema(schema).json(out["sink"])
    assert sorted(r.event_id for r in stored.collect()) == list(range(24))
    held = spark.read.parquet(out["bad"])
    assert sorted(r.value for r in held.collect()) == sorted([*bad, "broken again"])
    assert {r.reason for r in held.collect()} == {"not a record of the schema", "event_id is missing", "ts is missing"}
    assert held.select("partition", "position").distinct().count() == held.count()


def test_record_log_needs_a_path(spark):
    spark.dataSource.register(RecordLog)
    with pytest.raises(Exception, match="path"):
        spark.readStream.format("record_log").load().writeStream.format("noop").trigger(availableNow=True).start().awaitTermination()


def test_error_rate_and_heat_map_streams_equal_the_batch(spark, tmp_path):
    base, rng, t = str(tmp_path), random.Random(2), dt.datetime(2024, 1, 1)
    data = [(k, t + dt.timedelta(minutes=rng.randrange(600)), 1, rng.choice(["error", "view", "buy"]), rng.random(), "{}") for k in range(300)]
    for k in range(3):
        spark.createDataFrame(data[k::3], EVENTS).coalesce(1).write.parquet(f"{base}/src/{k}")
    batch = spark.createDataFrame(data, EVENTS)
    for name, rule, keys in (("rate", streams.error_rate, ["window_start"]), ("heat", streams.metric_heatmap, ["bucket_start", "component"])):
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{base}/src/*")
        told = streams.run_update_stream(rule(stream, watermark="1 day"), f"{base}/{name}", f"{base}/{name}-ck", name)
        assert told["rows_dropped_by_watermark"] == 0
        assert rows(streams.latest_rows(spark, f"{base}/{name}", keys)) == rows(rule(batch))
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{base}/src/*")
    streams.run_update_stream(streams.newest_event(stream), f"{base}/newest", f"{base}/newest-ck", "newest")
    newest = streams.latest_rows(spark, f"{base}/newest", ["one"])
    assert rows(streams.freshness(newest, t)) == rows(streams.freshness(batch, t))
