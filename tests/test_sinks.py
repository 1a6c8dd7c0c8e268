"""Sinks, snapshots, alert payload and CDC routing (the keys without SQL oracles)."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from storelens.operators import procedures
from storelens.sources import sinks
from storelens.streaming import streams
from tests.frames import AS_OF


def test_lifecycle_tiers(spark):
    now = dt.datetime(2024, 6, 1)
    inv = spark.createDataFrame(
        [("a", now - dt.timedelta(days=10), 1), ("b", now - dt.timedelta(days=31), 1),
         ("c", now - dt.timedelta(days=91), 1), ("d", now - dt.timedelta(days=366), 1)],
        "name string, last_modified timestamp, content_length long")
    got = {r["name"]: r["action"] for r in sinks.lake_lifecycle_plan(inv, now).collect()}
    assert got == {"a": "hot", "b": "cool", "c": "archive", "d": "delete"}


def test_raw_zone_append_counts_records(spark, tmp_path):
    df = spark.range(137).withColumnRenamed("id", "x")
    back, count = sinks.raw_zone_append(df, str(tmp_path), "t", dt.datetime(2024, 1, 1))
    assert count == 137 and back.count() == 137
    again, count = sinks.raw_zone_append(df, str(tmp_path), "t", dt.datetime(2024, 1, 1))
    assert count == 137 and again.count() == 137  # a batch of the same second has a folder of its own
    for _ in range(2):  # a named batch is replaced
        named, _ = sinks.raw_zone_append(df, str(tmp_path), "u", dt.datetime(2024, 1, 1), batch="b1")
    assert named.count() == spark.read.json(str(tmp_path / "raw-data" / "u" / "*")).count() == 137
    inv = sinks.file_inventory(spark, str(tmp_path / "raw-data"))
    assert inv.where(F.col("name").endswith(".json")).count() >= 1


def test_export_json_rerun_replaces_the_day(spark, tmp_path):
    df = spark.range(5)
    for _ in range(2):
        assert sinks.export_json(df, str(tmp_path), "c", dt.date(2024, 1, 1)).count() == 5
    assert sinks.export_json(df, str(tmp_path), "c", dt.date(2024, 1, 2)).count() == 5


def test_refresh_error_is_kept_whole(spark, tmp_path):
    import pytest

    text = 'no "quotes" lost\n' + "x" * 900
    bad = spark.range(1).select(F.raise_error(F.lit(text)))
    with pytest.raises(Exception, match="quotes"):
        sinks.snapshot_refresh(spark, str(tmp_path), "v", bad, dt.datetime(2024, 1, 1))
    row = spark.read.parquet(str(tmp_path / "_audit")).where("action = 'REFRESH_ERROR'").first()
    payload = json.loads(row["new_data"])
    assert payload["view"] == "v" and text in payload["error"]


def test_json_payloads_keep_microseconds(spark):
    from storelens.operators import access

    t = dt.datetime(2024, 1, 1, 1, 2, 3, 456789)
    new = spark.createDataFrame([(1, t)], "id long, at timestamp_ntz")
    row = access.audit_changes(new.limit(0), new, "id", "t").first()
    assert json.loads(row["new_data"])["at"].startswith("2024-01-01T01:02:03.456789")


def test_snapshot_ttl(spark, tmp_path):
    base = str(tmp_path)
    calls = []

    def build():
        calls.append(1)
        return spark.range(len(calls) * 10)

    t0 = dt.datetime(2024, 1, 1, 12, 0)
    assert sinks.snapshot_if_stale(spark, base, "v", build, 300, t0).count() == 10
    # within the TTL: the stored version is read, no rebuild
    assert sinks.snapshot_if_stale(spark, base, "v", build, 300, t0 + dt.timedelta(seconds=200)).count() == 10
    assert len(calls) == 1
    # after the TTL: rebuilt as a new version
    assert sinks.snapshot_if_stale(spark, base, "v", build, 300, t0 + dt.timedelta(seconds=400)).count() == 20
    assert spark.read.parquet(f"{base}/_manifest").count() == 2
    actions = {r["action"] for r in spark.read.parquet(f"{base}/_audit").collect()}
    assert actions == {"REFRESH_START", "REFRESH_COMPLETE"}


def test_alert_payload_json_and_null(spark):
    alerts = spark.createDataFrame([("A", "high", "m1", 3), ("B", "low", "m2", 7)],
                                   "alert_type string, severity string, message string, affected_count int")
    row = procedures.alert_payload(alerts, AS_OF).collect()[0]
    payload = json.loads(row["new_data"])
    assert sorted(a["alert_type"] for a in payload) == ["A", "B"]
    empty = procedures.alert_payload(alerts.limit(0), AS_OF).collect()[0]
    assert empty["new_data"] is None


def test_cdc_route_batches(spark, tmp_path):
    src = tmp_path / "src"
    events = spark.createDataFrame(
        [("products", "INSERT", '{"id":1}', None, dt.datetime(2024, 1, 1)),
         ("products", "UPDATE", '{"id":2,"p":3}', '{"id":2,"p":2}', dt.datetime(2024, 1, 1)),
         ("customers", "UPDATE", '{"id":9}', '{"id":9,"x":1}', dt.datetime(2024, 1, 1)),
         ("customers", "INSERT", '{"id":10}', None, dt.datetime(2024, 1, 1))],
        "table string, eventType string, new string, old string, commit_ts timestamp")
    events.write.json(str(src))
    out = str(tmp_path / "out")
    streams.cdc_route(spark, str(src), out, str(tmp_path / "ck"))
    raw = spark.read.json(f"{out}/raw-data")
    assert raw.count() == 2 and {r["table"] for r in raw.collect()} == {"products", "customers"}
    cust = spark.read.json(f"{out}/customer-changes")
    assert sorted((r["customerId"], r["change_type"]) for r in cust.collect()) == [("10", "INSERT"), ("9", "UPDATE")]
    trail = {r["record_id"]: json.loads(r["changes"]) for r in spark.read.json(f"{out}/audit-trail").collect()}
    assert trail == {"2": {"p": {"from": "2", "to": "3"}}, "9": {}}
