"""Edge cases from FIXTURES §4 with hand-computed expectations."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from storelens.operators import access, dashboards, metrics, procedures, views
from storelens.sources import sinks
from storelens.streaming import streams
from tests.frames import AS_OF, fixture_grants, rows, si_row, ts, world


def test_age_groups_else_branch(spark):
    # 17 and NULL fall into '65+' (ELSE branch); 65 is in '56-65'.
    ages = [17, 18, 25, 26, 65, 66, None]
    si = [si_row(i, 1, i, ts(1), 100, age=a) for i, a in enumerate(ages)]
    r = world(spark, si)
    out = dashboards.customer_analytics(r, AS_OF, 30)
    got = {g: n for g, n in rows(out, "age_group", "transaction_count")}
    assert got == {"65+": 3, "18-25": 2, "26-35": 1, "56-65": 1}


def test_empty_device_fleet_gives_null_not_error(spark):
    r = world(spark, [si_row(1, 1, 1, ts(0), 50)])
    empty_anomalies = spark.createDataFrame([], "type string, severity string, status string, "
                                                "created_at timestamp_ntz")
    out = dashboards.system_health(r, AS_OF, empty_anomalies).collect()[0]
    assert out["total_devices"] == 0
    assert out["device_uptime_percent"] is None
    assert out["overall_health_score"] is None
    assert out["total_transactions_today"] == 1


def test_rank_gaps_on_revenue_tie(spark):
    # Brand#1 and Brand#2 tie on revenue in NCR: ranks 1, 1, 3.
    si = [si_row(1, 1, 1, ts(1), 100), si_row(2, 1, 2, ts(1), 100), si_row(3, 1, 3, ts(1), 100)]
    items = [(1, 10, 2), (2, 20, 2), (3, 30, 1)]
    r = world(spark, si, items)
    got = rows(procedures.get_market_share(r, AS_OF), "brand_name", "rank_in_region", "market_share_percent")
    assert got == [("Brand#1", 1, 44.44), ("Brand#2", 1, 44.44), ("Brand#9", 3, 11.11)]
    # As written, a named brand always ranks first (rank after the filter).
    assert rows(procedures.get_market_share(r, AS_OF, brand="Brand#9"), "rank_in_region") == [(1,)]
    assert rows(procedures.market_share_ranked(r, AS_OF, brand="Brand#9"), "rank_in_region") == [(3,)]


def test_recency_bounds_are_closed(spark):
    # Last purchase exactly at as_of - 30 d is 'Recent'; - 90 d is 'Active'.
    si = [si_row(1, 1, 100, ts(30, 0), 50), si_row(2, 1, 200, ts(90, 0), 50), si_row(3, 1, 300, ts(91, 0), 50),
          si_row(4, 1, 400, ts(60, 0), 6000), si_row(5, 1, 400, ts(61, 0), 6000), si_row(6, 1, 400, ts(62, 0), 6000),
          si_row(7, 1, 400, ts(63, 0), 6000), si_row(8, 1, 400, ts(64, 0), 6000)]
    out = views.customer_segments(spark and world(spark, si), AS_OF)
    got = {c: (rec, seg) for c, rec, seg in rows(out, "customer_id", "recency_segment", "customer_segment")}
    assert got[100] == ("Recent", "Active")
    assert got[200] == ("Active", "At Risk")
    assert got[300] == ("Inactive", "At Risk")
    assert got[400] == ("Active", "Loyal")  # >= 5000, >= 5 baskets, seen exactly 60 days ago


def test_dq_orphans_nulls_and_future(spark):
    si = [si_row(1, 1, 1, ts(1), None), si_row(2, 1, 2, ts(-3), 100), si_row(3, 1, 3, ts(2), 0)]
    items = [(1, 10, 1), (99, 10, 1)]  # interaction 99 does not exist
    r = world(spark, si, items)
    out = {c: (v, ok, pen) for c, v, ok, pen in rows(metrics.dq_score(r, dt.datetime(2001, 8, 1, 23, 59)))}
    assert out["null_percentage"] == (33.33, False, 20)
    assert out["future_transactions"] == (1.0, False, 15)
    assert out["orphaned_items"] == (1.0, False, 15)
    assert out["avg_transaction_amount"] == (50.0, True, 0)  # mean of 100 and 0 lies in [20, 500]
    assert out["data_quality_score"][0] == 100 - 20 - 15 - 15


def test_audit_changes_and_cdc_diff(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", None), (3, "c", 30)], "id int, name string, qty int")
    new = spark.createDataFrame([(1, "a", 11), (2, "b", 20), (4, "d", 40)], "id int, name string, qty int")
    audit = access.audit_changes(old, new, "id", "t", user_id=7)
    got = rows(audit, "row_key", "action")
    assert got == [(1, "UPDATE"), (2, "UPDATE"), (3, "DELETE"), (4, "INSERT")]
    deleted = audit.where("action = 'DELETE'").collect()[0]
    assert deleted["new_data"] is None and '"qty":30' in deleted["old_data"]
    diff = rows(streams.cdc_diff(old, new, "id"))
    assert diff == [(1, "qty", "10", "11"), (2, "qty", None, "20")]


def test_csv_quoting(spark):
    df = spark.createDataFrame([(1, 'say "hi", ok', True), (2, "line\nbreak", None), (None, None, False)],
                               "n int, s string, b boolean")
    got = [r["line"] for r in sinks.csv_lines(df).collect()]
    assert got == ['1,"say ""hi"", ok",true', '2,"line\nbreak",', ',,false']
    path = tempfile.mkdtemp(prefix="csv-") + "/out"
    back = sinks.export_csv(df.repartition(3), path)
    key = lambda r: str(r)
    assert sorted(back.collect(), key=key) == sorted(df.collect(), key=key)
    for part in [f for f in os.listdir(path) if f.startswith("part-")]:  # every file is a whole CSV
        text = open(f"{path}/{part}").read()  # an empty task leaves an empty file
        assert not text or text.startswith("n,s,b\n")
    sinks.export_csv(df, path)
    assert sinks.export_csv(df, path).count() == 3  # a second run replaces the first


def test_policy_modes(spark):
    si = [si_row(1, 1, 1, ts(10), 10), si_row(2, 2, 2, ts(100), 10), si_row(3, 3, 3, ts(5), 10)]
    r = world(spark, si)
    grants = fixture_grants(spark).withColumn("store_id", F.when(F.col("store_id") == 3, 1)
                                                      .when(F.col("store_id") == 5, 3).otherwise(F.col("store_id")))
    df = r.interactions()
    kw = dict(r=r, as_of=AS_OF, grants=grants)
    # analyst at night: 90-day policy only; in business hours (as written) everything.
    assert rows(access.apply_policy(df, "sales_interactions", "data_analyst", hour=22, **kw), "interaction_id") \
        == [(1,), (3,)]
    assert len(rows(access.apply_policy(df, "sales_interactions", "data_analyst", hour=10, **kw))) == 3
    assert rows(access.apply_policy(df, "sales_interactions", "data_analyst", hour=10, mode="restrictive", **kw),
                "interaction_id") == [(1,), (3,)]
    # manager 7: as written the revoked grant (store 3 here) still admits; strict does not.
    assert rows(access.apply_policy(df, "sales_interactions", "store_manager", hour=22, user_id=7, **kw),
                "interaction_id") == [(1,), (3,)]
    assert rows(access.apply_policy(df, "sales_interactions", "store_manager", hour=10, user_id=7, mode="strict",
                                    **kw), "interaction_id") == [(1,)]
    # no policy -> nothing
    assert access.apply_policy(df, "anomalies", "data_analyst", **kw).count() == 0


def test_grant_and_revoke(spark):
    g = fixture_grants(spark)
    now = dt.datetime(2001, 8, 1)
    # user 1 is admin of store 3: may grant user 7 write on store 3 (upsert keeps id 1).
    state, audit = access.grant_access(g, granting_user=1, user_id=7, store_id=3, access_level="write", now=now)
    row = state.where("user_id = 7 AND store_id = 3").collect()
    assert len(row) == 1 and row[0]["access_level"] == "write" and row[0]["id"] == 1
    assert audit.count() == 1 and state.count() == g.count()
    # user 9 is not admin of store 3: nothing changes, no audit row.
    state2, audit2 = access.grant_access(g, granting_user=9, user_id=12, store_id=3, now=now)
    assert audit2.count() == 0 and state2.count() == g.count()
    state3, _ = access.revoke_access(g, revoking_user=1, user_id=7, store_id=3, now=now)
    assert state3.where("user_id = 7 AND store_id = 3").collect()[0]["is_active"] is False
    expired = access.expire_access(g, now)
    assert rows(expired.where("NOT is_active"), "id") == [(2,), (3,)]


def test_store_dashboard_device_fanout(spark):
    # Store 1 has two devices with the same (status, last_seen): sums double; store 3 is idle.
    si = [si_row(1, 1, 1, ts(1), 100, infl=True), si_row(2, 1, 2, ts(2), 50)]
    items = [(1, 10, 1), (1, 30, 2), (2, 10, 1)]
    seen = dt.datetime(2001, 8, 1, 6)
    devices = [(1, 1, "active", seen), (2, 1, "active", seen), (3, 2, "offline", dt.datetime(2001, 7, 1))]
    r = world(spark, si, items, devices)
    out = {x[0]: x[1:] for x in rows(dashboards.store_performance_dashboard(r, AS_OF), "store_id", "transactions_30d",
                                     "revenue_30d", "influence_rate_percent", "performance_tier",
                                     "device_alert", "connectivity_alert")}
    # as written: basket 1 has two item rows, basket 2 one row -> (2*100 + 50) * 2 devices
    assert out[1] == (2, Decimal("500.00"), 200.0, "Underperformer", None, None)
    assert out[2] == (0, None, None, "No Activity", "Device Issue", "Connectivity Issue")
    assert out[3] == (0, None, None, "No Activity", None, None)


def test_repeat_rate_blocks_match_window_definition(spark):
    # customer 1: gaps 40 d, 29 d -> repeat; 2: gap exactly 30 d -> repeat; 3: 31 d -> no; 4: one purchase.
    si = [si_row(1, 1, 1, ts(100), 1), si_row(2, 1, 1, ts(60), 1), si_row(3, 1, 1, ts(31), 1),
          si_row(4, 1, 2, ts(50, 0), 1), si_row(5, 1, 2, ts(20, 0), 1),
          si_row(6, 1, 3, ts(80, 0), 1), si_row(7, 1, 3, ts(49, 0), 1), si_row(8, 1, 4, ts(5), 1)]
    out = metrics.repeat_rate(world(spark, si), AS_OF).collect()[0]
    assert (out["customers"], out["repeat_customers"], out["repeat_rate_percent"]) == (4, 2, 50.0)


def test_stream_late_row_dropped(spark):
    base = tempfile.mkdtemp(prefix="stream-")
    src, sink, ck = f"{base}/src", f"{base}/sink", f"{base}/ck"
    os.makedirs(src)
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"

    def write(name, data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{src}/{name}")

    t = dt.datetime(2024, 1, 1, 12, 0)
    write("a", [(1, t, 1, "error", 1.0, "{}"), (2, t + dt.timedelta(seconds=5), 1, "error", 1.0, "{}")])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    agg = streams.error_bins(stream, "10 minutes", min_errors=0)
    q = (agg.writeStream.outputMode("update")
         .foreachBatch(lambda df, bid: df.write.mode("overwrite").parquet(f"{sink}/batch_id={bid}"))
         .option("checkpointLocation", ck).start())
    q.processAllAvailable()
    write("b", [(3, t + dt.timedelta(hours=2), 1, "error", 1.0, "{}")])  # advances the watermark
    q.processAllAvailable()
    write("c", [(4, t + dt.timedelta(seconds=30), 1, "error", 1.0, "{}")])  # 2 h late: dropped
    q.processAllAvailable()
    q.stop()
    got = rows(streams.latest_rows(spark, sink, ["bin_start"]), "bin_start", "error_count")
    assert got == [(t, 2), (t + dt.timedelta(hours=2), 1)]


def test_streaming_equals_batch_live_kpis(spark):
    si = [si_row(i, 1 + i % 3, i, ts(i % 5, 8 + i % 10), 10 * i) for i in range(1, 40)]
    r = world(spark, si)
    batch = rows(streams.live_kpis(r.interactions(), watermark=None))
    base = tempfile.mkdtemp(prefix="live-")
    r.interactions().write.parquet(f"{base}/src")
    stream = spark.readStream.schema(r.interactions().schema).parquet(f"{base}/src")
    streams.run_update_stream(streams.live_kpis(stream, "10 days"), f"{base}/sink", f"{base}/ck", "live_test")
    assert rows(streams.latest_rows(spark, f"{base}/sink", ["day"])) == batch


def test_latency_p95_is_nearest_rank(spark):
    """Exact at any size: windows with far more than 10000 values, ties, NULLs and negative values."""
    import random

    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    data = [(base + dt.timedelta(minutes=rnd.randrange(2880)), rnd.choice([None, 7.0, round(rnd.uniform(-5, 3), 4)]))
            for _ in range(40000)] + [(base + dt.timedelta(days=9), None)]
    ev = spark.createDataFrame(data, "ts timestamp_ntz, value double")
    got = {r["window_start"].date(): (r["p95_value"], r["samples"]) for r in streams.latency_p95(ev).collect()}
    by_day: dict = {}
    for t, v in data:
        by_day.setdefault(t.date(), []).append(v)
    for day, values in by_day.items():
        known = sorted(v for v in values if v is not None)
        want = known[(95 * len(known) + 99) // 100 - 1] if known else None
        assert got[day] == (want, len(values))


def test_retail_from_catalog(spark):
    # Retail tables registered in the catalog (here temp views) feed the same operators.
    si = [si_row(1, 1, 1, ts(1), 100), si_row(2, 3, 2, ts(2), 50)]
    src = world(spark, si, [(1, 10, 1), (2, 30, 2)])
    for name in ("brands", "products", "ph_regions", "stores", "transaction_items"):
        src.table(name).createOrReplaceTempView(f"cat_{name}")
    src.interactions().createOrReplaceTempView("cat_sales_interactions")
    names = {t: f"cat_{t}" for t in ("brands", "products", "ph_regions", "stores", "transaction_items",
                                      "sales_interactions")}
    from storelens.sources.retail import Retail

    r = Retail.from_catalog(spark, names=names)
    assert rows(views.brand_competition(r, AS_OF, 30), "brand_name", "transactions") == \
        rows(views.brand_competition(src, AS_OF, 30), "brand_name", "transactions")


def test_live_kpis_drop_duplicate_delivery(spark):
    # The same basket delivered twice in different micro-batches counts once.
    base = tempfile.mkdtemp(prefix="dup-")
    schema = spark.createDataFrame([si_row(1, 1, 1, ts(1), 10)], "interaction_id long, store_id int, "
                                   "customer_id long, transaction_date timestamp_ntz, total_amount decimal(18,2), "
                                   "is_attendant_influenced boolean, substitution_occurred boolean, gender string, "
                                   "age int, emotion string, duration_seconds long").schema

    def write(name, data):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{base}/src/{name}")

    write("a", [si_row(1, 1, 1, ts(1, 9), 10), si_row(2, 1, 2, ts(1, 10), 20)])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/src/*")
    q = (streams.live_kpis(stream, "10 days").writeStream.outputMode("update")
         .foreachBatch(lambda df, bid: df.write.mode("overwrite").parquet(f"{base}/sink/batch_id={bid}"))
         .option("checkpointLocation", f"{base}/ck").start())
    q.processAllAvailable()
    write("b", [si_row(2, 1, 2, ts(1, 10), 20), si_row(3, 1, 3, ts(1, 11), 30)])  # basket 2 again
    q.processAllAvailable()
    q.stop()
    got = rows(streams.latest_rows(spark, f"{base}/sink", ["day"]), "day", "transactions", "revenue")
    assert got == [(ts(1).date(), 3, Decimal("60.00"))]


def test_live_kpis_job_keeps_late_baskets(spark):
    """A basket that comes days after its day still counts there; the resolved days equal the batch."""
    si = [si_row(i, 1, i, ts(1 + i % 4, 9), 10 * i) for i in range(1, 13)]
    late = [si_row(50, 1, 50, ts(1, 10), 30), si_row(3, 1, 3, ts(4, 9), 30)]  # late, and delivered again
    r = world(spark, si + late[:1])
    schema = r.interactions().schema
    base = tempfile.mkdtemp(prefix="late-")
    for k, rows_ in enumerate((si[:6], si[6:], late)):
        spark.createDataFrame(rows_, schema).coalesce(1).write.parquet(f"{base}/src/{k}")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/src/*")
        streams.live_kpis_job(stream, f"{base}/lake", f"{base}/sink", f"{base}/ck", f"late_{k}")
    got = rows(streams.latest_rows(spark, f"{base}/sink", ["day"]), "day", "transactions", "revenue")
    assert got == rows(streams.live_kpis(r.interactions(), None), "day", "transactions", "revenue")


def _event_files(spark, base, batches):
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    for k, data in enumerate(batches):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{base}/src/{k}")
    return schema


def test_threshold_alert_is_taken_back(spark):
    """A later batch pulls the window's mean below the threshold: the alert goes."""
    t = dt.datetime(2024, 1, 1, 12, 0)
    first, second = [(1, t, 1, "cpu", 90.0, "{}")], [(k, t, 1, "cpu", 1.0, "{}") for k in range(2, 9)]
    base = tempfile.mkdtemp(prefix="alert-")
    schema = _event_files(spark, base, [first])
    for k in (0, 1):
        if k:
            spark.createDataFrame(second, schema).coalesce(1).write.parquet(f"{base}/src/1")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/src/*")
        streams.run_update_stream(streams.metric_threshold_windows(stream, 50.0, "1 hour"), f"{base}/sink", f"{base}/ck", f"a{k}")
        alerts = streams.firing(streams.latest_rows(spark, f"{base}/sink", ["window_start", "metric"]))
        assert alerts.count() == (0 if k else 5)
    batch = streams.metric_threshold_alert(spark.createDataFrame(first + second, schema), 50.0)
    assert batch.count() == 0


def test_dropped_rows_are_counted_over_all_batches(spark):
    t = dt.datetime(2024, 1, 1, 12, 0)
    base = tempfile.mkdtemp(prefix="drop-")
    hours = dt.timedelta(hours=1)
    batches = [[(1, t, 1, "error", 1.0, "{}")], [(2, t + 5 * hours, 1, "error", 1.0, "{}")],
               [(3, t, 1, "error", 1.0, "{}")], [(4, t + hours, 1, "error", 1.0, "{}")]]
    dropped = 0
    for k, batch in enumerate(batches):
        schema = _event_files(spark, f"{base}/{k}", [batch])
        os.makedirs(f"{base}/src", exist_ok=True)
        os.rename(f"{base}/{k}/src/0", f"{base}/src/{k}")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/src/*")
        dropped += streams.run_update_stream(streams.error_bins(stream, "10 minutes", 0), f"{base}/sink", f"{base}/ck",
                                             f"d{k}")["rows_dropped_by_watermark"]
    assert dropped == 2


def test_error_bursts_stream(spark):
    """Both groupings in one append-mode stream equal the batch rule for the periods that the watermark has closed."""
    t = dt.datetime(2024, 1, 1, 12, 0)
    minute = dt.timedelta(minutes=1)
    data = [(k, t + minute * (k // 3), 1, "error", 1.0, "{}") for k in range(40)]
    base = tempfile.mkdtemp(prefix="burst-")
    schema = _event_files(spark, base, [data, [(99, t + 120 * minute, 1, "error", 1.0, "{}")]])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/src/*")
    streams.run_update_stream(streams.error_bursts(stream, "10 minutes", 2), f"{base}/sink", f"{base}/ck", "burst", mode="append")
    got = rows(spark.read.parquet(f"{base}/sink").drop("batch_id"))
    want = rows(streams.error_burst_alert(streams.error_bins(spark.createDataFrame(data, schema), None, 2)))
    assert got == want and want
