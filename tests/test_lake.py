"""Commit log, incremental refresh, contract loading, snapshot diff, compaction: state, concurrency and odd rows."""

from __future__ import annotations

import datetime as dt
import json
import os
import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from storelens.operators import access, diff, incremental, views
from storelens.sources import contract, sinks
from storelens.sources.commits import CommitLog
from storelens.sources.files import Files
from storelens.streaming import streams
from tests.frames import AS_OF, rows, si_row, ts, world


# ------------------------------------------------------------ files, commits
def test_create_new_lets_one_win(spark, tmp_path):
    files, won = Files(spark), []

    def claim(k):
        if files.create_new(f"{tmp_path}/c/00000001.json", f"writer {k} " * 1000):
            won.append(k)

    threads = [threading.Thread(target=claim, args=(k,)) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and files.read(f"{tmp_path}/c/00000001.json") == f"writer {won[0]} " * 1000
    assert [e.name for e in files.entries(f"{tmp_path}/c") if not e.name.endswith(".crc")] == ["00000001.json"]
    assert files.entries(f"{tmp_path}/none") == [] and not files.exists(f"{tmp_path}/none")


def test_commits_of_many_writers_are_all_kept(spark, tmp_path):
    base = str(tmp_path)

    def write(k):
        CommitLog(spark, base).commit(lambda t: t | {f"t{k}": {"path": f"{base}/t{k}/v=1"}})

    threads = [threading.Thread(target=write, args=(k,)) for k in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    number, tables = CommitLog(spark, base).latest()
    assert number == 6 and sorted(tables) == [f"t{k}" for k in range(6)]
    assert CommitLog(spark, base).commit(lambda t: None) == (6, tables)


def test_two_stale_callers_give_one_version(spark, tmp_path):
    base, now = str(tmp_path), dt.datetime(2024, 1, 1, 12)
    both = threading.Barrier(2)
    seen = []

    def build(k):
        def run():
            both.wait(60)  # both have found the view stale
            return spark.range(10 + k)
        return run

    def call(k):
        seen.append(sinks.snapshot_if_stale(spark, base, "v", build(k), 300, now).count())

    threads = [threading.Thread(target=call, args=(k,)) for k in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(seen) == 2 and seen[0] == seen[1] and seen[0] in (10, 11)
    assert CommitLog(spark, base).numbers() == [1]
    assert len([e for e in Files(spark).entries(f"{base}/v") if e.is_folder]) == 1
    assert spark.read.parquet(f"{base}/_manifest").count() == 1


def test_crash_before_publishing_is_harmless(spark, tmp_path):
    base, now = str(tmp_path), dt.datetime(2024, 1, 1)
    sinks.snapshot_refresh(spark, base, "v", spark.range(3), now)
    lost = sinks.write_version(spark, base, "v", spark.range(99), now)  # its writer dies here
    assert sinks.snapshot_if_stale(spark, base, "v", lambda: spark.range(1), 300, now).count() == 3
    log = CommitLog(spark, base)
    assert log.vacuum() == []  # it may still be at work
    later = dt.datetime.now() + dt.timedelta(days=3)
    assert log.vacuum(later) == [lost[2].split(f"{base}/")[1]]
    for k in range(4):
        sinks.snapshot_refresh(spark, base, "v", spark.range(k), now + dt.timedelta(hours=k))
    removed = log.vacuum(later, keep=2)
    assert len(removed) == 3 and len(log.numbers()) == 2
    assert spark.read.parquet(log.latest()[1]["v"]["path"]).count() == 3
    assert sinks.latest_snapshot(spark, base, "v").first()["row_count"] == 3
    assert sinks.latest_snapshot(spark, base, "w") is None


# ------------------------------------------------------- incremental refresh
def baskets(spark, n=60):
    return world(spark, [si_row(i, 1 + i % 3, None if i % 11 == 0 else 40_000 * (i % 7) + i % 5, ts(i % 9, 7 + i % 13),
                                None if i % 17 == 0 else 10 * i, i % 2 == 0, i % 5 == 0) for i in range(n)])


def test_refresh_reads_only_the_changed_day(spark, tmp_path):
    r = baskets(spark)
    lake, base = f"{tmp_path}/lake", f"{tmp_path}/base"
    sinks.export_transactions(r.interactions(), lake)
    first = incremental.refresh(spark, lake, base)
    assert len(first["changed"]) == 9 and first["rows_read"] == 60
    assert incremental.refresh(spark, lake, base) == {"changed": [], "removed": [], "rows_read": 0}

    day = (AS_OF - dt.timedelta(days=4)).isoformat()
    changed = r.interactions().where((F.to_date("transaction_date") != F.lit(day).cast("date")) | (F.col("interaction_id") % 2 == 0))
    of_day = changed.where(F.to_date("transaction_date") == F.lit(day).cast("date"))
    of_day.write.mode("overwrite").parquet(f"{lake}/sale_date={day}")
    again = incremental.refresh(spark, lake, base)
    assert again == {"changed": [day], "removed": [], "rows_read": of_day.count()} and 0 < again["rows_read"] < 60

    whole = f"{tmp_path}/whole"
    incremental.refresh(spark, lake, whole)
    for table in incremental.TABLES:
        got, want = (incremental.partials(spark, b, table) for b in (base, whole))
        assert rows(got) == rows(want) and rows(got)
    shrunk = world(spark, [tuple(x) for x in changed.collect()])
    assert rows(incremental.daily_sales(spark, base, r.stores, AS_OF, 90)) == rows(views.daily_sales(shrunk, AS_OF, 90))


def test_a_day_that_goes_and_one_that_comes(spark, tmp_path):
    r = baskets(spark)
    lake, base = f"{tmp_path}/lake", f"{tmp_path}/base"
    sinks.export_transactions(r.interactions(), lake)
    incremental.refresh(spark, lake, base)
    gone, new = (AS_OF - dt.timedelta(days=2)).isoformat(), (AS_OF - dt.timedelta(days=20)).isoformat()
    os.rename(f"{lake}/sale_date={gone}", f"{lake}/sale_date={new}")
    assert incremental.refresh(spark, lake, base)["removed"] == [gone]
    dates = {x.sale_date.isoformat() for x in incremental.partials(spark, base, "hours").collect()}
    assert gone not in dates and new in dates
    assert incremental.partials(spark, base, "hours", AS_OF + dt.timedelta(days=5)).count() == 0
    assert incremental.partials(spark, f"{tmp_path}/empty", "customers").count() == 0


def test_region_windows_equal_distinct_counts(spark, tmp_path):
    r = baskets(spark)
    lake, base = f"{tmp_path}/lake", f"{tmp_path}/base"
    sinks.export_transactions(r.interactions(), lake)
    incremental.refresh(spark, lake, base)
    got = incremental.region_windows(spark, base, r.stores, AS_OF, (2, 5, 90))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    region = {x.id: x.region for x in r.stores.collect()}
    for x in got.collect():
        own = [b for b in r.interactions().collect() if region[b.store_id] == x.region
               and b.transaction_date.date() >= AS_OF - dt.timedelta(days=x.days)]
        assert (x.transactions, x.store_count) == (len(own), len({b.store_id for b in own}))
        assert x.unique_customers == len({b.customer_id for b in own if b.customer_id is not None})
        assert x.revenue == sum((b.total_amount for b in own if b.total_amount is not None), Decimal(0))
    assert got.count() == 6


# ------------------------------------------------------------------ contract
def test_contract_loads_and_rejects_with_reasons(spark):
    feed = spark.createDataFrame(
        [("1", "milk", "2", "Dairy", "true", "10.00", "x"), ("2", None, " 3 ", "Dairy", "FALSE", "0", "x"),
         ("3", "a", "b", "", None, "-1", "x"), (None, None, None, None, None, None, None),
         ("4", "tea", "5", "Tea", "yes", "12345678901.00", "x"), ("4", "tea", "5", "Tea", "maybe", "1e3", "x")],
        "id string, name string, brand_id string, category string, is_fmcg string, unit_price string, extra string")
    good, bad = contract.load(feed, "products")
    assert good.columns == [r.name for r in contract.CONTRACTS["products"]]
    assert rows(good, "id", "brand_id", "unit_price") == [(1, 2, Decimal("10.00")), (2, 3, Decimal("0.00"))]
    found = sorted(((x.row_key or "", list(x.reasons)) for x in bad.collect()))
    assert found == [
        ("", ["id is missing", "brand_id is missing", "category is missing", "is_fmcg is missing", "unit_price is missing"]),
        ("3", ["brand_id is no int", "is_fmcg is missing", "unit_price is negative"]),
        ("4", ["is_fmcg is no boolean"]), ("4", ["unit_price is no decimal(10,2)"])]
    assert good.count() + bad.count() == feed.count()
    assert json.loads(bad.where("row_key = '3'").first()["record"])["extra"] == "x"


def test_contract_of_a_feed_without_columns_or_rows(spark):
    feed = spark.createDataFrame([("1",)], "id string")
    good, bad = contract.load(feed, "brands")
    assert good.count() == 0 and bad.first()["reasons"] == ["name is missing", "category is missing"]
    for table in contract.CONTRACTS:
        names = ", ".join(f"{r.name} string" for r in contract.CONTRACTS[table])
        good, bad = contract.load(spark.createDataFrame([], names), table)
        assert good.count() == bad.count() == 0
    without_key = spark.createDataFrame([("a", "b")], "name string, category string")
    assert contract.load(without_key, "brands")[1].first()["row_key"] is None


# ---------------------------------------------------------------------- diff
SCHEMA = "id long, name string, price decimal(10,2), tags array<string>"


def snapshots(spark, changes=()):
    old = [(i, f"n{i}" if i % 7 else None, Decimal(i), [f"t{i % 3}"]) for i in range(500)]
    new = [r for r in old if r[0] not in (3, 4)] + [(900, "new", None, None)]
    new = [(i, "other" if i in (10, 11) else n, None if i == 12 else p, t) for i, n, p, t in new]
    return spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)


def test_diff_by_ranges_equals_full_join(spark):
    old, new = snapshots(spark)
    few = diff.differing(old, new, "id", leaves=64)
    assert 0 < few[0].count() < 120 and few[1].count() < 120  # about seven leaves of 64
    assert rows(access.audit_changes(*few, "id", "t")) == rows(access.audit_changes(old, new, "id", "t"))
    assert rows(streams.cdc_diff(*few, "id")) == rows(streams.cdc_diff(old, new, "id"))
    same = diff.differing(old, old, "id")
    assert same[0].count() == same[1].count() == 0
    empty = old.limit(0)
    assert rows(access.audit_changes(*diff.differing(empty, old, "id"), "id", "t")) == rows(access.audit_changes(empty, old, "id", "t"))


def test_diff_sees_moved_nulls_and_repeated_rows(spark):
    schema = "id long, a string, b string"
    old = spark.createDataFrame([(1, None, "x"), (2, "y", None), (3, "r", "r"), (None, "k", "k")], schema)
    moved = spark.createDataFrame([(1, "x", None), (2, "y", None), (3, "r", "r"), (None, "k", "k")], schema)
    assert {x.id for x in diff.differing(old, moved, "id")[0].collect()} == {1}
    twice = old.unionByName(old.where("id = 3"))
    assert {x.id for x in diff.differing(old, twice, "id")[1].collect()} == {3}
    thrice = twice.unionByName(old.where("id = 3"))  # pairs cancel in an exclusive or, not in the count
    assert {x.id for x in diff.differing(old, thrice, "id")[1].collect()} == {3}


def test_diff_with_stored_digests_and_new_columns(spark, tmp_path):
    old, new = snapshots(spark)
    diff.leaf_digests(old, "id", 64).write.parquet(f"{tmp_path}/digests")
    stored = spark.read.parquet(f"{tmp_path}/digests")
    assert stored.count() <= 64
    a = diff.differing(old, new, "id", leaves=64, old_digests=stored)
    assert rows(access.audit_changes(*a, "id", "t")) == rows(access.audit_changes(old, new, "id", "t"))
    wide = new.withColumn("more", F.lit(1))
    assert rows(streams.cdc_diff(*diff.differing(old, wide, "id"), "id")) == rows(streams.cdc_diff(old, wide, "id"))


def test_unchanged_ranges_are_not_shuffled(spark):
    old, new = snapshots(spark)
    few = diff.differing(old, new, "id", leaves=64)
    plan = few[0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


# ---------------------------------------------------------------- compaction
def test_inventory_and_compaction_of_written_files(spark, tmp_path):
    lake, out = f"{tmp_path}/lake", f"{tmp_path}/out"
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("p"), F.repeat(F.lit("x"), 20).alias("t"))
    for k in range(4):
        df.where(F.col("id") % 4 == k).coalesce(1).write.mode("append").partitionBy("p").parquet(lake)
    inventory = sinks.file_inventory(spark, lake).where(F.col("name").endswith(".parquet"))
    on_disk = {os.path.join(d, f): os.stat(os.path.join(d, f)) for d, _, names in os.walk(lake) for f in names if f.endswith(".parquet")}
    found = {x.name.removeprefix("file:").replace("//", "/"): x for x in inventory.collect()}
    assert set(found) == set(on_disk) and len(found) == 12
    for path, stat in on_disk.items():
        assert found[path].content_length == stat.st_size
        assert abs(found[path].last_modified.timestamp() - stat.st_mtime) < 2
    size = max(s.st_size for s in on_disk.values())
    plan = sinks.compaction_plan(sinks.lake_lifecycle_plan(inventory, dt.datetime.now() + dt.timedelta(days=100)), lake, 2 * size)
    assert {x.action for x in plan.collect()} == {"archive"} and plan.count() == 12
    bins = {(x.folder, x.bin): x["count"] for x in plan.groupBy("folder", "bin").count().collect()}
    assert all(b is not None and n >= 2 for (_, b), n in bins.items()) and len(bins) < 12
    back = sinks.compact_lake(spark, lake, out, plan)
    assert rows(back, "id", "p", "t") == rows(df, "id", "p", "t")
    assert len([f for _, _, names in os.walk(out) for f in names if f.endswith(".parquet")]) == len(bins)
    whole = sinks.compaction_plan(inventory, lake, size // 100)  # every file is large
    assert whole.where("bin is not null").count() == 0
    assert rows(sinks.compact_lake(spark, lake, f"{tmp_path}/as_is", whole), "id", "p") == rows(df, "id", "p")
    assert sinks.compaction_plan(inventory.limit(0), lake).count() == 0


@pytest.mark.parametrize("table", ["_audit", "_manifest"])
def test_history_files_can_be_joined(spark, tmp_path, table):
    base = str(tmp_path)
    for k in range(3):
        sinks.snapshot_refresh(spark, base, "v", spark.range(k), dt.datetime(2024, 1, 1, k))
    at = f"{base}/{table}"
    plan = sinks.compaction_plan(sinks.file_inventory(spark, at).where(F.col("name").endswith(".parquet")), at)
    assert plan.count() == (6 if table == "_audit" else 3) and plan.select("bin").distinct().count() == 1
    back = sinks.compact_lake(spark, at, f"{base}/joined", plan)
    assert rows(back) == rows(spark.read.parquet(at))
    assert len([f for f in os.listdir(f"{base}/joined") if f.endswith(".parquet")]) == 1
