"""Incremental maintenance of day aggregates over a lake of baskets by sale date.

The lake has a folder a sale date (``sinks.export_transactions``). A refresh takes the
inventory of its files, compares each date's digest (names, lengths, times) with that of
the last commit, and computes anew only the dates that changed; dates that went drop out.
What is kept of a date are mergeable partial aggregates, so every view over any window of
days is a sum, and distinct customers are an OR of bitmaps:

* ``hours``: per store, weekday and hour: baskets, revenue, priced, influenced and
  substituted baskets;
* ``customers``: per store and bucket of 32,768 customer ids: a bitmap of those who bought.

New partials are written first and published in one commit; a crash in between leaves the
last state in place.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.columns import count_if, dow, fixed, hour, money_sum
from storelens.plans.broadcast import size_checked_broadcast
from storelens.sources.commits import CommitLog, State
from storelens.sources.sinks import file_inventory

TABLES = {
    "hours": "sale_date date, store_id long, day_of_week long, peak_hour long, n long, revenue decimal(38,2), priced long, "
             "influenced long, substituted long",
    "customers": "sale_date date, store_id long, bucket long, seen binary",
}


def date_digests(inventory: DataFrame) -> DataFrame:
    """(sale_date, digest) of a lake's files; the order in which they are listed does not matter."""
    date = F.regexp_extract("name", "/sale_date=([^/]+)/[^/]+$", 1)
    one = F.xxhash64("name", "content_length", "last_modified")
    return (inventory.withColumn("sale_date", date).where("sale_date <> '' and content_length > 0").groupBy("sale_date")
            .agg(F.concat_ws("-", F.count(F.lit(1)), F.bit_xor(one), F.sum(one.cast("decimal(38,0)"))).alias("digest")))


def hour_partials(baskets: DataFrame) -> DataFrame:
    ts = F.col("transaction_date")
    return (baskets.groupBy(F.to_date("sale_date").alias("sale_date"), F.col("store_id").cast("long").alias("store_id"),
                            dow(ts).alias("day_of_week"), hour(ts).alias("peak_hour"))
            .agg(F.count(F.lit(1)).alias("n"), money_sum("total_amount").alias("revenue"), F.count("total_amount").alias("priced"),
                 count_if(F.col("is_attendant_influenced")).alias("influenced"),
                 count_if(F.col("substitution_occurred")).alias("substituted")))


def customer_partials(baskets: DataFrame) -> DataFrame:
    known = baskets.where("customer_id is not null").withColumn("_c", F.col("customer_id").cast("long"))
    return (known.groupBy(F.to_date("sale_date").alias("sale_date"), F.col("store_id").cast("long").alias("store_id"),
                          F.bitmap_bucket_number("_c").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_c")).alias("seen")))


def refresh(spark: SparkSession, lake: str, base: str, now: dt.datetime | None = None) -> dict:
    """Bring the partials under ``base`` up to the lake; returns the dates computed anew, those removed, and the rows read.

    Two refreshes at once both publish the state of the files that they saw; the later commit keeps the dates that the
    other has brought up to the same digest, and computes nothing twice for readers. An empty lake gives no dates.
    """
    log = CommitLog(spark, base)
    digests = {r.sale_date: r.digest for r in date_digests(file_inventory(spark, lake)).collect()}  # a row a calendar date
    known = log.latest()[1].get("days", {}).get("days", {})
    changed = sorted(d for d, digest in digests.items() if known.get(d, {}).get("digest") != digest)
    removed = sorted(set(known) - set(digests))
    out = {"changed": changed, "removed": removed, "rows_read": 0}
    if not changed and not removed:
        return out
    folder = f"{base.rstrip('/')}/days/v={uuid.uuid4().hex}"
    if changed:
        baskets = spark.read.parquet(lake).where(F.col("sale_date").cast("string").isin(changed))
        out["rows_read"] = baskets.count()
        for table, partials in (("hours", hour_partials(baskets)), ("customers", customer_partials(baskets))):
            # files of narrow date ranges: a reader of some dates skips the others
            partials.repartitionByRange("sale_date").sortWithinPartitions("sale_date").write.parquet(f"{folder}/{table}")

    def change(tables: State) -> State:
        days = dict(tables.get("days", {}).get("days", {}))
        for d in list(days):
            if d not in digests:
                del days[d]
        for d in changed:
            days[d] = {"digest": digests[d], "path": folder}
        return tables | {"days": {"days": days}}

    log.commit(change, now)
    return out


def partials(spark: SparkSession, base: str, table: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """The current partials of ``table`` for sale dates from ``start`` to before ``end``.

    Each version's folder is read for the dates that are still its own; a version whose dates have all been computed
    anew is read no more (and removed by ``CommitLog.vacuum``)."""
    days = CommitLog(spark, base).latest()[1].get("days", {}).get("days", {})
    of_folder: dict[str, list[str]] = {}
    for d, e in sorted(days.items()):
        if (start is None or d >= start.isoformat()) and (end is None or d < end.isoformat()):
            of_folder.setdefault(e["path"], []).append(d)
    out = spark.createDataFrame([], TABLES[table])
    for folder, dates in sorted(of_folder.items()):
        rows = spark.read.schema(TABLES[table]).parquet(f"{folder}/{table}")
        wanted = [dt.date.fromisoformat(d) for d in dates]
        out = out.unionByName(rows.where(F.col("sale_date").between(wanted[0], wanted[-1])).where(F.col("sale_date").isin(wanted)))
    return out


def daily_sales(spark: SparkSession, base: str, stores: DataFrame, as_of: dt.date, days: int = 90) -> DataFrame:
    """The view of the same name from the partials: per (date, store, weekday, hour) over the last ``days`` days."""
    shops = size_checked_broadcast(stores.select("id", "region", F.col("name").alias("store_name")))
    rows = partials(spark, base, "hours", as_of - dt.timedelta(days=days)).join(shops, F.col("store_id") == F.col("id"))
    return rows.select("sale_date", F.col("id").alias("store_id"), "region", "store_name", F.col("n").alias("transaction_count"),
                       F.col("revenue").alias("daily_revenue"), fixed(F.col("revenue") / F.col("priced"), 6).alias("avg_transaction_value"),
                       F.col("influenced").alias("influenced_transactions"), F.col("substituted").alias("substitution_transactions"),
                       "day_of_week", "peak_hour")


def region_windows(spark: SparkSession, base: str, stores: DataFrame, as_of: dt.date, windows: tuple[int, ...] = (7, 30, 90)
                   ) -> DataFrame:
    """Per region and window of days: active stores, baskets, revenue, mean basket and distinct customers, all exact.

    One stored table serves all windows: a day's partials are read once and count in every window that has the day.
    Customers are the set bits of the ORed bitmaps, so no customer id is sorted or expanded.
    """
    first = as_of - dt.timedelta(days=max(windows))
    shops = size_checked_broadcast(stores.select(F.col("id").alias("store_id"), "region"))
    ages = F.explode(F.filter(F.array(*[F.lit(w) for w in sorted(windows)]),
                              lambda w: F.col("sale_date") >= F.date_sub(F.lit(as_of), w))).alias("days")
    hours = (partials(spark, base, "hours", first).groupBy("sale_date", "store_id")
             .agg(F.sum("n").alias("n"), F.sum("revenue").alias("revenue"), F.sum("priced").alias("priced"))
             .select("*", ages).groupBy("days", "store_id")
             .agg(F.sum("n").alias("n"), F.sum("revenue").alias("revenue"), F.sum("priced").alias("priced")))
    sales = (hours.join(shops, "store_id").groupBy("region", "days")
             .agg(F.count(F.lit(1)).alias("store_count"), F.sum("n").alias("transactions"),
                  F.sum("revenue").cast("decimal(38,2)").alias("revenue"), F.sum("priced").alias("_priced")))
    seen = (partials(spark, base, "customers", first).join(shops, "store_id").select("region", "bucket", "seen", ages)
            .groupBy("region", "days", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("seen")).alias("_c"))
            .groupBy("region", "days").agg(F.sum("_c").alias("unique_customers")))
    return (sales.join(seen, ["region", "days"], "left")
            .select("region", "days", "store_count", "transactions", "revenue",
                    fixed(F.col("revenue") / F.col("_priced"), 6).alias("avg_transaction_value"),
                    F.coalesce("unique_customers", F.lit(0)).cast("long").alias("unique_customers")))
