"""Structured Streaming jobs: ingest, CDC routing, live KPIs and alert rules.

Each windowed rule is one function over a DataFrame that works on both a
static frame (the batch twin, used for back-fills and the SQL check) and a
streaming frame (``readStream``), so batch and stream share one definition.
Windowed rules take their event-time watermark delay from the caller (rows later
than that are dropped; ``run_update_stream`` returns how many, over all batches) and
write with ``foreachBatch`` in update mode: every micro-batch's changed rows go to
``{sink}/batch_id=N`` (idempotent on replay), and ``latest_rows`` resolves the newest
value per key. A rule that can turn false again (``metric_threshold_windows``) emits
every changed window with a flag, so a later batch takes an alert back. Live day
totals (``live_kpis_job``) keep every basket, however late, and quantiles are kept as
mergeable sketches, so neither loses late rows.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from storelens.functions.columns import as_double, count_when, fixed, money_sum, ts_lit
from storelens.plans.materialize import materialize
from storelens.sources.files import Files
from storelens.streaming.live import live_kpis_job  # noqa: F401  one of the stream jobs


# ----------------------------------------------------------- rule bodies
def live_kpis(baskets: DataFrame, watermark: str | None) -> DataFrame:
    """Per calendar day: baskets, revenue, mean basket, active stores.
    Duplicate deliveries of a basket (same id) are dropped first."""
    df = baskets.withColumn("event_ts", F.col("transaction_date").cast("timestamp"))
    if watermark:
        df = df.withWatermark("event_ts", watermark).dropDuplicatesWithinWatermark(["interaction_id"])
    else:
        df = df.dropDuplicates(["interaction_id"])
    return (df.groupBy(F.window("event_ts", "1 day").alias("w"))
            .agg(F.count(F.lit(1)).alias("transactions"), money_sum("total_amount").alias("revenue"),
                 F.avg("total_amount").alias("_avg"))
            .select(F.to_date(F.col("w.start")).alias("day"), "transactions", "revenue",
                    fixed("_avg", 6).alias("avg_transaction_value")))


def metric_threshold_alert(events: DataFrame, threshold: float, above: bool = True, window: str = "5 minutes",
                           slide: str = "1 minute") -> DataFrame:
    """Sliding windows (length ``window``, evaluated every ``slide``) per
    metric (event type) whose mean value is above (or below) the threshold."""
    return firing(metric_threshold_windows(events, threshold, None, above, window, slide))


def firing(windows: DataFrame) -> DataFrame:
    """The windows whose rule holds (of a static frame, or of ``latest_rows``)."""
    return windows.where("firing").drop("firing")


def metric_threshold_windows(events: DataFrame, threshold: float, watermark: str | None, above: bool = True,
                             window: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Every window of ``metric_threshold_alert`` with ``firing``: whether the rule holds. A stream must emit the
    windows where it does not, or a sink would keep an alert that a later batch has ended."""
    df = events.withColumn("event_ts", F.col("ts").cast("timestamp"))
    if watermark:
        df = df.withWatermark("event_ts", watermark)
    m = (df.groupBy(F.window("event_ts", window, slide).alias("w"), F.col("event_type").alias("metric"))
         .agg(F.avg(F.col("value").cast("decimal(18,2)")).alias("_avg"), F.count(F.lit(1)).alias("samples")))
    cond = F.col("_avg") > threshold if above else F.col("_avg") < threshold
    return m.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "metric",
                    fixed("_avg", 6).alias("avg_value"), "samples", F.coalesce(cond, F.lit(False)).alias("firing"))


def error_bins(events: DataFrame, watermark: str | None, min_errors: int = 10, bin_len: str = "1 minute") -> DataFrame:
    """Tumbling bins of error events with more than ``min_errors`` errors (the
    alert fires when any bin of the evaluation period qualifies)."""
    df = events.where(F.col("event_type") == "error").withColumn("event_ts", F.col("ts").cast("timestamp"))
    if watermark:
        df = df.withWatermark("event_ts", watermark)
    return (df.groupBy(F.window("event_ts", bin_len).alias("w")).agg(F.count(F.lit(1)).alias("error_count"))
            .where(F.col("error_count") > min_errors)
            .select(F.col("w.start").cast("timestamp_ntz").alias("bin_start"), "error_count"))


def error_burst_alert(bins: DataFrame, period: str = "5 minutes") -> DataFrame:
    """Evaluation periods holding at least one qualifying bin (batch side)."""
    return (bins.groupBy(F.window(F.col("bin_start").cast("timestamp"), period).alias("p"))
            .agg(F.count(F.lit(1)).alias("bins"), F.sum("error_count").cast("long").alias("errors"))
            .select(F.col("p.start").cast("timestamp_ntz").alias("period_start"), "bins", "errors"))


def error_bursts(events: DataFrame, watermark: str, min_errors: int = 10, bin_len: str = "1 minute",
                 period: str = "5 minutes") -> DataFrame:
    """The streaming side of ``error_burst_alert``: both groupings in one stream (append mode, so a period comes
    out once, when the watermark has passed its end)."""
    df = events.where(F.col("event_type") == "error").withColumn("event_ts", F.col("ts").cast("timestamp"))
    bins = (df.withWatermark("event_ts", watermark).groupBy(F.window("event_ts", bin_len).alias("w"))
            .agg(F.count(F.lit(1)).alias("error_count")).where(F.col("error_count") > min_errors))
    return (bins.groupBy(F.window(F.window_time("w"), period).alias("p"))
            .agg(F.count(F.lit(1)).alias("bins"), F.sum("error_count").cast("long").alias("errors"))
            .select(F.col("p.start").cast("timestamp_ntz").alias("period_start"), "bins", "errors"))


def rate_limit_violations(events: DataFrame, watermark: str | None, max_per_minute: int = 100,
                          key: str = "user_id") -> DataFrame:
    """Clients with more than ``max_per_minute`` requests in a 1-minute window."""
    df = events.withColumn("event_ts", F.col("ts").cast("timestamp"))
    if watermark:
        df = df.withWatermark("event_ts", watermark)
    return (df.groupBy(F.window("event_ts", "1 minute").alias("w"), F.col(key).alias("client"))
            .agg(F.count(F.lit(1)).alias("requests"))
            .where(F.col("requests") > max_per_minute)
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "client", "requests"))


def error_rate(events: DataFrame, window: str = "1 hour", good: float = 0.01, warn: float = 0.05,
               watermark: str | None = None) -> DataFrame:
    """Requests and error share per window; grade good (<= 1 %), warning
    (<= 5 %), else critical."""
    df = events.withColumn("event_ts", F.col("ts").cast("timestamp"))
    if watermark:
        df = df.withWatermark("event_ts", watermark)
    m = (df.groupBy(F.window("event_ts", window).alias("w"))
         .agg(F.count(F.lit(1)).alias("requests"), count_when(F.col("event_type") == "error").alias("errors")))
    share = as_double("errors") / as_double("requests")
    return m.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "requests", "errors",
                    fixed(share, 6).alias("error_rate"),
                    F.when(share <= good, "good").when(share <= warn, "warning").otherwise("critical").alias("grade"))


def latency_p95(events: DataFrame, window: str = "1 day", percent: int = 95) -> DataFrame:
    """Exact nearest-rank percentile of the value per window, at any size of a window.

    Equal values are counted before any shuffle. The counts are dealt to tasks by range of (window, value) and stored,
    so a window may spread over many tasks; what a window's earlier ranges hold is added to the running counts within
    a range, and the value whose count reaches the rank is the answer. No window has to fit into a task. NULL values have
    no rank; ``samples`` counts all rows.
    """
    df = events.select(F.window(F.col("ts").cast("timestamp"), window).alias("w"), "value")
    per = (df.select(F.col("w.start").alias("start"), "value").groupBy("start", "value")
           .agg(F.count("value").alias("n"), F.count(F.lit(1)).alias("rows")))
    placed = materialize(per.repartitionByRange("start", "value").withColumn("part", F.spark_partition_id()), "ranges")
    ranges = placed.groupBy("start", "part").agg(F.sum("n").alias("held"), F.sum("rows").alias("rows"))  # a row a range
    in_window = Window.partitionBy("start")
    before = F.sum("held").over(in_window.orderBy("part")) - F.col("held")
    ranges = ranges.select("start", "part", before.alias("before"), F.sum("held").over(in_window).alias("total"),
                           F.sum("rows").over(in_window).alias("samples"))
    rank = F.floor((F.col("total") * percent + 99) / 100).cast("long")
    own = F.sum("n").over(Window.partitionBy("start", "part").orderBy("value"))
    upto = (placed.select("start", "part", "value", "n", own.alias("own")).join(ranges, ["start", "part"])
            .withColumn("upto", F.col("before") + F.col("own")).withColumn("rank", rank)
            .where("upto >= rank and upto - n < rank").select("start", F.col("value").alias("p")))
    windows = ranges.select("start", "samples").distinct()
    return (windows.join(upto, "start", "left")
            .select(F.col("start").cast("timestamp_ntz").alias("window_start"), fixed("p", 6).alias("p95_value"), "samples"))


#: Size of a quantile sketch: with 400 a rank is off by about 0.7 % of the rows (99 % sure), in some 10 KB.
SKETCH_K = 400


def latency_sketches(events: DataFrame, window: str = "1 day", k: int = SKETCH_K) -> DataFrame:
    """(start, sketch, n, samples): a mergeable quantile sketch of the values per window, their number, and all rows."""
    df = events.select(F.window(F.col("ts").cast("timestamp"), window).alias("w"), "value")
    return (df.groupBy(F.col("w.start").alias("start"))
            .agg(F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"), F.count("value").alias("n"),
                 F.count(F.lit(1)).alias("samples")))


def latency_from_sketches(sketches: DataFrame, percent: int = 95, k: int = SKETCH_K) -> DataFrame:
    """The percentile per window, of sketches merged over batches (or of windows merged by a coarser ``start``).

    The value's rank is off by about 0.7 % of the rows at most, for k = 400; ``latency_p95`` is the exact way."""
    merged = (sketches.groupBy("start").agg(F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("sketch")), F.lit(k)).alias("sketch"),
                                            F.sum("n").alias("n"), F.sum("samples").alias("samples")))
    value = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(percent / 100)))
    return merged.select(F.col("start").cast("timestamp_ntz").alias("window_start"), fixed(value, 6).alias("p95_value"), "samples")


def latency_sketch_job(events: DataFrame, sink: str, checkpoint: str, name: str, window: str = "1 day") -> None:
    """Sketches of a running stream (availableNow): each micro-batch writes the sketches of its own rows under
    ``{sink}/batch_id=N``. No state is kept and no row is too late; a replayed batch overwrites its folder."""
    def run(batch: DataFrame, batch_id: int) -> None:
        latency_sketches(batch, window).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    q = (events.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).queryName(name)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def newest_event(events: DataFrame) -> DataFrame:
    """One row (``one`` = 1) with the newest event's time: what ``freshness`` needs of a stream."""
    return events.groupBy(F.lit(1).alias("one")).agg(F.max("ts").alias("ts"))


def freshness(events: DataFrame, now: dt.datetime, max_seconds: int = 300) -> DataFrame:
    """Seconds since the newest event, and whether that exceeds the limit."""
    last = events.agg(F.max("ts").alias("last_event"))
    age = F.col("_now").cast("timestamp").cast("long") - F.col("last_event").cast("timestamp").cast("long")
    return last.select("last_event", ts_lit(now).alias("_now")).select(
        "last_event", age.alias("seconds_since_last"), (age > max_seconds).alias("stale"))


def metric_heatmap(events: DataFrame, bucket: str = "1 hour", watermark: str | None = None) -> DataFrame:
    """Mean value per component (event type) x time bucket."""
    df = events.withColumn("event_ts", F.col("ts").cast("timestamp"))
    if watermark:
        df = df.withWatermark("event_ts", watermark)
    return (df.groupBy(F.window("event_ts", bucket).alias("w"), F.col("event_type").alias("component"))
            .agg(fixed(F.avg(F.col("value").cast("decimal(18,2)")), 6).alias("avg_value"),
                 F.count(F.lit(1)).alias("samples"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("bucket_start"), "component", "avg_value", "samples"))


# -------------------------------------------------------------- CDC diff
def cdc_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Per updated key, one row per changed column of ``new``: from / to
    values as text (NULL-safe comparison; columns only in ``old`` ignored)."""
    cols = [c for c in new.columns if c != key]
    o = old.select(F.col(key).alias("_k"), *[F.col(c).cast("string").alias(f"o_{c}") for c in cols if c in old.columns])
    n = new.select(F.col(key).alias("row_key"), *[F.col(c).cast("string").alias(f"n_{c}") for c in cols])
    j = n.join(o, F.col("row_key") == F.col("_k"))
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                 (F.col(f"o_{c}") if c in old.columns else F.lit(None).cast("string")).alias("old_value"),
                                 F.col(f"n_{c}").alias("new_value")) for c in cols])
    return (j.select("row_key", F.explode(entries).alias("e"))
            .where(~F.col("e.old_value").eqNullSafe(F.col("e.new_value")))
            .select("row_key", "e.column_name", "e.old_value", "e.new_value"))


# ------------------------------------------------------------ stream jobs
CDC_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("eventType", T.StringType()),
    T.StructField("new", T.StringType()),
    T.StructField("old", T.StringType()),
    T.StructField("commit_ts", T.TimestampType()),
])


def read_json_stream(spark: SparkSession, path: str, schema: T.StructType | str, max_files: int | None = None
                     ) -> DataFrame:
    from storelens.sources.sinks import JSON_OPTIONS

    reader = spark.readStream.schema(schema).options(**JSON_OPTIONS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


class _DropCounter(StreamingQueryListener):
    """Rows that a query's watermark dropped, summed over all its batches."""

    def __init__(self) -> None:
        self.dropped, self.batches, self.ended = 0, 0, False

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.batches += 1
        self.dropped += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended = True


def run_update_stream(agg: DataFrame, sink: str, checkpoint: str, name: str, mode: str = "update") -> dict:
    """Run an aggregating stream to completion (availableNow) in update (or append) mode; each micro-batch's
    changed rows are written to ``{sink}/batch_id=N`` (overwrite of that batch folder, so a replayed batch is
    idempotent). Returns ``batches`` and ``rows_dropped_by_watermark``, both over all batches of the run."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    spark, counter = agg.sparkSession, _DropCounter()
    spark.streams.addListener(counter)
    try:
        q = (agg.writeStream.outputMode(mode).foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint).queryName(name).trigger(availableNow=True).start())
        q.awaitTermination()
        for _ in range(100):  # the listener hears of the end a moment later
            if counter.ended:
                break
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(counter)
    return {"batches": counter.batches, "rows_dropped_by_watermark": counter.dropped}


def latest_rows(spark: SparkSession, sink: str, keys: list[str]) -> DataFrame:
    """Newest emitted row per key across the batch folders of ``sink``."""
    df = spark.read.parquet(sink)
    w = Window.partitionBy(*keys).orderBy(F.col("batch_id").desc())
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "batch_id")


def stream_ingest_json(stream: DataFrame, sink: str, checkpoint: str, interval: str | None = None) -> dict:
    """Live rows of any streaming frame -> JSON lake (``interval`` such as '5 minutes', else availableNow). The
    file sink commits each batch once, from its checkpoint."""
    from storelens.sources.sinks import JSON_OPTIONS

    writer = (stream.writeStream.format("json").options(**JSON_OPTIONS).option("path", sink)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    q = writer.start()
    if not interval:
        q.awaitTermination()
    return q.lastProgress or {}


def parse_records(lines: DataFrame, schema: str, required: tuple[str, ...] = ()) -> DataFrame:
    """``lines(value, ...)`` with ``record`` (the JSON text as a struct) and ``reason``, null where the record is good.

    Bad are null texts, texts that are no JSON object, values of another type than the schema's, and required fields
    that are missing or null."""
    from storelens.sources.sinks import JSON_OPTIONS

    fields = T._parse_datatype_string(schema)
    whole = T.StructType([*fields.fields, T.StructField("_corrupt", T.StringType())])
    options = {**JSON_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = lines.withColumn("_parsed", F.from_json("value", whole, options))
    reason = F.when(F.col("value").isNull() | F.col("_parsed").isNull() | F.col("_parsed._corrupt").isNotNull(),
                    F.lit("not a record of the schema"))
    for name in required:
        reason = reason.when(F.col("_parsed")[name].isNull(), F.lit(f"{name} is missing"))
    record = F.struct(*[F.col("_parsed")[f.name].alias(f.name) for f in fields.fields])
    return parsed.withColumn("record", record).withColumn("reason", reason).drop("_parsed")


def ingest_records(lines: DataFrame, schema: str, sink: str, quarantine: str, checkpoint: str,
                   required: tuple[str, ...] = (), name: str | None = None) -> dict:
    """A stream of text records (a column ``value``; others tell where it stood) -> JSON lake, bad ones to quarantine.

    Good records go to ``{sink}/batch_id=N``; the others, whole and with all columns and their ``reason``, to
    ``{quarantine}/batch_id=N`` (availableNow). A replayed batch overwrites its folders, so with a source that replays
    the same rows nothing is lost and nothing comes twice. Returns the numbers of stored and quarantined rows."""
    from storelens.sources.sinks import JSON_OPTIONS

    total = {"stored": 0, "quarantined": 0}

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        draft = f"{checkpoint}/drafts/batch_id={batch_id}"  # parsed once; the source is read once
        parse_records(batch, schema, required).write.mode("overwrite").parquet(draft)
        parsed = spark.read.parquet(draft)
        good, bad = parsed.where("reason is null").select("record.*"), parsed.where("reason is not null").drop("record")
        good.write.mode("overwrite").options(**JSON_OPTIONS).json(f"{sink}/batch_id={batch_id}")
        bad.write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
        total["stored"] += good.count()
        total["quarantined"] += bad.count()
        Files(spark).delete(draft)

    writer = lines.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = (writer.queryName(name) if name else writer).start()
    q.awaitTermination()
    return total


def change_map(old: F.Column, new: F.Column) -> F.Column:
    """Of two JSON rows: changed column -> {from, to}, NULL-safe, over the columns of ``new``."""
    o, n = F.from_json(old, "map<string,string>"), F.from_json(new, "map<string,string>")
    changed = F.filter(F.array_sort(F.map_keys(n)), lambda k: ~F.try_element_at(o, k).eqNullSafe(F.try_element_at(n, k)))
    return F.map_from_entries(F.transform(changed, lambda k: F.struct(
        k, F.struct(F.try_element_at(o, k).alias("from"), F.try_element_at(n, k).alias("to")))))


def cdc_routes(batch: DataFrame) -> dict[str, DataFrame]:
    """The routes of change events: every INSERT to the raw zone; every change of a customer as a wrapped record;
    every UPDATE to the audit trail with its record, its user and the map of changed columns."""
    row = F.coalesce("new", "old")
    keep = {"ignoreNullFields": "false"}
    return {
        "raw-data": batch.where(F.col("eventType") == "INSERT").select("table", "eventType", "new", "commit_ts"),
        "customer-changes": batch.where(F.col("table") == "customers").select(
            F.get_json_object(row, "$.id").alias("customerId"), F.col("eventType").alias("change_type"),
            F.col("new").alias("record"), "commit_ts"),
        "audit-trail": batch.where(F.col("eventType") == "UPDATE").select(
            "table", F.get_json_object(row, "$.id").alias("record_id"), F.get_json_object(row, "$.updated_by").alias("user_id"),
            F.to_json(change_map(F.col("old"), F.col("new")), keep).alias("changes"), "commit_ts")}


def cdc_route_batch(batch: DataFrame, base: str, batch_id: int) -> None:
    """Write one micro-batch's routes. Folders are per batch id (idempotent)."""
    from storelens.sources.sinks import JSON_OPTIONS

    for route, rows in cdc_routes(batch).items():
        writer = rows.write.mode("overwrite").options(**JSON_OPTIONS)
        writer = writer.partitionBy("table") if route == "raw-data" else writer
        writer.json(f"{base}/{route}/batch_id={batch_id}")


def cdc_route(spark: SparkSession, source: str, base: str, checkpoint: str, max_files: int | None = None) -> dict:
    stream = read_json_stream(spark, source, CDC_SCHEMA, max_files)
    q = (stream.writeStream.foreachBatch(lambda df, bid: cdc_route_batch(df, base, bid))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q.lastProgress or {}
