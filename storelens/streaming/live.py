"""Live day totals that never reread history.

Every basket counts once, on its own day, however late or often it is delivered. The lake
holds the baskets that were counted (their ids decide what is new) and, for each day and
micro-batch that added to it, one row of partial sums, in a folder a month, sorted by day.
A micro-batch reads the ids and the partial sums of its own days: other months' folders are
not listed, and other days are pruned by the files' day ranges.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.columns import fixed, money_sum
from storelens.sources.files import Files

_OWN = {"partitionOverwriteMode": "dynamic"}  # a replayed batch replaces its own folders, no others


def _days_of(spark: SparkSession, table: str, days: list[dt.date], schema: str) -> DataFrame:
    """The rows of some days of a table stored as ``{table}/month=.../batch_id=...``; only their months are listed."""
    files = Files(spark)
    there = {e.name for e in files.entries(table)}
    paths = [f"{table}/{m}" for m in sorted({f"month={d:%Y-%m}" for d in days}) if m in there]
    whole = f"{schema}, day date, month string, batch_id long"
    if not paths:
        return spark.createDataFrame([], whole)
    rows = spark.read.schema(whole).option("basePath", table).parquet(*paths)
    return rows.where(F.col("day").between(days[0], days[-1])).where(F.col("day").isin(days))


def _store(rows: DataFrame, table: str, batch_id: int) -> None:
    """Add a batch's rows to the table, each month's in files of narrow day ranges."""
    placed = rows.withColumn("month", F.date_format("day", "yyyy-MM")).withColumn("batch_id", F.lit(batch_id).cast("long"))
    (placed.repartitionByRange("day").sortWithinPartitions("day").write.mode("overwrite").options(**_OWN)
     .partitionBy("month", "batch_id").parquet(table))


def live_kpis_job(baskets: DataFrame, lake: str, sink: str, checkpoint: str, name: str) -> list[dict]:
    """Day totals of a basket stream that stay right however late a basket is (availableNow).

    The days that a micro-batch touches are written to ``{sink}/batch_id=N`` (``latest_rows`` resolves them). Baskets
    without a time have no day and don't count. Nothing expires, and a replayed batch overwrites its own folders.
    Returns, for each micro-batch, its days, its baskets, those of them that were new, and the rows read from the lake.
    """
    lake, steps = lake.rstrip("/"), []
    incoming, counted, sums = f"{lake}/_incoming", f"{lake}/baskets", f"{lake}/sums"

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        id_type = dict(batch.dtypes)["interaction_id"]
        (batch.where("transaction_date is not null").dropDuplicates(["interaction_id"])
         .select("interaction_id", "total_amount", F.to_date("transaction_date").alias("day"))
         .write.mode("overwrite").parquet(incoming))
        new = spark.read.parquet(incoming)
        days = sorted(r.day for r in new.select("day").distinct().collect())  # calendar days of one batch
        if not days:
            return
        known = _days_of(spark, counted, days, f"interaction_id {id_type}").where(F.col("batch_id") < batch_id)
        seen = known.select(F.col("day").alias("_day"), F.col("interaction_id").alias("_id"))
        fresh = new.join(seen, (F.col("day") == F.col("_day")) & F.col("interaction_id").eqNullSafe(F.col("_id")), "left_anti")
        _store(fresh.select("interaction_id", "total_amount", "day"), counted, batch_id)
        added = _days_of(spark, counted, days, f"interaction_id {id_type}, total_amount decimal(18,2)").where(
            F.col("batch_id") == batch_id)
        _store(added.groupBy("day").agg(F.count(F.lit(1)).alias("n"), money_sum("total_amount").alias("revenue"),
                                        F.count("total_amount").alias("priced")), sums, batch_id)
        parts = _days_of(spark, sums, days, "n long, revenue decimal(38,2), priced long").where(F.col("batch_id") <= batch_id)
        (parts.groupBy("day").agg(F.sum("n").alias("transactions"), F.sum("revenue").cast("decimal(38,2)").alias("revenue"),
                                  F.sum("priced").alias("_priced"))
         .select("day", "transactions", "revenue", fixed(F.col("revenue") / F.col("_priced"), 6).alias("avg_transaction_value"))
         .write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}"))
        steps.append({"batch_id": batch_id, "days": days, "baskets": new.count(), "new": added.count(),
                      "rows_read": known.count() + parts.count()})

    q = (baskets.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).queryName(name)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return steps

