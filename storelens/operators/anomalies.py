"""Sales anomaly rules and the stateful detection job.

Statistics the reference keeps in PL/pgSQL variables (mean, standard deviation)
are one-row aggregates here, read back as scalar subqueries (computed once by
Spark, no join): no value passes through our driver code.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.columns import as_double, count_if, fixed, midnight, ratio, ts_lit
from storelens.plans.lines import window_start
from storelens.plans.scalars import one_row, with_scalars
from storelens.sources.retail import Retail
from storelens.sources.sinks import JSON_OPTIONS

ANOMALY_TYPES = ("SUSPICIOUS_TRANSACTION", "UNUSUAL_PATTERN", "HIGH_SUBSTITUTION_RATE")


def high_value_threshold(r: Retail, as_of: dt.date, k: float = 3.0, base_days: int = 30) -> DataFrame:
    """One row: mean + k * sample stddev of the baskets of the last ``base_days``."""
    return (r.interactions(window_start(as_of, base_days))
            .agg((as_double(F.avg("total_amount")) + F.lit(float(k)) * F.stddev_samp(as_double("total_amount")))
                 .alias("_threshold")))


def anomaly_high_value(r: Retail, as_of: dt.date, k: float = 3.0, base_days: int = 30,
                       scan_days: int = 7) -> DataFrame:
    """Baskets of the last ``scan_days`` above mean + k * sample stddev of the
    last ``base_days``; severity high above twice the threshold."""
    stats = high_value_threshold(r, as_of, k, base_days)
    scan = r.interactions(window_start(as_of, scan_days))
    amount = as_double("total_amount")
    th = one_row(stats).getField("_threshold")
    return (scan.where(amount > th)
            .select(F.lit("SUSPICIOUS_TRANSACTION").alias("anomaly_type"), "interaction_id", "store_id",
                    F.col("total_amount").alias("amount"), fixed(th, 2).alias("threshold"),
                    F.col("transaction_date").alias("transaction_date"),
                    F.when(amount > th * 2, "high").otherwise("medium").alias("severity")))


def anomaly_store_pattern(r: Retail, as_of: dt.date, k: float = 2.0, days: int = 7, min_txn: int = 5) -> DataFrame:
    """Stores (with >= min_txn baskets in ``days``) whose mean basket deviates
    from the mean of store means by more than k sample stddevs."""
    sp = (r.interactions(window_start(as_of, days)).groupBy("store_id")
          .agg(F.avg("total_amount").alias("avg_amount"), F.count(F.lit(1)).alias("transaction_count"))
          .where(F.col("transaction_count") >= min_txn))
    ps = sp.agg(F.avg("avg_amount").alias("_overall_avg"), F.stddev_samp(as_double("avg_amount")).alias("_std"))
    sp = with_scalars(sp, ps)
    dev = F.abs(as_double(F.col("avg_amount") - F.col("_overall_avg")))
    return (sp.where(dev > F.lit(float(k)) * F.col("_std"))
            .select(F.lit("UNUSUAL_PATTERN").alias("anomaly_type"), "store_id",
                    fixed("avg_amount", 6).alias("store_avg_amount"),
                    fixed("_overall_avg", 6).alias("overall_avg_amount"),
                    ratio(dev, "_std", 1.0, 4).alias("deviation_factor"),
                    F.lit("medium").alias("severity")))


def anomaly_substitution(r: Retail, as_of: dt.date, rate: float = 25.0, days: int = 7,
                         min_txn: int = 10) -> DataFrame:
    """Stores (>= min_txn baskets in ``days``) with substitution rate > rate %."""
    st = (r.interactions(window_start(as_of, days)).groupBy("store_id")
          .agg(F.count(F.lit(1)).alias("transaction_count"),
               count_if(F.col("substitution_occurred")).alias("_subs"))
          .where(F.col("transaction_count") >= min_txn))
    value = as_double("_subs") / as_double("transaction_count") * F.lit(100.0)
    return (st.where(value > F.lit(float(rate)))
            .select(F.lit("HIGH_SUBSTITUTION_RATE").alias("anomaly_type"), "store_id",
                    fixed(value, 4).alias("substitution_rate"), "transaction_count",
                    F.lit("low").alias("severity")))


def _details(*fields: str) -> F.Column:
    return F.to_json(F.struct(*[F.col(f) for f in fields]), {"ignoreNullFields": "false", **JSON_OPTIONS})


def detected_anomalies(r: Retail, as_of: dt.date, run_ts: dt.datetime | None = None,
                       high_value: dict | None = None, store_pattern: dict | None = None,
                       substitution: dict | None = None) -> DataFrame:
    """The rows one detection run inserts: type, details JSON, severity,
    status 'active', created_at = run time."""
    run_ts = run_ts or midnight(as_of)
    hv = anomaly_high_value(r, as_of, **(high_value or {}))
    sp = anomaly_store_pattern(r, as_of, **(store_pattern or {}))
    sb = anomaly_substitution(r, as_of, **(substitution or {}))
    hv = hv.withColumn("date", F.col("transaction_date"))
    rows = [
        hv.select(F.col("anomaly_type").alias("type"),
                  _details("interaction_id", "store_id", "amount", "threshold", "date").alias("details"),
                  "severity"),
        sp.select(F.col("anomaly_type").alias("type"),
                  _details("store_id", "store_avg_amount", "overall_avg_amount", "deviation_factor").alias("details"),
                  "severity"),
        sb.select(F.col("anomaly_type").alias("type"),
                  _details("store_id", "substitution_rate", "transaction_count").alias("details"), "severity"),
    ]
    out = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return out.select(
        F.sha2(F.concat_ws("|", F.col("type"), F.col("details"), F.lit(run_ts.isoformat())), 256).alias("id"),
        "type", "details", "severity", F.lit("active").alias("status"),
        ts_lit(run_ts).alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("resolved_at"))


def detect_anomalies(r: Retail, as_of: dt.date, existing: DataFrame | None = None,
                     run_ts: dt.datetime | None = None, **rule_params) -> tuple[DataFrame, DataFrame]:
    """One detection run as a state transition.

    Active anomalies of the three rule types in ``existing`` become resolved
    (resolved_at = run time), the new detections are appended. A detection's id
    holds the run time, so ids differ between runs; a rerun of one run (same
    ``run_ts``) replaces its own rows. Returns ``(new_state, audit_row)``;
    ``storelens.jobs.detection_run`` writes both.
    """
    run_ts = run_ts or midnight(as_of)
    new = detected_anomalies(r, as_of, run_ts, **rule_params)
    if existing is None:
        state = new
    else:
        closing = F.col("type").isin(*ANOMALY_TYPES) & (F.col("status") == "active")
        resolved = existing.join(new.select("id"), "id", "left_anti").select(
            "id", "type", "details", "severity",
            F.when(closing, F.lit("resolved")).otherwise(F.col("status")).alias("status"),
            "created_at",
            F.when(closing, ts_lit(run_ts)).otherwise(F.col("resolved_at")).alias("resolved_at"))
        state = resolved.unionByName(new)
    summary = new.agg(
        F.sum(F.when(F.col("type") == "SUSPICIOUS_TRANSACTION", 1).otherwise(0)).alias("suspicious_transactions"),
        F.sum(F.when(F.col("type") == "UNUSUAL_PATTERN", 1).otherwise(0)).alias("unusual_patterns"))
    hv = {k: v for k, v in (rule_params.get("high_value") or {}).items() if k in ("k", "base_days")}
    threshold = one_row(high_value_threshold(r, as_of, **hv)).getField("_threshold")
    audit = summary.select(
        F.lit("anomalies").alias("table_name"), F.lit("DETECTION_RUN").alias("action"),
        F.to_json(F.struct(F.coalesce("suspicious_transactions", F.lit(0)).alias("suspicious_transactions"),
                           F.coalesce("unusual_patterns", F.lit(0)).alias("unusual_patterns"),
                           fixed(threshold, 2).alias("high_value_threshold"),
                           F.lit(as_of.isoformat()).alias("detection_date")),
                  {"ignoreNullFields": "false"}).alias("new_data"),
        ts_lit(run_ts).alias("audit_ts"))
    return state, audit
