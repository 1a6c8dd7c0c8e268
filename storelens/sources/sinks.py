"""Sinks and lake connectors: exports, raw-zone appends, file inventory,
lifecycle plan and stored snapshots with a manifest.

Every writer writes in parallel (one file per partition, no coalesce to one
task) under a path the caller gives; jobs derive their paths from the shared
``spark.checkpoint.dir`` of the session (see ``storelens.session.scratch_path``).
Overwrites always go to a new versioned folder, never to the path being read.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.observation import Observation

from storelens.sources.commits import CommitLog, State
from storelens.sources.files import Files

# JSON keeps full microsecond precision (Spark's default JSON timestamp format
# stops at milliseconds, which would silently truncate event times).
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def read_lake_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read JSON written by these sinks with an explicit schema."""
    return spark.read.schema(schema).options(**JSON_OPTIONS).json(path)


# ------------------------------------------------------------------ exports
def export_transactions(df: DataFrame, path: str, date_col: str = "transaction_date",
                        max_records: int = 5_000_000) -> DataFrame:
    """Nightly export of the baskets as parquet, a folder per sale date, then read back.

    Rows are rebalanced by sale date: small dates share a task, and AQE splits a date that is larger than its
    advisory partition size over several tasks, at any size of the day. No file has more than ``max_records``."""
    out = df.withColumn("sale_date", F.to_date(date_col)).hint("rebalance", "sale_date")
    out.write.mode("overwrite").option("maxRecordsPerFile", max_records).partitionBy("sale_date").parquet(path)
    return df.sparkSession.read.parquet(path)


def export_json(df: DataFrame, base: str, category: str, day: dt.date) -> DataFrame:
    """Analytics JSON under ``{base}/analytics/category=.../dt=yyyy-mm-dd``, read back. A second run of a day
    replaces it."""
    out = f"{base.rstrip('/')}/analytics/category={category}/dt={day.isoformat()}"
    df.write.mode("overwrite").options(**JSON_OPTIONS).json(out)
    return read_lake_json(df.sparkSession, out, df.schema)


def csv_lines(df: DataFrame) -> DataFrame:
    """CSV rows as in the reference exporter: every string quoted with inner
    quotes doubled, numbers and booleans bare, NULL empty. One ``line`` column."""
    parts = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            v = F.concat(F.lit('"'), F.regexp_replace(c, '"', '""'), F.lit('"'))
        elif isinstance(field.dataType, T.BooleanType):
            v = F.when(c, "true").when(~c, "false")
        else:
            v = c.cast("string")
        parts.append(F.coalesce(v, F.lit("")))  # concat_ws would drop NULLs and shift columns
    return df.select(F.concat_ws(",", *parts).alias("line"))


def export_csv(df: DataFrame, path: str) -> DataFrame:
    """CSV files, each with the header, read back as a CSV reader sees them.

    Each task puts the header before its first row, so any file of the folder is a whole CSV. Values may hold line
    breaks, commas and quotes. An empty input writes no row and no header."""
    spark = df.sparkSession
    header = ",".join(df.columns)
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # of this task
    lines = csv_lines(df).select(F.when(first, F.concat(F.lit(header + "\n"), "line")).otherwise(F.col("line")).alias("line"))
    lines.write.mode("overwrite").text(path)
    return read_csv(spark, path, df.schema)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """CSV written by ``export_csv``."""
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, quote='"', escape='"')


def raw_zone_append(df: DataFrame, base: str, category: str, run_ts: dt.datetime, batch: str | None = None
                    ) -> tuple[DataFrame, int]:
    """Append a batch as timestamped JSON under ``{base}/raw-data/{category}``; the record count comes from an
    ``observe`` on the write itself. Each batch has a folder of its own; a rerun that names the same ``batch``
    replaces it, an unnamed one is always new."""
    obs = Observation(f"raw_{category}_{uuid.uuid4().hex[:8]}")
    name = f"{run_ts.strftime('%Y%m%dT%H%M%S%f')}-{batch or uuid.uuid4().hex}"
    folder = f"{base.rstrip('/')}/raw-data/{category}/{name}"
    stamped = df.observe(obs, F.count(F.lit(1)).alias("records")).withColumn("_ingested_at",
                                                                              F.lit(run_ts.isoformat()))
    stamped.write.mode("overwrite").options(**JSON_OPTIONS).json(folder)
    return read_lake_json(df.sparkSession, folder, stamped.schema), int(obs.get["records"])


# -------------------------------------------------------------- inventory
def file_inventory(spark: SparkSession, prefix: str) -> DataFrame:
    """name, modification time and length of every file under ``prefix``
    (binaryFile source; the content column is pruned, so no bytes are read)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(prefix)
            .select(F.col("path").alias("name"), F.col("modificationTime").alias("last_modified"),
                    F.col("length").alias("content_length")))


#: Files that a compacted one should have about, in bytes, and up to what share of that a file counts as small.
TARGET_BYTES, SMALL = 128 << 20, 0.75


def compaction_plan(inventory: DataFrame, base: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """``inventory`` (files under ``base``) with folder, and bin: which new file of its folder a file's rows go to.

    Small files of a folder are filled into bins of about ``target_bytes`` in the order of their names; large files, empty
    ones, and a small file that would be alone in its bin have none (null), for there is nothing to gain. Files of the
    lake's own bookkeeping (names or folders that begin with _ or .) are left out."""
    root = F.regexp_replace(F.lit(base.rstrip("/")), "^file:/*", "/")
    below = F.expr("substring(path, length(root) + 2)")
    files = (inventory.withColumn("root", root).withColumn("path", F.regexp_replace("name", "^file:/*", "/"))
             .where(F.col("path").startswith(F.concat("root", F.lit("/")))).withColumn("below", below)
             .where(~F.col("below").rlike("(^|/)[._]")).withColumn("folder", F.regexp_extract("below", "^(.*)/[^/]*$", 1)))
    small = (F.col("content_length") > 0) & (F.col("content_length") < int(SMALL * target_bytes))
    upto = F.sum("content_length").over(Window.partitionBy("folder", "small").orderBy("name"))
    binned = (files.withColumn("small", small).withColumn("upto", upto)
              .withColumn("bin", F.when(F.col("small"), F.floor((F.col("upto") - 1) / target_bytes).cast("long"))))
    together = F.count("bin").over(Window.partitionBy("folder", "bin")) > 1
    return (binned.withColumn("bin", F.when(together, F.col("bin")))
            .drop("root", "path", "below", "small", "upto"))


def compact_lake(spark: SparkSession, base: str, out: str, plan: DataFrame) -> DataFrame:
    """Write the parquet lake ``base`` anew to ``out`` by a compaction plan: one file a bin, every row kept; read back.

    Rows of files without a bin keep their files apart. The source is left as it is: readers go over to ``out`` (by a
    commit, for instance), and a crash in between harms nothing."""
    data = spark.read.parquet(base)
    parts = [c for c in data.columns if c not in _file_columns(spark, data, plan)]
    # one row a file; the new files are numbered, so that each is a task of its own
    target = plan.select(F.regexp_replace("name", "^file:/*", "/").alias("_file"), "folder",
                         F.coalesce(F.col("bin").cast("string"), F.col("name")).alias("_bin"))
    new = target.select("folder", "_bin").distinct()
    numbered = new.withColumn("_to", (F.row_number().over(Window.orderBy("folder", "_bin")) - 1).cast("int"))
    rows = (data.withColumn("_file", F.regexp_replace(F.col("_metadata.file_path"), "^file:/*", "/"))
            .join(target.join(numbered, ["folder", "_bin"]).select("_file", "_to"), "_file").drop("_file"))
    writer = rows.repartitionById(max(1, new.count()), "_to").drop("_to").write.mode("errorifexists")
    (writer.partitionBy(*parts) if parts else writer).parquet(out)
    return spark.read.schema(data.schema).parquet(out)


def _file_columns(spark: SparkSession, data: DataFrame, plan: DataFrame) -> set[str]:
    """The columns that stand in the files themselves, not in their folders' names."""
    one = plan.where("content_length > 0").select("name").first()
    return set(spark.read.parquet(one["name"]).columns) if one else set(data.columns)


def lake_lifecycle_plan(inventory: DataFrame, now: dt.datetime, cool_days: int = 30, archive_days: int = 90,
                        delete_days: int = 365) -> DataFrame:
    """Tier per file by age: > delete_days delete, > archive_days archive,
    > cool_days cool, else hot."""
    age = F.datediff(F.lit(now.date()), F.to_date("last_modified"))
    return inventory.withColumn("age_days", age).withColumn(
        "action", F.when(age > delete_days, "delete").when(age > archive_days, "archive")
        .when(age > cool_days, "cool").otherwise("hot"))


# --------------------------------------------------------------- snapshots
MANIFEST_SCHEMA = "name string, version string, path string, row_count long, refreshed_at timestamp, " \
                  "duration_seconds double"
AUDIT_SCHEMA = "table_name string, action string, new_data string, audit_ts timestamp"


def append_history(rows: DataFrame, base: str, table: str) -> None:
    """Add the few rows of a run to ``{base}/{table}`` as one file (``compaction_plan`` and ``compact_lake`` join them).

    The file is written aside and then moved, so that runs at the same time don't disturb each other."""
    files, root = Files(rows.sparkSession), base.rstrip("/")
    name = uuid.uuid4().hex
    draft = f"{root}/_drafts/{name}"
    rows.coalesce(1).write.parquet(draft)
    for part in files.entries(draft):
        if part.name.endswith(".parquet"):
            files.move(part.path, f"{root}/{table}/{name}-{part.name}")
    files.delete(draft)


def _append(spark: SparkSession, base: str, table: str, rows: list[tuple], schema: str) -> None:
    append_history(spark.createDataFrame(rows, schema), base, table)


def _audit(spark: SparkSession, base: str, name: str, action: str, payload: str, at: dt.datetime) -> None:
    _append(spark, base, "_audit", [("materialized_views", action, payload, at)], AUDIT_SCHEMA)


def write_version(spark: SparkSession, base: str, name: str, df: DataFrame, now: dt.datetime) -> tuple:
    """Write ``df`` as a new version folder of ``name``; returns its manifest
    row. On failure an ERROR audit row is appended at once (independently of
    the failed write) and the error is re-raised. Nobody reads the version before it is published."""
    version = now.strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:6]
    path = f"{base.rstrip('/')}/{name}/v={version}"
    t0 = time.time()
    obs = Observation(f"snap_{name}_{version}")
    try:
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
    except Exception as e:  # noqa: BLE001
        _audit(spark, base, name, "REFRESH_ERROR", json.dumps({"view": name, "error": str(e)}), now)
        raise
    return (name, version, path, int(obs.get["rows"]), now, time.time() - t0)


def _entry(row: tuple) -> dict:
    name, version, path, count, at, seconds = row
    return {"version": version, "path": path, "row_count": count, "refreshed_at": at.isoformat(), "duration_seconds": seconds}


def publish_versions(spark: SparkSession, base: str, rows: list[tuple], now: dt.datetime,
                     unless: Callable[[State], bool] | None = None) -> DataFrame:
    """Publish written versions in one commit (readers switch to them together), and append the manifest's history and
    one COMPLETE audit row per view. Where ``unless`` holds of the newest state nothing is published: then another
    writer was first, and the versions are removed. Returns the manifest rows published."""
    def change(tables: State) -> State | None:
        if unless is not None and unless(tables):
            return None
        return tables | {row[0]: _entry(row) for row in rows}

    _, state = CommitLog(spark, base).commit(change, now)
    if any(state.get(row[0], {}).get("version") != row[1] for row in rows):
        for row in rows:
            Files(spark).delete(row[2])
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    _append(spark, base, "_manifest", rows, MANIFEST_SCHEMA)
    _append(spark, base, "_audit", [
        ("materialized_views", "REFRESH_COMPLETE", json.dumps({"view": n, "rows": c, "duration_seconds": round(d, 3)}), now)
        for n, _v, _p, c, _t, d in rows], AUDIT_SCHEMA)
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)


def snapshot_refresh(spark: SparkSession, base: str, name: str, df: DataFrame,
                     now: dt.datetime | None = None) -> DataFrame:
    """Recompute one stored view: write a new version folder, then publish it in the commit log under ``base`` (readers
    see the newest commit, whole), with START, COMPLETE and ERROR audit rows."""
    now = now or dt.datetime.now()
    _audit(spark, base, name, "REFRESH_START", json.dumps({"views": [name]}), now)
    return publish_versions(spark, base, [write_version(spark, base, name, df, now)], now)


def latest_snapshot(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """The manifest row of the current version of ``name`` (None before its first refresh under ``base``)."""
    entry = CommitLog(spark, base).latest()[1].get(name)
    if entry is None:
        return None
    row = (name, entry["version"], entry["path"], entry["row_count"], dt.datetime.fromisoformat(entry["refreshed_at"]),
           entry["duration_seconds"])
    return spark.createDataFrame([row], MANIFEST_SCHEMA)


def snapshot_if_stale(spark: SparkSession, base: str, name: str, build, ttl_seconds: int = 300,
                      now: dt.datetime | None = None) -> DataFrame:
    """Read the stored view if its current version is younger than the TTL, else recompute it with ``build()`` and
    store a new version. Of two callers that find it stale at once, the first to publish wins: the other removes what it
    wrote and reads the published version."""
    now = now or dt.datetime.now()
    fresh = lambda e: e is not None and (now - dt.datetime.fromisoformat(e["refreshed_at"])).total_seconds() < ttl_seconds
    log = CommitLog(spark, base)
    if not fresh(log.latest()[1].get(name)):
        _audit(spark, base, name, "REFRESH_START", json.dumps({"views": [name]}), now)
        written = write_version(spark, base, name, build(), now)
        publish_versions(spark, base, [written], now, unless=lambda tables: fresh(tables.get(name)))
    return spark.read.parquet(log.latest()[1][name]["path"])
