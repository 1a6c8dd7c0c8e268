"""Loading the retail tables from raw feeds by a contract.

A raw feed is a table of texts (a CSV or JSON landing zone). The contract names each
column's type, whether it must be there, and a check of its value. A row is loaded if all
its columns hold; otherwise it is rejected, whole and with every reason. One pass over the
feed finds both; no row is lost.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A column: its SQL type, whether a value is required, a check (SQL, over typed columns) and what a failed one says."""

    name: str
    type: str
    required: bool = True
    check: str | None = None
    says: str | None = None


# The columns of the eight retail tables; the first is the key.
CONTRACTS: dict[str, tuple[Rule, ...]] = {
    "brands": (Rule("id", "int"), Rule("name", "string"), Rule("category", "string")),
    "products": (Rule("id", "long"), Rule("name", "string", False), Rule("brand_id", "int"), Rule("category", "string"),
                 Rule("is_fmcg", "boolean"), Rule("unit_price", "decimal(10,2)", True, "unit_price >= 0", "is negative")),
    "ph_regions": (Rule("id", "int"), Rule("region", "string"),
                   Rule("mega_region", "string", True, "mega_region in ('Luzon', 'Visayas', 'Mindanao')", "is unknown"),
                   Rule("population_millions", "decimal(4,2)"),
                   Rule("economic_weight", "decimal(5,4)", True, "economic_weight between 0 and 1", "is out of range")),
    "stores": (Rule("id", "int"), Rule("name", "string"), Rule("region", "string"),
               Rule("store_type", "string", True,
                    "store_type in ('supermarket', 'department_store', 'convenience_store', 'sari_sari')", "is unknown")),
    "device_master": (Rule("device_id", "long"), Rule("store_id", "int"),
                      Rule("status", "string", True, "status in ('active', 'offline', 'maintenance')", "is unknown"),
                      Rule("last_seen", "timestamp_ntz", False)),
    "sales_interactions": (Rule("interaction_id", "long"), Rule("store_id", "int"), Rule("customer_id", "long", False),
                           Rule("transaction_date", "timestamp_ntz"),
                           Rule("total_amount", "decimal(18,2)", True, "total_amount >= 0", "is negative"),
                           Rule("is_attendant_influenced", "boolean"), Rule("substitution_occurred", "boolean"),
                           Rule("gender", "string", False, "gender in ('F', 'M')", "is unknown"),
                           Rule("age", "int", False, "age between 0 and 120", "is out of range"),
                           Rule("emotion", "string", False), Rule("duration_seconds", "long", False, "duration_seconds >= 0",
                                                                  "is negative")),
    "transaction_items": (Rule("interaction_id", "long"), Rule("product_id", "long"),
                          Rule("quantity", "int", True, "quantity > 0", "is not positive")),
    "audit_log": (Rule("id", "long"), Rule("user_id", "long", False), Rule("table_name", "string"), Rule("action", "string"),
                  Rule("audit_ts", "timestamp_ntz"), Rule("new_data", "string", False), Rule("ip_address", "string", False),
                  Rule("user_agent", "string", False)),
}


def raw_feed(df: DataFrame) -> DataFrame:
    """A typed table as a feed of texts."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _reason(rule: Rule, columns: list[str]) -> Column:
    """What is wrong with a column, null if nothing is."""
    if rule.name not in columns:
        return F.lit(f"{rule.name} is missing" if rule.required else None).cast("string")
    text = F.col(f"_raw.{rule.name}")
    absent = text.isNull() if rule.type == "string" else text.isNull() | (F.trim(text) == "")
    out = F.when(absent, F.lit(f"{rule.name} is missing" if rule.required else None).cast("string"))
    out = out.when(F.col(f"_row.{rule.name}").isNull(), F.lit(f"{rule.name} is no {rule.type}"))
    if rule.check:
        out = out.when(~F.col(f"_ok.{rule.name}"), F.lit(f"{rule.name} {rule.says}"))
    return out


def checked(feed: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(row, raw, reasons) of every row of ``feed`` (texts): the typed row, the feed's row, and what is wrong with it."""
    typed = [F.expr(f"try_cast(`{r.name}` as {r.type})").alias(r.name) if r.name in feed.columns
             else F.lit(None).cast(r.type).alias(r.name) for r in rules]
    rows = feed.select(F.struct(*feed.columns).alias("_raw"), *feed.columns).select("_raw", F.struct(*typed).alias("_row"))
    checks = [F.expr(r.check).alias(r.name) for r in rules if r.check]
    if checks:
        rows = rows.select("_raw", "_row", "_row.*").select("_raw", "_row", F.struct(*checks).alias("_ok"))
    reasons = F.array_compact(F.array(*[_reason(r, feed.columns) for r in rules]))
    return rows.select(F.col("_row").alias("row"), F.col("_raw").alias("raw"), reasons.alias("reasons"))


def load(feed: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(loaded, rejected) rows of a raw feed of one of the retail tables.

    ``loaded``: typed columns of the contract. ``rejected``: table_name, row_key (the key's text), reasons (sorted by
    column) and record (the feed's row as JSON). Columns that the contract doesn't name are not loaded; a required one
    that the feed lacks rejects all its rows. An empty feed gives two empty tables.
    """
    rules = CONTRACTS[table]
    found = checked(feed, rules)
    key = F.col(f"raw.{rules[0].name}") if rules[0].name in feed.columns else F.lit(None).cast("string")
    rejected = found.where("size(reasons) > 0").select(
        F.lit(table).alias("table_name"), key.alias("row_key"), "reasons",
        F.to_json("raw", {"ignoreNullFields": "false"}).alias("record"))
    return found.where("size(reasons) = 0").select("row.*"), rejected
