"""Small hand-made retail frames for edge cases no driver table has."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from storelens.operators.access import GRANT_SCHEMA
from storelens.sources.retail import Retail

AS_OF = dt.date(2001, 8, 1)

SI_SCHEMA = ("interaction_id long, store_id int, customer_id long, transaction_date timestamp_ntz, "
             "total_amount decimal(18,2), is_attendant_influenced boolean, substitution_occurred boolean, "
             "gender string, age int, emotion string, duration_seconds long")


def ts(days_before: float, hour: int = 10) -> dt.datetime:
    return dt.datetime.combine(AS_OF, dt.time()) - dt.timedelta(days=days_before) + dt.timedelta(hours=hour)


def si_row(iid, store, cust, when, amount, infl=False, subs=False, gender="F", age=30, emotion="happy", dur=60):
    from decimal import Decimal

    amt = None if amount is None else Decimal(str(amount))
    return (iid, store, cust, when, amt, infl, subs, gender, age, emotion, dur)


def world(spark: SparkSession, interactions: list[tuple], items: list[tuple] | None = None,
          devices: list[tuple] | None = None, products: list[tuple] | None = None,
          brands: list[tuple] | None = None) -> Retail:
    """A Retail over injected frames: two regions, three stores."""
    from decimal import Decimal

    stores = spark.createDataFrame([(1, "S1", "NCR", "supermarket"), (2, "S2", "NCR", "sari_sari"),
                                    (3, "S3", "VISAYAS", "sari_sari")], "id int, name string, region string, "
                                                                        "store_type string")
    regions = spark.createDataFrame([(1, "NCR", "Luzon", Decimal("5.00"), Decimal("0.3000")),
                                     (2, "VISAYAS", "Visayas", Decimal("6.00"), Decimal("0.2000"))],
                                    "id int, region string, mega_region string, population_millions decimal(4,2), "
                                    "economic_weight decimal(5,4)")
    brands = brands or [(1, "Brand#1", "Dairy"), (2, "Brand#2", "Dairy"), (9, "Brand#9", "Snacks")]
    products = products or [(10, "milk", 1, "Dairy", True, Decimal("10.00")),
                            (20, "cream", 2, "Dairy", True, Decimal("10.00")),
                            (30, "chips", 9, "Snacks", False, Decimal("5.00"))]
    frames = dict(
        stores=stores, ph_regions=regions,
        brands=spark.createDataFrame(brands, "id int, name string, category string"),
        products=spark.createDataFrame(products, "id long, name string, brand_id int, category string, "
                                                 "is_fmcg boolean, unit_price decimal(10,2)"),
        sales_interactions=spark.createDataFrame(interactions, SI_SCHEMA),
        transaction_items=spark.createDataFrame(items or [], "interaction_id long, product_id long, quantity int"),
        device_master=spark.createDataFrame(devices or [], "device_id long, store_id int, status string, "
                                                           "last_seen timestamp_ntz"),
    )
    return Retail.from_frames(spark, **frames)


def rows(df: DataFrame, *cols: str) -> list[tuple]:
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple(str(x) for x in t))


def fixture_grants(spark: SparkSession) -> DataFrame:
    """The user_store_access fixture: a live grant, a revoked one, an expired
    one, an admin grant, a user with two stores and a user whose only store
    never sold (store 99 does not exist)."""
    t = dt.datetime
    rows = [
        (1, 7, 3, "read", 1, t(2001, 1, 1), None, True),
        (2, 7, 5, "read", 1, t(2001, 1, 1), None, False),
        (3, 7, 8, "read", 1, t(2001, 1, 1), t(2001, 6, 1), True),
        (4, 1, 3, "admin", None, t(2000, 1, 1), None, True),
        (5, 9, 10, "write", 1, t(2001, 2, 1), None, True),
        (6, 9, 11, "read", 1, t(2001, 2, 1), t(2002, 1, 1), True),
        (7, 12, 99, "read", 1, t(2001, 3, 1), None, True),
    ]
    return spark.createDataFrame(rows, GRANT_SCHEMA)
