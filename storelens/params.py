"""Fixture parameters.

Thresholds default to the blueprint's values; every operator takes them as
keyword arguments so the fixtures can use cut-offs that fit their amounts.
"""

from __future__ import annotations

import datetime as dt

# On the TPC-H-shaped fixtures the eight client brands are Brand#1 .. Brand#8.
FIXTURE_FOCUS_BRANDS = tuple(f"Brand#{i}" for i in range(1, 9))

# as_of for the fixtures = max(o_orderdate) at every scale factor.
FIXTURE_AS_OF = dt.date(2001, 8, 1)
# audit_log (events) runs 2024-01-01 .. 2024-01-30.
FIXTURE_AUDIT_AS_OF = dt.datetime(2024, 1, 31)

MONEY_SCALE = 2
