from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from quarterlens.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8)
    yield s


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


SUB_SCHEMA = ("subscription_id STRING, customer_id BIGINT, month DATE, plan_tier STRING, "
              "mrr DECIMAL(12,2), status STRING")


def subs_frame(spark, rows):
    """rows: (customer_id, 'YYYY-MM-01', plan_tier or None, status)."""
    from decimal import Decimal
    data = [(f"S{i}", c, d(m), t, Decimal("100.00"), st) for i, (c, m, t, st) in enumerate(rows)]
    return spark.createDataFrame(data, SUB_SCHEMA)
