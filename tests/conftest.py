import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from rosband.session import local_session

    s = local_session("*", 8, app="rosband-tests")
    yield s


SALES_COLS = ["date", "period", "outlet", "product", "region", "segment", "data_partner", "value", "quantity", "volume"]


def d(month: int, year: int = 2020) -> dt.date:
    return dt.date(year, month, 1)


@pytest.fixture
def sales(spark):
    """Build a sales frame from tuples in SALES_COLS order (volume defaults to quantity)."""

    def make(rows):
        full = []
        for r in rows:
            r = list(r)
            if len(r) == len(SALES_COLS) - 1:
                r.append(float(r[8]))
            full.append(tuple(r))
        schema = (
            "date date, period int, outlet long, product string, region string, segment string, "
            "data_partner string, value double, quantity double, volume double"
        )
        return spark.createDataFrame(full, schema)

    return make
