import random

import numpy as np

from rosband.operators.bands import edges_of_cells
from rosband.operators.joins import Datasets
from rosband.plans.price_bands import price_bands
from rosband.schema import DimSpec
from rosband.sources.retail import PERIOD_FILTER

from conftest import d


def test_edges_of_cells_from_rows_that_are_not_expanded(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice(["a", "b"]), rng.choice(["x", "y", None]), rng.choice(["Core", "Other", None]), rng.uniform(1, 9), rng.randint(1, 3))
        for _ in range(400)
    ]
    hist = spark.createDataFrame(rows, "item string, region string, segment string, price double, __n long")
    spec, cells = DimSpec(), {}
    for item, region, segment, price, n in rows:
        for r in {region, spec.all_regions} - {None}:
            for s in {segment, spec.all_segments} - {None}:
                cells.setdefault((item, r, s), []).extend([price] * n)
    qs = [0.2, 0.5, 1.0]
    got = {
        (r["item"], r["region"], r["segment"]): r["edges"]
        for r in edges_of_cells(hist, spec, ["region", "segment"], ["item"], qs).collect()
    }
    assert got.keys() == cells.keys() and len(got) == 18
    assert all(np.allclose(got[k], np.quantile(cells[k], qs), rtol=1e-12) for k in cells)


def test_bands_are_looked_up_once(spark, sales):
    rng = random.Random(5)
    rows = sales([
        (d(m, PERIOD_FILTER[0]), PERIOD_FILTER[0], o, "p", f"r{o % 2}", "Core", str(o % 3), rng.uniform(5, 9), 2.0)
        for m in (1, 2) for o in range(30)
    ])
    own = Datasets(spark)
    with own.active():
        stages = price_bands(rows, period_filter=PERIOD_FILTER)
        for df in (stages.banded, stages.grain):
            assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
        assert stages.banded.count() == 60 * 4
    own.close()
