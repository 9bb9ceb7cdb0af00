"""rosband: retail price-band and rate-of-sale analytics on Spark.

Layout
------
``sources``    reading the sales extract (Parquet / JDBC), snapshots, selection tables
``functions``  column-expression builders (labels, unit rules, band assignment)
``operators``  DataFrame -> DataFrame steps (outliers, roll-up expansion, edges, ROS, dominance, suppression)
``plans``      the composite jobs (price bands, average price, report lists)
"""

from rosband.schema import Columns, Thresholds

__all__ = ["Columns", "Thresholds"]
