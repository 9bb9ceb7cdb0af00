"""Disclosure control: data-partner shares, unique dominant partner, suppression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosband.functions.measures import share, share_key, share_limit
from rosband.schema import Thresholds


def partner_shares(volumes: DataFrame, keys: Sequence[str], totals: Sequence[str] = ()) -> DataFrame:
    """Add ``total_dp_volume``, ``dp_volume_share`` and ``data_partner_count``.

    ``totals`` names further columns whose sum over the key takes their place.
    The window is over already aggregated partner rows, so a partition holds
    one row per data partner of the cell -- bounded by the partner count.
    The number of rows per key is the number of distinct data partners.
    """
    w = Window.partitionBy(*keys)
    return (
        volumes.withColumn("total_dp_volume", F.sum("dp_volume").over(w))
        .withColumn("dp_volume_share", share("dp_volume", "total_dp_volume"))
        .withColumn("data_partner_count", F.count(F.lit(1)).over(w))
        .withColumns({c: F.sum(c).over(w) for c in totals})
    )


def partner_summary(
    shares: DataFrame,
    keys: Sequence[str],
    partner: str = "data_partner",
    tie_policy: str = "drop",
    totals: Sequence[str] = (),
) -> DataFrame:
    """One row per key: ``data_partner_count``, the unique largest partner with its share, and ``totals`` of the key.

    With ``tie_policy="drop"`` (the analysed job's behaviour: an average-method
    rank gives tied leaders 1.5, so no row has rank 1) a key whose top share is
    tied gets nulls in the two ``nda_*`` columns and is later removed by the
    inner-join semantics.  ``"keep"`` reports the smallest partner id among the
    leaders.  Null shares (zero total) never rank.  Shares are compared at 12
    decimals (``share_key``) so that order-dependent last-bit noise cannot split
    a tie.

    Both windows and the final aggregate share the partitioning of ``shares``
    (by ``keys``): no further shuffle, and a partition holds one row per partner.
    """
    if tie_policy not in ("drop", "keep"):
        raise ValueError(f"unknown tie_policy {tie_policy!r}")
    w = Window.partitionBy(*keys)
    s = F.col("dp_volume_share")
    k = share_key(s)
    ranked = shares.withColumn("__k", k).withColumn("__max", F.max("__k").over(w))
    ranked = ranked.withColumn("__n_top", F.count(F.when(F.col("__k") == F.col("__max"), 1)).over(w))
    lead = ranked.where((F.col("__k") == F.col("__max")) | F.col("__max").isNull())
    summary = lead.groupBy(*keys).agg(
        F.max("data_partner_count").alias("data_partner_count"),
        F.max("__n_top").alias("__n_top"),
        F.min(partner).alias("__top"),
        F.max(s).alias("__share"),
        *[F.max(c).alias(c) for c in totals],
    )
    unique = F.col("__n_top") == 1 if tie_policy == "drop" else F.col("__n_top") >= 1
    return summary.select(
        *keys,
        "data_partner_count",
        F.when(unique, F.col("__top")).alias("nda_data_partner_with_max_share"),
        F.when(unique, F.col("__share")).alias("nda_max_data_partner_share"),
        *totals,
    )


def disclosure_flags(cells: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Add one boolean per rule and their conjunction ``publish`` (null -> False)."""
    po = F.coalesce(F.col("outlet_count") >= F.lit(t.min_outlets), F.lit(False))
    pp = F.coalesce(F.col("data_partner_count") >= F.lit(t.min_partners), F.lit(False))
    ps = F.coalesce(share_key("nda_max_data_partner_share") <= F.lit(share_limit(t.max_share)), F.lit(False))
    return cells.withColumns(
        {"pass_outlets": po, "pass_partners": pp, "pass_share": ps, "publish": po & pp & ps}
    )


def suppress(cells: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Keep cells with >= min outlets, >= min partners and top share <= max share."""
    return cells.where(
        (F.col("outlet_count") >= F.lit(t.min_outlets))
        & (F.col("data_partner_count") >= F.lit(t.min_partners))
        & (share_key("nda_max_data_partner_share") <= F.lit(share_limit(t.max_share)))
    )
