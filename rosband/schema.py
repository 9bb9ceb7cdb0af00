"""Column names, fixed labels and the sales schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the analysed job's values for identical output.
ALL_REGIONS = "GB"  # label of the all-regions roll-up member
ALL_SEGMENTS = "All Pubs"  # label of the all-segments roll-up member
NOT_MEMBER = "n"  # "row is not in this region dimension"
DEFAULT_QUANTILES = (0.2, 0.4, 0.6, 0.8, 1.0)
DEFAULT_METRICS = ("volume", "value")  # order used by the published job
OUTLIER_DEFAULT_METRICS = ("value", "volume")  # default order of the outlier step
PINT_ML = 568.0
MIN_OUTLETS = 50
MIN_PARTNERS = 3
MAX_PARTNER_SHARE = 0.5
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Columns:
    """Names of the columns of a sales frame."""

    date: str = "date"
    period: str = "period"
    outlet: str = "outlet"
    product: str = "product"
    data_partner: str = "data_partner"
    value: str = "value"
    volume: str = "volume"
    quantity: str = "quantity"
    price: str = "price"


@dataclass(frozen=True)
class Thresholds:
    """Disclosure rule: publish a cell only if all three hold (all inclusive)."""

    min_outlets: int = MIN_OUTLETS
    min_partners: int = MIN_PARTNERS
    max_share: float = MAX_PARTNER_SHARE


@dataclass(frozen=True)
class DimSpec:
    """Which columns form a cell next to date/period and the item.

    ``regions`` / ``segments`` list candidate columns; only those present in the
    frame are used.  With one region and one segment column this is the cube of
    variant A.  With several region columns, or whenever ``shared_labels`` is set
    (variant B), every (region column, segment column) pair is cubed and the region
    labels share one output column ``region``; ``region_dim`` names the column that a
    label came from, so equal labels of two region columns stay apart.  ``not_member``
    rows are dropped and the all-regions roll-up is omitted unless ``keep_all_regions``.
    """

    regions: tuple[str, ...] = ("region",)
    segments: tuple[str, ...] = ("segment",)
    all_regions: str = ALL_REGIONS
    all_segments: str = ALL_SEGMENTS
    not_member: str | None = None
    keep_all_regions: bool = True
    region_out: str = "region"
    segment_out: str = "segment"
    region_dim_out: str = "region_dim"
    shared_labels: bool = False

    @staticmethod
    def multi(region_columns, segment_columns=("segment",)) -> "DimSpec":
        return DimSpec(
            regions=tuple(region_columns),
            segments=tuple(segment_columns),
            not_member=NOT_MEMBER,
            keep_all_regions=False,
            shared_labels=True,
        )


SALES_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("period", T.IntegerType()),
        T.StructField("outlet", T.LongType()),
        T.StructField("product", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("data_partner", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
    ]
)


MULTI_SCHEMA = T.StructType(
    [f for f in SALES_SCHEMA.fields if f.name != "region"] + [T.StructField(f"region{i}", T.StringType()) for i in range(1, 5)]
)


def require_columns(df: DataFrame, names) -> None:
    """Fail fast (at plan time, no job) when a needed column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; frame has {df.columns}")


def conform(df: DataFrame, schema: T.StructType = SALES_SCHEMA) -> DataFrame:
    """Cast the schema's columns to their declared types; keep extra columns."""
    require_columns(df, schema.fieldNames())
    casts = {f.name: df[f.name].cast(f.dataType) for f in schema.fields}
    return df.withColumns(casts)
