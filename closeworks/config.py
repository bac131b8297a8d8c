"""Settings of a close: business units, currencies, thresholds, phases.

Everything here is driver-side and small. The dimension frames built from it
have one row per configured entry, which is the size bound that the broadcast
joins in ``closeworks.operators`` rely on.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------

PHASE_NAMES = {
    1: "Data Gathering - Exchange Rates",
    2: "Adjustments",
    3: "Data Gathering - Segmented & Forecast",
    4: "Review",
    5: "Reporting & Sign-off",
}

PHASE_SLA_HOURS = {1: 24, 2: 48, 3: 24, 4: 24, 5: 12}

CATEGORY_BY_FIRST_DIGIT = {
    "4": "Revenue",
    "5": "COGS",
    "6": "OpEx",
    "7": "Other Income/Expense",
    "8": "Tax",
}

# Report order of the categories; everything else sorts after them.
CATEGORY_RANK = {"Revenue": 1, "COGS": 2, "OpEx": 3}

SEGMENT_TYPES = ("Product", "Geography", "Customer", "Channel")

CURRENCIES = ("USD", "EUR", "GBP", "JPY", "CNY", "SGD", "BRL", "MXN", "CAD", "AUD")

RECONCILED_ACCOUNTS = ("4000", "4100", "4200", "5000", "5100")

SEGMENT_VALUES = {
    "Product": ("Hardware", "Software", "Services", "Subscriptions"),
    "Geography": ("North", "South", "East", "West", "Central"),
    "Customer": ("Enterprise", "SMB", "Consumer"),
    "Channel": ("Direct", "Partner", "Online", "Retail"),
}

ACCOUNT_GROUPS = {
    "revenue": ("4000", "4100", "4200", "4300"),
    "cogs": ("5000", "5100", "5200"),
    "opex": ("6000", "6100", "6200", "6300", "6400"),
    "other": ("7000", "7100", "8000", "8100"),
}

# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class BusinessUnit:
    code: str
    name: str
    region: str
    currency: str
    contact: str


@dataclass(frozen=True)
class CloseConfig:
    business_units: tuple[BusinessUnit, ...]
    currencies: tuple[str, ...] = CURRENCIES
    base_currency: str = "USD"
    fx_variance_threshold: float = 5.0
    valid_cuts: tuple[int, ...] = (1, 2)
    segment_types: tuple[str, ...] = SEGMENT_TYPES
    reconciled_accounts: tuple[str, ...] = RECONCILED_ACCOUNTS
    reconciliation_tolerance: float = 0.01
    large_adjustment: float = 100_000.0
    material_variance: float = 10_000.0
    operations_contact: str = "finance.ops@company.com"
    phase_names: dict[int, str] = field(default_factory=lambda: dict(PHASE_NAMES))
    phase_sla_hours: dict[int, int] = field(default_factory=lambda: dict(PHASE_SLA_HOURS))

    @property
    def bu_codes(self) -> list[str]:
        return [bu.code for bu in self.business_units]


# The business units of the standard close.
DEFAULT_CONFIG = CloseConfig(
    business_units=(
        BusinessUnit("NA", "North America", "Americas", "USD", "na.finance@company.com"),
        BusinessUnit("EMEA", "Europe, Middle East, Africa", "EMEA", "EUR", "emea.finance@company.com"),
        BusinessUnit("APAC", "Asia Pacific", "APAC", "SGD", "apac.finance@company.com"),
        BusinessUnit("LATAM", "Latin America", "Americas", "BRL", "latam.finance@company.com"),
    )
)


BU_SCHEMA = T.StructType(
    [
        T.StructField("bu_code", T.StringType(), False),
        T.StructField("bu_name", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("bu_currency", T.StringType()),
        T.StructField("contact", T.StringType()),
    ]
)


def local_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small literal frame. Arrow input becomes a local relation, so Spark knows its size."""
    table = pa.Table.from_pylist([dict(zip(schema.fieldNames(), row)) for row in rows])
    return spark.createDataFrame(table, schema=schema)


def bu_dim(spark: SparkSession, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    rows = [(b.code, b.name, b.region, b.currency, b.contact) for b in cfg.business_units]
    return local_frame(spark, rows, BU_SCHEMA)


def segment_dim(spark: SparkSession) -> DataFrame:
    """The configured (segment_type, segment_value) pairs."""
    schema = T.StructType().add("segment_type", "string").add("segment_value", "string")
    return local_frame(spark, [(t, v) for t, values in SEGMENT_VALUES.items() for v in values], schema)


def account_dim(spark: SparkSession) -> DataFrame:
    """The configured (account_group, account_code) pairs."""
    schema = T.StructType().add("account_group", "string").add("account_code", "string")
    return local_frame(spark, [(g, a) for g, codes in ACCOUNT_GROUPS.items() for a in codes], schema)
