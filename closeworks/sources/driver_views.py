"""The raw close tables, derived from an order/line-item schema and an event log.

The mapping is fixed by the fixtures of this repository: line items stand for ledger
lines, events for rate ticks and task-log entries, orders for status and sign-off rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closeworks.config import BusinessUnit, CloseConfig

# --- fixed values -----------------------------------------------------------

PERIOD = "1997-06"
FX_AS_OF = "2024-01-31"
STATUS_AS_OF = "2001-09-01"
FX_ORDER = ("rate_date", "event_id")

CONFIG = CloseConfig(
    business_units=(
        BusinessUnit("AMERICA", "America Unit", "Americas", "USD", "america.finance@company.com"),
        BusinessUnit("EUROPE", "Europe Unit", "EMEA", "EUR", "europe.finance@company.com"),
        BusinessUnit("ASIA", "Asia Unit", "APAC", "SGD", "asia.finance@company.com"),
        BusinessUnit("AFRICA", "Africa Unit", "EMEA", "BRL", "africa.finance@company.com"),
    ),
    currencies=("EUR", "SGD", "BRL", "GBP", "USD"),
)

# Columns of the driver tables; stated, so that opening a table reads no file.
LAYOUT = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

FX_RAW = """
event_id
cast(event_id AS string) AS load_id
CASE user_id % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'SGD' WHEN 2 THEN 'BRL' WHEN 3 THEN 'GBP' ELSE 'QQQ' END AS currency
CASE WHEN event_type = 'error' AND event_id % 7 = 0 THEN NULL WHEN event_id % 499 = 0 THEN 0e0 ELSE (CASE user_id % 5 WHEN 0 THEN 0.92e0 WHEN 1 THEN 1.34e0 WHEN 2 THEN 4.97e0 WHEN 3 THEN 0.79e0 ELSE 1e0 END) * (1e0 + cast((event_id * 37) % 200 - 100 AS double) / 1e4) * (CASE WHEN event_id % 97 = 0 THEN 1.08e0 ELSE 1e0 END) END AS rate
cast(ts AS date) AS rate_date
event_type AS source
ts AS loaded_at
"""

FORECAST_FX_RAW = """
currency
concat(cast(1996 + cast((event_id % 72 - event_id % 12) / 12 AS int) AS string), '-', lpad(cast(event_id % 12 + 1 AS string), 2, '0')) AS forecast_month
rate AS forecast_rate
'TREASURY_FORECAST' AS source
"""

LEDGER_RAW = """
l_orderkey
l_linenumber
l_partkey
l_suppkey
CASE WHEN l_orderkey % 1009 = 0 THEN NULL ELSE r_name END AS bu_code
CASE WHEN l_orderkey % 997 = 0 THEN NULL ELSE CASE l_linenumber WHEN 1 THEN '4000' WHEN 2 THEN '4100' WHEN 3 THEN '5000' WHEN 4 THEN '5100' WHEN 5 THEN '6000' WHEN 6 THEN '7000' ELSE '8000' END END AS account_code
concat('line ', cast(l_linenumber AS string)) AS account_description
CASE WHEN n_nationkey = 23 THEN 'ZZZ' ELSE CASE r_name WHEN 'AMERICA' THEN 'USD' WHEN 'EUROPE' THEN 'EUR' WHEN 'ASIA' THEN 'SGD' WHEN 'AFRICA' THEN 'BRL' ELSE 'GBP' END END AS local_currency
cast(CASE WHEN l_linenumber IN (1, 2, 6) THEN l_extendedprice ELSE -l_extendedprice END AS double) AS local_amount
period
concat('CC00', cast(l_suppkey % 5 + 1 AS string)) AS cost_center
n_name
c_mktsegment
o_orderpriority
l_returnflag
l_linestatus
l_discount
"""

CUTS_RAW = """
CASE WHEN l_orderkey % 503 = 0 THEN 3 WHEN l_returnflag = 'A' THEN 1 ELSE 2 END AS cut_number
bu_code
account_code
concat('type ', l_linestatus, '-', o_orderpriority) AS adjustment_type
cast(CASE WHEN l_linenumber % 2 = 0 THEN l_discount ELSE -l_discount END * 1e3 AS double) * l_suppkey AS adjustment_amount
local_currency AS currency
account_description AS description
period
"""

SEGMENTS_RAW = """
bu_code
account_code
stack(4, part_type, p_type, 'Geography', n_name, 'Customer', c_mktsegment, CASE WHEN o_orderpriority = '5-LOW' THEN 'Unknown' ELSE 'Channel' END, o_orderpriority) AS (segment_type, segment_value)
local_amount / 4e0 AS amount
local_currency AS currency
period
"""

FORECAST_RAW = """
bu_code
account_code
concat(cast(cast(substr(period, 1, 4) AS int) + 1 AS string), substr(period, 5, 3)) AS forecast_period
local_amount * 1.05e0 AS forecast_amount
local_currency AS currency
'Rolling12' AS forecast_type
CASE WHEN l_linestatus = 'O' THEN 'v2.0' ELSE 'v1.0' END AS version
"""

TASK_LOG = """
cast(event_id AS string) AS log_id
concat('agent-', cast(user_id % 6 AS string)) AS agent_id
concat('Agent ', cast(user_id % 6 AS string)) AS agent_name
date_format(ts, 'yyyy-MM') AS closure_period
cast(user_id % 6 AS int) AS phase
concat('task ', cast(event_id % 9 AS string)) AS task_name
CASE event_type WHEN 'purchase' THEN 'COMPLETED' WHEN 'click' THEN 'COMPLETED' WHEN 'view' THEN 'RUNNING' WHEN 'error' THEN 'FAILED' ELSE 'WARNING' END AS status
ts AS started_at
value AS duration_seconds
event_id % 1000 AS records_processed
CASE WHEN event_type = 'error' THEN props END AS error_message
"""

NOTIFICATIONS = """
event_id AS notification_id
date_format(ts, 'yyyy-MM') AS closure_period
cast(user_id % 6 AS int) AS phase
CASE WHEN event_type = 'error' THEN 'WARNING' ELSE 'INFO' END AS severity
props AS message
event_type AS recipient
ts AS sent_at
CASE WHEN event_id % 3 = 0 THEN ts END AS acknowledged_at
"""

CLOSURE_STATUS = """
o_orderkey AS closure_id
date_format(o_orderdate, 'yyyy-MM') AS closure_period
cast(o_orderkey % 5 + 1 AS int) AS current_phase
CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'INITIALIZED' ELSE 'FAILED' END AS phase_status
o_orderdate AS started_at
cast(o_orderdate AS date) + cast(o_orderkey % 9 AS int) AS expected_completion
CASE WHEN o_orderstatus = 'F' THEN cast(o_orderdate AS date) + cast(o_orderkey % 11 AS int) END AS actual_completion
o_orderpriority AS notes
"""

APPROVALS = """
o_orderkey AS approval_id
date_format(o_orderdate, 'yyyy-MM') AS closure_period
4 AS phase
CASE WHEN o_orderkey % 3 = 0 THEN 'BU_SIGNOFF' ELSE 'FORECAST_REVIEW' END AS approval_type
o_orderpriority AS required_approver
CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'O' THEN 'PENDING' ELSE 'SCHEDULED' END AS status
o_orderdate AS requested_at
'c' AS comments
"""

# --- end of fixed values ----------------------------------------------------


def _columns(text: str) -> list[str]:
    return text.strip().splitlines()


class DriverViews:
    """Raw close tables over the parquet tables of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._opened: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.schema(LAYOUT[name]).parquet(f"{self.sf_dir}/{name}.parquet")
        return self._opened[name]

    def raw_table(self, name: str) -> DataFrame:
        """A raw close table by its name in ``closeworks.schemas``."""
        return {
            "exchange_rates_raw": self.fx_raw,
            "bu_preliminary_close_raw": self.ledger_raw,
            "accounting_cuts_raw": self.cuts_raw,
            "segmented_files_raw": self.segments_raw,
            "forecast_files_raw": self.forecast_raw,
            "forecast_fx_raw": self.forecast_fx_raw,
        }[name]()

    # --- rates --------------------------------------------------------------

    def fx_raw(self) -> DataFrame:
        return self.table("events").selectExpr(*_columns(FX_RAW))

    def forecast_fx_raw(self) -> DataFrame:
        return self.fx_raw().filter("rate > 0").selectExpr(*_columns(FORECAST_FX_RAW))

    # --- ledger and what derives from it --------------------------------------

    def ledger_raw(self) -> DataFrame:
        """Ledger lines. Orders get their customer attributes before they meet the line items.

        That way the largest table is shuffled once at most, by order key.
        """
        places = self.table("nation").join(self.table("region"), F.expr("n_regionkey = r_regionkey"))
        customers = self.table("customer").join(places, F.expr("c_nationkey = n_nationkey"))
        dated = self.table("orders").selectExpr(
            "o_orderkey", "o_custkey", "o_orderpriority", "date_format(o_orderdate, 'yyyy-MM') AS period"
        )
        orders = dated.join(customers, F.expr("o_custkey = c_custkey"))
        lines = self.table("lineitem").join(orders, F.expr("l_orderkey = o_orderkey"))
        return lines.selectExpr(*_columns(LEDGER_RAW))

    def cuts_raw(self) -> DataFrame:
        return self.ledger_raw().filter("l_returnflag IN ('A', 'R')").selectExpr(*_columns(CUTS_RAW))

    def segments_raw(self) -> DataFrame:
        """Four segment rows per ledger line, from one pass over the lines.

        Part keys are unique, so the left join keeps one row per line; a line whose part
        is unknown has no product row.
        """
        parts = self.table("part").selectExpr("p_partkey", "p_type", "'Product' AS part_type")
        lines = self.ledger_raw().join(parts, F.expr("l_partkey = p_partkey"), "left")
        return lines.selectExpr(*_columns(SEGMENTS_RAW)).filter("segment_type IS NOT NULL")

    def forecast_raw(self) -> DataFrame:
        return self.ledger_raw().selectExpr(*_columns(FORECAST_RAW))

    # --- status, sign-offs, task log ------------------------------------------

    def task_log(self) -> DataFrame:
        return self.table("events").selectExpr(*_columns(TASK_LOG))

    def notifications(self) -> DataFrame:
        return self.table("events").filter("event_type IN ('error', 'signup')").selectExpr(*_columns(NOTIFICATIONS))

    def closure_status(self) -> DataFrame:
        return self.table("orders").selectExpr(*_columns(CLOSURE_STATUS))

    def approvals(self) -> DataFrame:
        return self.table("orders").selectExpr(*_columns(APPROVALS))
