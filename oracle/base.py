"""Shared tables of the oracle: raw, processed and published, as CTE texts."""

from __future__ import annotations

P = "1997-06"
BUS = "('AMERICA', 'EUROPE', 'ASIA', 'AFRICA')"
CURRENCIES = "('EUR', 'SGD', 'BRL', 'GBP', 'USD')"
SEGMENTS = "('Product', 'Geography', 'Customer', 'Channel')"


def money(x: str) -> str:
    """Order-independent sum."""
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,4))) AS DOUBLE)"


def mean(x: str, scale: str = "DECIMAL(18,4)") -> str:
    return f"CAST(SUM(CAST({x} AS {scale})) AS DOUBLE) / NULLIF(COUNT({x}), 0)"


def r2(x: str) -> str:
    """Round to two decimals, half away from zero on the printed value."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE)"


def pct_or_zero(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} <> 0 THEN {part} / ABS({whole}) * 1e2 ELSE 0e0 END"


def shift(period: str, months: int) -> str:
    sign, n = ("+", months) if months >= 0 else ("-", -months)
    return f"strftime(CAST({period} || '-01' AS DATE) {sign} INTERVAL {n} MONTH, '%Y-%m')"


def category(code: str, other: str = "Other") -> str:
    return (
        f"CASE WHEN {code} LIKE '4%' THEN 'Revenue' WHEN {code} LIKE '5%' THEN 'COGS' "
        f"WHEN {code} LIKE '6%' THEN 'OpEx' WHEN {code} LIKE '7%' THEN 'Other Income/Expense' "
        f"WHEN {code} LIKE '8%' THEN 'Tax' ELSE '{other}' END"
    )


def phase_name(col: str, default: str = "NULL") -> str:
    return (
        f"CASE {col} WHEN 1 THEN 'Data Gathering - Exchange Rates' WHEN 2 THEN 'Adjustments' "
        f"WHEN 3 THEN 'Data Gathering - Segmented & Forecast' WHEN 4 THEN 'Review' "
        f"WHEN 5 THEN 'Reporting & Sign-off' ELSE {default} END"
    )


USD = (
    "CASE WHEN {cur} = 'USD' THEN {amount} WHEN exchange_rate IS NOT NULL THEN {amount} / NULLIF(exchange_rate, 0) END"
)


def usd(amount: str, cur: str) -> str:
    return USD.format(cur=cur, amount=amount)


def scorecard(table: str, name: str, phase: int, check: str, subject: str, warn: str, fail: str) -> str:
    hundredths = "((f * 20000 + n) // (n * 2))"
    return f"""
SELECT closure_period, {phase} AS phase, '{name}' AS table_name, 'validation' AS check_type,
  '{check}' AS check_name,
  CASE WHEN rate < {warn} THEN 'PASSED' WHEN rate < {fail} THEN 'WARNING' ELSE 'FAILED' END AS check_result,
  n AS records_checked, f AS records_failed, rate AS failure_rate,
  'Processed {subject} with ' || CAST({hundredths} // 100 AS VARCHAR) || '.'
    || lpad(CAST({hundredths} % 100 AS VARCHAR), 2, '0') || '% failure rate' AS details
FROM (SELECT closure_period, COUNT(*) AS n, COUNT(*) FILTER (WHERE NOT is_validated) AS f,
        CAST(COUNT(*) FILTER (WHERE NOT is_validated) AS DOUBLE) / COUNT(*) AS rate
      FROM {table} GROUP BY closure_period) s"""


def prelim(ledger: str, extra_joins: str = "", prior: str = "", version: str = "1") -> str:
    """Preliminary results over a ledger; ``prior`` is a relation with (period, bu, account, amount)."""
    return f"""
SELECT a.closure_period, a.bu_code, a.bu_name, a.account_code, a.account_description,
  {category('a.account_code')} AS account_category,
  a.preliminary_amount, a.currency, a.preliminary_amount AS usd_amount,
  COALESCE(p.prior_period_amount, 0e0) AS prior_period_amount,
  COALESCE(a.preliminary_amount - p.prior_period_amount, 0e0) AS variance_amount,
  COALESCE((a.preliminary_amount - p.prior_period_amount) / NULLIF(ABS(p.prior_period_amount), 0) * 1e2, 0e0)
    AS variance_percent,
  CAST({version} AS INTEGER) AS version
FROM (SELECT closure_period, bu_code, bu_name, account_code, account_description,
        {money('usd_amount')} AS preliminary_amount, MIN(local_currency) AS currency
      FROM {ledger} WHERE is_validated
      GROUP BY closure_period, bu_code, bu_name, account_code, account_description) a
LEFT JOIN (SELECT closure_period, bu_code, account_code, MAX(preliminary_amount) AS prior_period_amount
           FROM {prior} GROUP BY closure_period, bu_code, account_code) p
  ON p.closure_period = {shift('a.closure_period', -1)}
 AND p.bu_code = a.bu_code AND p.account_code = a.account_code
{extra_joins}"""


_LEDGER_SUMS = """(SELECT closure_period, bu_code, account_code, account_description, {amount} AS preliminary_amount
  FROM {ledger} WHERE is_validated GROUP BY closure_period, bu_code, account_code, account_description)"""


def ledger_sums(ledger: str) -> str:
    return _LEDGER_SUMS.format(ledger=ledger, amount=money("usd_amount"))


def process_ledger(source: str) -> str:
    issues = f"""list_distinct(list_filter([
    CASE WHEN bu_code IS NULL THEN 'Missing BU code' END,
    CASE WHEN bu_code NOT IN {BUS} THEN 'Invalid BU code' END,
    CASE WHEN account_code IS NULL THEN 'Missing account code' END,
    CASE WHEN local_amount IS NULL THEN 'Missing amount' END,
    CASE WHEN local_currency <> 'USD' AND exchange_rate IS NULL THEN 'Missing FX rate' END,
    CASE WHEN period IS NULL THEN 'Missing period' END], lambda x: x IS NOT NULL))"""
    text = f"""concat_ws('; ',
    CASE WHEN bu_code IS NULL THEN 'Missing BU code' END,
    CASE WHEN bu_code NOT IN {BUS} THEN 'Invalid BU code' END,
    CASE WHEN account_code IS NULL THEN 'Missing account code' END,
    CASE WHEN local_amount IS NULL THEN 'Missing amount' END,
    CASE WHEN local_currency <> 'USD' AND exchange_rate IS NULL THEN 'Missing FX rate' END,
    CASE WHEN period IS NULL THEN 'Missing period' END)"""
    return f"""
SELECT bu_code, bu_name, account_code, account_description, local_currency, local_amount,
  {usd('local_amount', 'local_currency')} AS usd_amount, exchange_rate, period, cost_center,
  len({issues}) = 0 AS is_validated, {text} AS validation_issues, period AS closure_period, l_linestatus
FROM {source} l LEFT JOIN bus b USING (bu_code)
LEFT JOIN fx_latest f ON f.currency = l.local_currency"""


CTES: dict[str, str] = {
    "bus": """
SELECT * FROM (VALUES
  ('AMERICA', 'America Unit', 'Americas', 'USD', 'america.finance@company.com'),
  ('EUROPE', 'Europe Unit', 'EMEA', 'EUR', 'europe.finance@company.com'),
  ('ASIA', 'Asia Unit', 'APAC', 'SGD', 'asia.finance@company.com'),
  ('AFRICA', 'Africa Unit', 'EMEA', 'BRL', 'africa.finance@company.com'))
  t(bu_code, bu_name, region, bu_currency, contact)""",
    "fx_raw": """
SELECT event_id, cast(event_id as string) AS load_id,
  CASE user_id % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'SGD' WHEN 2 THEN 'BRL' WHEN 3 THEN 'GBP' ELSE 'QQQ' END AS currency,
  CASE WHEN event_type = 'error' AND event_id % 7 = 0 THEN NULL
       WHEN event_id % 499 = 0 THEN 0e0
       ELSE (CASE user_id % 5 WHEN 0 THEN 0.92e0 WHEN 1 THEN 1.34e0 WHEN 2 THEN 4.97e0 WHEN 3 THEN 0.79e0 ELSE 1e0 END)
            * (1e0 + cast((event_id * 37) % 200 - 100 AS double) / 1e4)
            * (CASE WHEN event_id % 97 = 0 THEN 1.08e0 ELSE 1e0 END) END AS rate,
  cast(ts AS date) AS rate_date, event_type AS source, ts AS loaded_at
FROM events""",
    "ledger_raw": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_orderkey % 1009 = 0 THEN NULL ELSE r_name END AS bu_code,
  CASE WHEN l_orderkey % 997 = 0 THEN NULL ELSE
    CASE l_linenumber WHEN 1 THEN '4000' WHEN 2 THEN '4100' WHEN 3 THEN '5000' WHEN 4 THEN '5100'
                      WHEN 5 THEN '6000' WHEN 6 THEN '7000' ELSE '8000' END END AS account_code,
  concat('line ', cast(l_linenumber AS string)) AS account_description,
  CASE WHEN n_nationkey = 23 THEN 'ZZZ' ELSE
    CASE r_name WHEN 'AMERICA' THEN 'USD' WHEN 'EUROPE' THEN 'EUR' WHEN 'ASIA' THEN 'SGD'
                WHEN 'AFRICA' THEN 'BRL' ELSE 'GBP' END END AS local_currency,
  cast(CASE WHEN l_linenumber IN (1, 2, 6) THEN l_extendedprice ELSE -l_extendedprice END AS double) AS local_amount,
  substr(cast(o_orderdate as string),1,7) AS period,
  concat('CC00', cast(l_suppkey % 5 + 1 AS string)) AS cost_center,
  n_name, c_mktsegment, o_orderpriority, l_returnflag, l_linestatus, l_discount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "cuts_raw": """
SELECT CASE WHEN l_orderkey % 503 = 0 THEN 3 WHEN l_returnflag = 'A' THEN 1 ELSE 2 END AS cut_number,
  bu_code, account_code, concat('type ', l_linestatus, '-', o_orderpriority) AS adjustment_type,
  cast(CASE WHEN l_linenumber % 2 = 0 THEN l_discount ELSE -l_discount END * 1e3 AS double) * l_suppkey AS adjustment_amount,
  local_currency AS currency, account_description AS description, period
FROM ledger_raw WHERE l_returnflag IN ('A', 'R')""",
    "segments_raw": """
SELECT bu_code, account_code, 'Product' AS segment_type, p_type AS segment_value, local_amount / 4e0 AS amount, local_currency AS currency, period FROM ledger_raw JOIN part ON l_partkey = p_partkey
UNION ALL SELECT bu_code, account_code, 'Geography', n_name, local_amount / 4e0, local_currency, period FROM ledger_raw
UNION ALL SELECT bu_code, account_code, 'Customer', c_mktsegment, local_amount / 4e0, local_currency, period FROM ledger_raw
UNION ALL SELECT bu_code, account_code, CASE WHEN o_orderpriority = '5-LOW' THEN 'Unknown' ELSE 'Channel' END, o_orderpriority, local_amount / 4e0, local_currency, period FROM ledger_raw""",
    "forecast_raw": """
SELECT bu_code, account_code,
  concat(cast(cast(substr(period, 1, 4) AS int) + 1 AS string), substr(period, 5, 3)) AS forecast_period,
  local_amount * 1.05e0 AS forecast_amount, local_currency AS currency, 'Rolling12' AS forecast_type,
  CASE WHEN l_linestatus = 'O' THEN 'v2.0' ELSE 'v1.0' END AS version
FROM ledger_raw""",
    "forecast_fx_raw": """
SELECT currency,
  concat(cast(1996 + cast((event_id % 72 - event_id % 12) / 12 AS int) AS string), '-', lpad(cast(event_id % 12 + 1 AS string), 2, '0')) AS forecast_month,
  rate AS forecast_rate, 'TREASURY_FORECAST' AS source
FROM fx_raw WHERE rate > 0e0""",
    "task_log": """
SELECT cast(event_id AS string) AS log_id, concat('agent-', cast(user_id % 6 AS string)) AS agent_id,
  concat('Agent ', cast(user_id % 6 AS string)) AS agent_name, substr(cast(ts AS string), 1, 7) AS closure_period,
  cast(user_id % 6 AS int) AS phase, concat('task ', cast(event_id % 9 AS string)) AS task_name,
  CASE event_type WHEN 'purchase' THEN 'COMPLETED' WHEN 'click' THEN 'COMPLETED' WHEN 'view' THEN 'RUNNING' WHEN 'error' THEN 'FAILED' ELSE 'WARNING' END AS status,
  ts AS started_at, cast(value AS double) AS duration_seconds, event_id % 1000 AS records_processed,
  CASE WHEN event_type = 'error' THEN props END AS error_message FROM events""",
    "closure_status": """
SELECT o_orderkey AS closure_id, substr(cast(o_orderdate AS string), 1, 7) AS closure_period,
  cast(o_orderkey % 5 + 1 AS int) AS current_phase, CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'INITIALIZED' ELSE 'FAILED' END AS phase_status,
  o_orderdate AS started_at, cast(o_orderdate AS date) + cast(o_orderkey % 9 AS int) AS expected_completion,
  CASE WHEN o_orderstatus = 'F' THEN cast(o_orderdate AS date) + cast(o_orderkey % 11 AS int) END AS actual_completion, o_orderpriority AS notes FROM orders""",
    "approvals": """
SELECT o_orderkey AS approval_id, substr(cast(o_orderdate AS string), 1, 7) AS closure_period, 4 AS phase,
  CASE WHEN o_orderkey % 3 = 0 THEN 'BU_SIGNOFF' ELSE 'FORECAST_REVIEW' END AS approval_type, o_orderpriority AS required_approver,
  CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'O' THEN 'PENDING' ELSE 'SCHEDULED' END AS status, o_orderdate AS requested_at, 'c' AS comments FROM orders""",
    "notifications": """
SELECT event_id AS notification_id, substr(cast(ts AS string), 1, 7) AS closure_period, cast(user_id % 6 AS int) AS phase,
  CASE WHEN event_type = 'error' THEN 'WARNING' ELSE 'INFO' END AS severity, props AS message, event_type AS recipient, ts AS sent_at,
  CASE WHEN event_id % 3 = 0 THEN ts END AS acknowledged_at
FROM events WHERE event_type IN ('error', 'signup')""",
    # --- processed ------------------------------------------------------------
    "fx_var": """
SELECT *, CASE WHEN prior_rate IS NOT NULL THEN (rate - prior_rate) / NULLIF(prior_rate, 0) * 1e2 ELSE 0e0 END
  AS variance_from_prior
FROM (SELECT *, lag(rate) OVER (PARTITION BY currency ORDER BY rate_date, event_id) AS prior_rate FROM fx_raw) q""",
    "fx_proc": f"""
SELECT event_id, currency, rate, rate_date, source, variance_from_prior,
  COALESCE(currency IN {CURRENCIES} AND rate > 0 AND rate IS NOT NULL AND ABS(variance_from_prior) <= 5, FALSE)
    AS is_validated,
  CASE WHEN currency NOT IN {CURRENCIES} THEN 'Invalid currency' WHEN rate <= 0 THEN 'Invalid rate'
       WHEN rate IS NULL THEN 'Missing rate' WHEN ABS(variance_from_prior) > 5 THEN 'Variance exceeds 5.0%' END
    AS validation_notes,
  '{P}' AS closure_period
FROM fx_var""",
    "fx_latest": """
SELECT currency, arg_max(rate, (rate_date, event_id)) AS exchange_rate
FROM fx_proc WHERE is_validated GROUP BY currency""",
    "fx_month": f"""
SELECT currency, forecast_month AS forecast_period, {mean('forecast_rate', 'DECIMAL(38,12)')} AS exchange_rate
FROM forecast_fx_raw GROUP BY currency, forecast_month""",
    "ledger": process_ledger("ledger_raw"),
    "ledger_early": process_ledger("(SELECT * FROM ledger_raw WHERE l_linestatus = 'F')"),
    "cuts": f"""
SELECT cut_number, bu_code, account_code, adjustment_type, adjustment_amount, c.currency,
  {usd('adjustment_amount', 'c.currency')} AS usd_amount, exchange_rate, description, period,
  COALESCE(cut_number IN (1, 2) AND bu_code IN {BUS} AND account_code IS NOT NULL AND adjustment_amount IS NOT NULL
    AND (c.currency = 'USD' OR exchange_rate IS NOT NULL), FALSE) AS is_validated,
  period AS closure_period
FROM cuts_raw c LEFT JOIN fx_latest f ON f.currency = c.currency""",
    "segs": f"""
SELECT bu_code, account_code, segment_type, segment_value, amount, s.currency,
  {usd('amount', 's.currency')} AS usd_amount, exchange_rate, period,
  COALESCE(bu_code IN {BUS} AND account_code IS NOT NULL AND segment_type IN {SEGMENTS}
    AND segment_value IS NOT NULL AND amount IS NOT NULL
    AND (s.currency = 'USD' OR exchange_rate IS NOT NULL), FALSE) AS is_validated,
  period AS closure_period
FROM segments_raw s LEFT JOIN fx_latest f ON f.currency = s.currency""",
    "forecast_usd": f"""
SELECT bu_code, account_code, r.forecast_period, forecast_amount, r.currency,
  {usd('forecast_amount', 'r.currency')} AS usd_amount, exchange_rate, forecast_type, version
FROM forecast_raw r LEFT JOIN fx_month m ON m.currency = r.currency AND m.forecast_period = r.forecast_period""",
    "forecast_own": f"""
SELECT *, COALESCE(bu_code IN {BUS} AND account_code IS NOT NULL AND forecast_period IS NOT NULL
    AND forecast_amount IS NOT NULL AND (currency = 'USD' OR exchange_rate IS NOT NULL), FALSE) AS is_validated,
  forecast_period AS closure_period
FROM forecast_usd""",
    "forecast_p": f"""
SELECT *, COALESCE(bu_code IN {BUS} AND account_code IS NOT NULL AND forecast_period IS NOT NULL
    AND forecast_period >= '{P}' AND forecast_amount IS NOT NULL
    AND (currency = 'USD' OR exchange_rate IS NOT NULL), FALSE) AS is_validated,
  '{P}' AS closure_period
FROM forecast_usd""",
    "forecast_versions": f"""
SELECT *, CASE WHEN prior_version_amount IS NOT NULL
    THEN (version_amount - prior_version_amount) / NULLIF(ABS(prior_version_amount), 0) * 1e2 ELSE 0e0 END
    AS variance_from_prior
FROM (SELECT *, lag(version_amount) OVER (PARTITION BY bu_code, account_code, forecast_period, forecast_type
        ORDER BY version) AS prior_version_amount
      FROM (SELECT bu_code, account_code, forecast_period, forecast_type, version,
              {money('forecast_amount')} AS version_amount
            FROM forecast_raw GROUP BY ALL) v) w""",
    # --- published ------------------------------------------------------------
    "prelim": prelim("ledger", prior=ledger_sums("ledger")),
    "prelim_first": prelim("ledger_early", prior=ledger_sums("ledger_early")),
    "prelim_again": prelim(
        "ledger",
        prior="prelim_first",
        version="COALESCE(v.highest, 0) + 1",
        extra_joins="LEFT JOIN (SELECT closure_period, MAX(version) AS highest FROM prelim_first "
        "GROUP BY closure_period) v ON v.closure_period = a.closure_period",
    ),
    "final_base": f"""
SELECT a.*, COALESCE(a.preliminary_amount, 0e0) + COALESCE(c.adjustments_amount, 0e0) AS final_amount,
  c.adjustments_amount
FROM (SELECT closure_period, bu_code, bu_name, account_code, {money('usd_amount')} AS preliminary_amount
      FROM ledger WHERE is_validated GROUP BY ALL) a
LEFT JOIN (SELECT closure_period, bu_code, account_code, {money('usd_amount')} AS adjustments_amount
           FROM cuts WHERE is_validated GROUP BY ALL) c USING (closure_period, bu_code, account_code)""",
    "final": f"""
SELECT a.closure_period, a.bu_code, a.bu_name, b.region, a.account_code, d.account_description,
  {category('a.account_code')} AS account_category,
  COALESCE(s1.v, 'Unallocated') AS segment_product, COALESCE(s2.v, 'Unallocated') AS segment_geography,
  COALESCE(s3.v, 'Unallocated') AS segment_customer, COALESCE(s4.v, 'Unallocated') AS segment_channel,
  COALESCE(a.preliminary_amount, 0e0) AS preliminary_amount, COALESCE(a.adjustments_amount, 0e0) AS adjustments_amount,
  a.final_amount, 'USD' AS currency, a.final_amount AS usd_amount, f.forecast_amount,
  COALESCE(a.final_amount - f.forecast_amount, 0e0) AS forecast_variance,
  COALESCE(p.prior_period_amount, 0e0) AS prior_period_amount,
  COALESCE(a.final_amount - p.prior_period_amount, 0e0) AS yoy_variance,
  COALESCE((a.final_amount - p.prior_period_amount) / NULLIF(ABS(p.prior_period_amount), 0) * 1e2, 0e0)
    AS yoy_variance_percent,
  TRUE AS is_final, 'system' AS approved_by
FROM final_base a
LEFT JOIN bus b ON b.bu_code = a.bu_code
LEFT JOIN (SELECT closure_period, account_code, MIN(account_description) AS account_description
           FROM ledger WHERE is_validated GROUP BY ALL) d
  ON d.closure_period = a.closure_period AND d.account_code = a.account_code
""" + "\n".join(
        f"""LEFT JOIN (SELECT closure_period, bu_code, account_code, MIN(segment_value) AS v FROM segs
  WHERE is_validated AND segment_type = '{t}' GROUP BY ALL) s{i}
  ON s{i}.closure_period = a.closure_period AND s{i}.bu_code = a.bu_code AND s{i}.account_code = a.account_code"""
        for i, t in enumerate(("Product", "Geography", "Customer", "Channel"), 1)
    ) + f"""
LEFT JOIN (SELECT forecast_period, bu_code, account_code, {money('usd_amount')} AS forecast_amount
           FROM forecast_own WHERE is_validated GROUP BY ALL) f
  ON f.forecast_period = a.closure_period AND f.bu_code = a.bu_code AND f.account_code = a.account_code
LEFT JOIN (SELECT closure_period, bu_code, account_code, MAX(final_amount) AS prior_period_amount
           FROM final_base GROUP BY ALL) p
  ON p.closure_period = {shift('a.closure_period', -1)} AND p.bu_code = a.bu_code AND p.account_code = a.account_code""",
    "kpi_sums": f"""
SELECT closure_period, rev, cogs, opex,
  CASE WHEN rev <> 0 THEN (rev - cogs) / rev * 1e2 ELSE 0e0 END AS gm,
  CASE WHEN rev <> 0 THEN (rev - cogs - opex) / rev * 1e2 ELSE 0e0 END AS om
FROM (SELECT closure_period,
        COALESCE({money("CASE WHEN account_category = 'Revenue' THEN final_amount END")}, 0e0) AS rev,
        ABS(COALESCE({money("CASE WHEN account_category = 'COGS' THEN final_amount END")}, 0e0)) AS cogs,
        ABS(COALESCE({money("CASE WHEN account_category = 'OpEx' THEN final_amount END")}, 0e0)) AS opex
      FROM final GROUP BY closure_period) k""",
    "kpi": f"""
SELECT *, CAST(NULL AS DOUBLE) AS target_value, CAST(NULL AS DOUBLE) AS variance_from_target FROM (
  SELECT closure_period, 'Total Revenue' AS metric_name, 'Revenue' AS metric_category, rev AS metric_value,
    'ALL' AS bu_code, 'Global' AS region FROM kpi_sums
  UNION ALL SELECT closure_period, 'Gross Margin %', 'Profitability', gm, 'ALL', 'Global' FROM kpi_sums
  UNION ALL SELECT closure_period, 'Operating Margin %', 'Profitability', om, 'ALL', 'Global' FROM kpi_sums
  UNION ALL SELECT k.closure_period, 'Revenue', 'Revenue', COALESCE(r.rev, 0e0), b.bu_code, b.region
  FROM kpi_sums k CROSS JOIN bus b
  LEFT JOIN (SELECT closure_period, bu_code, {money('final_amount')} AS rev FROM final
             WHERE account_category = 'Revenue' GROUP BY ALL) r
    ON r.closure_period = k.closure_period AND r.bu_code = b.bu_code) u""",
    "dq": " UNION ALL ".join(
        (
            scorecard("fx_proc", "exchange_rates", 1, "Exchange Rate Processing", "exchange rates", "0.05", "0.10"),
            scorecard(
                "ledger", "bu_preliminary_close", 1, "Preliminary Close Processing", "preliminary close", "0.02", "0.05"
            ),
            scorecard("cuts", "accounting_cuts", 2, "Accounting Cuts Processing", "accounting cuts", "0.02", "0.05"),
            scorecard("segs", "segmented_files", 3, "Segmented Files Processing", "segmented files", "0.02", "0.05"),
            scorecard(
                "forecast_own", "forecast_files", 3, "Forecast Files Processing", "forecast files", "0.02", "0.05"
            ),
        )
    ),
}
