"""One SELECT per registered query."""

from __future__ import annotations

from oracle.base import BUS, CURRENCIES, P, SEGMENTS, category, mean, money, pct_or_zero, phase_name, r2, shift

AS_OF_FX = "2024-01-31"
AS_OF = "2001-09-01"
APPROVED_AT = "1997-07-10 00:00:00"


def _union(*parts: str) -> str:
    return "\nUNION ALL ".join(parts)


def _null_profile(table: str, *columns: str) -> str:
    return _union(
        *[
            f"SELECT '{name}' AS table_name, '{c}' AS column_name, COUNT(*) AS records, "
            f"COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls FROM {src}"
            for src, name in (table.split(":"),)
            for c in columns
        ]
    )


def _rules(table: str, *rules: tuple[str, str, str]) -> str:
    return _union(
        *[
            f"SELECT '{rule}' AS rule, '{column}' AS column_name, COUNT(*) AS checked, "
            f"COUNT(*) FILTER (WHERE {failed}) AS failed FROM {table}"
            for rule, column, failed in rules
        ]
    )


def _no_nulls(*columns: str) -> list[tuple[str, str, str]]:
    return [("no_nulls", c, f"{c} IS NULL") for c in columns]


def _violations(table: str, name: str, column: str, allowed: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, '{column}' AS column_name, CAST({column} AS VARCHAR) AS offending_value, "
        f"COUNT(*) AS records FROM {table} WHERE {column} NOT IN {allowed} GROUP BY {column}"
    )


def _missing_fx(table: str, name: str, currency: str) -> str:
    return (
        f"SELECT '{name}' AS dataset, {currency} AS currency, COUNT(*) AS records FROM {table} "
        f"WHERE {currency} <> 'USD' AND exchange_rate IS NULL GROUP BY {currency}"
    )


def _state(done: str, late: str, running: str) -> str:
    return (
        f"CASE WHEN actual_completion IS NOT NULL THEN '{done}' "
        f"WHEN expected_completion < TIMESTAMP '{AS_OF} 00:00:00' THEN '{late}' ELSE '{running}' END"
    )


DAYS = (
    f"CAST(date_diff('day', CAST(started_at AS DATE), "
    f"COALESCE(CAST(actual_completion AS DATE), DATE '{AS_OF}')) AS INTEGER)"
)

REV = money("CASE WHEN account_category = 'Revenue' THEN final_amount ELSE 0e0 END")
COGS = money("CASE WHEN account_category = 'COGS' THEN ABS(final_amount) ELSE 0e0 END")
OPEX = money("CASE WHEN account_category = 'OpEx' THEN ABS(final_amount) ELSE 0e0 END")
DATASETS = (
    ("exchange_rates", "Exchange Rates", "fx_proc"),
    ("bu_preliminary_close", "Preliminary Close", "ledger"),
    ("accounting_cuts", "Accounting Cuts", "cuts"),
    ("segmented_files", "Segmented Files", "segs"),
    ("forecast_files", "Forecast Files", "forecast_own"),
)
FAILURE = r2("failure_rate * 100")


def _gross(keys: str, where: str = "") -> str:
    return f"""
SELECT *, revenue - cogs AS gross_profit, (revenue - cogs) / NULLIF(revenue, 0) * 1e2 AS gross_margin_pct
FROM (SELECT {keys}, {REV} AS revenue, {COGS} AS cogs FROM final WHERE is_final {where} GROUP BY ALL) q"""


def _forecast_groups(keys: str) -> str:
    return f"""
SELECT {keys}, {money('final_amount')} AS actual, {money('forecast_amount')} AS forecast,
  {money('forecast_variance')} AS variance
FROM final WHERE is_final AND forecast_amount IS NOT NULL"""


def _rating(bands: tuple, otherwise: str) -> str:
    share = "ABS(variance / NULLIF(ABS(forecast), 0) * 1e2)"
    return "CASE " + " ".join(f"WHEN {share} <= {n} THEN '{label}'" for n, label in bands) + f" ELSE '{otherwise}' END"


def _forecast_by_bu(table: str, amount: str, alias: str, where: str = "") -> str:
    return f"""
SELECT bu_code, currency, COUNT(*) AS forecast_count, COUNT(DISTINCT forecast_period) AS periods,
  COUNT(DISTINCT account_code) AS accounts, {money(amount)} AS {alias}
FROM {table} {where} GROUP BY bu_code, currency"""


def _trend(table: str, amount: str, names: tuple[str, str, str], where: str = "") -> str:
    return f"""
SELECT forecast_period, {money(f'CASE WHEN {amount} > 0 THEN {amount} ELSE 0e0 END')} AS {names[0]},
  {money(f'CASE WHEN {amount} < 0 THEN {amount} ELSE 0e0 END')} AS {names[1]}, {money(amount)} AS {names[2]}
FROM {table} {where} GROUP BY forecast_period"""


def _preview(table: str, columns: str, n: int = 50) -> str:
    names = columns.split()
    order = ", ".join(f"{c} NULLS FIRST" for c in names)
    return f"SELECT {', '.join(names)} FROM {table} ORDER BY {order} LIMIT {n}"


MISSING_LEDGER = """
SELECT p.closure_period, b.bu_code, b.bu_name, b.region, b.contact
FROM (SELECT DISTINCT closure_period FROM ledger WHERE closure_period IS NOT NULL) p CROSS JOIN bus b
WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.is_validated AND l.closure_period = p.closure_period
                  AND l.bu_code = b.bu_code)"""

MISSING_FORECAST = """
SELECT p.closure_period, b.bu_code, b.bu_name, b.region, b.contact
FROM (SELECT DISTINCT closure_period FROM ledger WHERE closure_period IS NOT NULL) p CROSS JOIN bus b
WHERE NOT EXISTS (SELECT 1 FROM forecast_own l WHERE l.is_validated AND l.closure_period = p.closure_period
                  AND l.bu_code = b.bu_code)"""

LARGE = """
SELECT closure_period, COUNT(*) FILTER (WHERE is_validated AND ABS(usd_amount) > 100000) AS adjustments FROM cuts
GROUP BY closure_period"""

COVERAGE = f"""
SELECT closure_period, bu_code, CAST(COUNT(DISTINCT segment_type) AS INTEGER) AS segments_present,
  string_agg(DISTINCT segment_type, '; ' ORDER BY segment_type) AS segment_types,
  array_to_string(list_sort(list_filter(['Product', 'Geography', 'Customer', 'Channel'],
    lambda x: NOT list_contains(list(DISTINCT segment_type), x))), '; ') AS segments_missing
FROM segs WHERE is_validated GROUP BY closure_period, bu_code"""

FX_OUTLIER_COUNT = """
SELECT closure_period, COUNT(*) FILTER (WHERE ABS(variance_from_prior) > 5 AND NOT is_validated) AS outliers
FROM fx_proc GROUP BY closure_period"""

EXEC = f"""
SELECT *, total_revenue - total_cogs AS gross_profit,
  COALESCE((total_revenue - total_cogs) / NULLIF(total_revenue, 0) * 1e2, 0e0) AS gross_margin_pct,
  total_revenue - total_cogs - total_opex AS operating_income,
  COALESCE((total_revenue - total_cogs - total_opex) / NULLIF(total_revenue, 0) * 1e2, 0e0) AS operating_margin_pct
FROM (SELECT closure_period, {REV} AS total_revenue, {COGS} AS total_cogs, {OPEX} AS total_opex,
        COUNT(DISTINCT bu_code) AS bu_count, COUNT(*) AS total_records
      FROM final WHERE is_final GROUP BY closure_period) q"""


def _alert(phase: int, severity: str, message: str, recipient: str, source: str) -> str:
    return (
        f"SELECT closure_period, {phase} AS phase, '{severity}' AS severity, {message} AS message, "
        f"{recipient} AS recipient FROM ({source}) a{phase}"
    )


OPS = "'finance.ops@company.com'"
COMPLETION = (
    "'Financial closure for ' || closure_period || ' is complete.' || chr(10) || chr(10) || 'Key Metrics:' || chr(10)"
    " || '- Total Revenue: $' || format('{:,.2f}', total_revenue) || chr(10)"
    " || '- Gross Margin: ' || format('{:,.2f}', gross_margin_pct) || '%' || chr(10)"
    " || '- Operating Margin: ' || format('{:,.2f}', operating_margin_pct) || '%' || chr(10) || chr(10)"
    " || 'Final results are available in the reporting dashboards.'"
)


def _request(phase: int, kind: str, approver: str, status: str, comments: str, source: str) -> str:
    return (
        f"SELECT closure_period, {phase} AS phase, '{kind}' AS approval_type, {approver} AS required_approver, "
        f"'{status}' AS status, {comments} AS comments FROM {source}"
    )


PERIODS = "(SELECT DISTINCT closure_period FROM ledger WHERE closure_period IS NOT NULL) p"
TEAMS = "'FP&A + Tech Teams'"
NEWEST = "(SELECT MAX(closure_period) FROM {})"

BODIES: dict[str, str] = {
    # --- dimensions, joins, conversion -----------------------------------------
    "bu_dim": """
SELECT b.*, n.ledger_lines FROM bus b
LEFT JOIN (SELECT bu_code, COUNT(*) AS ledger_lines FROM ledger_raw GROUP BY bu_code) n ON n.bu_code = b.bu_code""",
    "join_bu_dim": """
SELECT l.bu_code, b.bu_name, COUNT(*) AS records FROM ledger_raw l LEFT JOIN bus b ON b.bu_code = l.bu_code
GROUP BY l.bu_code, b.bu_name""",
    "bu_currency": """
SELECT l.bu_code, COALESCE(b.bu_currency, 'USD') AS bu_currency, b.bu_currency IS NOT NULL AS bu_exists,
  COUNT(*) AS records
FROM ledger_raw l LEFT JOIN bus b ON b.bu_code = l.bu_code GROUP BY ALL""",
    "convert_ledger": """
SELECT period, bu_code, account_code, local_currency, local_amount, exchange_rate, usd_amount FROM ledger""",
    "convert_cuts": """
SELECT period, bu_code, account_code, currency, adjustment_amount, exchange_rate, usd_amount FROM cuts""",
    "convert_forecast": """
SELECT bu_code, account_code, forecast_period, currency, forecast_amount, exchange_rate, usd_amount
FROM forecast_usd""",
    "missing_fx": _union(
        _missing_fx("ledger", "bu_preliminary_close", "local_currency"),
        _missing_fx("cuts", "accounting_cuts", "currency"),
        _missing_fx("segs", "segmented_files", "currency"),
        _missing_fx("forecast_own", "forecast_files", "currency"),
    ),
    "account_category": f"""
SELECT account_code, {category('account_code')} AS account_category, COUNT(*) AS records
FROM ledger_raw GROUP BY ALL""",
    "period_prior": f"""
SELECT period, {shift('period', -1)} AS prior_period, {shift('period', -12)} AS prior_year_period,
  COUNT(*) AS records
FROM ledger_raw GROUP BY period""",
    # --- rates -------------------------------------------------------------------
    "closing_period": """
SELECT CAST(started_at AS DATE) AS day, COUNT(*) AS records,
  strftime(CASE WHEN day(CAST(started_at AS DATE)) < 10
    THEN CAST(started_at AS DATE) - CAST(day(CAST(started_at AS DATE)) + 5 AS INTEGER) ELSE CAST(started_at AS DATE) END,
    '%Y-%m') AS closing_period
FROM closure_status GROUP BY CAST(started_at AS DATE)""",
    "phase_deadline": """
SELECT closure_id, current_phase, started_at, started_at + to_hours(
  CASE current_phase WHEN 1 THEN 24 WHEN 2 THEN 48 WHEN 3 THEN 24 WHEN 4 THEN 24 WHEN 5 THEN 12 END) AS deadline
FROM closure_status""",
    "fx_variance_by_load": """
SELECT event_id, currency, rate_date, rate, prior_rate,
  CASE WHEN prior_rate IS NULL THEN 0e0 ELSE (rate - prior_rate) / NULLIF(prior_rate, 0) * 1e2 END AS variance_from_prior
FROM (SELECT *, lag(rate) OVER (PARTITION BY currency ORDER BY rate_date, loaded_at, load_id) AS prior_rate FROM fx_raw) q""",
    "fx_variance": "SELECT event_id, currency, rate_date, rate, prior_rate, variance_from_prior FROM fx_var",
    "fx_outliers": """
SELECT event_id, currency, rate_date, rate, prior_rate, variance_from_prior FROM fx_var
WHERE ABS(variance_from_prior) > 5""",
    "fx_processed": """
SELECT currency, rate, rate_date, source, variance_from_prior, is_validated, validation_notes, closure_period,
  event_id FROM fx_proc""",
    "fx_dedup": """
SELECT currency, rate_date, arg_max(rate_box, event_id).r AS rate
FROM (SELECT currency, rate_date, event_id, {'r': rate} AS rate_box FROM fx_raw) q GROUP BY currency, rate_date""",
    "fx_latest": "SELECT currency, exchange_rate FROM fx_latest",
    "fx_monthly_avg": "SELECT currency, forecast_period, exchange_rate FROM fx_month",
    "fx_recent": f"""
SELECT currency, rate_date, rate, variance_from_prior, is_validated, validation_notes FROM fx_proc
WHERE rate_date >= DATE '{AS_OF_FX}' - 7""",
    "fx_outlier_count": FX_OUTLIER_COUNT,
    # --- processed datasets --------------------------------------------------------
    "ledger_processed": "SELECT * EXCLUDE (l_linestatus) FROM ledger",
    "cuts_processed": f"""
SELECT *, CASE WHEN is_validated THEN 'system_auto_approved' END AS approved_by,
  CASE WHEN is_validated THEN TIMESTAMP '{APPROVED_AT}' END AS approved_at
FROM cuts""",
    "segments_processed": "SELECT * FROM segs",
    "forecasts_processed": """
SELECT f.*, CASE WHEN f.bu_code IS NULL OR f.account_code IS NULL OR f.forecast_period IS NULL
    OR f.forecast_type IS NULL OR f.version IS NULL THEN 0e0 ELSE v.variance_from_prior END AS variance_from_prior
FROM forecast_p f LEFT JOIN forecast_versions v ON v.bu_code = f.bu_code AND v.account_code = f.account_code
  AND v.forecast_period = f.forecast_period AND v.forecast_type = f.forecast_type AND v.version = f.version""",
    "forecast_version_variance": "SELECT * FROM forecast_versions",
    "forecast_past": f"""
SELECT forecast_period, COUNT(*) AS past_forecasts FROM forecast_raw WHERE forecast_period < '{P}'
GROUP BY forecast_period""",
    "segment_completeness": """
SELECT bu_code, account_code, COUNT(DISTINCT segment_type) AS segment_count,
  string_agg(DISTINCT segment_type, '; ' ORDER BY segment_type) AS segments_present,
  COUNT(DISTINCT segment_type) = 4 AS is_complete,
  array_to_string(list_sort(list_filter(['Product', 'Geography', 'Customer', 'Channel'],
    lambda x: NOT list_contains(list(DISTINCT segment_type), x))), '; ') AS segments_missing
FROM segments_raw GROUP BY bu_code, account_code""",
    "segment_pivot": "SELECT closure_period, bu_code, account_code, "
    + ", ".join(
        f"MIN(CASE WHEN segment_type = '{t}' THEN segment_value END) AS segment_{t.lower()}"
        for t in ("Product", "Geography", "Customer", "Channel")
    )
    + " FROM segs WHERE is_validated GROUP BY closure_period, bu_code, account_code",
    "adjustments_by_account": f"""
SELECT closure_period, bu_code, account_code, {money('usd_amount')} AS adjustments_amount
FROM cuts WHERE is_validated GROUP BY ALL""",
    # --- quality -------------------------------------------------------------------
    "null_profile": _union(
        _null_profile("fx_raw:exchange_rates_raw", "currency", "rate", "rate_date"),
        _null_profile("ledger_raw:bu_preliminary_close_raw", "bu_code", "account_code", "local_amount", "period"),
        _null_profile("cuts_raw:accounting_cuts_raw", "cut_number", "bu_code", "account_code", "adjustment_amount"),
        _null_profile(
            "segments_raw:segmented_files_raw", "bu_code", "account_code", "segment_type", "segment_value", "amount"
        ),
        _null_profile(
            "forecast_raw:forecast_files_raw", "bu_code", "account_code", "forecast_period", "forecast_amount"
        ),
    ),
    "domain_violations": _union(
        _violations("fx_raw", "exchange_rates_raw", "currency", CURRENCIES),
        _violations("ledger_raw", "bu_preliminary_close_raw", "bu_code", BUS),
        _violations("cuts_raw", "accounting_cuts_raw", "cut_number", "(1, 2)"),
        _violations("segments_raw", "segmented_files_raw", "segment_type", SEGMENTS),
        _violations("forecast_raw", "forecast_files_raw", "bu_code", BUS),
    ),
    "preview_invalid": """
SELECT bu_code, account_code, local_amount, period, validation_issues FROM ledger WHERE NOT is_validated
ORDER BY bu_code NULLS FIRST, account_code NULLS FIRST, local_amount NULLS FIRST, period NULLS FIRST,
  validation_issues NULLS FIRST LIMIT 20""",
    "ledger_issues": "SELECT validation_issues, COUNT(*) AS records FROM ledger GROUP BY validation_issues",
    "validation_summary": _union(
        *[
            f"SELECT '{name}' AS dataset, is_validated, COUNT(*) AS records FROM {table} GROUP BY is_validated"
            for name, _, table in DATASETS
        ]
    ),
    "dq_rules_fx": _rules(
        "fx_var",
        *_no_nulls("currency", "rate", "rate_date"),
        ("positive_values", "rate", "rate <= 0"),
        ("variance_check", "variance_from_prior", "ABS(variance_from_prior) > 5"),
    ),
    "dq_rules_ledger": _rules(
        "ledger_raw",
        *_no_nulls("bu_code", "account_code", "local_amount", "period"),
        ("valid_bu", "bu_code", f"bu_code NOT IN {BUS}"),
    )
    + """
UNION ALL SELECT 'balance_check', 'local_amount', COUNT(*), COUNT(*) FILTER (WHERE net <> 0)
FROM (SELECT period, bu_code, SUM(CAST(local_amount AS DECIMAL(18,4))) AS net FROM ledger_raw
      GROUP BY period, bu_code) b""",
    "dq_rules_cuts": _rules(
        "cuts",
        *_no_nulls("cut_number", "account_code", "adjustment_amount"),
        ("valid_cut_number", "cut_number", "cut_number NOT IN (1, 2)"),
    )
    + f"""
UNION ALL SELECT 'reconciliation', 'usd_amount', COUNT(*),
  COUNT(*) FILTER (WHERE ABS(adjusted) > ABS(COALESCE(booked, 0e0)) * 0.01e0)
FROM (SELECT closure_period, bu_code, {money('usd_amount')} AS adjusted FROM cuts GROUP BY ALL) a
LEFT JOIN (SELECT closure_period, bu_code, {money('usd_amount')} AS booked FROM ledger GROUP BY ALL) b
  ON a.closure_period = b.closure_period AND a.bu_code = b.bu_code""",
    "dq_rules_segments": _rules("segments_raw", *_no_nulls("bu_code", "segment_type", "amount"))
    + f"""
UNION ALL SELECT 'segment_completeness', 'segment_type', COUNT(*), COUNT(*) FILTER (WHERE n < 4)
FROM (SELECT bu_code, account_code,
        COUNT(DISTINCT CASE WHEN segment_type IN {SEGMENTS} THEN segment_type END) AS n
      FROM segments_raw GROUP BY bu_code, account_code) g""",
    "dq_rules_forecast": _rules(
        "forecast_raw",
        *_no_nulls("bu_code", "forecast_period", "forecast_amount"),
        ("future_dates_only", "forecast_period", f"forecast_period < '{P}'"),
    ),
    "dq_scorecard": "SELECT * FROM dq",
    "dq_summary": f"""
SELECT d.closure_period, phase, table_name, check_result, records_checked, records_failed,
  {FAILURE} AS failure_rate_pct, critical_failures
FROM dq d JOIN (SELECT closure_period, COUNT(*) FILTER (WHERE check_result = 'FAILED') AS critical_failures
                FROM dq WHERE phase = 3 GROUP BY closure_period) c ON c.closure_period = d.closure_period
WHERE phase = 3""",
    "dq_dashboard": f"""
SELECT closure_period, phase, table_name, check_name, check_result, records_checked, records_failed,
  {FAILURE} AS failure_rate_pct FROM dq""",
    "dq_issues": f"""
SELECT closure_period, phase, table_name, check_name, check_result, records_failed,
  {FAILURE} AS failure_rate_pct, details FROM dq WHERE check_result IN ('WARNING', 'FAILED')""",
    "audit_quality": f"""
SELECT closure_period, phase, table_name, check_result, records_checked, records_failed,
  {FAILURE} AS failure_rate_pct FROM dq""",
    # --- controls ------------------------------------------------------------------
    "bu_submitted": "SELECT DISTINCT closure_period, bu_code FROM ledger WHERE is_validated",
    "bu_missing": MISSING_LEDGER,
    "forecast_coverage": """
SELECT closure_period, bu_code, COUNT(DISTINCT forecast_period) AS periods_forecasted, COUNT(*) AS forecast_records
FROM forecast_p WHERE is_validated GROUP BY closure_period, bu_code""",
    "large_adjustments": LARGE,
    "recon_totals": f"""
SELECT closure_period, MAX(prelim_total) AS prelim_total, MAX(adj_total) AS adj_total FROM (
  SELECT closure_period, {money('usd_amount')} AS prelim_total, NULL AS adj_total FROM ledger
  WHERE is_validated GROUP BY closure_period
  UNION ALL SELECT closure_period, NULL, {money('usd_amount')} FROM cuts WHERE is_validated GROUP BY closure_period) u
GROUP BY closure_period""",
    "cut_counts": """
SELECT closure_period, cut_number, COUNT(*) AS records FROM cuts WHERE is_validated GROUP BY ALL""",
    "cut_completeness": """
SELECT *, CASE WHEN first_cut_rows > 0 AND second_cut_rows > 0 THEN 'Both cuts received'
  WHEN first_cut_rows > 0 THEN 'Only 1st cut received' ELSE 'No cuts received' END AS cut_status
FROM (SELECT closure_period, COUNT(*) FILTER (WHERE is_validated AND cut_number = 1) AS first_cut_rows,
        COUNT(*) FILTER (WHERE is_validated AND cut_number = 2) AS second_cut_rows
      FROM cuts GROUP BY closure_period) q""",
    "segment_coverage": COVERAGE,
    "review_summary": f"""
SELECT l.closure_period, l.bu_code, l.bu_name, l.accounts, l.preliminary_total,
  COALESCE(s.n, 0) AS segments_present, COALESCE(f.n, 0) AS forecast_periods
FROM (SELECT closure_period, bu_code, bu_name, COUNT(DISTINCT account_code) AS accounts,
        {money('usd_amount')} AS preliminary_total
      FROM ledger WHERE is_validated GROUP BY ALL) l
LEFT JOIN (SELECT closure_period, bu_code, COUNT(DISTINCT segment_type) AS n FROM segs GROUP BY ALL) s
  ON s.closure_period = l.closure_period AND s.bu_code = l.bu_code
LEFT JOIN (SELECT closure_period, bu_code, COUNT(DISTINCT forecast_period) AS n FROM forecast_p GROUP BY ALL) f
  ON f.closure_period = l.closure_period AND f.bu_code = l.bu_code""",
    "dataset_completeness": """
SELECT p.closure_period, w.dataset, COALESCE(n, 0) AS actual, CAST(w.expected AS BIGINT) AS expected,
  COALESCE(n, 0) = w.expected AS passed
FROM (SELECT closure_period FROM ledger WHERE is_validated UNION SELECT closure_period FROM cuts WHERE is_validated
      UNION SELECT closure_period FROM segs WHERE is_validated
      UNION SELECT closure_period FROM forecast_own WHERE is_validated) p
CROSS JOIN (VALUES ('Preliminary Close', 4), ('Accounting Cuts', 2), ('Segmented Files', 4), ('Forecast Files', 4))
  w(dataset, expected)
LEFT JOIN (
  SELECT closure_period, 'Preliminary Close' AS dataset, COUNT(DISTINCT bu_code) AS n FROM ledger
  WHERE is_validated GROUP BY ALL
  UNION ALL SELECT closure_period, 'Accounting Cuts', COUNT(DISTINCT cut_number) FROM cuts WHERE is_validated GROUP BY ALL
  UNION ALL SELECT closure_period, 'Segmented Files', COUNT(DISTINCT bu_code) FROM segs WHERE is_validated GROUP BY ALL
  UNION ALL SELECT closure_period, 'Forecast Files', COUNT(DISTINCT bu_code) FROM forecast_own
  WHERE is_validated GROUP BY ALL) c
  ON c.closure_period = p.closure_period AND c.dataset = w.dataset""",
    "recon_prelim_segment": f"""
SELECT COALESCE(l.closure_period, s.closure_period) AS closure_period,
  'Preliminary vs Segmented' AS reconciliation_type, total_prelim, total_segment,
  ABS(total_prelim - total_segment) AS variance,
  CASE WHEN ABS(total_prelim - total_segment) / NULLIF(ABS(total_prelim), 0) < 0.01 THEN 'PASS' ELSE 'FAIL' END
    AS result
FROM (SELECT closure_period, {money('usd_amount')} AS total_prelim FROM ledger
      WHERE is_validated AND account_code IN ('4000', '4100', '4200', '5000', '5100') GROUP BY closure_period) l
FULL JOIN (SELECT closure_period, {money('usd_amount')} AS total_segment FROM segs WHERE is_validated
           GROUP BY closure_period) s ON s.closure_period = l.closure_period""",
    "alerts": _union(
        _alert(
            1,
            "WARNING",
            "'Found ' || outliers || ' exchange rates exceeding variance threshold'",
            OPS,
            f"SELECT * FROM ({FX_OUTLIER_COUNT}) o WHERE outliers > 0",
        ),
        _alert(1, "WARNING", "'Preliminary close file missing from ' || bu_name", "contact", MISSING_LEDGER),
        _alert(
            3,
            "WARNING",
            "'Incomplete segment data from ' || bu_name",
            "contact",
            f"SELECT c.closure_period, b.bu_name, b.contact FROM ({COVERAGE}) c JOIN bus b ON b.bu_code = c.bu_code "
            "WHERE c.segments_present < 4",
        ),
        _alert(3, "WARNING", "'Missing forecast data from ' || bu_name", "contact", MISSING_FORECAST),
        _alert(5, "INFO", COMPLETION, OPS, EXEC),
    ),
    "signoff_requests": _union(
        _request(
            2,
            "PRELIMINARY_REVIEW_MEETING",
            TEAMS,
            "SCHEDULED",
            "'Preliminary results review - auto-scheduled by agent'",
            PERIODS,
        ),
        _request(
            4, "SEGMENTED_CLOSE_REVIEW", TEAMS, "SCHEDULED", "'Segmented close review - auto-scheduled by agent'", PERIODS
        ),
        _request(4, "FORECAST_REVIEW", TEAMS, "SCHEDULED", "'Forecast review - auto-scheduled by agent'", PERIODS),
        _request(
            4,
            "BU_SIGNOFF",
            "bu_name || ' CFO'",
            "PENDING",
            "'Final data sign-off required from ' || bu_name",
            f"{PERIODS} CROSS JOIN bus",
        ),
        _request(
            2,
            "LARGE_ADJUSTMENT_REVIEW",
            "'Controller'",
            "PENDING",
            "CAST(adjustments AS VARCHAR) || ' adjustments >$100K require approval'",
            f"({LARGE}) q WHERE adjustments > 0",
        ),
    ),
    "approvals_pending": """
SELECT closure_period, approval_type, required_approver, status FROM approvals
WHERE approval_type = 'BU_SIGNOFF' AND status = 'PENDING'""",
    "approvals_approve": f"""
SELECT approval_id, closure_period, phase, approval_type, required_approver,
  CASE WHEN hit THEN 'APPROVED' ELSE status END AS status, requested_at,
  CASE WHEN hit THEN comments || ' - Auto-approved for demo' ELSE comments END AS comments,
  CASE WHEN hit THEN TIMESTAMP '{APPROVED_AT}' END AS approved_at
FROM (SELECT *, approval_type = 'BU_SIGNOFF' AND status = 'PENDING' AS hit FROM approvals) q""",
    # --- publishing ----------------------------------------------------------------
    "prelim_results": "SELECT * FROM prelim",
    "prelim_next_version": """
SELECT p.period AS closure_period, CAST(COALESCE(MAX(v.version), 0) + 1 AS INTEGER) AS version
FROM (SELECT DISTINCT period FROM ledger_raw) p LEFT JOIN prelim_first v ON v.closure_period = p.period
GROUP BY p.period""",
    "prelim_republished": "SELECT * FROM prelim_again",
    "prelim_latest_version": """
SELECT closure_period, version, COUNT(*) AS results
FROM (SELECT *, MAX(version) OVER (PARTITION BY closure_period) AS highest
      FROM (SELECT closure_period, version FROM prelim_first
            UNION ALL SELECT closure_period, version FROM prelim_again) u) q
WHERE version = highest GROUP BY closure_period, version""",
    "prelim_category_summary": f"""
SELECT closure_period, account_category, {money('preliminary_amount')} AS total_amount,
  {mean('variance_percent')} AS avg_variance_pct
FROM prelim GROUP BY closure_period, account_category""",
    "prelim_by_bu": f"""
SELECT *, {pct_or_zero('total_variance', 'total_prior')} AS variance_pct
FROM (SELECT closure_period, bu_name, account_category, {money('preliminary_amount')} AS total_amount,
        {money('prior_period_amount')} AS total_prior, {money('variance_amount')} AS total_variance
      FROM prelim GROUP BY ALL) q""",
    "top_variances": f"""
SELECT bu_name, account_description, account_category, preliminary_amount, prior_period_amount, variance_amount,
  variance_percent
FROM prelim WHERE closure_period = '{P}' AND ABS(variance_amount) > 10000
ORDER BY ABS(variance_amount) DESC, bu_code, account_code, account_description LIMIT 20""",
    "final_results": "SELECT * FROM final",
    "final_published": f"SELECT * FROM final WHERE closure_period = '{P}'",
    "final_by_bu": f"""
SELECT closure_period, bu_name, account_category, {money('preliminary_amount')} AS preliminary,
  {money('adjustments_amount')} AS adjustments, {money('final_amount')} AS final_amount,
  {money('forecast_amount')} AS forecast, {money('forecast_variance')} AS vs_forecast,
  {money('prior_period_amount')} AS prior_period, {money('yoy_variance')} AS yoy_variance
FROM final GROUP BY closure_period, bu_name, account_category""",
    "final_listing": "SELECT * FROM final WHERE is_final",
    "kpi_metrics": "SELECT * FROM kpi",
    "kpi_listing": f"""
SELECT closure_period, metric_name, CASE WHEN bu_code = 'ALL' THEN 'Global' ELSE bu_code END AS scope,
  metric_category, {r2('metric_value')} AS value, target_value AS target, variance_from_target AS variance
FROM kpi""",
    # --- dataset reports -------------------------------------------------------------
    "ledger_by_bu": f"""
SELECT bu_code, bu_name, local_currency, COUNT(*) AS record_count, {money('local_amount')} AS total_local,
  {money('usd_amount')} AS total_usd, COUNT(*) FILTER (WHERE is_validated) AS valid_records,
  COUNT(*) FILTER (WHERE NOT is_validated) AS invalid_records
FROM ledger GROUP BY bu_code, bu_name, local_currency""",
    "cuts_summary": f"""
SELECT cut_number, COUNT(*) AS adjustment_count, {money('usd_amount')} AS total_usd_adjustments,
  {mean('usd_amount')} AS avg_usd_adjustment, COUNT(DISTINCT bu_code) AS bu_count,
  COUNT(DISTINCT adjustment_type) AS adjustment_types, COUNT(*) FILTER (WHERE is_validated) AS valid_count
FROM cuts GROUP BY cut_number""",
    "cuts_by_bu": f"""
SELECT bu_code, cut_number, COUNT(*) AS adjustment_count, {money('usd_amount')} AS total_usd_adjustments,
  COUNT(DISTINCT adjustment_type) AS adjustment_types
FROM cuts WHERE is_validated GROUP BY bu_code, cut_number""",
    "segments_by_type": f"""
SELECT segment_type, COUNT(*) AS record_count, COUNT(DISTINCT segment_value) AS unique_values,
  {money('usd_amount')} AS total_usd, {mean('usd_amount')} AS avg_usd
FROM segs WHERE is_validated GROUP BY segment_type""",
    "segments_by_bu": f"""
SELECT bu_code, COUNT(*) AS record_count, COUNT(DISTINCT segment_type) AS segment_types,
  COUNT(DISTINCT account_code) AS accounts, {money('usd_amount')} AS total_usd
FROM segs WHERE is_validated GROUP BY bu_code""",
    "forecast_by_bu": _forecast_by_bu("forecast_p", "usd_amount", "total_forecast_usd", "WHERE is_validated"),
    "forecast_trend": _trend(
        "forecast_p", "usd_amount", ("revenue_forecast", "cost_forecast", "net_forecast"), "WHERE is_validated"
    ),
    "data_completeness": "SELECT p.closure_period, d.dataset, COALESCE(c.n, 0) AS record_count, "
    "CASE WHEN COALESCE(c.n, 0) > 0 THEN 'Complete' ELSE 'Missing' END AS status FROM ("
    + " UNION ".join(f"SELECT closure_period FROM {t} WHERE closure_period IS NOT NULL" for _, _, t in DATASETS)
    + ") p CROSS JOIN (VALUES "
    + ", ".join(f"('{title}')" for _, title, _ in DATASETS)
    + ") d(dataset) LEFT JOIN ("
    + " UNION ALL ".join(
        f"SELECT '{title}' AS dataset, closure_period, COUNT(*) AS n FROM {t} WHERE is_validated GROUP BY closure_period"
        for _, title, t in DATASETS
    )
    + ") c ON c.closure_period = p.closure_period AND c.dataset = d.dataset",
    "dataset_counts": _union(
        *[
            f"SELECT '{name}' AS dataset, closure_period, COUNT(*) AS records FROM {t} GROUP BY closure_period"
            for name, _, t in (*DATASETS, ("preliminary_results", "", "prelim"), ("final_results", "", "final"))
        ]
    ),
    # --- financial metrics -----------------------------------------------------------
    "financial_summary": f"""
SELECT *, total_revenue - total_cogs AS gross_profit,
  (total_revenue - total_cogs) / NULLIF(total_revenue, 0) * 1e2 AS gross_margin_pct,
  total_revenue - total_cogs - total_opex AS operating_income,
  (total_revenue - total_cogs - total_opex) / NULLIF(total_revenue, 0) * 1e2 AS operating_margin_pct
FROM (SELECT closure_period, {REV} AS total_revenue, {COGS} AS total_cogs, {OPEX} AS total_opex
      FROM final WHERE is_final GROUP BY closure_period) q""",
    "exec_summary": EXEC,
    "bu_revenue": _gross("closure_period, bu_name, region"),
    "product_performance": _gross("closure_period, segment_product", "AND segment_product <> 'Unallocated'"),
    "forecast_accuracy": f"""
SELECT *, {pct_or_zero('variance', 'forecast')} AS variance_pct,
  {_rating(((5, 'Excellent'), (10, 'Good'), (15, 'Fair')), 'Poor')} AS accuracy_rating
FROM ({_forecast_groups('closure_period, bu_name, account_category')} GROUP BY ALL) q""",
    "yoy_comparison": f"""
SELECT *, {pct_or_zero('variance', 'prior_period')} AS variance_pct,
  CASE account_category WHEN 'Revenue' THEN 1 WHEN 'COGS' THEN 2 WHEN 'OpEx' THEN 3 ELSE 4 END AS category_rank
FROM (SELECT closure_period, account_category, {money('final_amount')} AS current_period,
        {money('prior_period_amount')} AS prior_period, {money('yoy_variance')} AS variance
      FROM final WHERE is_final GROUP BY ALL) q""",
    # --- cycle status ----------------------------------------------------------------
    "recent_periods": "SELECT DISTINCT closure_period FROM closure_status ORDER BY closure_period DESC LIMIT 6",
    "cycle_status": f"""
SELECT closure_period, current_phase, {phase_name('current_phase')} AS phase_name, phase_status, started_at,
  expected_completion, actual_completion, {DAYS} AS days_elapsed,
  {_state('COMPLETED', 'OVERDUE', 'IN_PROGRESS')} AS status
FROM closure_status WHERE closure_period = '{P}' ORDER BY started_at DESC, closure_id DESC LIMIT 1""",
    "status_history": f"""
SELECT closure_period, current_phase, phase_status, started_at, actual_completion, {DAYS} AS days_elapsed, notes
FROM closure_status""",
    "newest_statuses": "SELECT * FROM closure_status ORDER BY started_at DESC, closure_id DESC LIMIT 5",
    # --- task log --------------------------------------------------------------------
    "task_summary": f"""
SELECT agent_name, phase, COUNT(*) AS total_tasks, COUNT(*) FILTER (WHERE status = 'COMPLETED') AS completed,
  COUNT(*) FILTER (WHERE status = 'FAILED') AS failed, COUNT(*) FILTER (WHERE status = 'RUNNING') AS running,
  {r2(mean('duration_seconds') + ' / 60')} AS avg_duration_minutes,
  CAST(SUM(records_processed) AS BIGINT) AS total_records, MAX(started_at) AS last_run
FROM task_log GROUP BY agent_name, phase""",
    "task_timeline": f"""
SELECT agent_name, phase, task_name, status, started_at, {r2('duration_seconds / 60')} AS duration_minutes,
  records_processed, error_message FROM task_log""",
    "newest_tasks": "SELECT * FROM task_log ORDER BY started_at DESC, log_id DESC LIMIT 20",
    "task_performance": f"""
SELECT agent_name, COUNT(*) AS executions, COUNT(*) FILTER (WHERE status = 'COMPLETED') AS successful,
  COUNT(*) FILTER (WHERE status = 'FAILED') AS failed,
  {r2("CAST(COUNT(*) FILTER (WHERE status = 'COMPLETED') * 100 AS DOUBLE) / COUNT(*)")} AS success_rate,
  {r2(mean('duration_seconds') + ' / 60')} AS avg_duration_min,
  {r2('MIN(duration_seconds) / 60')} AS min_duration_min, {r2('MAX(duration_seconds) / 60')} AS max_duration_min,
  CAST(SUM(records_processed) AS BIGINT) AS total_records
FROM task_log GROUP BY agent_name""",
    "failed_tasks": """
SELECT agent_name, phase, task_name, started_at, error_message FROM task_log WHERE status = 'FAILED'""",
    "phase_progress": f"""
SELECT phase, {phase_name('phase')} AS phase_name, COUNT(*) AS total_tasks,
  COUNT(*) FILTER (WHERE status = 'COMPLETED') AS completed_tasks,
  {r2("CAST(COUNT(*) FILTER (WHERE status = 'COMPLETED') * 100 AS DOUBLE) / COUNT(*)")} AS completion_pct
FROM task_log GROUP BY phase""",
    "overall_stats": f"""
SELECT COUNT(DISTINCT agent_name) AS total_agents, COUNT(*) AS total_tasks,
  COUNT(*) FILTER (WHERE status = 'COMPLETED') AS completed_tasks,
  COUNT(*) FILTER (WHERE status = 'FAILED') AS failed_tasks,
  {r2(money('duration_seconds') + ' / 3600')} AS total_hours,
  CAST(SUM(records_processed) AS BIGINT) AS total_records,
  {r2("CAST(COUNT(*) FILTER (WHERE status = 'COMPLETED') * 100 AS DOUBLE) / COUNT(*)")} AS success_rate,
  CASE WHEN COUNT(*) FILTER (WHERE status = 'FAILED') = 0 THEN 'Healthy' ELSE 'Issues Detected' END AS health
FROM task_log""",
    "audit_activity": f"""
SELECT phase, agent_name, task_name, status, records_processed, {r2('duration_seconds / 60')} AS duration_minutes
FROM task_log""",
    "task_daily_performance": f"""
SELECT agent_id, closure_period, CAST(started_at AS DATE) AS metric_date,
  CAST(COUNT(*) FILTER (WHERE status = 'COMPLETED') AS INTEGER) AS tasks_completed,
  CAST(COUNT(*) FILTER (WHERE status = 'FAILED') AS INTEGER) AS tasks_failed,
  {mean('duration_seconds')} AS average_duration_seconds,
  CAST(SUM(records_processed) AS BIGINT) AS total_records_processed,
  CAST(COUNT(*) FILTER (WHERE status = 'FAILED') AS DOUBLE) / COUNT(*) AS error_rate,
  CAST(COUNT(*) FILTER (WHERE duration_seconds <= sla) AS DOUBLE)
    / NULLIF(COUNT(*) FILTER (WHERE sla IS NOT NULL AND duration_seconds IS NOT NULL), 0) AS sla_compliance_rate
FROM (SELECT *, CASE phase WHEN 1 THEN 24 WHEN 2 THEN 48 WHEN 3 THEN 24 WHEN 4 THEN 24 WHEN 5 THEN 12 END * 3600
        AS sla FROM task_log) q
GROUP BY agent_id, closure_period, CAST(started_at AS DATE)""",
    "notification_status": """
SELECT phase, severity, message, recipient, sent_at, acknowledged_at,
  CASE WHEN acknowledged_at IS NOT NULL THEN 'Acknowledged' ELSE 'Pending' END AS status FROM notifications""",
    # --- raw landing reports -----------------------------------------------------------
    "raw_fx_stats": f"""
SELECT currency, COUNT(*) AS record_count, MIN(rate) AS min_rate, MAX(rate) AS max_rate,
  {mean('rate', 'DECIMAL(38,12)')} AS avg_rate, ROUND(STDDEV_SAMP(rate), 8) AS stddev_rate,
  MIN(rate_date) AS earliest_date, MAX(rate_date) AS latest_date
FROM fx_raw GROUP BY currency""",
    "raw_ledger_by_bu": f"""
SELECT bu_code, local_currency, COUNT(*) AS record_count, {money('local_amount')} AS total_amount,
  {mean('local_amount')} AS avg_amount, COUNT(DISTINCT account_code) AS unique_accounts,
  COUNT(DISTINCT cost_center) AS unique_cost_centers
FROM ledger_raw WHERE bu_code IN {BUS} GROUP BY bu_code, local_currency""",
    "raw_ledger_by_category": f"""
SELECT {category('account_code', 'Unknown')} AS category, COUNT(*) AS record_count,
  {money('local_amount')} AS total_amount
FROM ledger_raw WHERE bu_code IN {BUS} GROUP BY 1""",
    "raw_cuts_by_cut": f"""
SELECT cut_number, COUNT(*) AS adjustment_count, {money('adjustment_amount')} AS total_adjustments,
  {mean('adjustment_amount')} AS avg_adjustment, COUNT(DISTINCT bu_code) AS bu_count,
  COUNT(DISTINCT adjustment_type) AS adjustment_types
FROM cuts_raw GROUP BY cut_number""",
    "raw_cuts_by_bu": f"""
SELECT bu_code, cut_number, currency, COUNT(*) AS adjustment_count,
  {money('adjustment_amount')} AS total_adjustments, {mean('adjustment_amount')} AS avg_adjustment
FROM cuts_raw GROUP BY bu_code, cut_number, currency""",
    "raw_cuts_by_type": f"""
SELECT adjustment_type, cut_number, COUNT(*) AS records, {money('adjustment_amount')} AS total_amount
FROM cuts_raw GROUP BY adjustment_type, cut_number""",
    "raw_segments_by_type": f"""
SELECT segment_type, COUNT(*) AS record_count, COUNT(DISTINCT segment_value) AS unique_values,
  {money('amount')} AS total_amount, COUNT(DISTINCT bu_code) AS bu_count
FROM segments_raw GROUP BY segment_type""",
    "raw_segments_by_bu": f"""
SELECT bu_code, currency, COUNT(*) AS record_count, COUNT(DISTINCT segment_type) AS segment_types,
  {money('amount')} AS total_amount
FROM segments_raw GROUP BY bu_code, currency""",
    "raw_segments_by_product": f"""
SELECT segment_value AS product, COUNT(*) AS record_count, {money('amount')} AS total_amount,
  {mean('amount')} AS avg_amount
FROM segments_raw WHERE segment_type = 'Product' GROUP BY segment_value""",
    "raw_forecast_by_bu": _forecast_by_bu("forecast_raw", "forecast_amount", "total_forecast"),
    "raw_forecast_trend": _trend("forecast_raw", "forecast_amount", ("total_revenue", "total_costs", "net_income")),
    "raw_forecast_fx_summary": f"""
SELECT currency, COUNT(*) AS forecast_count, MIN(forecast_rate) AS min_rate, MAX(forecast_rate) AS max_rate,
  {mean('forecast_rate', 'DECIMAL(38,12)')} AS avg_rate, MIN(forecast_month) AS first_date,
  MAX(forecast_month) AS last_date
FROM forecast_fx_raw GROUP BY currency""",
    "preview_raw_rates": f"""
SELECT currency, rate_date, rate, source, loaded_at FROM fx_raw WHERE rate_date >= DATE '{AS_OF_FX}' - 7
ORDER BY rate_date DESC, currency NULLS FIRST, rate NULLS FIRST, source NULLS FIRST, loaded_at NULLS FIRST LIMIT 50""",
    "preview_raw_ledger": _preview(
        "ledger_raw",
        "bu_code account_code account_description local_currency local_amount period cost_center",
    ),
    "preview_raw_cuts": _preview(
        "cuts_raw",
        "cut_number bu_code account_code adjustment_type adjustment_amount currency description period",
    ),
    "preview_raw_segments": _preview(
        "segments_raw", "bu_code account_code segment_type segment_value amount currency period", 100
    ),
    "preview_raw_forecasts": _preview(
        "forecast_raw", "bu_code account_code forecast_period forecast_amount currency forecast_type version"
    ),
    "preview_raw_forecast_fx": """
SELECT currency, forecast_month, forecast_rate, source FROM forecast_fx_raw
ORDER BY forecast_month NULLS FIRST, currency NULLS FIRST, forecast_rate NULLS FIRST, source NULLS FIRST LIMIT 50""",
    # --- dashboard views -----------------------------------------------------------------
    "v_closure_status": f"""
SELECT closure_period, current_phase, {phase_name('current_phase', "'Unknown'")} AS phase_name, phase_status,
  started_at, expected_completion, actual_completion, {_state('Completed', 'Overdue', 'In Progress')} AS status,
  {DAYS} AS days_elapsed, notes
FROM closure_status WHERE closure_period = {NEWEST.format('closure_status')}
ORDER BY started_at DESC, closure_id DESC LIMIT 1""",
    "v_fx_monitor": f"""
SELECT currency, rate_date, rate, variance_from_prior, is_validated, validation_notes,
  CASE WHEN ABS(variance_from_prior) > 5 THEN 'High Variance' WHEN ABS(variance_from_prior) > 2 THEN 'Medium Variance'
       ELSE 'Normal' END AS variance_level, source, closure_period
FROM fx_proc WHERE rate_date >= DATE '{AS_OF_FX}' - 30""",
    "v_bu_submission": """
SELECT bu_code, bu_name, p AS preliminary_submitted, s AS segmented_submitted, f AS forecast_submitted,
  CASE WHEN p AND s AND f THEN 'Complete' WHEN p THEN 'Partial' ELSE 'Pending' END AS overall_status
FROM (SELECT b.bu_code, b.bu_name,
  b.bu_code IN (SELECT bu_code FROM ledger WHERE bu_code IS NOT NULL
                AND closure_period = (SELECT MAX(closure_period) FROM closure_status)) AS p,
  b.bu_code IN (SELECT bu_code FROM segs WHERE bu_code IS NOT NULL
                AND closure_period = (SELECT MAX(closure_period) FROM closure_status)) AS s,
  b.bu_code IN (SELECT bu_code FROM forecast_own WHERE bu_code IS NOT NULL
                AND closure_period = (SELECT MAX(closure_period) FROM closure_status)) AS f
  FROM bus b) q""",
    "v_top_adjustments": f"""
SELECT bu_code, account_code, adjustment_type, cut_number, ABS(usd_amount) AS adjustment_amount,
  usd_amount AS signed_amount, description, 'system_auto_approved' AS approved_by, closure_period
FROM cuts WHERE is_validated AND closure_period = {NEWEST.format('cuts')}
ORDER BY ABS(usd_amount) DESC, bu_code, account_code, adjustment_type, cut_number, usd_amount, description LIMIT 20""",
    "v_prelim_summary": f"""
SELECT *, {pct_or_zero('variance', 'prior_period')} AS variance_percent
FROM (SELECT closure_period, bu_name, account_category, {money('preliminary_amount')} AS total_amount,
        {money('prior_period_amount')} AS prior_period, {money('variance_amount')} AS variance,
        COUNT(*) AS account_count
      FROM prelim WHERE closure_period = {NEWEST.format('prelim')} GROUP BY ALL) q""",
    "v_final_segmented": f"""
SELECT *, {pct_or_zero('yoy_variance', 'prior_year')} AS yoy_variance_percent
FROM (SELECT closure_period, bu_name, region, account_category, segment_product, segment_geography,
        segment_customer, segment_channel, {money('final_amount')} AS final_amount,
        {money('forecast_amount')} AS forecast_amount, {money('forecast_variance')} AS vs_forecast,
        {money('prior_period_amount')} AS prior_year, {money('yoy_variance')} AS yoy_variance
      FROM final WHERE is_final AND closure_period = {NEWEST.format('final')} GROUP BY ALL) q""",
    "v_forecast_vs_actual": f"""
SELECT bu_name, account_category, segment_product, actual AS actual_amount, forecast AS forecast_amount, variance,
  {pct_or_zero('variance', 'forecast')} AS variance_percent,
  {_rating(((5, 'On Target'), (10, 'Minor Variance')), 'Significant Variance')} AS accuracy_rating
FROM ({_forecast_groups('bu_name, account_category, segment_product')}
      AND closure_period = {NEWEST.format('final')} GROUP BY ALL) q""",
    "v_kpi_dashboard": f"""
SELECT closure_period, metric_name, metric_category,
  CASE WHEN bu_code = 'ALL' THEN 'Global' ELSE bu_code END AS business_unit, region,
  {r2('metric_value')} AS metric_value, target_value, variance_from_target, 'No Target' AS performance_status
FROM kpi WHERE closure_period = {NEWEST.format('kpi')}""",
    "v_dq_dashboard": f"""
SELECT closure_period, phase, {phase_name('phase', "'Unknown'")} AS phase_name, table_name, check_name, check_result,
  records_checked, records_failed, {FAILURE} AS failure_rate_percent,
  CASE check_result WHEN 'PASSED' THEN '✅' WHEN 'WARNING' THEN '⚠️' ELSE '❌' END AS status_icon, details
FROM dq WHERE closure_period = {NEWEST.format('dq')}""",
    "v_task_activity": f"""
SELECT agent_name, phase, task_name, status, started_at, {r2('duration_seconds')} AS duration_seconds,
  records_processed,
  CASE status WHEN 'COMPLETED' THEN '✅' WHEN 'RUNNING' THEN '🔄' WHEN 'FAILED' THEN '❌' ELSE '⏸️' END AS status_icon,
  error_message, closure_period
FROM task_log WHERE closure_period = {NEWEST.format('task_log')}
ORDER BY started_at DESC, log_id DESC LIMIT 50""",
    "v_trends": f"""
SELECT *, revenue - cogs AS gross_profit, (revenue - cogs) / NULLIF(revenue, 0) * 1e2 AS gross_margin_pct
FROM (SELECT closure_period, CAST(closure_period || '-01' AS DATE) AS period_date, bu_name, {REV} AS revenue,
        ABS({money("CASE WHEN account_category = 'COGS' THEN final_amount ELSE 0e0 END")}) AS cogs,
        ABS({money("CASE WHEN account_category = 'OpEx' THEN final_amount ELSE 0e0 END")}) AS opex
      FROM final WHERE is_final GROUP BY ALL) q""",
    "v_variance_analysis": f"""
SELECT bu_name, account_description, account_category, segment_product, final_amount AS current_period,
  prior_period_amount AS prior_period, yoy_variance AS variance_amount, yoy_variance_percent AS variance_percent,
  CASE WHEN ABS(yoy_variance_percent) > 50 THEN 'Extreme' WHEN ABS(yoy_variance_percent) > 20 THEN 'High'
       WHEN ABS(yoy_variance_percent) > 10 THEN 'Medium' ELSE 'Normal' END AS variance_severity, closure_period
FROM final WHERE is_final AND closure_period = {NEWEST.format('final')} AND ABS(yoy_variance) > 10000
ORDER BY ABS(yoy_variance) DESC, bu_code, account_code LIMIT 50""",
}
