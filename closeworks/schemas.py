"""Column layout of the close tables, by layer.

Each layout is a Spark DDL string; ``SCHEMAS`` holds the parsed ``StructType``.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW, PROCESSED, REPORTING, AUDIT = "raw", "processed", "reporting", "audit"

_LINEAGE = "loaded_at timestamp, file_name string"

# Names and order of the columns of every table.
_DDL: dict[str, tuple[str, str]] = {
    "exchange_rates_raw": (
        RAW,
        "load_id string, currency string, rate double, rate_date date, source string, " + _LINEAGE,
    ),
    "bu_preliminary_close_raw": (
        RAW,
        "load_id string, bu_code string, account_code string, account_description string, "
        "local_currency string, local_amount double, period string, cost_center string, " + _LINEAGE,
    ),
    "accounting_cuts_raw": (
        RAW,
        "load_id string, cut_number int, bu_code string, account_code string, adjustment_type string, "
        "adjustment_amount double, currency string, description string, period string, " + _LINEAGE,
    ),
    "segmented_files_raw": (
        RAW,
        "load_id string, bu_code string, account_code string, segment_type string, segment_value string, "
        "amount double, currency string, period string, " + _LINEAGE,
    ),
    "forecast_files_raw": (
        RAW,
        "load_id string, bu_code string, account_code string, forecast_period string, forecast_amount double, "
        "currency string, forecast_type string, version string, " + _LINEAGE,
    ),
    "forecast_fx_raw": (
        RAW,
        "load_id string, currency string, forecast_date date, forecast_rate double, source string, " + _LINEAGE,
    ),
    "exchange_rates": (
        PROCESSED,
        "rate_id string, currency string, rate double, rate_date date, source string, "
        "variance_from_prior double, is_validated boolean, validation_notes string, "
        "loaded_at timestamp, load_id string, processed_at timestamp, closure_period string",
    ),
    "bu_preliminary_close": (
        PROCESSED,
        "record_id string, bu_code string, bu_name string, account_code string, account_description string, "
        "local_currency string, local_amount double, usd_amount double, exchange_rate double, period string, "
        "cost_center string, is_validated boolean, validation_issues array<string>, "
        "processed_at timestamp, closure_period string",
    ),
    "accounting_cuts": (
        PROCESSED,
        "cut_id string, cut_number int, bu_code string, account_code string, adjustment_type string, "
        "adjustment_amount double, currency string, usd_amount double, description string, period string, "
        "approved_by string, approved_at timestamp, is_validated boolean, "
        "processed_at timestamp, closure_period string",
    ),
    "segmented_files": (
        PROCESSED,
        "segment_id string, bu_code string, account_code string, segment_type string, segment_value string, "
        "amount double, currency string, usd_amount double, period string, is_validated boolean, "
        "processed_at timestamp, closure_period string",
    ),
    "forecast_files": (
        PROCESSED,
        "forecast_id string, bu_code string, account_code string, forecast_period string, "
        "forecast_amount double, currency string, usd_amount double, forecast_type string, version string, "
        "is_validated boolean, variance_from_prior double, processed_at timestamp, closure_period string",
    ),
    "preliminary_results": (
        REPORTING,
        "result_id string, closure_period string, bu_code string, bu_name string, account_code string, "
        "account_description string, account_category string, preliminary_amount double, currency string, "
        "usd_amount double, prior_period_amount double, variance_amount double, variance_percent double, "
        "published_at timestamp, version int",
    ),
    "final_results": (
        REPORTING,
        "result_id string, closure_period string, bu_code string, bu_name string, region string, "
        "account_code string, account_description string, account_category string, segment_product string, "
        "segment_geography string, segment_customer string, segment_channel string, "
        "preliminary_amount double, adjustments_amount double, final_amount double, currency string, "
        "usd_amount double, forecast_amount double, forecast_variance double, prior_period_amount double, "
        "yoy_variance double, yoy_variance_percent double, published_at timestamp, is_final boolean, "
        "approved_by string, approved_at timestamp",
    ),
    "kpi_metrics": (
        REPORTING,
        "metric_id string, closure_period string, metric_name string, metric_category string, "
        "metric_value double, target_value double, variance_from_target double, bu_code string, "
        "region string, calculated_at timestamp",
    ),
    "closure_status": (
        REPORTING,
        "closure_id string, closure_period string, current_phase int, phase_status string, "
        "started_at timestamp, expected_completion timestamp, actual_completion timestamp, "
        "created_by string, updated_at timestamp, notes string",
    ),
    "agent_execution_logs": (
        AUDIT,
        "log_id string, agent_id string, agent_name string, closure_period string, phase int, "
        "task_name string, status string, started_at timestamp, completed_at timestamp, "
        "duration_seconds double, records_processed bigint, error_message string, metadata map<string,string>",
    ),
    "data_quality_checks": (
        AUDIT,
        "check_id string, closure_period string, phase int, table_name string, check_type string, "
        "check_name string, check_result string, records_checked bigint, records_failed bigint, "
        "failure_rate double, details string, checked_at timestamp",
    ),
    "notifications": (
        AUDIT,
        "notification_id string, closure_period string, phase int, severity string, message string, "
        "recipient string, sent_at timestamp, acknowledged_at timestamp",
    ),
    "approvals": (
        AUDIT,
        "approval_id string, closure_period string, phase int, approval_type string, "
        "required_approver string, status string, requested_at timestamp, approved_at timestamp, comments string",
    ),
    "agent_performance": (
        AUDIT,
        "metric_id string, agent_id string, closure_period string, metric_date date, tasks_completed int, "
        "tasks_failed int, average_duration_seconds double, total_records_processed bigint, "
        "error_rate double, sla_compliance_rate double, calculated_at timestamp",
    ),
    "agent_state": (
        AUDIT,
        "agent_id string, agent_name string, phase int, status string, current_task string, "
        "closure_period string, started_at timestamp, updated_at timestamp, metadata map<string,string>",
    ),
    "agent_registry": (
        AUDIT,
        "agent_id string, agent_name string, agent_type string, phase int, description string, "
        "is_enabled boolean, config map<string,string>, created_at timestamp, updated_at timestamp",
    ),
    "agent_task_queue": (
        AUDIT,
        "task_id string, agent_id string, closure_period string, phase int, task_type string, "
        "task_description string, priority int, status string, created_at timestamp, scheduled_for timestamp, "
        "started_at timestamp, completed_at timestamp, result string, error_message string, retry_count int, "
        "metadata map<string,string>",
    ),
    "agent_communications": (
        AUDIT,
        "communication_id string, closure_period string, from_agent_id string, to_agent_id string, "
        "message_type string, message_content string, sent_at timestamp, received_at timestamp, "
        "acknowledged_at timestamp",
    ),
    "agent_capabilities": (
        AUDIT,
        "capability_id string, agent_id string, capability_name string, capability_type string, "
        "is_enabled boolean, parameters map<string,string>",
    ),
    "agent_decisions": (
        AUDIT,
        "decision_id string, agent_id string, closure_period string, phase int, decision_type string, "
        "decision_description string, decision_outcome string, confidence_score double, "
        "factors array<string>, made_at timestamp, overridden boolean, overridden_by string, "
        "overridden_at timestamp",
    ),
}

LAYER: dict[str, str] = {name: layer for name, (layer, _) in _DDL.items()}

SCHEMAS: dict[str, T.StructType] = {}


def ddl(name: str) -> str:
    return _DDL[name][1]


def schema(name: str) -> T.StructType:
    """The ``StructType`` of a table. Parsed on first use, as parsing needs a session."""
    if name not in SCHEMAS:
        SCHEMAS[name] = T.StructType.fromDDL(ddl(name))
    return SCHEMAS[name]


# Tables partitioned by closure period: every report reads one or few periods.
PARTITION_COLUMN = "closure_period"

# Columns by which a table is laid out inside its files, for min/max skipping.
CLUSTER_KEYS: dict[str, tuple[str, str]] = {
    "exchange_rates": ("currency", "rate_date"),
    "bu_preliminary_close": ("bu_code", "period"),
    "accounting_cuts": ("cut_number", "period"),
    "preliminary_results": ("closure_period", "bu_code"),
    "final_results": ("closure_period", "bu_code"),
    "agent_execution_logs": ("closure_period", "phase"),
    "data_quality_checks": ("closure_period", "phase"),
}


def is_partitioned(name: str) -> bool:
    return LAYER[name] != RAW and PARTITION_COLUMN in schema(name).fieldNames()
