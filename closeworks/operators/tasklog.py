"""Reports over the task log and the notifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.config import DEFAULT_CONFIG, CloseConfig
from closeworks.functions.exprs import amount_of, decode, in_period, mean, phase_name, unit_sum


def _with_status(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def _minutes(seconds: Column | str) -> Column:
    return F.round((F.col(seconds) if isinstance(seconds, str) else seconds) / 60, 2)


def _completed_at(log: DataFrame) -> list[str]:
    return ["completed_at"] if "completed_at" in log.columns else []


def task_summary(log: DataFrame, period: str | None = None) -> DataFrame:
    """Per agent and phase: tasks by outcome, average minutes, records, last run."""
    return (
        in_period(log, period)
        .groupBy("agent_name", "phase")
        .agg(
            F.count("*").alias("total_tasks"),
            _with_status("COMPLETED").alias("completed"),
            _with_status("FAILED").alias("failed"),
            _with_status("RUNNING").alias("running"),
            _minutes(mean("duration_seconds")).alias("avg_duration_minutes"),
            F.sum("records_processed").alias("total_records"),
            F.max("started_at").alias("last_run"),
        )
        .orderBy("phase", "agent_name")
    )


def task_timeline(log: DataFrame, period: str | None = None, n: int | None = None) -> DataFrame:
    """Tasks, newest first; all of them or the newest ``n``."""
    ordered = in_period(log, period).orderBy(F.desc("started_at"), F.desc("log_id"))
    return (ordered if n is None else ordered.limit(n)).select(
        "agent_name",
        "phase",
        "task_name",
        "status",
        "started_at",
        *_completed_at(log),
        _minutes("duration_seconds").alias("duration_minutes"),
        "records_processed",
        "error_message",
    )


def newest_tasks(log: DataFrame, n: int = 20) -> DataFrame:
    """The newest ``n`` log rows as they are."""
    return log.orderBy(F.desc("started_at"), F.desc("log_id")).limit(n)


def task_performance(log: DataFrame, period: str | None = None) -> DataFrame:
    """Per agent: executions, success rate, duration statistics."""
    return (
        in_period(log, period)
        .groupBy("agent_name")
        .agg(
            F.count("*").alias("executions"),
            _with_status("COMPLETED").alias("successful"),
            _with_status("FAILED").alias("failed"),
            mean("duration_seconds").alias("_avg"),
            F.min("duration_seconds").alias("_min"),
            F.max("duration_seconds").alias("_max"),
            F.sum("records_processed").alias("total_records"),
        )
        .select(
            "agent_name",
            "executions",
            "successful",
            "failed",
            F.round(F.col("successful") * 100 / F.col("executions"), 2).alias("success_rate"),
            _minutes("_avg").alias("avg_duration_min"),
            _minutes("_min").alias("min_duration_min"),
            _minutes("_max").alias("max_duration_min"),
            "total_records",
        )
        .orderBy("agent_name")
    )


def failed_tasks(log: DataFrame, period: str | None = None) -> DataFrame:
    return (
        in_period(log, period)
        .filter(F.col("status") == "FAILED")
        .orderBy(F.desc("started_at"), F.desc("log_id"))
        .select("agent_name", "phase", "task_name", "started_at", "error_message")
    )


def phase_progress(log: DataFrame, period: str | None = None) -> DataFrame:
    """Completed share of the tasks of each phase."""
    return (
        in_period(log, period)
        .groupBy("phase")
        .agg(F.count("*").alias("total_tasks"), _with_status("COMPLETED").alias("completed_tasks"))
        .select(
            "phase",
            phase_name().alias("phase_name"),
            "total_tasks",
            "completed_tasks",
            F.round(F.col("completed_tasks") * 100 / F.col("total_tasks"), 2).alias("completion_pct"),
        )
        .orderBy("phase")
    )


def notification_status(notifications: DataFrame, period: str | None = None) -> DataFrame:
    return (
        in_period(notifications, period)
        .orderBy(F.desc("sent_at"), F.desc("notification_id"))
        .select(
            "phase",
            "severity",
            "message",
            "recipient",
            "sent_at",
            "acknowledged_at",
            F.when(F.col("acknowledged_at").isNotNull(), "Acknowledged").otherwise("Pending").alias("status"),
        )
    )


def overall_stats(log: DataFrame, period: str | None = None) -> DataFrame:
    """One row over all agents. Combined per agent first, so the distinct count is a plain count."""
    by_agent = (
        in_period(log, period)
        .groupBy("agent_name")
        .agg(
            F.count("*").alias("_tasks"),
            _with_status("COMPLETED").alias("_done"),
            _with_status("FAILED").alias("_failed"),
            unit_sum("duration_seconds").alias("_seconds"),
            F.sum("records_processed").alias("_records"),
        )
    )
    done, tasks = F.col("completed_tasks"), F.col("total_tasks")
    return (
        by_agent.agg(
            F.count("agent_name").alias("total_agents"),
            F.coalesce(F.sum("_tasks"), F.lit(0)).alias("total_tasks"),
            F.sum("_done").alias("completed_tasks"),
            F.sum("_failed").alias("failed_tasks"),
            F.round(amount_of(F.sum("_seconds")) / 3600, 2).alias("total_hours"),
            F.sum("_records").alias("total_records"),
        )
        .withColumn("success_rate", F.round(F.try_divide(done * 100, tasks), 2))
        .withColumn("health", F.when(F.col("failed_tasks") == 0, "Healthy").otherwise("Issues Detected"))
    )


def audit_activity(log: DataFrame, period: str | None = None) -> DataFrame:
    """Activity section of the audit report, in order of start."""
    return (
        in_period(log, period)
        .orderBy("phase", "started_at", "log_id")
        .select(
            "phase",
            "agent_name",
            "task_name",
            "status",
            "records_processed",
            _minutes("duration_seconds").alias("duration_minutes"),
        )
    )


def task_daily_performance(log: DataFrame, cfg: CloseConfig = DEFAULT_CONFIG) -> DataFrame:
    """Per agent and day: outcomes, average duration, error rate, share of tasks within the phase SLA.

    Tasks of a phase without an SLA do not count towards compliance.
    """
    limit = decode("phase", cfg.phase_sla_hours) * 3600
    judged = limit.isNotNull() & F.col("duration_seconds").isNotNull()
    return (
        log.groupBy("agent_id", "closure_period", F.col("started_at").cast("date").alias("metric_date"))
        .agg(
            _with_status("COMPLETED").cast("int").alias("tasks_completed"),
            _with_status("FAILED").cast("int").alias("tasks_failed"),
            mean("duration_seconds").alias("average_duration_seconds"),
            F.sum("records_processed").alias("total_records_processed"),
            F.try_divide(_with_status("FAILED"), F.count("*")).alias("error_rate"),
            F.try_divide(F.count_if(judged & (F.col("duration_seconds") <= limit)), F.count_if(judged)).alias(
                "sla_compliance_rate"
            ),
        )
    )
