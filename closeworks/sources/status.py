"""Status rows of a close cycle: one row each, built with the fixed layout and appended.

The point in time is always given. Expected completion of a phase is its SLA away.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from closeworks.config import DEFAULT_CONFIG, CloseConfig
from closeworks.operators import controls
from closeworks.sources import files
from closeworks.sources.tables import audit_rows, stamp

CYCLE_DAYS = 7


def _row(
    spark: SparkSession,
    period: str,
    phase: int,
    state: str,
    at: str,
    by: str,
    notes: str,
    expected: dt.datetime | None = None,
    finished: bool = False,
) -> DataFrame:
    now = _time(at)
    row = {
        "closure_period": period,
        "current_phase": phase,
        "phase_status": state,
        "started_at": now,
        "expected_completion": expected,
        "actual_completion": now if finished else None,
        "created_by": by,
        "updated_at": now,
        "notes": notes,
    }
    return stamp(audit_rows(spark, [row], "closure_status").drop("closure_id"), "closure_status")


def _time(at: str) -> dt.datetime:
    return dt.datetime.fromisoformat(at).replace(tzinfo=dt.timezone.utc)


def initialized(spark: SparkSession, period: str, at: str) -> DataFrame:
    due = _time(at) + dt.timedelta(days=CYCLE_DAYS)
    return _row(spark, period, 1, "INITIALIZED", at, "orchestrator", "Closure cycle initialized by orchestrator", due)


def phase_update(
    spark: SparkSession, period: str, phase: int, state: str, at: str, cfg: CloseConfig = DEFAULT_CONFIG
) -> DataFrame:
    due = _time(at) + dt.timedelta(hours=cfg.phase_sla_hours[phase])
    notes = f"Phase {phase} {state}"
    return _row(spark, period, phase, state, at, "orchestrator", notes, due, finished=state == "COMPLETED")


def preliminary_published(spark: SparkSession, period: str, version: int, at: str) -> DataFrame:
    notes = f"Preliminary results published - Version {version}"
    return _row(spark, period, 2, "PRELIMINARY_PUBLISHED", at, "phase2_agent", notes)


def completed(spark: SparkSession, period: str, at: str) -> DataFrame:
    notes = "Final results published successfully"
    return _row(spark, period, 5, "COMPLETED", at, "phase5_agent", notes, finished=True)


def approve_stored(
    spark: SparkSession, root: str, at: str, period: str | None = None, approval_type: str = "BU_SIGNOFF"
) -> int:
    """Approve the pending sign-offs of a type in the stored table; files without one stay as they are.

    Returns how many files were rewritten: none the second time.
    """
    hit = controls.pending_condition(period, approval_type)
    change = lambda rows: controls.approve_pending(rows, at, period, approval_type)
    return files.update_where(spark, root, "approvals", hit, change, period)
