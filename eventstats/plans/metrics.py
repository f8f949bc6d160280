"""The shipped metrics: accounts, logins, activity, enrolment and courseware use per minute.

Input is an enriched event frame: canonical columns, ``time_minute_1_start`` / ``_end``,
the daily and minutely repeat flags of ``user_id``, ``date_joined`` and the course columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from eventstats.functions.events import REGISTER_TYPES
from eventstats.operators.stats import StatSpec, statistics

# Dimension labels of the shipped metrics.
LABELS = {
    "L0": "NONE",
    "L1": "host",
    "L2": "platform",
    "L3.1": "origin_referer",
    "L3.2": "spam",
    "L3.2.1": "origin_referer",
    "L3.2.2": "spam",
    "L5": "course_type",
    "L6": "course_process",
    "L7": "course_id",
    "T1": "start_date",
    "T2": "end_date",
}
ACCOUNT_TARGETS = ("L0:T1:T2", "L1:T1:T2", "L2:T1:T2", "L3.1:T1:T2", "L3.2:T1:T2")
VISIT_TARGETS = ("L0:T1:T2", "L1:T1:T2", "L2:T1:T2", "L3.2.1:T1:T2", "L3.2.2:T1:T2")
COURSE_TARGETS = (*VISIT_TARGETS, "L5:T1:T2", "L6:T1:T2", "L7:T1:T2")

FIRST_OF_DAY = "user_id_daily_duplicate_flag = 0"
FIRST_OF_MINUTE = "user_id_minutely_duplicate_flag = 0"
NOT_JOINED_TODAY = "substr(time, 1, 10) <> substr(coalesce(date_joined, ''), 1, 10)"
COURSEWARE = "event_type LIKE '/courses/%/courseware/%'"
ENROLLING = "event_group = 'enrollment'"


def _all(*conditions: str | None) -> str | None:
    return " AND ".join(c for c in conditions if c) or None


def _quoted(values: Sequence[str]) -> str:
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


def specs(
    register_types: Sequence[str] = REGISTER_TYPES, enrollment_only: bool = False
) -> dict[str, StatSpec]:
    """The nine metrics by name. ``enrollment_only`` restricts the enrolment metrics to
    enrolment events; as shipped they count every event."""

    def metric(data_type: str, value_type: str, targets, where: str | None) -> StatSpec:
        return StatSpec(
            labels=LABELS,
            targets=targets,
            aggs=["user_id:count"],
            data_type=data_type,
            value_type=value_type,
            cycle="minute_1",
            excludes=["T1", "T2"],
            where=where,
        )

    registering = f"event_type IN ({_quoted(register_types)})"
    enrolling = ENROLLING if enrollment_only else None
    return {
        "new_accounts": metric(
            "create_account", "users", ACCOUNT_TARGETS, _all(registering, FIRST_OF_DAY)
        ),
        "login_visits": metric("login_account", "visits", VISIT_TARGETS, NOT_JOINED_TODAY),
        "login_users": metric(
            "login_account", "users", VISIT_TARGETS, _all(NOT_JOINED_TODAY, FIRST_OF_MINUTE)
        ),
        "active_visits": metric("active_account", "visits", VISIT_TARGETS, None),
        "active_users": metric("active_account", "users", VISIT_TARGETS, FIRST_OF_MINUTE),
        "enrol_visits": metric("enrollment_state", "visits", COURSE_TARGETS, enrolling),
        "enrol_users": metric(
            "enrollment_state", "users", COURSE_TARGETS, _all(enrolling, FIRST_OF_MINUTE)
        ),
        "courseware_visits": metric("access_courseware", "visits", VISIT_TARGETS, COURSEWARE),
        "courseware_users": metric(
            "access_courseware", "users", VISIT_TARGETS, _all(COURSEWARE, FIRST_OF_MINUTE)
        ),
    }


def with_period(df: DataFrame, prefix: str = "time_minute_1") -> DataFrame:
    """Name the bucket columns as the metrics' labels expect them."""
    return df.withColumns(
        {"start_date": F.col(f"{prefix}_start"), "end_date": F.col(f"{prefix}_end")}
    )


def compute(df: DataFrame, *names: str, **options) -> DataFrame:
    """Named metrics (all nine when none is named) over one enriched frame, in one pass."""
    known = specs(**options)
    return statistics(with_period(df), *[known[n] for n in names or known])
