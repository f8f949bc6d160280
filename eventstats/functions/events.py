"""Functions that know the event vocabulary: platform, group, user id, course progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from eventstats.functions.values import (
    first_non_empty,
    is_blank,
    is_user_number,
    null_to_empty,
)

# Event types counted as registration and as enrolment, and the courseware path.
REGISTER_TYPES = (
    "common.student.account_created",
    "common.student.account_success",
    "oauth.user.register",
    "oauth.user.register_success",
    "weixinapp.user.register_success",
    "api.user.oauth.register_success",
    "api.user.register",
    "api.user.register_success",
)
ENROLLMENT_TYPES = ("edx.course.enrollment.activated",)
COURSEWARE_PATTERN = "/courses/.*/courseware/.*"


def platform_of(
    agent: Column, prefixes: Sequence[tuple[str, str]], default: str = "web"
) -> Column:
    """Platform of the first agent prefix that fits, in list order."""
    result = F.lit(default)
    for prefix, platform in reversed(list(prefixes)):
        result = F.when(agent.startswith(prefix), F.lit(platform)).otherwise(result)
    return result


def event_group(
    event_type: Column,
    register_types: Sequence[str] = REGISTER_TYPES,
    enrollment_types: Sequence[str] = ENROLLMENT_TYPES,
    courseware_pattern: str = COURSEWARE_PATTERN,
) -> Column:
    return (
        F.when(event_type.isin(*register_types), "register")
        .when(event_type.isin(*enrollment_types), "enrollment")
        .when(event_type.rlike(courseware_pattern), "access_courseware")
        .otherwise("unknown")
    )


def resolve_user_id(
    event_uid: Column, context_user_id: Column, event_username: Column, event_uuid: Column
) -> Column:
    """Numeric event uid, numeric context user, then user name, device id, event uid as it is."""
    return (
        F.when(is_user_number(event_uid), event_uid)
        .when(is_user_number(context_user_id), context_user_id)
        .otherwise(first_non_empty(event_username, event_uuid, event_uid))
    )


def resolve_user_id_strict(
    numbers: Sequence[Column], event_username: Column, event_uuid: Column
) -> Column:
    """First JSON integer that is neither 0 nor -1, then user name, device id, ''."""
    usable = [F.when((n != 0) & (n != -1), n.cast("string")) for n in numbers]
    names = [
        F.when(~is_blank(name), name) for name in (event_username, event_uuid)
    ]
    return F.coalesce(*usable, *names, F.lit(""))


def course_process(
    course_type: Column,
    status: Column,
    start: Column,
    end: Column,
    now: Column | None = None,
    finished: Column | None = None,
) -> Column:
    """Progress of a course at ``now``: -1 not running, 0 running, 1 finished.

    Type "1" (self-paced) is finished when its status is "-1". Type "0" (scheduled) does
    not run when its status is "-1", it has no start or starts later, and is finished after
    its end or when ``finished`` holds. Other types give -1. Times are wall-clock text; a
    start or end that cannot be read does not bound the course.
    """
    if now is None:
        now = F.expr("convert_timezone(current_timezone(), '+08:00', localtimestamp())")
    starts = F.substring(start, 1, 19).try_cast("timestamp_ntz")
    ends = F.substring(end, 1, 19).try_cast("timestamp_ntz")
    over = F.coalesce(ends < now, F.lit(False))
    if finished is not None:
        over = over | finished
    closed = null_to_empty(status) == "-1"
    waiting = closed | is_blank(start) | F.coalesce(starts > now, F.lit(False))
    return (
        F.when(course_type == "1", F.when(closed, 1).otherwise(0))
        .when(course_type == "0", F.when(waiting, -1).when(over, 1).otherwise(0))
        .otherwise(-1)
    )
