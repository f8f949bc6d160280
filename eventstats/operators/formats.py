"""JSON log lines -> canonical events."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from eventstats.functions import (
    event_group,
    first_non_empty,
    is_blank,
    is_int32,
    null_to_empty,
    platform_of,
    resolve_user_id,
    resolve_user_id_strict,
)
from eventstats.functions.events import COURSEWARE_PATTERN, ENROLLMENT_TYPES, REGISTER_TYPES

# Fields of a raw log line.
TOP_FIELDS = (
    "uid", "time", "username", "uuid", "event_type", "agent", "origin_referer", "spam", "host",
)
EVENT_FIELDS = ("uid", "user_id", "uuid", "username", "course_id")
CONTEXT_FIELDS = ("user_id", "course_id")

_BAD = "_unparsed"
#: Fields whose JSON type the strict user id policy looks at; it reads them as variants.
_TYPED = ("uid", "event.uid", "context.user_id")


@dataclass(frozen=True)
class LogRules:
    """Vocabulary of the log: ordered agent prefixes and the event groups."""

    platforms: Sequence[tuple[str, str]] = ()
    default_platform: str = "web"
    register_types: Sequence[str] = REGISTER_TYPES
    enrollment_types: Sequence[str] = ENROLLMENT_TYPES
    courseware_pattern: str = COURSEWARE_PATTERN
    event_groups: bool = True


def format_log(
    df: DataFrame,
    rules: LogRules = LogRules(),
    value_col: str = "value",
    keep: Sequence[str] = (),
    user_id_policy: str = "resolve",
    uuid_from_event: bool = False,
    on_error: str = "drop",
    observe: Observation | str | None = None,
) -> DataFrame:
    """Parse each line once and project the canonical event.

    ``keep`` names input columns to carry along (row ids). ``user_id_policy`` is "resolve"
    (numbers may be quoted) or "strict" (JSON integers only, the top-level uid included).
    Lines that are not JSON are dropped, or kept with ``is_malformed`` when
    ``on_error="keep"``. Missing fields and JSON nulls become ''. ``observe`` counts, on the way,
    ``rows_in`` and ``malformed``: an ``Observation`` for a batch, a name for a stream's progress.
    """
    if user_id_policy not in ("resolve", "strict"):
        raise ValueError(f"unknown user id policy {user_id_policy!r}")
    if on_error not in ("drop", "keep"):
        raise ValueError(f"unknown error mode {on_error!r}")
    strict = user_id_policy == "strict"
    parsed, malformed = _parse(df, value_col, keep, strict)
    j = _reader("j")
    event_username, event_uuid = j("event.username"), j("event.uuid")

    if strict:
        user_id = resolve_user_id_strict(
            [_json_integer(j(path)) for path in ("event.uid", "context.user_id", "uid")],
            event_username,
            event_uuid,
        )
    else:
        user_id = resolve_user_id(
            j("event.uid"), j("context.user_id"), event_username, event_uuid
        )

    def event_first(event_value: Column, top: Column) -> Column:
        if strict:
            event_value = F.when(~is_blank(event_value), event_value)
        return first_non_empty(event_value, top)

    columns = {
        "user_id": user_id,
        "username": event_first(event_username, j("username")),
        "uuid": event_first(event_uuid, j("uuid")) if uuid_from_event else null_to_empty(j("uuid")),
        "event_type": null_to_empty(j("event_type")),
        "platform": platform_of(j("agent"), rules.platforms, rules.default_platform),
        "origin_referer": null_to_empty(j("origin_referer")),
        "spam": null_to_empty(j("spam")),
        "host": null_to_empty(j("host")),
        "time": null_to_empty(j("time")),
        "course_id": event_first(j("event.course_id"), j("context.course_id")),
    }
    if rules.event_groups:
        columns["event_group"] = event_group(
            null_to_empty(j("event_type")),
            rules.register_types,
            rules.enrollment_types,
            rules.courseware_pattern,
        )
    if observe is not None:
        counts = F.count(F.lit(1)).alias("rows_in"), F.count_if(malformed).alias("malformed")
        parsed = parsed.observe(observe, *counts)
    if on_error == "drop":
        parsed = parsed.filter(~malformed)
    else:
        columns["is_malformed"] = malformed
    return parsed.select(*keep, *[col.alias(name) for name, col in columns.items()])


def format_log_basic(
    df: DataFrame, value_col: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Plain projection: integer ``user_id`` (first positive of two fields or null) and ``agent``."""
    parsed, malformed = _parse(df, value_col, keep, strict=False)
    j = _reader("j")

    def positive(col: Column) -> Column:
        number = F.when(is_int32(col), col.try_cast("int"))
        return F.when(number > 0, number)

    names = ("username", "time", "uuid", "event_type", "agent", "origin_referer", "spam", "host")
    return parsed.filter(~malformed).select(
        *keep,
        F.coalesce(positive(j("event.uid")), positive(j("event.user_id"))).alias("user_id"),
        *[null_to_empty(j(name)).alias(name) for name in names],
    )


def malformed_rows(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Rows whose text is not JSON, unchanged, for a quarantine table."""
    return df.filter(F.try_parse_json(F.col(value_col)).isNull())


def _parse(
    df: DataFrame, value_col: str, keep: Sequence[str], strict: bool
) -> tuple[DataFrame, Column]:
    """Parsed frame and the 'line is not JSON' condition.

    The parse is a generator, so later filters use its result; over a plain projection they
    would be pushed below it and parse the line again. The parser reports partly readable
    lines as well (an ``event`` that holds text, say), so the full JSON check runs only on
    lines it reported.
    """

    def fields(names: Sequence[str], parent: str = "") -> str:
        kinds = {n: "variant" if strict and parent + n in _TYPED else "string" for n in names}
        return ", ".join(f"{name}: {kind}" for name, kind in kinds.items())

    schema = (
        f"struct<{fields(TOP_FIELDS)}, event: struct<{fields(EVENT_FIELDS, 'event.')}>, "
        f"context: struct<{fields(CONTEXT_FIELDS, 'context.')}>, {_BAD}: string>"
    )
    value = F.col(value_col)
    read = F.from_json(value, schema, {"columnNameOfCorruptRecord": _BAD}).alias("j")
    parsed = df.select(*keep, value.alias("_line"), F.inline(F.array(F.struct(read))))
    unread = F.col("j").isNull() | F.col(f"j.{_BAD}").isNotNull()
    return parsed, unread & F.try_parse_json(F.col("_line")).isNull()


def _json_integer(value: Column) -> Column:
    """A variant that is a JSON integer of 64 bits, as a number; null for any other."""
    return F.when(F.schema_of_variant(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))


def _reader(root: str):
    return lambda path: F.col(f"{root}.{path}")
