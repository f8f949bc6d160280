"""Scalar helpers on text and ids. Every function is ``Column -> Column``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Type names accepted in configurations, with the Spark type each stands for.
# "interger" is a spelling found in existing configurations.
CAST_TYPES = {
    "int": "int",
    "interger": "int",
    "long": "bigint",
    "double": "double",
    "string": "string",
}

# Fixed value: a URL gives a domain only when a slash follows the host.
URL_PATTERN = r"^http(s?)://(.*?)/.*$"


def null_to_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def is_blank(col: Column) -> Column:
    """True for null, empty text, and text of nothing but characters up to U+0020."""
    return null_to_empty(col).rlike(r"\A[\x00-\x20]*\z")


def first_non_empty(*cols: Column) -> Column:
    """First argument that is neither null nor empty, else ''."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def blank_default(col: Column, default: str) -> Column:
    return F.when(is_blank(col), F.lit(default)).otherwise(col)


def is_int32(col: Column) -> Column:
    """Text that is a whole number and fits 32 bits; never null.

    The pattern is needed beside the cast, which also accepts ' 5 '.
    """
    return F.coalesce(
        col.rlike(r"^[+-]?[0-9]+\z") & col.try_cast("int").isNotNull(), F.lit(False)
    )


def is_user_number(col: Column) -> Column:
    """A 32-bit number other than the 'no user' marker -1."""
    return is_int32(col) & (col != "-1")


def strip_quotes(col: Column) -> Column:
    """Remove one leading and one trailing double quote."""
    return F.regexp_replace(col, r'^"|"$', "")


def url_domain(col: Column) -> Column:
    """Host of a URL that has a path; any other text is returned unchanged."""
    return F.when(col.rlike(URL_PATTERN), F.regexp_extract(col, URL_PATTERN, 2)).otherwise(col)


def typed_cast(col: Column, type_name: str) -> Column:
    """Cast by configured type name; unknown names mean text. Bad input gives null."""
    return col.try_cast(CAST_TYPES.get(type_name.strip().lower(), "string"))


def json_path(col: Column, path: str) -> Column:
    """Read one value of a JSON document; missing and JSON null give null."""
    return F.get_json_object(col, path)


def doc_id(*names: str) -> Column:
    """md5 over the named columns as a JSON document with sorted field names."""
    return F.md5(F.to_json(F.struct(*[F.col(n) for n in sorted(names)])))


def raw_data(*names: str) -> Column:
    """JSON copy of the named columns, in the given order."""
    return F.to_json(F.struct(*[F.col(n) for n in names]))


def duration_text(ms: Column) -> Column:
    """Milliseconds as '35 ms', '1.5 s', '2.0 m' or '1.00 h' (single-precision rounding)."""
    # The optimizer merges a direct bigint -> float -> double cast into bigint -> double.
    single = (ms.cast("float") + F.lit(0.0).cast("float")).cast("double")

    def part(fmt: str, unit: int) -> Column:
        return F.format_string(fmt, (single / F.lit(float(unit))).cast("float").cast("double"))

    return (
        F.when(ms < 1_000, F.format_string("%d ms", ms.cast("bigint")))
        .when(ms < 60_000, part("%.1f s", 1_000))
        .when(ms < 3_600_000, part("%.1f m", 60_000))
        .otherwise(part("%.2f h", 3_600_000))
    )
