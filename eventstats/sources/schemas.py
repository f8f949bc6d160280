"""Declared schemas from short text such as ``"user_id, count:long, labels:map"``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# Type names of the schema text.
FIELD_TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "short": T.ShortType(),
    "float": T.FloatType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "decimal": T.DecimalType(10, 0),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "map": T.MapType(T.StringType(), T.StringType()),
}


def parse_fields(items: Iterable[str]) -> list[T.StructField]:
    """``name`` or ``name:type`` items as nullable fields; the type defaults to string."""
    fields = []
    for item in items:
        name, _, type_name = item.partition(":")
        type_name = type_name.strip() or "string"
        if type_name not in FIELD_TYPES:
            raise ValueError(f"unknown type {type_name!r} in schema item {item!r}")
        fields.append(T.StructField(name.strip(), FIELD_TYPES[type_name], True))
    return fields


def schema_from_string(text: str, map_fields: Iterable[str] = ()) -> T.StructType:
    """Schema of a comma-separated field list plus map columns, fields sorted by name."""
    fields = parse_fields(text.split(","))
    names = {f.name for f in fields}
    for name in map_fields:
        if name in names:
            raise ValueError(f"map field {name!r} is already declared")
        fields.append(T.StructField(name, FIELD_TYPES["map"], True))
    return T.StructType(sorted(fields, key=lambda f: f.name))
