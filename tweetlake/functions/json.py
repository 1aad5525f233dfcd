"""JSON column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def json_field(col, key: str) -> Column:
    """Named field of a JSON object as text (P1); numbers and nested values as their JSON text."""
    return F.get_json_object(_c(col), f"$.{key}")


def json_type_of(col, key: str) -> Column:
    """Variant type name of a field (``STRING``, ``BIGINT``, ``VOID`` for null, NULL when
    absent or when the line is not JSON)."""
    parsed = F.try_parse_json(_c(col))
    return F.schema_of_variant(F.try_variant_get(parsed, f"$.{key}", "variant"))


def has_string_field(col, key: str = "id") -> Column:
    """The line is a JSON object whose ``key`` exists and is a JSON string."""
    return F.coalesce(json_type_of(col, key) == F.lit("STRING"), F.lit(False))
