"""Numeric and rendering expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_double(col, strict: bool = True) -> Column:
    """Text to double (P12): ANSI cast fails on bad text; ``strict=False`` gives NULL instead."""
    c = _c(col)
    return c.cast("double") if strict else c.try_cast("double")


def round_half_up(col, scale: int = 1) -> Column:
    """Half-up rounding at ``scale`` decimals (P13). Ties are taken on the decimal value
    (0.15 -> 0.2), see D6."""
    return F.round(_c(col), scale)


def round_half_up_text(col, scale: int = 1) -> Column:
    """P13 string form: the rounded value with exactly ``scale`` decimals."""
    return F.format_string(f"%.{scale}f", F.round(_c(col), scale))


def squared_error(prediction, label) -> Column:
    """P19."""
    d = _c(prediction) - _c(label)
    return d * d


def composite_key(*cols) -> Column:
    """Key texts concatenated without a separator (kept for compatibility, see D7)."""
    return F.concat(*[_c(c) for c in cols])


def feature_row_text(cols: list, scale: int | None = 1) -> Column:
    """``1:a 2:b ...``, values rendered with ``scale`` decimals (or Spark's double text)."""
    parts = []
    for i, c in enumerate(cols, start=1):
        v = round_half_up_text(c, scale) if scale is not None else _c(c).cast("string")
        parts.append(F.concat(F.lit(f"{i}:"), v))
    return F.concat_ws(" ", *parts)


def value_at(values: list, index_col) -> Column:
    """Element ``index`` (0-based) of a small literal array, e.g. a cluster's centre: a number, or
    for centres of several dimensions an array of numbers."""
    def literal(v) -> Column:
        return F.array(*[F.lit(float(x)) for x in v]) if isinstance(v, (list, tuple)) else F.lit(float(v))
    return F.element_at(F.array(*[literal(v) for v in values]), _c(index_col).cast("int") + 1)
