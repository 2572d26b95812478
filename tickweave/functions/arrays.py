"""Array helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def empty_if_null(col, array_type) -> Column:
    """Null array -> empty array of `array_type` (an ArrayType or its DDL string)."""
    return F.coalesce(_c(col), F.array().cast(array_type))


def first_or_null(col) -> Column:
    """H2: first element, null for an empty or null array (never raises under ANSI)."""
    return F.get(_c(col), 0)


def nonempty(col) -> Column:
    """W6 predicate: array has at least one element (null counts as empty)."""
    return F.coalesce(F.size(_c(col)) > 0, F.lit(False))


def element_count(col) -> Column:
    """A2: number of elements; null array -> 0."""
    return F.coalesce(F.size(_c(col)), F.lit(0))


def keep_fields(col, mapping: dict[str, str]) -> Column:
    """H1: map an array of structs to structs of selected (renamed) fields.

    `mapping` is {source_field: output_field}, in output order.
    """
    return F.transform(_c(col), lambda x: F.struct(*[x[src].alias(dst) for src, dst in mapping.items()]))
