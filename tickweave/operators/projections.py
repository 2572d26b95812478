"""Projections and renames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import BAR_SHORT_TO_LONG, CAMEL_TO_SNAKE, SNAKE_TO_CAMEL

# The narrow contract record kept by the document/SQL tables
CONTRACT_NARROW = ["underlying_ticker", "ticker", "contract_type", "exercise_style",
                   "expiration_date", "strike_price"]


def contract_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Keep the narrow contract columns (column pruning reaches the scan)."""
    return df.select(*(cols or CONTRACT_NARROW))


def flatten_struct(df: DataFrame, struct_col: str, fields: list[str], keep: list[str] = ()) -> DataFrame:
    """`select(keep..., struct.f1, struct.f2, ...)`; outputs are named after the leaf field."""
    return df.select(*keep, *[F.col(f"{struct_col}.{f}").alias(f) for f in fields])


def replace_with_element(df: DataFrame, array_col: str) -> DataFrame:
    """Replace an array column by its exploded element, under the same name (G1 semantics)."""
    return df.withColumn(array_col, F.explode(array_col))


def to_camel_case(df: DataFrame) -> DataFrame:
    """snake_case contract columns -> camelCase record properties."""
    return df.withColumnsRenamed({k: v for k, v in SNAKE_TO_CAMEL.items() if k in df.columns})


def to_snake_case(df: DataFrame) -> DataFrame:
    """P8 inverse."""
    return df.withColumnsRenamed({k: v for k, v in CAMEL_TO_SNAKE.items() if k in df.columns})


def bar_long_names(df: DataFrame) -> DataFrame:
    """Short bar keys (o, h, l, c, v, vw, t, n) -> long names."""
    return df.withColumnsRenamed({k: v for k, v in BAR_SHORT_TO_LONG.items() if k in df.columns})
