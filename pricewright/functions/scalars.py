"""Scalar column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Code of each product type. Other values have no code.
TYPE_CODES = {"conventional": 0, "organic": 1}


def _col(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def log_plus_one(c: Column | str) -> Column:
    """Natural log of c + 1; null where c <= -1."""
    return F.log(_col(c) + F.lit(1))


def type_code(c: Column | str) -> Column:
    """0 / 1 code of the product type, null for anything else."""
    expr = None
    for level, code in TYPE_CODES.items():
        hit = _col(c) == level
        expr = F.when(hit, code) if expr is None else expr.when(hit, code)
    return expr.cast("int")


def micros_per_row(seconds: Column | str, rows: Column | str) -> Column:
    """Microseconds spent per row, null for an empty batch."""
    return _col(seconds) * 1e6 / F.nullif(_col(rows), F.lit(0))
