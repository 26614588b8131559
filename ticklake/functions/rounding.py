"""Rounding at the result edge, so that equal doubles print equally."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def r4(c: Column | str) -> Column:
    """Four decimals, nudged off the exact ties that decimal prices produce."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(1e-9), 4)


def r2(c: Column | str) -> Column:
    """Two decimals, for money totals."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(1e-9), 2)


def sql4(expr: str) -> str:
    return f"round(({expr}) + 1e-9, 4)"


def sql2(expr: str) -> str:
    return f"round(({expr}) + 1e-9, 2)"
