"""Decimal rounding of the exact binary value, half to even, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_exact(x: Column, digits: int = 2) -> Column:
    """x (a double) rounded to digits decimals as if its binary value were written out in full.

    The product x*2*10^digits is computed with its rounding error (Veltkamp and Dekker
    splitting), so ties of the double are told from ties of the number it stands for.
    Null stays null. Built-in, so it stays inside whole-stage code generation.
    """
    scale, half = float(10**digits), float(2 * 10**digits)
    x = x.cast("double")
    p = x * half
    c = x * 134217729.0
    high = c - (c - x)
    low = x - high
    error = (high * half - p) + low * half
    n = F.rint(p)
    k = F.floor((n - 1) / 2)
    d = (p - n) + error
    tie = (F.abs(p - n) < 1e-7) & (F.abs(n) % 2 == 1)
    even = F.when(F.pmod(k, F.lit(2)) == 0, k).otherwise(k + 1)
    return F.when(x.isNull(), None).when(tie, F.when(d > 0, k + 1).when(d < 0, k).otherwise(even) / scale).otherwise(F.round(x, digits))


def round_exact_sql(x: str, digits: int = 2) -> str:
    """The same as a SQL expression for the oracles."""
    half, scale = f"{2 * 10**digits}.0::DOUBLE", f"{10**digits}.0::DOUBLE"
    p, c = f"(({x}) * {half})", f"(({x}) * 134217729.0::DOUBLE)"
    high = f"({c} - ({c} - ({x})))"
    d = f"(({p} - round_even({p}, 0)) + (({high} * {half} - {p}) + (({x}) - {high}) * {half}))"
    n = f"round_even({p}, 0)"
    k = f"floor(({n} - 1) / 2)"
    return f"CASE WHEN ({x}) IS NULL THEN NULL WHEN abs({p} - {n}) < 1e-7 AND abs({n}) % 2 = 1 THEN (CASE WHEN {d} > 0 THEN {k} + 1 WHEN {d} < 0 THEN {k} WHEN {k} % 2 = 0 THEN {k} ELSE {k} + 1 END) / {scale} ELSE round(({x}), {digits}) END"
