"""Rounding, parsing and capping."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bround_int(value: Column) -> Column:
    """Half-even rounding to a whole number (a plain cast would truncate)."""
    return F.bround(value, 0).cast("bigint")


def ceil_to(value: Column, step: int = 5) -> Column:
    """Round to a whole number, then up to the next multiple of ``step``."""
    return (F.ceil(F.bround(value, 0) / step) * step).cast("bigint")


def half(value: Column) -> Column:
    """Half of a decimal, exact and without a division."""
    return value * F.lit(Decimal("0.5"))


def to_cents(value: Column) -> Column:
    """A two-digit decimal as whole hundredths."""
    return (value * 100).cast("bigint")


def from_cents(cents: Column) -> Column:
    return (cents.cast("decimal(12,0)") * F.lit(Decimal("0.01"))).cast("decimal(8,2)")


def divide_half_up(total: Column, divisor: int) -> Column:
    """Whole-number quotient, halves away from zero; much faster than decimals.

    Kept short: the JVM does not compile a generated method of over 8000 bytes.
    """
    away = F.when(total < 0, F.lit(-divisor)).otherwise(F.lit(divisor))
    return F.call_function("div", total * 2 + away, F.lit(2 * divisor))


def km_to_int(km: Column) -> Column:
    """'12+345' -> 12345."""
    return F.replace(km, F.lit("+"), F.lit("")).cast("int")


def survey_date(text: Column) -> Column:
    """Dates come as yyyy-MM-dd or yyyyMMdd, with stray blanks."""
    clean = F.replace(text, F.lit(" "), F.lit(""))
    return F.coalesce(F.try_to_date(clean, "yyyy-MM-dd"), F.try_to_date(clean, "yyyyMMdd"))


def pad_frame(frame: Column) -> Column:
    """Five digits at least; lpad alone would cut longer numbers."""
    return F.lpad(frame, F.greatest(F.lit(5), F.length(frame)), F.lit("0"))


def capped(
    value: Column,
    limit: float,
    mode: str,
    keys: Sequence[Column],
    low: float = 7.0,
    high: float = 8.0,
) -> Column:
    """``value``, or its substitute where it exceeds ``limit``.

    The random substitute is a function of ``keys``: rerunning a task, or the
    whole job, gives the same number.
    """
    if mode == "random":
        step = F.pmod(F.xxhash64(*keys), F.lit(1001)).cast("double") / 1000
        substitute = (F.lit(low) + F.lit(high - low) * step).cast("decimal(8,2)")
    elif mode == "clamp":
        substitute = F.lit(limit).cast("decimal(8,2)")
    elif mode == "null":
        substitute = F.lit(None).cast("decimal(8,2)")
    else:
        raise ValueError(f"unknown cap mode: {mode}")
    return F.when(value > limit, substitute).otherwise(value)


def cap_values(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    limit: float = 8.0,
    mode: str = "random",
    low: float = 7.0,
    high: float = 8.0,
) -> DataFrame:
    """Replace values above ``limit``; keep ``<c>_raw`` and flag ``<c>_imputed``."""
    changes: dict[str, Column] = {}
    for name in columns:
        raw = F.col(name)
        salted = [F.lit(name), *[F.col(k) for k in keys]]
        changes[f"{name}_raw"] = raw
        changes[f"{name}_imputed"] = F.coalesce(raw > limit, F.lit(False))
        changes[name] = capped(raw, limit, mode, salted, low, high)
    return df.withColumns(changes)
