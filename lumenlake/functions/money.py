"""Decimal arithmetic that rounds once, half away from zero."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def prorate(levy: Column, paid: Column, billed: Column) -> Column:
    """levy x least(paid / billed, 1), to the cent.

    A zero bill has no ratio, and ``least`` skips the null: the levy then
    counts as fully collected.  The ratio is kept at 18 digits so that the
    product is rounded only once; ratios below -100 do not fit there and take
    the double formula.
    """
    ratio = F.least(paid.try_cast(MONEY) / F.nullif(billed, F.lit(0).cast(MONEY)), F.lit(1).cast("decimal(2,0)"))
    exact = F.round(levy * ratio.try_cast("decimal(20,18)"), 2)
    rough = F.round(levy.cast("double") * ratio.cast("double"), 2)
    return F.coalesce(exact.cast(MONEY), rough.try_cast(MONEY))


def mean_money(total: Column, n: Column) -> Column:
    """Mean of cents with one rounding; ``avg`` would round to six digits first."""
    return F.round(total.cast("decimal(28,2)") / F.nullif(n, F.lit(0)).cast("decimal(18,0)"), 2).cast(MONEY)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 x part / whole; null when the whole is zero."""
    ratio = (part * 100).cast("decimal(28,0)") / F.nullif(whole, F.lit(0)).cast("decimal(18,0)")
    return F.round(ratio, digits).cast(f"decimal(18,{digits})")


def guarded_percent(difference: Column, reference: Column) -> Column:
    """Percentage change; null when the reference is below one."""
    return F.when(reference >= 1, difference * 100 / reference)
