"""Exact money arithmetic.

Amounts arrive as doubles. Summing doubles is order dependent, so results
would change with partitioning; every amount is cast to DECIMAL first, summed
exactly, and rounded once (HALF_UP) into the stored scale.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(12,2)"       # one amount / one window's revenue
MEAN = "decimal(10,2)"        # per-window average transaction value
MEAN_OF_MEANS = "decimal(14,6)"
TOTAL = "decimal(38,2)"       # all-time totals over many windows


def money(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


def money_sum(c: Column | str, dtype: str = MONEY) -> Column:
    """Exact sum of amounts, rounded into ``dtype``."""
    return F.sum(money(c)).cast(dtype)


def exact_mean(c: Column | str, dtype: str = MEAN) -> Column:
    """sum(decimal) / count, rounded HALF_UP once into ``dtype``.

    ``avg(double)`` followed by rounding is not safe: half-cent ties come out
    differently depending on the order of the double additions.
    """
    c = money(c)
    return (F.sum(c) / F.count(c)).cast(dtype)


def mean_of_means(c: Column | str, dtype: str = MEAN_OF_MEANS) -> Column:
    """Unweighted mean of already averaged values (as the roll-ups define it)."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.sum(c) / F.count(c)).cast(dtype)


def round_half_up_ratio(num: Column, den: Column, scale: int, dtype: str) -> Column:
    """round_half_up(num / den, scale) for non-negative integers, exactly.

    Integral division of decimals without a fraction (``div``: no floating
    point, no intermediate rounding); NULL when ``den`` is 0 or NULL (a plain
    division raises under ANSI mode).
    """
    twice = num.cast("decimal(30,0)") * F.lit(2 * 10 ** scale) + den.cast("decimal(30,0)")
    whole = den.cast("decimal(30,0)") * F.lit(2)
    units = F.when(den > 0, F.call_function("div", twice, F.when(den > 0, whole)))
    if scale == 0:
        return units.cast(dtype)
    return (units.cast("decimal(38,0)") / F.lit(10 ** scale)).cast(dtype)
