"""Exact rounded ratios.

``ROUND(k / n, s)`` on doubles (or on Spark's 6-digit decimal quotient) can
round twice; the half-up result is computed exactly with integers instead:

    q = (2 * k * m * 10^s + n) div (2 * n)        -> q / 10^s

where ``m`` is an optional multiplier (100 for percentages).  ``k`` and ``n``
are whole numbers (counts, or sums scaled to integers); ``n = 0`` gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def half_up_ratio(k, n, scale: int = 4, times: int = 1, precision: int = 10) -> Column:
    """round_half_up(k * times / n, scale) as DECIMAL(precision, scale); NULL if n = 0.

    Works for any sign of ``k`` (sign-aware), ``n`` > 0.
    """
    whole = "decimal(38,0)"
    k, n = _c(k).cast(whole), _c(n).cast(whole)
    mult = 2 * times * 10 ** scale
    # whole numbers of 38 digits throughout: no BIGINT to overflow, no double to lose digits
    mag = (F.abs(k) * F.lit(mult).cast(whole) + n).cast(whole)
    den = F.nullif((F.lit(2) * n).cast(whole), F.lit(0).cast(whole))
    q = ((mag - F.pmod(mag, den)).cast(whole) / den).cast(whole)
    q = F.when(k < 0, -q).otherwise(q)
    return (q / F.lit(10 ** scale).cast(whole)).cast(f"decimal({precision},{scale})")


def half_up_avg(total, n, scale: int = 2, total_scale: int = 2,
                precision: int = 10) -> Column:
    """round_half_up(total / n, scale) for a DECIMAL ``total`` with ``total_scale`` digits.

    ``total * 10^total_scale`` is a whole number k, so the average is
    k / (n * 10^total_scale) and one exact half-up rounding applies.
    """
    k = (_c(total).cast(f"decimal(38,{total_scale})") * F.lit(10 ** total_scale)).cast("decimal(38,0)")
    return half_up_ratio(k, _c(n).cast("decimal(38,0)") * F.lit(10 ** total_scale), scale=scale,
                         precision=precision)


def plain_ratio(k, n) -> Column:
    """Unrounded DOUBLE ratio k / n, NULL when n = 0 (the ``NULLIF`` guard)."""
    return _c(k).cast("double") / F.nullif(_c(n).cast("double"), F.lit(0.0))


def duck_half_up(k: str, n: str, scale: int = 4, times: int = 1, precision: int = 10) -> str:
    """The same formula as DuckDB SQL text, for oracle queries."""
    mult = 2 * times * 10 ** scale
    return (f"cast(cast(((2 * ({k}) * {mult // 2}) + ({n})) // nullif(2 * ({n}), 0) as decimal(38,0))"
            f" / {10 ** scale} as decimal({precision},{scale}))")


def duck_half_up_avg(total: str, n: str, scale: int = 2, total_scale: int = 2,
                     precision: int = 10) -> str:
    """DuckDB text for ``half_up_avg`` (non-negative totals)."""
    k = f"cast(({total}) * {10 ** total_scale} as bigint)"
    return duck_half_up(k, f"({n}) * {10 ** total_scale}", scale=scale, precision=precision)
