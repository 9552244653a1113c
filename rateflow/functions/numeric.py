"""Column expressions for rates: reciprocal conversion, percent change, fixed-point output.

All of these stay JVM-side (no Python UDF) so they sit inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fixed(col: Column | str, precision: int = 10, scale: int = 4) -> Column:
    """``CAST(ROUND(COALESCE(x, 0), scale) AS DECIMAL(precision, scale))`` (half away from zero)."""
    return F.round(F.coalesce(_c(col), F.lit(0)), scale).cast(f"decimal({precision},{scale})")


def usd_conversion(rate: Column | str, precision: int = 35, scale: int = 4) -> Column:
    """Reciprocal of a quoted rate: the argument is taken as DECIMAL(precision, scale);
    0 -> 0, NULL -> NULL, else 1/rate rounded half-up to ``scale`` places."""
    dec = f"decimal({precision},{scale})"
    x = _c(rate).cast(dec)
    return (
        F.when(x == 0, F.lit(0).cast(dec))
        .otherwise((F.lit(1).cast("decimal(1,0)") / x).cast(dec))
    )


def abs_pct_change_expr(
    cur: Column | str,
    prev: Column | str,
    precision: int = 10,
    scale: int = 4,
    work: str = "decimal(18,8)",
) -> Column:
    """``CAST(ROUND(COALESCE(ABS((x - prev) / NULLIF(prev, 0) * 100), 0), 4) AS DECIMAL(p, 4))``.

    Decimals are computed in exact decimal arithmetic at ``work`` width (inputs of up to 8
    places are not rounded), so rounding is half-up on the exact quotient. Doubles stay doubles
    and only the result is rounded. ``NULLIF`` is required: ANSI mode raises on division by zero.
    """
    x, p = _c(cur), _c(prev)
    xd, pd = x.cast(work), p.cast(work)
    exact = F.abs((xd - pd) * F.lit(100).cast("decimal(3,0)") / F.nullif(pd, F.lit(0).cast(work)))
    xf, pf = x.cast("double"), p.cast("double")
    double = round_double(F.coalesce(F.abs((xf - pf) / F.nullif(pf, F.lit(0.0)) * 100), F.lit(0.0)), scale)
    # the type is known when the plan is made, so only one branch is left in it
    return F.when(F.typeof(x).isin("double", "float"), double.cast(f"decimal({precision},{scale})")).otherwise(
        fixed(exact, precision, scale))


def round_double(x: Column | str, scale: int = 4, guard: int = 11) -> Column:
    """Half-up rounding of a double that stands for an exact value, as a decimal.

    A deviation over a gap-filled series is often an exact short decimal (a tie such as
    ``20.32325``) that double arithmetic lands a few ulps above or below. The double is
    first taken as a decimal with ``guard`` places (far above the ~1e-13 noise, far below
    any real digit), then rounded half-up in exact decimal arithmetic.
    """
    return F.round(_c(x).cast(f"decimal(38,{guard})"), scale)


def stddev_to_fixed(sd: Column | str, precision: int = 10, scale: int = 4) -> Column:
    """Volatility output: NULL (fewer than two points) becomes 0, then fixed point."""
    return round_double(F.coalesce(_c(sd), F.lit(0.0)), scale).cast(f"decimal({precision},{scale})")
