"""Half-up rounding against exact rational arithmetic (random 4-place rates)."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal, getcontext
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from rateflow.functions.numeric import abs_pct_change_expr, usd_conversion
from rateflow.operators.metrics import volatility

getcontext().prec = 60
rates = st.integers(min_value=1, max_value=5_000_000).map(lambda m: Decimal(m).scaleb(-4))


def half_up(x: Fraction, places: int = 4) -> Decimal:
    d = Decimal(x.numerator) / Decimal(x.denominator)
    return d.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(rates, rates), min_size=1, max_size=30))
def test_conversion_and_change_are_exact(spark, pairs):
    df = spark.createDataFrame([(a, b) for a, b in pairs], "x decimal(18,4), p decimal(18,4)")
    # precision 18: random pairs reach changes beyond DECIMAL(10,4), which would rightly raise
    got = df.select(usd_conversion("x").alias("c"), abs_pct_change_expr("x", "p", precision=18).alias("g")).collect()
    for (x, p), r in zip(pairs, got):
        assert r.c == half_up(1 / Fraction(x))
        assert r.g == half_up(abs(Fraction(x) - Fraction(p)) / Fraction(p) * 100)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from(["0.5000", "1.2500", "2.0000", "3.7500", "10.0000", "0.0001"]),
                min_size=2, max_size=25))
def test_volatility_rounds_the_exact_deviation(spark, vals):
    # repeated short decimals make exact ties common: the guard must round them up
    d0 = dt.date(2020, 1, 1)
    rows = [("A", d0 + dt.timedelta(days=i), Decimal(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "series_id string, date date, value decimal(18,4)")
    got = [r.volatility for r in volatility(df).orderBy("date").collect()]
    xs = [Fraction(Decimal(v)) for v in vals]
    for k in range(len(xs)):
        if k == 0:
            assert got[k] == Decimal("0.0000")
            continue
        sub = xs[: k + 1]
        mean = sum(sub) / len(sub)
        var = sum((x - mean) ** 2 for x in sub) / (len(sub) - 1)
        exact = (Decimal(var.numerator) / Decimal(var.denominator)).sqrt()
        assert got[k] == exact.quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP), (k, sub)
