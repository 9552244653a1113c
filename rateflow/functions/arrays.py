"""Array forms of the forward fill (parity with an ARRAY -> ARRAY scalar function).

The window form in ``rateflow.operators.fill`` is the scalable default. The array form
fills one bounded array (a series block) with higher-order functions, all JVM-side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _valid(x: Column) -> Column:
    # "valid" = not NULL and not numeric zero
    return x.isNotNull() & (x != 0)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def forward_fill_array(arr: Column | str, seed: Column | None = None) -> Column:
    """Replace NULL and 0 elements with the last valid element before them.

    Leading missing elements stay NULL unless ``seed`` (the last valid value of an
    earlier block) is given. Same length as the input; ``[] -> []``, NULL -> NULL. Every valid element is repeated up to the
    next one, so the work is in proportion to the length.
    """
    arr = F.col(arr) if isinstance(arr, str) else arr
    first = F.lit(None).cast("double") if seed is None else seed.cast("double")

    def fill(a: Column) -> Column:
        marked = F.transform(a, lambda x, i: F.when(_valid(x), F.struct(i.alias("at"), x.cast("double").alias("value"))))
        return _once(F.filter(marked, lambda m: m.isNotNull()), lambda valid: runs(a, valid))

    def runs(a: Column, valid: Column) -> Column:
        end = F.size(a)
        before = F.array_repeat(first, F.coalesce(F.get(valid, 0)["at"], end))
        each = F.transform(valid, lambda v, j: F.array_repeat(v["value"], F.coalesce(F.get(valid, j + 1)["at"], end) - v["at"]))
        return F.concat(before, F.flatten(each))

    return F.when(arr.isNotNull(), _once(arr, fill))
