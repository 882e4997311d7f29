"""Sums and means of doubles whose digits don't depend on the order of rows.

Every finite double is a whole number of units of some power of two. A value is cut into four integers, in
units of 1, 2**-31, 2**-62 and 2**-93, without losing a digit; integers add up the same in any order,
and one last step turns the four totals into a double. That holds for values below 2**62 that are
whole numbers of 2**-93, which all are from 5e-13 on. A group with any other value has the plain sum
instead, and so has one whose whole numbers outgrow 64 bits; the other integers could only do so after
four thousand million rows of a group, and would raise an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT = f"{1 << 31}D"
_UNITS = f"{1 << 62}D"
_MASK = (1 << 31) - 1


def exact_totals(column: str) -> Column:
    """Aggregate of a double column for ``sum_of`` and ``mean_of``: totals of the four integers, whether they are all of
    the values, the plain sum and the number of values. Nulls are left out."""
    small = f"if(abs({column}) < {_UNITS}, {column}, null)"
    whole = f"cast({small} as bigint)"
    rest = f"({small} - cast({whole} as double)) * {_UNITS}"
    units = f"cast({rest} as bigint)"
    low = f"({rest} - cast({units} as double)) * {_UNIT}"
    fits = f"if({column} is not null, coalesce({low} = rint({low}), false), null)"
    return F.expr(
        f"""named_struct(
            'whole', try_sum(if({fits}, {whole}, null)), 'high', sum(if({fits}, shiftright({units}, 31), null)),
            'mid', sum(if({fits}, {units} & {_MASK}L, null)), 'low', sum(if({fits}, cast({low} as bigint), null)),
            'fits', every({fits}), 'plain', sum({column}), 'n', count({column}))"""
    )


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _carried(whole: str, high: str, mid: str, low: str) -> str:
    """The same number with every integer but the first from 0 to 2**31."""
    digits = f"""named_struct('whole', {whole} + shiftright(h, 31), 'high', h & {_MASK}L, 'mid', m & {_MASK}L,
                              'low', {low} & {_MASK}L)"""
    return _let("m", f"{mid} + shiftright({low}, 31)", _let("h", f"{high} + shiftright(m, 31)", digits))


def _sum(totals: str) -> str:
    parts = [f"{totals}.{name}" for name in ("whole", "high", "mid", "low")]
    # The double is made of the magnitude's digits, so that nothing cancels.
    size = f"if(p.whole < 0, {_carried(*(f'-{part}' for part in parts))}, p)"
    below = f"(cast(d.high as double) + (cast(d.mid as double) + cast(d.low as double) / {_UNIT}) / {_UNIT}) / {_UNIT}"
    value = f"(cast(d.whole as double) + {below}) * if(p.whole < 0, -1D, 1D)"
    exact = _let("p", _carried(*parts), _let("d", size, value))
    return f"if({totals}.fits and {totals}.whole is not null, {exact}, {totals}.plain)"


def sum_of(totals: str) -> Column:
    """Sum of the values of a column of totals; null without values."""
    return F.expr(_sum(totals))


def mean_of(totals: str) -> Column:
    """Mean of the values of a column of totals; null without values."""
    return F.expr(f"try_divide({_sum(totals)}, cast({totals}.n as double))")
