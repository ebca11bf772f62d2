"""Column expressions that carry the portability rules (PostgreSQL → Spark).

All helpers return native ``Column`` expressions, so they stay inside
whole-stage codegen; none of them is a UDF.

Rules (see the survey's P-table):
* P1  money is summed exactly as decimal, ratios are computed in double
      and rounded at the end (``avg_money``/``ratio``/``pct``).
* P2  ``numeric::INT`` rounds, Spark's cast truncates (``round_int``).
* P5  division by zero yields NULL instead of an error (``try_divide``).
* P6  text → date uses ``try_cast`` so bad input is NULL, not an error.
* P8  whole years between two dates like PostgreSQL's ``AGE`` (``age_years``).
* P9  ``ROUND(x, 2)::TEXT`` keeps two decimals (``fixed2_text``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c: str | Column) -> Column:
    return col(c).cast("double")


def div(num: str | Column, den: str | Column) -> Column:
    """``num / NULLIF(den, 0)`` in double; NULL on a zero or NULL divisor."""
    return F.try_divide(as_double(num), as_double(den))


def pct(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    """``ROUND(part / whole * 100, digits)`` in double."""
    return F.round(div(part, whole) * F.lit(100.0), digits)


def avg_exact(c: str | Column) -> Column:
    """Average as ``double(sum) / count``: exact decimal sum, one division.

    Spark's ``avg(decimal)`` keeps 6 decimals with HALF_UP rounding while the
    reference and DuckDB divide in floating point; summing exactly and
    dividing once gives the same double in every engine.
    """
    x = col(c)
    return F.try_divide(F.sum(x).cast("double"), F.count(x).cast("double"))


def avg_round(c: str | Column, digits: int = 2) -> Column:
    return F.round(avg_exact(c), digits)


def money_round(c: Column, digits: int = 2) -> Column:
    """``ROUND(decimal, 2)`` kept as a fixed decimal (money totals)."""
    return F.round(c, digits).cast(MONEY)


def sum_money(c: str | Column) -> Column:
    return money_round(F.sum(col(c)))


def round_int(c: Column, digits: int = 0, to: str = "bigint") -> Column:
    """``ROUND(x)::INT`` / ``x::BIGINT`` — PostgreSQL rounds, Spark truncates."""
    return F.round(c, digits).cast(to)


def count_if(pred: Column) -> Column:
    """``COUNT(CASE WHEN pred THEN 1 END)``: NULL predicates are not counted."""
    return F.count(F.when(pred, F.lit(1)))


def sum_if(pred: Column) -> Column:
    """``SUM(CASE WHEN pred THEN 1 ELSE 0 END)``: NULL on empty input."""
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def non_blank(c: str | Column) -> Column:
    x = col(c)
    return x.isNotNull() & (x != F.lit(""))


def fixed2_text(c: Column) -> Column:
    """``ROUND(x, 2)::TEXT`` — always two decimals, e.g. ``97.00``."""
    return F.round(c, 2).cast("decimal(38,2)").cast("string")


def try_date(c: str | Column) -> Column:
    """Text → DATE; impossible or blank dates become NULL."""
    return col(c).try_cast("date")


def age_years(birth: Column, as_of: _dt.date | _dt.datetime) -> Column:
    """Whole years from ``birth`` to ``as_of`` (``EXTRACT(YEAR FROM AGE(..))``, P8).

    ``floor(months_between/12)`` counts 2000-02-29 → 2001-02-28 as one year;
    PostgreSQL counts it as zero.  Compare month-day strings instead.
    """
    ref = F.lit(as_of.date() if isinstance(as_of, _dt.datetime) else as_of)
    before_birthday = (F.date_format(ref, "MMdd") < F.date_format(birth, "MMdd")).cast("int")
    return F.year(ref) - F.year(birth) - before_birthday


def first_match(cases: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    """Searched CASE: the first true predicate wins; no ELSE → NULL."""
    expr = None
    for pred, value in cases:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(pred, v) if expr is None else expr.when(pred, v)
    if otherwise is not None:
        o = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
        expr = expr.otherwise(o)
    return expr
