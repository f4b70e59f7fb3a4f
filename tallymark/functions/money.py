"""Exact decimal arithmetic for money and quantities.

Money has 2 decimals, quantities 6; every step rounds half-up by casting, in the
order the business rules round.
"""

from __future__ import annotations

from functools import reduce
from operator import add as _plus

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
QUANTITY = "decimal(20,6)"


def money(value) -> Column:
    return _col(value).cast(MONEY)


def money_at(value, scale: int) -> Column:
    return _col(value).cast(f"decimal({16 + scale},{scale})")


def to_decimal(value) -> Column:
    """Parse text to a wide decimal; null when it is not a number."""
    return _col(value).try_cast("decimal(38,12)")


def add_money(*values) -> Column:
    return reduce(_plus, [_col(v) for v in values]).cast(MONEY)


def subtract_money(a, b) -> Column:
    return (_col(a) - _col(b)).cast(MONEY)


def multiply_money(amount, factor) -> Column:
    return (_col(amount) * _col(factor)).cast(MONEY)


def divide_money(amount, divisor) -> Column:
    """Null for a zero divisor, so that callers choose the answer."""
    return (_col(amount) / F.nullif(_col(divisor), F.lit(0))).cast(MONEY)


def compare_money(a, b) -> Column:
    """-1, 0 or 1."""
    return F.signum(_col(a) - _col(b)).cast("int")


def greater_money(a, b) -> Column:
    return _col(a) > _col(b)


def equal_money(a, b) -> Column:
    return _col(a) == _col(b)


def zero_money() -> Column:
    return F.lit("0.00").cast(MONEY)


def sum_money(value) -> Column:
    """Aggregate; 0.00 for no rows."""
    return F.coalesce(F.sum(_col(value)).cast(MONEY), zero_money())


def quantity(value, scale: int = 6) -> Column:
    return _col(value).cast(f"decimal({14 + scale},{scale})")


def add_quantity(*values) -> Column:
    return reduce(_plus, [_col(v) for v in values]).cast(QUANTITY)


def multiply_quantity(amount, factor) -> Column:
    return (_col(amount) * _col(factor)).cast(QUANTITY)


def zero_quantity() -> Column:
    return F.lit("0").cast(QUANTITY)


def max_quantity(a, b) -> Column:
    return F.greatest(_col(a), _col(b)).cast(QUANTITY)


def plain_number(value) -> Column:
    """Decimal as text without trailing zeros: 0.020000 -> 0.02, 12.000000 -> 12."""
    text = _col(value).cast("string")
    return F.when(F.instr(text, ".") > 0, F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value
