"""Safe parsing and exact money arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.schemas import MONEY, RATE


def _exact(raw: Column, parsed: Column, kind: str) -> Column:
    """``parsed``, where that is no number NULL; a number that is too large for its type is
    an error, as it would otherwise pass for a gap."""
    number = raw.try_cast("double")
    lost = parsed.isNull() & number.isNotNull() & ~F.isnan(number)
    return F.when(lost, F.raise_error(F.concat(F.lit(f"no {kind}: "), raw))).otherwise(parsed)


def parse_rate(raw: Column) -> Column:
    """Text to an exact decimal; NULL when it is no number."""
    return _exact(raw, raw.try_cast(RATE), RATE.simpleString())


def parse_money(raw: Column) -> Column:
    """Text to cents, rounded half up; NULL when it is no number."""
    return _exact(raw, raw.try_cast(MONEY), MONEY.simpleString())


def parse_whole(raw: Column) -> Column:
    """Text to BIGINT ("7", "7.0"); NULL when it is no number."""
    decimal = raw.try_cast("decimal(38,10)")
    return _exact(raw, F.coalesce(raw.try_cast("bigint"), decimal.try_cast("bigint")), "bigint")


def parse_double(raw: Column) -> Column:
    """Text to DOUBLE; NULL when it is no number (NaN counts as none)."""
    number = raw.try_cast("double")
    return F.when(~F.isnan(number), number)


def or_zero(number: Column) -> Column:
    return F.coalesce(number, F.lit(0))


def mean(total: Column, n: Column) -> Column:
    """``total / n`` as DOUBLE, NULL for no rows."""
    return F.try_divide(total.cast("double"), n.cast("double"))


def net_price(price: Column, discount_pct: Column) -> Column:
    """Price after a percentage discount, in cents.

    The factor is built by multiplying with 0.01, so the whole product stays decimal.
    """
    factor = (F.lit(1) - discount_pct * F.expr("0.01BD")).cast("decimal(18,8)")
    return F.round(price * factor, 2).cast(MONEY)


def line_saving(total: Column, discounted: Column) -> Column:
    return (total - discounted).cast(MONEY)


def stock_value(stock: Column, net: Column) -> Column:
    return F.round(stock.cast("decimal(19,0)") * net, 2)
