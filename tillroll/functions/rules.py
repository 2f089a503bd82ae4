"""Business rules used by more than one mart, report or model step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits of the accuracy bands (absolute error in units) and of the
# stock and rating rules.
EXCELLENT_UP_TO = 5
GOOD_UP_TO = 15
LOW_STOCK_BELOW = 10
DEAD_STOCK_ABOVE = 50
DEAD_RATING_BELOW = 3.5
HIGH_RATING_FROM = 4.5


def prediction_error(predicted: Column, actual: Column) -> Column:
    return F.round(predicted - actual, 2)


def pct_error(predicted: Column, actual: Column) -> Column:
    """Signed error in percent of the actual value; NULL where that is 0."""
    return F.round(F.try_divide(predicted - actual, actual) * 100, 1)


def accuracy_band(predicted: Column, actual: Column) -> Column:
    """A missing prediction falls through to ``needs_review``."""
    error = F.abs(predicted - actual)
    return (
        F.when(error <= EXCELLENT_UP_TO, "excellent")
        .when(error <= GOOD_UP_TO, "good")
        .otherwise("needs_review")
    )


def flag(condition: Column) -> Column:
    """Predicate as 0/1; unknown counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def is_out_of_stock(stock: Column) -> Column:
    return stock == 0


def is_low_stock(stock: Column) -> Column:
    """Counts and model flag: includes empty shelves (the low-stock *list* does not)."""
    return stock < LOW_STOCK_BELOW


def is_dead_stock(stock: Column, rating: Column) -> Column:
    return (stock > DEAD_STOCK_ABOVE) & (rating < DEAD_RATING_BELOW)


def usd_label(amount: Column) -> Column:
    """``$1,234.50``"""
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def pct_label(value: Column) -> Column:
    """``12.5%``"""
    return F.concat(value.cast("string"), F.lit("%"))
