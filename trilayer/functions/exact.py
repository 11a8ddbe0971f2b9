"""Sums and averages that do not depend on task order.

A sum of doubles changes with the order in which partial sums meet, so a retried
stage can change a published figure. These add in decimal and go back to double.
Finite amounts may have ten decimals, as ``amount_type`` says, and be below 1e18 in
absolute value; a larger one ends the job. NaN and infinite amounts count as in a plain
sum of doubles: NaN, or infinities of both signs, give NaN, others an infinity.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(28,10)"
NAN, INFINITY = float("nan"), float("inf")


def is_finite(value: Column) -> Column:
    """Whether a number is neither NaN nor infinite; null stays null."""
    number = value.cast("double")
    return ~F.isnan(number) & (F.abs(number) != INFINITY)


def round2(value: Column) -> Column:
    """Two decimals, half up, decided on the decimal value; NaN and infinities stay."""
    number = value.cast("double")
    finite = F.when(is_finite(number), value)
    rounded = F.round(finite.cast(AMOUNT), 2).cast("double")
    return F.when(is_finite(number), rounded).otherwise(number)


def special_or(result: Column, nan: Column, plus: Column, minus: Column) -> Column:
    """``result``, unless there was a NaN or an infinity among the values."""
    return (
        F.when(nan | (plus & minus), F.lit(NAN))
        .when(plus, F.lit(INFINITY))
        .when(minus, F.lit(-INFINITY))
        .otherwise(result)
    )


def special_values(name: str) -> tuple[Column, Column, Column]:
    """Per value: whether it is NaN, infinity, minus infinity."""
    number = F.col(name).cast("double")
    return F.isnan(number), number == INFINITY, number == -INFINITY


def finite_amount(name: str, amount_type: str = AMOUNT) -> Column:
    """The value as a decimal, null where it is NaN or infinite."""
    return F.when(is_finite(F.col(name)), F.col(name)).cast(amount_type)


def _special_or(name: str, result: Column) -> Column:
    return special_or(result, *[F.max(special) for special in special_values(name)])


def exact_sum(name: str, amount_type: str = AMOUNT) -> Column:
    """Sum of the non-null values; null if there are none."""
    return _special_or(name, F.sum(finite_amount(name, amount_type)).cast("double"))


def rounded_sum(name: str, amount_type: str = AMOUNT) -> Column:
    """The sum to two decimals, rounded before it goes back to double."""
    return _special_or(name, F.round(F.sum(finite_amount(name, amount_type)), 2).cast("double"))


def exact_avg(name: str, amount_type: str = AMOUNT) -> Column:
    """Average over the non-null values; null if there are none."""
    total = F.sum(finite_amount(name, amount_type)).cast("double")
    return _special_or(name, F.try_divide(total, F.count(name)))
