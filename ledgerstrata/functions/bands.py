"""Threshold bands and the segment columns built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits and labels of the published segments.
VALUE_OVER = ((1000, "High Value"), (100, "Medium Value"))
VALUE_ELSE = "Low Value"
INCOME_OVER = ((50000, "High Income"), (25000, "Medium Income"))
INCOME_ELSE = "Low Income"
TIER_OVER = ((80000, "Premium"), (50000, "Gold"), (25000, "Silver"))
TIER_ELSE = "Standard"
AGE_UNDER = ((25, "Young"), (45, "Middle-aged"), (65, "Mature"))
AGE_ELSE = "Senior"
HOUR_BETWEEN = ((9, 17, "Business Hours"), (18, 23, "Evening"))
HOUR_ELSE = "Night"
WEEKEND_DAYS = (1, 7)
WEEKEND, WEEKDAY = "Weekend", "Weekday"


def band(steps: Sequence[tuple[Column, str]], default: str) -> Column:
    """Label of the first true condition; NULL conditions count as false."""
    chain = F
    for condition, label in steps:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(default))


def transaction_value(amount: Column) -> Column:
    return band([(amount > limit, label) for limit, label in VALUE_OVER], VALUE_ELSE)


def income_segment(income: Column) -> Column:
    return band([(income > limit, label) for limit, label in INCOME_OVER], INCOME_ELSE)


def customer_tier(income: Column) -> Column:
    return band([(income > limit, label) for limit, label in TIER_OVER], TIER_ELSE)


def age_group(age: Column) -> Column:
    return band([(age < limit, label) for limit, label in AGE_UNDER], AGE_ELSE)


def time_period(hour: Column) -> Column:
    return band([(hour.between(a, b), label) for a, b, label in HOUR_BETWEEN], HOUR_ELSE)


def day_type(day_of_week: Column) -> Column:
    """Weekend or weekday, with days numbered from 1 = Sunday."""
    return band([(day_of_week.isin(*WEEKEND_DAYS), WEEKEND)], WEEKDAY)
