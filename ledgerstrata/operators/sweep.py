"""How many versions are open on each day, without laying versions out by day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import END, START

DAY = "day"


def open_by_day(
    history: DataFrame, groups: Sequence[str], first: dt.date, last: dt.date, *, start: str = START, end: str = END,
    count: str = "open_versions",
) -> DataFrame:
    """Versions open at the close of each day from ``first`` to ``last``, per group; days without any have no row.

    Each version is a step of +1 on its first day and of -1 on the day it ends. Steps are summed per group and day
    before the shuffle, so whatever the number of versions, a group has one row per day of the range at most;
    running sums of these are what is open until the group's next step. A version that ends on its first day is never
    open at a close, one without a start never. NULL is a group of its own.
    """
    opened = history.select(*groups, F.to_date(start).alias(DAY), F.lit(1).alias("_step"))
    closed = history.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(*groups, F.to_date(end).alias(DAY), F.lit(-1).alias("_step"))
    steps = opened.unionAll(closed).where(F.col(DAY) <= F.lit(last))
    # All that happened before the range is one step on its first day.
    steps = steps.groupBy(*groups, F.greatest(DAY, F.lit(first)).alias(DAY)).agg(F.sum("_step").alias("_step"))
    in_order = Window.partitionBy(*groups).orderBy(DAY)
    runs = steps.select(*groups, DAY, F.sum("_step").over(in_order).alias(count), F.lead(DAY).over(in_order).alias("_next"))
    until = F.coalesce(F.date_sub("_next", 1), F.lit(last))
    days = F.explode(F.sequence(F.col(DAY), until, F.expr("INTERVAL 1 DAY")))
    return runs.where(F.col(count) > 0).select(*groups, days.alias(DAY), count)
