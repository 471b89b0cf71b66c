"""Day-of-week expressions; day 0 is Saturday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.schema import DAY_NAMES, WEEKEND_DAYS


def dow_of(moment: Column) -> Column:
    return (F.dayofweek(moment) % 7).cast("int")


def dow_flags(dow: Column, prefix: str = "is_dow_") -> list[Column]:
    """One 0/1 column per day; all are 0 for a null day."""
    return [F.when(dow == day, 1).otherwise(0).alias(f"{prefix}{day}") for day in range(7)]


def is_weekend(dow: Column) -> Column:
    return F.when(dow.isin(*WEEKEND_DAYS), 1).otherwise(0)


def day_name(dow: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in enumerate(DAY_NAMES) for x in pair])
    return F.coalesce(F.try_element_at(names, dow), F.lit("?"))


def day_kind(dow: Column) -> Column:
    return F.when(dow.isin(*WEEKEND_DAYS), "Weekend").otherwise("Weekday")
