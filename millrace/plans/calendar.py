"""Date and time dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ordinal_day
from ..functions.keys import surrogate_key

# The words used for quarters and day kinds.
QUARTER_WORDS = ("First", "Second", "Third", "Fourth")


def days(spark: SparkSession, start: str, end: str, end_included: bool = True) -> DataFrame:
    """One row per day (`date_actual`) from start to end."""
    last = F.lit(end).cast("date") if end_included else F.date_sub(F.lit(end).cast("date"), 1)
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), last)).alias("date_actual"))


def days_of(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last date of a column, gaps filled."""
    limits = df.agg(F.min(F.to_date(column)).alias("a"), F.max(F.to_date(column)).alias("b")).where("a is not null")
    return limits.select(F.explode(F.sequence("a", "b")).alias("date_actual"))


def date_attributes(day: Column) -> dict[str, Column]:
    """The 25 columns of the warehouse date dimension. Weeks start on Monday."""
    month, quarter, year = F.month(day), F.quarter(day), F.year(day)
    week = F.weekofyear(day)
    quarter_start = F.trunc(day, "quarter")
    monday = F.trunc(day, "week")
    return {
        "date_id": F.date_format(day, "yyyyMMdd").cast("int"),
        "date_actual": day,
        "day_suffix": ordinal_day(day),
        "day_name": F.date_format(day, "EEEE"),
        "day_of_year": F.dayofyear(day),
        "week_of_month": F.floor((F.dayofmonth(day) - 1) / 7).cast("int") + 1,
        "week_of_year": week,
        "week_of_year_iso": F.format_string("%d-W%02d", year, week),
        "month_actual": month,
        "month_name": F.date_format(day, "MMMM"),
        "month_name_abbreviated": F.date_format(day, "MMM"),
        "quarter_actual": quarter,
        "quarter_name": F.get(F.array(*[F.lit(w) for w in QUARTER_WORDS]), quarter - 1),
        "year_actual": year,
        "first_day_of_week": monday,
        "last_day_of_week": F.date_add(monday, 6),
        "first_day_of_month": F.trunc(day, "month"),
        "last_day_of_month": F.last_day(day),
        "first_day_of_quarter": quarter_start,
        "last_day_of_quarter": F.last_day(F.add_months(quarter_start, 2)),
        "first_day_of_year": F.trunc(day, "year"),
        "last_day_of_year": F.make_date(year, F.lit(12), F.lit(31)),
        "mmyyyy": F.date_format(day, "MMyyyy"),
        "mmddyyyy": F.date_format(day, "MMddyyyy"),
        "weekend_indr": F.when(F.weekday(day) >= 5, "weekend").otherwise("weekday"),
    }


def date_dimension(day_rows: DataFrame) -> DataFrame:
    """Warehouse date dimension, key yyyymmdd, from rows with `date_actual`."""
    return day_rows.select(*[c.alias(n) for n, c in date_attributes(F.col("date_actual")).items()])


def mart_date_dimension(day_rows: DataFrame) -> DataFrame:
    """Date dimension of the order mart: MD5 key over the ISO date, ISO weekdays."""
    day = F.col("date_actual")
    return day_rows.select(
        surrogate_key(day).alias("sk_date_id"),
        day.alias("date_day"),
        F.date_sub(day, 1).alias("prior_date_day"),
        F.date_add(day, 1).alias("next_date_day"),
        (F.weekday(day) + 1).alias("day_of_week_iso"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.trunc(day, "week").alias("iso_week_start_date"),
        F.weekofyear(day).alias("iso_week_of_year"),
        F.month(day).alias("month_of_year"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.trunc(day, "month").alias("month_start_date"),
        F.last_day(day).alias("month_end_date"),
        F.quarter(day).alias("quarter_of_year"),
        F.year(day).alias("year_number"),
    )


def time_dimension(spark: SparkSession) -> DataFrame:
    """One row per minute of the day: 1,440 rows."""
    minute = F.col("id").cast("int")
    hour = F.floor(minute / 60).cast("int")
    return spark.range(1440).select(
        minute.alias("time_id"),
        F.format_string("%02d:%02d:00", hour, minute % 60).alias("time_actual"),
        hour.alias("hour"),
        (minute % 60).alias("minute"),
        F.floor(minute / 15).cast("int").alias("quarter_hour"),
        F.when(hour < 12, "AM").otherwise("PM").alias("half_day"),
    )
