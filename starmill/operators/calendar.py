"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CALENDAR_SCHEMA = (
    "date_id int, date date, day_of_year int, day_of_week string, "
    "day_of_week_num int, month string, month_num int, year int"
)


def calendar(spark: SparkSession, start_year: int, end_year: int | None = None) -> DataFrame:
    """One row per day from 1 January of the first to 31 December of the last year."""
    end_year = start_year if end_year is None else end_year
    if end_year < start_year:
        raise ValueError(f"no years from {start_year} to {end_year}")
    first, last = F.make_date(F.lit(start_year), F.lit(1), F.lit(1)), F.make_date(F.lit(end_year), F.lit(12), F.lit(31))
    # one row per year first, so that a long span is generated by several tasks
    days = spark.range(start_year, end_year + 1).select(
        F.explode(
            F.sequence(
                F.make_date(F.col("id").cast("int"), F.lit(1), F.lit(1)),
                F.make_date(F.col("id").cast("int"), F.lit(12), F.lit(31)),
            )
        ).alias("date")
    )
    return with_date_attributes(days.filter(F.col("date").between(first, last)))


def with_date_attributes(days: DataFrame) -> DataFrame:
    d = F.col("date")
    return days.select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).alias("date_id"),
        d,
        F.dayofyear(d).alias("day_of_year"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofweek(d).alias("day_of_week_num"),  # Sunday is 1
        F.date_format(d, "MMMM").alias("month"),
        F.month(d).alias("month_num"),
        F.year(d).alias("year"),
    )


def missing_days(existing: DataFrame, wanted: DataFrame) -> DataFrame:
    """Days of ``wanted`` that are not in ``existing`` yet."""
    return wanted.join(existing.select("date"), "date", "left_anti").select(*wanted.columns)


def extend_calendar(existing: DataFrame, start_year: int, end_year: int | None = None) -> DataFrame:
    """``existing`` plus the days of the given years it lacks; present days are not touched."""
    wanted = calendar(existing.sparkSession, start_year, end_year)
    return existing.unionByName(missing_days(existing, wanted))
