"""Calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import date_key

# Default range of the calendar (fixed values).
FIRST_DAY = dt.date(2026, 1, 1)
LAST_DAY = dt.date(2029, 12, 31)


def date_series(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day, both ends included."""
    days = (last - first).days + 1
    return spark.range(max(days, 0)).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("calendar_date")
    )


def build_dim_dates(
    spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY
) -> DataFrame:
    day = F.col("calendar_date")
    return date_series(spark, first, last).select(
        date_key(day).alias("dim_date"),
        day,
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
    )


def _outside(df: DataFrame, dim_dates: DataFrame, columns: list[str]) -> DataFrame:
    """Add one flag per date column: it is set, and not in the calendar.

    The calendar is a few thousand rows by construction, so it is broadcast.
    """
    for column in columns:
        known = F.broadcast(
            dim_dates.select(F.col("dim_date").alias(column), F.lit(True).alias(f"_{column}_known"))
        )
        df = (
            df.join(known, column, "left")
            .withColumn(f"_{column}_out", F.col(column).isNotNull() & F.col(f"_{column}_known").isNull())
            .drop(f"_{column}_known")
        )
    return df


def flag_dates(
    df: DataFrame, dim_dates: DataFrame, required: list[str], optional: list[str]
) -> DataFrame:
    """Add ``<column>_ok``: the date is in the calendar, or is null where that is allowed."""
    flagged = _outside(df, dim_dates, [*required, *optional])
    for column in required:
        flagged = flagged.withColumn(
            f"{column}_ok", F.col(column).isNotNull() & ~F.col(f"_{column}_out")
        )
    for column in optional:
        flagged = flagged.withColumn(f"{column}_ok", ~F.col(f"_{column}_out"))
    return flagged.drop(*[f"_{column}_out" for column in [*required, *optional]])
