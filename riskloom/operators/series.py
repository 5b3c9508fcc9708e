"""Rolling features of daily series.

Windows run per company over at most one row per calendar day (the validators reject
repeated days), so a company's partition is bounded by its calendar. All features share
one window order: one shuffle, one sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.config import SEASON_DAYS, SERIES_COLUMNS

ROLLING_WINDOWS = (7, 30)


def _rolling(column: str, width: int, key: str, date: str) -> dict[str, Column]:
    before = Window.partitionBy(key).orderBy(date).rowsBetween(-width, -1)
    value = F.col(column).cast("double")
    enough = F.count(value).over(before) >= max(3, width // 4)
    return {
        f"{column}_rolling_mean_{width}": F.when(enough, F.avg(value).over(before)),
        f"{column}_rolling_std_{width}": F.when(enough, F.stddev_samp(value).over(before)),
    }


def rolling_mean_std(daily: DataFrame, columns: list[str] = SERIES_COLUMNS, key: str = "company_id",
                     date: str = "date") -> DataFrame:
    """Mean and deviation of the previous 7 and 30 rows, once 3 / 7 values are there."""
    out = {}
    for column in columns:
        for width in ROLLING_WINDOWS:
            out.update(_rolling(column, width, key, date))
    return daily.withColumns(out)


def rolling_residual(rolled: DataFrame, columns: list[str] = SERIES_COLUMNS) -> DataFrame:
    """Distance from the rolling mean, relative to it."""
    return rolled.withColumns({
        f"{c}_rolling_residual_{w}": F.try_divide(
            F.col(c) - F.col(f"{c}_rolling_mean_{w}"), F.col(f"{c}_rolling_mean_{w}")
        )
        for c in columns for w in ROLLING_WINDOWS
    })


def rolling_zscore(rolled: DataFrame, columns: list[str] = SERIES_COLUMNS) -> DataFrame:
    """Distance from the rolling mean in rolling deviations."""
    return rolled.withColumns({
        f"{c}_zscore_{w}": F.try_divide(
            F.col(c) - F.col(f"{c}_rolling_mean_{w}"), F.col(f"{c}_rolling_std_{w}")
        )
        for c in columns for w in ROLLING_WINDOWS
    })


def pct_change(daily: DataFrame, columns: list[str] = SERIES_COLUMNS, key: str = "company_id",
               date: str = "date") -> DataFrame:
    """Change against the previous row, signed and absolute."""
    order = Window.partitionBy(key).orderBy(date)
    out = {}
    for c in columns:
        change = F.try_divide(F.col(c).cast("double"), F.lag(F.col(c).cast("double")).over(order)) - 1
        out[f"{c}_pct_change_1d"] = change
        out[f"{c}_abs_pct_change_1d"] = F.abs(change)
    return daily.withColumns(out)


def calendar_and_ratios(daily: DataFrame, date: str = "date") -> DataFrame:
    """Monday-based weekday, revenue per active user and signup rate."""
    return daily.withColumns({
        "day_of_week": F.weekday(date),
        "revenue_per_active_user": F.try_divide(F.col("revenue"), F.col("active_users")),
        "signup_rate": F.try_divide(F.col("signups"), F.col("active_users")),
    })


def build_features(daily: DataFrame, key: str = "company_id", date: str = "date") -> DataFrame:
    """All series features; undefined values are 0 and every input row comes back."""
    absent = [c for c in [date, *SERIES_COLUMNS] if c not in daily.columns]
    if absent:
        raise ValueError(f"Missing time-series columns: {absent}")
    kept = set(daily.columns)
    out = rolling_mean_std(daily, SERIES_COLUMNS, key, date)
    out = rolling_zscore(rolling_residual(out))
    out = calendar_and_ratios(pct_change(out, SERIES_COLUMNS, key, date), date)
    zeroed = [
        F.coalesce(F.col(c), F.lit(0)).alias(c) if c not in kept or c in SERIES_COLUMNS else F.col(c)
        for c in out.columns
    ]
    return out.select(zeroed)


def seasonal_residuals(daily: DataFrame, value: str = "revenue", key: str = "company_id",
                       date: str = "date") -> DataFrame:
    """Difference to the value one season of rows earlier."""
    order = Window.partitionBy(key).orderBy(date)
    return daily.withColumn(
        "seasonal_residual", F.col(value) - F.lag(value, SEASON_DAYS).over(order)
    )


def seasonal_tail(daily: DataFrame, value: str = "revenue", key: str = "company_id",
                  date: str = "date") -> DataFrame:
    """The last season as `(company, season_no, tail_value)`, oldest first."""
    recent = Window.partitionBy(key).orderBy(F.col(date).desc())
    tail = daily.withColumn("__r", F.row_number().over(recent)).where(F.col("__r") <= SEASON_DAYS)
    return tail.select(
        key, (SEASON_DAYS - F.col("__r")).alias("season_no"),
        F.col(value).cast("double").alias("tail_value"),
    )
