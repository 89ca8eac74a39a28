"""Small, reusable column expressions and DataFrame idioms."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapledger.model import STATUS_PAID, STATUS_UNPAID


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def status_from_release(release_date: str | Column = "release_date") -> Column:
    """A purchase is paid once it has a release date."""
    return F.when(_c(release_date).isNotNull(), F.lit(STATUS_PAID)).otherwise(F.lit(STATUS_UNPAID))


def gmv_amount(qty: str = "item_quantity", value: str = "purchase_value") -> Column:
    """Gross merchandise value of one row (exact decimal arithmetic)."""
    return _c(qty) * _c(value)


def money_to_double(c: Column) -> Column:
    """Money leaves the package as double, after exact decimal aggregation."""
    return c.cast("double")


def desc_order(cols: Sequence[str | Column]) -> list[Column]:
    """Descending, NULLS LAST order over ``cols`` (stated explicitly everywhere)."""
    return [_c(c).desc_nulls_last() for c in cols]


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``key`` under ``order`` (a total order).

    Planned as a WindowGroupLimit: each map task keeps only its best row per
    key before the shuffle, so a key holding a large share of all rows is
    reduced map-side instead of landing whole in one task.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def days_after(ts: str | Column, days: Column | int) -> Column:
    """``ts`` plus a whole number of days (type of ``ts`` is kept)."""
    d = days if isinstance(days, Column) else F.lit(days)
    return _c(ts) + F.make_dt_interval(days=d)


def hours_after(ts: str | Column, hours: Column | int) -> Column:
    h = hours if isinstance(hours, Column) else F.lit(hours)
    return _c(ts) + F.make_dt_interval(hours=h)


def year_bounds(year: int) -> tuple[dt.date, dt.date]:
    """Half-open [Jan 1, next Jan 1) range: unlike ``year(col) = y`` it reaches the Parquet scan."""
    return dt.date(year, 1, 1), dt.date(year + 1, 1, 1)


def ntz(value: Column | str | dt.datetime) -> Column:
    """A wall-clock literal without a zone.

    ``F.lit`` reads a naive datetime in the driver's own zone and would shift it
    by that zone's offset; the text form has no zone to be read in.
    """
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    return F.expr(f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'")


def stamp(value: Column | str | dt.datetime | None) -> Column:
    """``value`` as a wall-clock column; the session's clock when it is None."""
    return F.localtimestamp() if value is None else ntz(value)


def session_clock(spark: SparkSession) -> dt.datetime:
    """One reading of the session's wall clock (the session time zone, not the driver's)."""
    return spark.range(1).select(F.localtimestamp().alias("t")).first()["t"]


def as_date(d: str | dt.date) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)
