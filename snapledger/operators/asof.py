"""As-of state: the latest version of every entity on or before a day.

``as_of`` answers one day; ``as_of_many`` answers a list of days in one pass
through half-open validity intervals.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapledger.functions.columns import as_date, desc_order, latest_per_key, ntz
from snapledger.model import Entity
from snapledger.operators.silver import FLAG, prepare_increment

def _state_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (FLAG, "line_created_at")]


DELIVERY_COLUMNS = ("bronze_ingestion_date", "ingestion_date")


def _version_order(df: DataFrame, entity: Entity) -> list:
    """Newest version first: event day, event time, then newest delivery.

    Putting the delivery time right after the event time makes ranking raw
    (undeduplicated) events give the same winner as deduplicating first,
    because all deliveries of one event share its key, time and day (bronze
    rejects rows whose day differs from the day of their event time).
    """
    first = ["transaction_date", "transaction_datetime"]
    first += [c for c in DELIVERY_COLUMNS if c in df.columns]
    rest = [c for c in _state_columns(df) if c not in first and c not in entity.business_key]
    return desc_order([*first, *rest])


def as_of(silver: DataFrame, entity: Entity, cutoff: str | dt.date) -> DataFrame:
    """Latest version per business key among rows with ``transaction_date <= cutoff``.

    ``silver`` may be the deduplicated silver table or the raw event rows: one
    ranked pass handles redeliveries too (see :func:`_version_order`). The
    cutoff filter is applied before ranking, so it prunes partitions /
    row groups at the scan (it is a partition-column literal comparison).
    """
    cut = as_date(cutoff)
    rows = silver.filter(F.col("transaction_date") <= F.lit(cut)).select(*_state_columns(silver))
    return latest_per_key(rows, entity.business_key, _version_order(rows, entity))


def as_of_known_by(
    bronze: DataFrame, entity: Entity, cutoff: str | dt.date, known_by: dt.datetime
) -> DataFrame:
    """Bitemporal as-of: only deliveries received by ``known_by`` count.

    Starts from bronze (every delivery), because the delivery-time filter
    must come before deduplication; the ranked as-of pass then deduplicates.
    """
    delivered = bronze.filter(F.col("ingestion_date") <= ntz(known_by))
    return as_of(prepare_increment(delivered, entity, F.lit(None).cast("timestamp_ntz")), entity, cutoff)


def validity_intervals(silver: DataFrame, entity: Entity) -> DataFrame:
    """Versions with half-open validity ``[valid_from, valid_to)`` in days.

    First only the last version per (key, day) is kept (partially aggregated
    WindowGroupLimit, so a hot key shrinks before the shuffle). The ``lead``
    window then sees at most one row per key per calendar day: its partition
    size is bounded by the number of days, not by the data volume.
    ``valid_to`` is NULL for the open, latest version.
    """
    rows = silver.select(*_state_columns(silver))
    day_key = [*entity.business_key, "transaction_date"]
    per_day = latest_per_key(rows, day_key, _version_order(rows, entity))
    w = Window.partitionBy(*entity.business_key).orderBy("transaction_date")
    return (
        per_day.withColumn("valid_from", F.col("transaction_date"))
        .withColumn("valid_to", F.lead("transaction_date").over(w))
    )


def snapshot_grid(
    start: str | dt.date, end: str | dt.date, every: str = "quarter"
) -> list[dt.date]:
    """Calendar of snapshot days in [start, end]: period ends ('day', 'month', 'quarter', 'year')."""
    s, e = as_date(start), as_date(end)
    out: list[dt.date] = []
    if every == "day":
        d = s
        while d <= e:
            out.append(d)
            d += dt.timedelta(days=1)
        return out
    step = {"month": 1, "quarter": 3, "year": 12}[every]
    m = ((s.month - 1) // step) * step  # first period containing start (0-based month)
    y = s.year
    while True:
        nm, ny = m + step, y
        if nm >= 12:
            nm, ny = nm - 12, y + 1
        period_end = dt.date(ny, nm + 1, 1) - dt.timedelta(days=1)
        if period_end > e:
            break
        if period_end >= s:
            out.append(period_end)
        m, y = nm, ny
    return out


def as_of_many(silver: DataFrame, entity: Entity, dates: Iterable[str | dt.date]) -> DataFrame:
    """As-of state for every day in ``dates`` at once, with a ``snapshot_date`` column.

    Each version is expanded only into the listed days inside its validity
    interval (``explode`` over a literal array), so the output is exactly
    the answer and no join or broadcast is involved.
    """
    days = sorted({as_date(d) for d in dates})
    if not days:
        raise ValueError("no snapshot days given")
    grid = F.array(*[F.lit(d) for d in days])
    iv = validity_intervals(silver, entity)
    hit = F.filter(
        grid,
        lambda d: (d >= F.col("valid_from")) & (F.col("valid_to").isNull() | (d < F.col("valid_to"))),
    )
    return (
        iv.withColumn("snapshot_date", F.explode(hit))
        .drop("valid_from", "valid_to")
    )


__all__: Sequence[str] = [
    "as_of",
    "as_of_known_by",
    "as_of_many",
    "snapshot_grid",
    "validity_intervals",
]
