"""Bronze layer: typed, stamped, append-only change events and arrival checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.functions.columns import as_date, stamp
from snapledger.model import Entity


def typed_events(raw: DataFrame, entity: Entity) -> DataFrame:
    """Cast raw columns (e.g. strings) to the entity's bronze types.

    ``try_cast`` gives NULL on malformed input instead of failing the job
    (ANSI casts raise); rows with NULL keys are separated by :func:`split_valid`.
    Columns absent from ``raw`` come out as typed NULLs.
    """
    cols = []
    for f in entity.bronze_schema.fields:
        if f.name in raw.columns:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def stamp_ingestion(df: DataFrame, at: Column | dt.datetime | None = None) -> DataFrame:
    """Set ``ingestion_date`` (the delivery time) – the clock unless ``at`` is given."""
    return df.withColumn("ingestion_date", stamp(at))


def is_valid(entity: Entity) -> Column:
    """Whether an event keeps the bronze rules.

    A valid event has every event-key column and a partition day equal to the
    day of its event time. The second rule keeps all deliveries of one event
    in one partition and lets as-of ranking run directly on undeduplicated
    events (see :func:`snapledger.operators.asof.as_of`).
    """
    ok = F.lit(True)
    for c in entity.event_key:
        ok = ok & F.col(c).isNotNull()
    return ok & F.coalesce(F.col(entity.partition_col) == F.to_date("transaction_datetime"), F.lit(False))


def split_valid(df: DataFrame, entity: Entity) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) events by :func:`is_valid`; :func:`reject_report` counts both."""
    ok = is_valid(entity)
    return df.filter(ok), df.filter(~ok)


def has_partition(events: DataFrame, day: str | dt.date, col: str = "transaction_date") -> bool:
    """Did any event of ``day`` arrive? A partition-pruned probe of one row."""
    return len(events.filter(F.col(col) == F.lit(as_date(day))).select(col).limit(1).collect()) > 0


def arrival_report(tables: dict[str, DataFrame], col: str = "transaction_date") -> DataFrame:
    """Per table and calendar day between its first and last event day: events that arrived.

    Days without events appear with ``events = 0`` and ``has_data = false``;
    a downstream job skips (and keeps yesterday's carry-forward state) for those.
    Counts are partially aggregated; the calendar per table is bounded by the
    number of days it spans.
    """
    counts = None
    for name, df in tables.items():
        c = df.groupBy(F.col(col).alias("transaction_date")).agg(F.count(F.lit(1)).alias("events"))
        c = c.withColumn("table_name", F.lit(name))
        counts = c if counts is None else counts.unionByName(c)
    # Each day with events also stands for the empty days up to the next one:
    # the tables are read once, and the window sees one row per table and day.
    following = F.lead("transaction_date").over(Window.partitionBy("table_name").orderBy("transaction_date"))
    days = counts.where(F.col("transaction_date").isNotNull()).withColumn("following", following)
    gap = F.sequence("transaction_date", F.coalesce(F.date_sub("following", 1), F.col("transaction_date")))
    every = days.select("table_name", "events", F.posexplode(gap).alias("empty_days", "transaction_date"))
    return every.select(
        "table_name",
        "transaction_date",
        F.when(F.col("empty_days") == 0, F.col("events")).otherwise(0).cast("long").alias("events"),
        (F.col("empty_days") == 0).alias("has_data"),
    )


def reject_report(tables: dict[str, DataFrame], entities: dict[str, Entity]) -> DataFrame:
    """Per table: events that pass the bronze rules and events that are rejected."""
    out = None
    for name, df in tables.items():
        ok = is_valid(entities[name])
        c = df.agg(F.count(F.when(ok, 1)).alias("valid_events"), F.count(F.when(~ok, 1)).alias("rejected_events"))
        c = c.select(F.lit(name).alias("table_name"), "valid_events", "rejected_events")
        out = c if out is None else out.unionByName(c)
    return out
