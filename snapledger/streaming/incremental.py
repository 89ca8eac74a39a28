"""Silver maintained by Structured Streaming instead of a high-water mark.

The bronze folder is read as a file stream; the checkpoint records which
files were processed, replacing the ``max(bronze_ingestion_date)`` mark (and
its strict-``>`` blind spot for late files with old stamps). Each micro-batch
is merged into silver for the keys it touches, exactly like the batch run.
A replayed batch (after a failure) is absorbed by deduplication: the newest
delivery still wins and full ties keep the row created first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from snapledger.model import Entity
from snapledger.plans import daily


def silver_stream(
    spark: SparkSession,
    entity: Entity,
    lake: daily.Lake,
    checkpoint_path: str,
    line_created_at: dt.datetime | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the bronze -> silver stream for ``entity`` in ``lake``.

    ``available_now`` processes everything present and stops (a scheduled
    incremental job); otherwise the query keeps running.
    """
    schema = entity.bronze_schema
    if lake.event_part_col not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(lake.event_part_col, T.DateType())])
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    source = reader.parquet(lake.bronze(entity)).select(*entity.bronze_schema.fieldNames())

    def on_batch(batch: DataFrame, _epoch: int) -> None:
        daily.merge_into_silver(batch.sparkSession, lake, entity, batch, line_created_at)

    writer = source.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
