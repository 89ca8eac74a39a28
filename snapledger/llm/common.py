"""Helpers shared by the operators: shared-folder tables, ordered buckets, Arrow mapping."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path
from typing import TypeVar

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.session import scratch_path
from snapledger.sources.storage import remove

#: Rows in one Arrow batch handed to Python. Texts are long, so batches are
#: kept small; a batch is the unit of memory of every Python stage.
BATCH_ROWS = 512
#: Rows in one batch between Spark and its Python workers, at most.
ARROW_ROWS = 1024
ARROW_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"

Kept = TypeVar("Kept")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the application's own part of the shared checkpoint folder."""
    return scratch_path(spark, f"llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}")


def forget(spark: SparkSession) -> None:
    """Remove the tables that this application's operators have written in between.

    For the end of a job, when its results are saved: results not saved yet are
    read from them.
    """
    remove(spark, scratch_path(spark, f"llm-{spark.sparkContext.applicationId}"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage: a lost executor re-reads the files instead of
    recomputing what made them.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], Kept]) -> Kept:
    """What a worker keeps between tasks (vocabularies, words met): of one operator at a time."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, and Arrow batches small
    enough for long texts.

    The package isn't sent where PYTHONPATH already names its folder (or the
    caller has used ``--py-files``: a second copy does no harm).
    """
    if int(spark.conf.get(ARROW_ROWS_CONF)) > ARROW_ROWS:
        spark.conf.set(ARROW_ROWS_CONF, str(ARROW_ROWS))
    package = Path(__file__).resolve().parent.parent
    app = spark.sparkContext.applicationId
    paths = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if app in _SHIPPED or str(package.parent) in paths:
        return
    out = Path(tempfile.mkdtemp(prefix="snapledger-")) / "snapledger.zip"
    with zipfile.ZipFile(out, "w") as z:
        for f in package.rglob("*.py"):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(out))
    _SHIPPED.add(app)


def tokenizer_path(name: str) -> str:
    """The file of a public tokenizer's name; a path is its own."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def partitions_for(spark: SparkSession, total_bytes: int, per_partition: int) -> int:
    """A partition count that follows the input, at least the session's own."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total_bytes) // per_partition), 1)


def map_batches(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """``mapInArrow`` whose input batches hold at most BATCH_ROWS rows."""

    ship(df.sparkSession)

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut() -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(0, b.num_rows, BATCH_ROWS):
                    yield b.slice(i, BATCH_ROWS)

        return fn(cut())

    return df.mapInArrow(small, schema)


def ordered_bounds(df: DataFrame, key: str, buckets: int) -> list[int]:
    """Ascending cut points that split ``key`` into about equal row counts.

    At most ``buckets - 1`` numbers reach the driver.
    """
    if buckets < 2:
        return []
    cuts = df.select(F.col(key).cast("double").alias(key)).na.drop().approxQuantile(
        key, [i / buckets for i in range(1, buckets)], min(0.01, 0.2 / buckets))
    return sorted({int(np.ceil(c)) for c in cuts})


def bucket_of(key: Column, bounds: Sequence[int]) -> Column:
    """Index of the ordered bucket of ``key``; null keys go to the last one."""
    cuts = np.asarray(bounds, dtype=np.int64)

    @F.pandas_udf(T.IntegerType())
    def find(keys: pd.Series) -> pd.Series:
        known = keys.notna()
        out = np.full(len(keys), len(cuts), dtype=np.int32)
        out[known] = np.searchsorted(cuts, keys[known].astype(np.int64), side="right")
        return pd.Series(out)

    return find(key.cast("long"))


def row_keyed(docs: DataFrame, key: str) -> tuple[DataFrame, str]:
    """``docs`` with a column that numbers its rows in the order of ``key``, and its name.

    The key itself where it is unique and never null; else the rows are sorted by
    key (nulls last), numbered and written, so the numbers stay the same.
    """
    name = "__row"
    while name in docs.columns:
        name += "_"
    ids = docs.select(F.col(key).cast("long").alias("key"))
    total, known = ids.agg(F.count("*"), F.count("key")).first()
    if total == known and ids.distinct().count() == total:
        return docs.withColumn(name, F.col(key).cast("long")), name
    place = F.col(key).cast("long").asc_nulls_last()
    ordered = docs.repartitionByRange(place).sortWithinPartitions(place)
    return written(ordered.withColumn(name, F.monotonically_increasing_id()), "rows"), name
