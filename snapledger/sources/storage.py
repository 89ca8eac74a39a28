"""Typed Parquet storage: reads, appends and partition-scoped replacement.

All writes go through Spark's commit protocol, so a lost executor only
re-runs its tasks. A table is never overwritten from a plan that still reads
it: such writes are staged first, as Parquet in a folder that goes after its
use, or with ``checkpoint()`` into the shared folder named by
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from snapledger.session import checkpoint_dir


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of an action are deleted when it has ended.

    Otherwise they stay until the driver's garbage collector finds the plan unused, so
    the steps of a long run add up on the executors' disks.
    """
    old = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, old)


def _missing(e: AnalysisException) -> bool:
    cond = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    return (cond() if cond else None) == "PATH_NOT_FOUND"


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """Typed read of a Parquet table; ``None`` when it does not exist yet.

    Only a missing path counts as "does not exist"; any other analysis error
    (bad schema, permissions) is raised.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if _missing(e):
            return None
        raise


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Like :func:`read_table`, but an absent table is a typed empty DataFrame."""
    df = read_table(spark, path, schema)
    return df if df is not None else spark.createDataFrame([], schema)


def _balanced(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Group rows of a partition into few files without a single-task hot spot.

    The REBALANCE hint lets AQE coalesce small outputs and split a partition
    value that holds a large share of all rows over several tasks.
    """
    return df.hint("rebalance", *partition_cols) if partition_cols else df.hint("rebalance")


def append(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> None:
    """Append-only write (bronze, event logs)."""
    _balanced(df, partition_cols).write.mode("append").partitionBy(*partition_cols).parquet(path)


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    owned: Sequence[object] | None = None,
    sort_cols: Sequence[str] = (),
    balanced: bool = False,
) -> None:
    """Overwrite the partitions present in ``df``; all others are kept.

    ``owned``: values of the first partition column (or tuples of the values of
    the first ones) that this write stands for as a whole. What ``df`` no longer has of them is cleared too, after the
    write has succeeded, so a rerun whose result is empty (or has lost a
    second-level partition) leaves nothing old behind. ``sort_cols`` orders the
    rows inside each file. ``balanced``: ``df`` reads a table that was written by
    these partitions, so its files are copied without another shuffle.
    """
    spark = df.sparkSession
    before = [f for v in owned or () for f in _files(spark, _partition(path, partition_cols, v if isinstance(v, tuple) else (v,)))]
    out = df if balanced else _balanced(df, partition_cols)
    if sort_cols:
        out = out.sortWithinPartitions(*partition_cols, *sort_cols)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )
    # Replaced partitions have lost their old files already; the rest are stale.
    for f in before:
        _delete_file(spark, f)


def write_run(df: DataFrame, path: str, run: int, sort_cols: Sequence[str], more: bool = False) -> None:
    """Add ``df`` as the folder ``run=<run>`` of a table that grows by runs, sorted for row-group pruning;
    with ``more`` to what that folder has."""
    _balanced(df, ()).sortWithinPartitions(*sort_cols).write.mode("append" if more else "overwrite").parquet(f"{path}/run={run}")


def shelved(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet to a folder of its own and read back: a third of a checkpoint's
    size or less, and gone with :func:`remove`."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _partition(path: str, partition_cols: Sequence[str], values: tuple) -> str:
    return "/".join([path, *(f"{c}={v}" for c, v in zip(partition_cols, values))])


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _files(spark: SparkSession, path: str) -> list[str]:
    """All files below a folder; none if it isn't there."""
    fs, target = _folder(spark, path)
    if not fs.exists(target):
        return []
    found, each = [], fs.listFiles(target, True)
    while each.hasNext():
        found.append(each.next().getPath().toString())
    return found


def folder_values(spark: SparkSession, path: str, col: str) -> list[str]:
    """Values of the partition folders ``col=value`` right below a folder; none if it isn't there."""
    fs, target = _folder(spark, path)
    if not fs.exists(target):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(target)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{col}="))


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _folder(spark, path)
    return fs.exists(target)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _folder(spark, path)
    fs.mkdirs(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package has made, with all below it."""
    fs, target = _folder(spark, path)
    fs.delete(target, True)


def _delete_file(spark: SparkSession, path: str) -> None:
    """Delete a file if it is there, and its folder when that leaves it empty."""
    fs, target = _folder(spark, path)
    if fs.exists(target):
        fs.delete(target, False)
    parent = target.getParent()
    if fs.exists(parent) and not fs.listStatus(parent):
        fs.delete(parent, False)


def staged(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Used before overwriting a table that ``df`` was computed from, and to
    survive executor loss in long chains (a reliable checkpoint, never a
    local one).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
