"""Session settings the package relies on, and checkpoint-directory handling."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that matter for correctness or for the plans the operators expect.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot keys: AQE splits an oversized shuffle partition of a join side into
    # several tasks (the other side's partition is replicated).
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    # A task sorts several such partitions at once, each of them several times
    # as large in memory as in the shuffle; see also INPUT_PER_PARTITION.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # No broadcast from plan-time estimates: they come from compressed file
    # sizes and ignore fan-out (explode, joins), so they can be far too small.
    # Broadcasts happen only (a) at runtime, when AQE has measured the real
    # shuffle output of a side, or (b) explicitly for inputs of a bounded size.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    # A side already hash-partitioned on a subset of the join keys (e.g.
    # purchase_id for keys purchase_id, snapshot_date) is joined in place.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Writes replace only the partitions present in the data being written.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Static settings (spark.ui.*) can only be set when the session is created.
STATIC_CONF = {"spark.ui.enabled", "spark.ui.showConsoleProgress"}


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Bytes of the larger tables per shuffle partition, before AQE joins small ones:
#: with a fixed number the memory of a task would grow with the tables.
INPUT_PER_PARTITION = 4 << 20
LARGER_TABLES = ("orders", "lineitem", "customer")


def apply_sql_conf(spark: SparkSession, sf_dir: str | None = None) -> SparkSession:
    """Apply the runtime SQL settings of :data:`RECOMMENDED_CONF` to a session
    the package did not create (results do not depend on them; plans do). With
    ``sf_dir`` shuffles get as many partitions as its tables ask for."""
    for k, v in RECOMMENDED_CONF.items():
        if k not in STATIC_CONF and spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    if sf_dir is not None:
        own = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(INITIAL_PARTITIONS, str(max(own, -(-_bytes_of(spark, sf_dir) // INPUT_PER_PARTITION))))
    return spark


def _bytes_of(spark: SparkSession, sf_dir: str) -> int:
    total = 0
    for t in LARGER_TABLES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


def build_session(
    master: str | None = None,
    app_name: str = "snapledger",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with :data:`RECOMMENDED_CONF` applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared, durable folder and is used as
    is. Only when it is unset is ``fallback`` installed, or in local mode (as
    in tests) a fresh scratch folder; on a cluster that is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if current:
        if not sc_dir:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if sc_dir:
        return sc_dir
    if fallback is None:
        # In local mode (tests) driver and tasks share the machine's disk; elsewhere they don't.
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        fallback = tempfile.mkdtemp(prefix="snapledger-ckpt-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    base = checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name
