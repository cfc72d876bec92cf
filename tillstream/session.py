"""Session settings the engine relies on.

Event times are zoneless local times (ISO strings without offset); the engine
reads them in UTC so window bounds, hours and days of week never shift with the
host's zone or across DST changes.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings applied by ``configure``. AQE re-plans joins and
# aggregations at runtime (coalescing small shuffle partitions, splitting
# skewed ones); the skew-join split handles a hot key holding a large share of
# rows on the big side of a sort-merge join.
RUNTIME_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Streaming state defaults, applied only where the session leaves them unset:
# window state (open windows x stores / products) lives in RocksDB off the JVM
# heap, and checkpoints write changelogs instead of full snapshots per batch.
STREAMING_SQL_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# For a stream whose state is bounded by what one micro-batch brings (input in order of
# time, windows much shorter than a batch): a map on the heap, without a lookup, a write
# and a compaction in RocksDB for every row.
BOUNDED_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
}


# Shuffle files go when the action that made them ends. Otherwise they stay until the driver
# happens to collect its garbage, and those of many micro-batches add up on the disks.
SHUFFLES_DROPPED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# For a stream with much state: its changelogs and files, and the tables written beside it, in the denser codec.
DENSE_FILES = {
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure_streaming(spark: SparkSession) -> SparkSession:
    """Fill in streaming state settings the cluster has not chosen itself."""
    for key, value in STREAMING_SQL_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the engine's semantics depend on."""
    for key, value in RUNTIME_SQL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "tillstream", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session for scripts and tests. On a cluster the master and sizing come
    from spark-submit; only what is unset is filled in here."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in RUNTIME_SQL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Streaming checkpoints, staged tables and lineage cuts all live below it so
    that a lost executor (or driver restart) finds them again. Only where the
    session leaves it unset and runs in one local process (tests) is a fresh
    scratch folder created and registered; elsewhere that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = _context(spark)
    if not root and context is not None:
        root = context.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        # The setting cannot be changed while a session runs; its context remembers the folder.
        root = (context.getCheckpointDir() if context is not None else None) or tempfile.mkdtemp(prefix="tillstream-ckpt-")
    if context is not None and context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None on a Spark Connect client."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        return None


@contextlib.contextmanager
def temporary_conf(spark: SparkSession, values: dict[str, str]):
    """Set runtime SQL settings for the duration of a block, then restore."""
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield spark
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def default_parallelism(spark: SparkSession) -> int:
    """Total task slots of the cluster (cores), or the shuffle setting."""
    context = _context(spark)
    if context is not None:
        return int(context.defaultParallelism)
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique location below the checkpoint root."""
    return "/".join([checkpoint_root(spark), *parts, uuid.uuid4().hex])
