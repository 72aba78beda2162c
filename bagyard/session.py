"""Session settings the engine relies on.

The engine never creates its own cluster settings on a live session except
where they are unset: a cluster names its shared checkpoint folder in
``spark.checkpoint.dir`` and we only fall back to a scratch folder in tests.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that change query *results* are forced; the session time zone
# decides how naive timestamps render (ISO text with a zone, F08).
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings for a 100 TB run; only applied when the session does not have
# them set already, so a cluster's own tuning wins.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a partition is skewed once it is 4x the median and over 256 MB
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    # sizes on disk: keys and constant columns are up to a hundred times as large in a task's memory,
    # which then does not grow with the input as long as there are partitions enough to begin with
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1600",
    "spark.sql.files.maxPartitionBytes": str(8 * 1024 * 1024),
    "spark.sql.files.openCostInBytes": str(1024 * 1024),
    # a join whose one side was shuffled into partitions of this size at most hashes that side instead of sorting both
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "4m",
    # a union of tables that are dealt alike keeps their initial partitions, which are then not coalesced: 1,600 tasks for a few MB
    "spark.sql.unionOutputPartitioning": "false",
}

# Broadcast only small dimensions (disciplines, licences, rights map).  The first threshold is
# compared with an estimate before the run: file size times the share of the columns' widths,
# which takes the keys of millions of rows for a few MB.  It only lets tables pass that are small
# by any measure; the second is compared with the bytes that the side's shuffle has really written,
# less the columns that are not used: the driver holds several times as much of up to a dozen tables at once.
# They belong together: a session that names the first keeps its own.
BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": str(256 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(1024 * 1024),
}


# Partition sizing for a cluster run over ~100 TB: start from many shuffle
# partitions and let AQE coalesce them to ~128 MB each (size first, not
# parallelism first), so a partition always fits an executor's memory.
# Not applied to local sessions, where small data wants parallelism instead.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
}


def configure(spark: SparkSession, cluster: bool = False) -> SparkSession:
    """Apply result-relevant settings and fill in unset scale settings.

    With ``cluster=True`` the cluster partition sizing is filled in too; the
    shuffle partition count is then always raised, since every session carries
    one (Spark's 200 is far too few for 100 TB)."""
    conf = spark.conf
    for key, value in RESULT_SETTINGS.items():
        conf.set(key, value)
    if conf.get("spark.sql.autoBroadcastJoinThreshold", None) is None:
        for key, value in BROADCAST.items():
            conf.set(key, value)
    extra = CLUSTER_SETTINGS if cluster else {}
    for key, value in {**SCALE_DEFAULTS, **extra}.items():
        if conf.get(key, None) is None or (cluster and key in CLUSTER_SETTINGS and key == "spark.sql.shuffle.partitions"):
            conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "bagyard") -> SparkSession:
    """A local session for tests and the bench (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("BAGYARD_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster; a scratch one only if unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc_dir = spark.sparkContext.getCheckpointDir()
        if not sc_dir:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    sc_dir = spark.sparkContext.getCheckpointDir()
    if sc_dir:
        return sc_dir
    # unset: tests and the local bench only; executors elsewhere would not see this folder
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="bagyard-ckpt-")
    spark.sparkContext.setCheckpointDir(scratch)
    try:
        spark.conf.set("spark.checkpoint.dir", scratch)
    except Exception:  # noqa: BLE001 — some sessions reject runtime core settings; the context dir suffices
        pass
    return spark.sparkContext.getCheckpointDir() or scratch


_scopes = threading.local()


@contextmanager
def intermediate_tables(spark: SparkSession) -> Iterator[None]:
    """Drop the tables that :func:`cut_lineage` writes within this block when it ends.

    For jobs that write their outputs inside it: a stream would otherwise leave the
    intermediate tables of every micro-batch behind."""
    outer, mine = getattr(_scopes, "paths", None), []
    _scopes.paths = mine
    try:
        yield
    finally:
        _scopes.paths = outer
        _delete(spark, mine)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def written(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The table of :func:`cut_lineage` for the length of the block; what is made from it must be written before the block ends."""
    outer, mine = getattr(_scopes, "paths", None), []
    _scopes.paths = mine
    try:
        table = cut_lineage(df, name)
    finally:
        _scopes.paths = outer
    try:
        yield table
    finally:
        _delete(df.sparkSession, mine)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of an intermediate form that nothing reads any more."""
    _delete(spark, [path])


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_go(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a table that is written in this block go when it is written, not at some
    later garbage collection of the driver: disk holds the tables and one job's shuffles."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def cut_lineage(df: DataFrame, name: str = "t") -> DataFrame:
    """Materialise an intermediate table in the shared checkpoint folder and
    read it back.

    A written Parquet table survives executor loss (unlike cached blocks or a
    local checkpoint), is computed exactly once (a reliable RDD checkpoint
    recomputes an unpersisted input when it saves), and gives the optimizer
    real sizes, so AQE can broadcast a small intermediate and shuffle a big one.
    The shuffle files it was made with go when it is written.  Its columns are known, so no job reads the files for them.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    if getattr(_scopes, "paths", None) is not None:
        _scopes.paths.append(path)
    with shuffle_files_go(spark):
        df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
