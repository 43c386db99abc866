"""Session settings and the shared folder for intermediate tables."""

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root = None


def build_session(master=None, app="topicloom", **conf) -> SparkSession:
    """A session with adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared checkpoint folder of the cluster.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors would not see it.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="topicloom-")
            atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
        root = _local_root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within it the files of a query's shuffles go as soon as the query has ended.

    Otherwise they stay until the driver happens to collect its garbage, and those of
    all steps of a job lie on the disks at once.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back.

    The result has no lineage, so a lost executor costs one re-read and not a
    re-run of everything upstream. The shuffles behind it are not needed again and go.
    """
    path = work_dir(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path, compression=compression)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def release(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialize` that nothing reads any more."""
    for table in tables:
        path = table.__dict__.pop("stored_at", None)
        if path is not None:
            spark = table.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def spread_input(scan: DataFrame) -> DataFrame:
    """Give a scan at least as many partitions as the session has task slots.

    A file with one row group, or one that cannot be split, is one task, and the
    text work after it would be serial. Inputs with enough splits are returned
    as they are, without a shuffle. Only for plain scans: the partition count of
    anything else may run its shuffles.
    """
    slots = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= slots:
        return scan
    spread = scan.repartition(slots)
    if "stored_at" in scan.__dict__:
        spread.stored_at = scan.stored_at
    return spread
