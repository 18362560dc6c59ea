"""Tables in the folder that the driver and all executors share, which cut lineage and outlive executors, and tables on the executors' disks."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_written: set[str] = set()
_kept: dict[str, DataFrame] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the checkpoint folder that the context has. Where neither is set, a temporary folder is right only
    if driver and executors are one process; on a cluster it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if not current.isDefined():
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="clipweave-"))
        current = context._jsc.sc().getCheckpointDir()
    return current.get()


def new_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/clipweave-{uuid.uuid4().hex}-{tag}"
    _written.add(path)
    return path


def stored(df: DataFrame, tag: str, partition_by: str | None = None) -> DataFrame:
    """df written as Parquet into the shared folder and read again."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.clipweave_path = path
    return out


def kept(df: DataFrame, tag: str) -> DataFrame:
    """df computed once and held on the executors' disks; what a lost executor held is computed again. It writes no files into the
    shared folder, where each starts processes on a local file system, but later plans contain df's: not for loops. Its plan is
    adapted to the end, as a written table's is: small partitions are joined, skewed joins dealt anew."""
    conf, key = df.sparkSession.conf, "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        out = df.persist(StorageLevel.DISK_ONLY)
    finally:
        conf.set(key, before)
    out.clipweave_path = f"kept:{uuid.uuid4().hex}-{tag}"
    _kept[out.clipweave_path] = out
    _written.add(out.clipweave_path)
    out.count()
    return out


def drop_stored(spark: SparkSession, path: str) -> None:
    """Deletes a table of stored() or kept() that no later plan needs."""
    if path in _kept:
        _kept.pop(path).unpersist()
        _written.discard(path)
        return
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    _written.discard(path)


def drop(*tables: DataFrame) -> None:
    """Deletes tables of stored() or kept() that no later plan needs."""
    for df in tables:
        drop_stored(df.sparkSession, df.clipweave_path)


def written() -> set[str]:
    """The paths of the tables that have not been dropped, kept ones under names of their own."""
    return set(_written)


def _at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        for path in list(_written):
            try:
                drop_stored(spark, path)
            except Exception:  # the JVM may be gone already
                return


atexit.register(_at_exit)


def extended(schema: T.StructType, **kinds: str) -> T.StructType:
    """A copy of the schema with more columns, kinds as DDL."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(", ".join(f"{k} {v}" for k, v in kinds.items())).fields])
