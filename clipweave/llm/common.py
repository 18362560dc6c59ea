"""Shared helpers: table access, shared-folder tables, size-checked broadcasts."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipweave.storage import drop, drop_stored, extended, kept, new_path, shared_dir, stored, written  # noqa: F401

#: Largest table, in estimated bytes, that a helper here sends to every executor.
BROADCAST_LIMIT = 32 << 20

#: The id that stands for a null id inside an operator (results carry the null).
NULL_ID = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch. Spark's default, 10,000 texts, is copied several times over outside the heap.
BATCH_ROWS = 512


def in_arrow(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow with batches small enough for whole texts, where the session doesn't ask for smaller ones; workers give
    free memory back after a task."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df.mapInArrow(tidied(run), schema)


def tidied(run):
    """run for mapInArrow; when a task is over, its worker, which the next task will use, gives free memory back."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return wrapped


def fresh(df: DataFrame, name: str) -> str:
    """A name like the given one that no column of df has, letter case aside."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(df: DataFrame, *names: str | None) -> DataFrame:
    """df without the columns of these names, letter case aside, which are to be added."""
    gone = {n.lower() for n in names if n}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in gone))


def id_key(column: str = "doc_id") -> Column:
    """The id as a join key that is never null."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def small_side(df: DataFrame, row_bytes: int, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """df with a broadcast hint if its counted rows, with what a hashed row takes besides, stay under the limit; else df, for a
    shuffled join."""
    return F.broadcast(df) if df.count() * (row_bytes + 48) <= limit else df


def joined(left: DataFrame, right: DataFrame, on, how: str, row_bytes: int, hold=stored) -> DataFrame:
    """A join that broadcasts a counted small right side; the right side is stored (or kept), so that it is not made twice."""
    held = right if getattr(right, "clipweave_path", None) else hold(right, "side")
    return left.join(small_side(held, row_bytes), on, how)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
