"""Helpers shared by the operators: worker caches, shared folders, table reading.

Worker functions of this subpackage are shipped by value (see
``prismark/__init__``), so module globals do not outlive a task.  What is
expensive to build (a tokenizer, an automaton) is kept in a holder module that
lives as long as the Python worker.
"""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from prismark.session import checkpoint_dir

_HOLDER = "prismark_worker_cache"


def worker_cached(key, build):
    """The value of ``build()``, made once per Python worker process."""
    holder = sys.modules.get(_HOLDER)
    if holder is None:
        holder = sys.modules[_HOLDER] = types.ModuleType(_HOLDER)
        holder.values = {}
    if key not in holder.values:
        holder.values[key] = build()
    return holder.values[key]


def drop_cached() -> None:
    """Forget the values of ``worker_cached`` in this process."""
    if holder := sys.modules.get(_HOLDER):
        holder.values.clear()


def give_back() -> None:
    """Return memory that is free, but still held by Arrow or the C library, to the system."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def tidy(run, cached: bool = False):
    """``run`` (batches to batches) in a worker that holds on to little.

    A worker that waits for its next task would hold unused memory, so it is given back at the end.  Unless
    ``run`` uses ``worker_cached`` (``cached``), what earlier work kept there (tokenizers) is dropped first.
    """

    def tidied(batches):
        if not cached:
            drop_cached()
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder of the session."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage like a reliable checkpoint, but keeps the table
    columnar: later readers fetch only the columns they use.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` has written, once nothing will read them any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.stored_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of finished queries now: it does so when the driver's JVM collects their plans."""
    spark.sparkContext._jvm.java.lang.System.gc()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of a table of keys that may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 1 << 18


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (keys and fixed-size values only) marked for broadcast if it is counted to have at most ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df
