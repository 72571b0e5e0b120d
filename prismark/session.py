"""Spark session helpers.

Library code never builds its own session: every operator takes DataFrames
and returns DataFrames.  These helpers exist for tests, the bench and the
driver entry point, plus one rule for iterative operators: lineage is cut
with ``checkpoint()`` into the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", partitions: int = 8, app: str = "prismark") -> SparkSession:
    """A local session tuned like the cluster one (AQE on, UTC, Arrow)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PRISMARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where none is named.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage and is
    read from the session.  Only a local master without that setting (tests,
    the bench) gets a fresh folder under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return sc.getCheckpointDir() or named
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative operators need a shared checkpoint folder"
        )
    path = tempfile.mkdtemp(prefix="prismark-ckpt-")
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never a local one."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder as Parquet and read back.

    Cuts the lineage like ``cut_lineage``; the table also has a size that the
    planner knows, and carries none of the constraints that a checkpoint keeps,
    which grow from round to round of a long loop.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_driver(spark: SparkSession) -> None:
    """Have the driver's JVM collect its garbage now and return what it then does not need.

    A long loop of small queries leaves plans, generated code and broadcasts behind.  The
    JVM would rather grow to its largest heap than collect them, and broadcasts and
    shuffle files of finished queries are deleted only once their plans are collected.
    """
    spark.sparkContext._jvm.java.lang.System.gc()
