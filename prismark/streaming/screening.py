"""Incremental screening of arriving record files (Structured Streaming).

The reference screens in a loop, saves every ten rows and resumes by skipping
rows already decided.  Here new record files landing in a folder are a
file stream; each micro-batch is conformed, de-duplicated against the keys
already accepted (the output table is the state, so no key set grows in
memory), screened, and written to its own ``batch=<id>`` folder with
overwrite.  Replaying a batch after a failure rewrites the same folder, so
the sink is idempotent; the checkpoint folder records progress.

Within a batch the primary source wins and its rows are all kept, as in
``merge_sources``; across batches the first arrival of a title is kept, and rows
of the primary source without a title key always.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from prismark.operators.dedup import KEY, dedup_against, first_wins, with_title_key
from prismark.operators.screen import parse_verdict, screen, screening_prompt, score_with
from prismark.schema import RECORD_SCHEMA
from prismark.sources.records import conform


def _accepted_keys(spark: SparkSession, out_dir: str, batch_id: int) -> DataFrame | None:
    """Keys written by earlier batches; a batch that is replayed does not see its own rows."""
    try:
        written = spark.read.parquet(out_dir)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None  # no batch written yet
    return written.where((F.col("batch") < batch_id) & (F.col(KEY) != "")).select(KEY)


def process_batch(
    batch: DataFrame,
    batch_id: int,
    out_dir: str,
    criteria: str,
    scorer: Callable[[str], str] | None = None,
    primary_source: str = "PubMed",
) -> None:
    spark = batch.sparkSession
    recs = with_title_key(conform(batch))
    primary = recs.where(F.col("Source").eqNullSafe(primary_source))  # kept whole, also without a title
    others = recs.where(~F.col("Source").eqNullSafe(primary_source) & (F.col(KEY) != ""))
    others = first_wins(others.withColumn("_order", F.monotonically_increasing_id()), KEY, "_order").drop("_order")
    recs = primary.unionByName(dedup_against(primary, others))
    seen = _accepted_keys(spark, out_dir, batch_id)
    if seen is not None:
        recs = recs.join(seen, KEY, "left_anti")
    if scorer is not None:
        scored = score_with(recs.withColumn("prompt", screening_prompt(recs, criteria)), scorer).drop("prompt")
    else:
        scored = recs.withColumn("raw_verdict", F.lit(None).cast("string"))
    out = screen(scored).withColumn("batch_id", F.lit(batch_id).cast("long"))
    out.write.mode("overwrite").parquet(os.path.join(out_dir, f"batch={batch_id}"))


def screen_stream(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    criteria: str,
    scorer: Callable[[str], str] | None = None,
    once: bool = True,
):
    """Start the stream over CSV record files in ``in_dir``; ``once`` processes what is there and stops."""
    src = (
        spark.readStream.schema(RECORD_SCHEMA)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(in_dir)
    )
    w = src.writeStream.foreachBatch(
        lambda df, bid: process_batch(df, bid, out_dir, criteria, scorer)
    ).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")
    return w.start()


__all__ = ["screen_stream", "process_batch", "parse_verdict"]
