"""Positions in a total order without a single-task window.

``row_number() over (order by id)`` moves every row into one task.  Here the
position is built from two bounded steps instead:

1. rows are bucketed by ``id div bucket`` and counted per bucket (a partial
   aggregate); a running sum over the bucket counts gives each bucket's
   offset.  That window sees one row per bucket, not one per record.
2. the rank inside a bucket uses a window partitioned by the bucket, which by
   construction holds at most ``bucket`` rows (ids are unique per group).

position = offset(bucket) + rank inside bucket.  The order column must be an
integral id that is unique within each group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def dense_position(
    df: DataFrame,
    order_col: str,
    group_cols: Sequence[str] = (),
    name: str = "position",
    bucket: int = 1 << 16,
) -> DataFrame:
    """Add ``name`` = 1-based position of the row in ``order_col`` order within ``group_cols``."""
    groups = list(group_cols)
    b = F.floor(F.col(order_col) / F.lit(bucket)).alias("_bkt")
    keyed = df.withColumn("_bkt", b)
    counts = keyed.groupBy(*groups, "_bkt").agg(F.count(F.lit(1)).alias("_bn"))
    w_off = Window.partitionBy(*groups).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*groups, "_bkt", F.coalesce(F.sum("_bn").over(w_off), F.lit(0)).alias("_off"))
    w_in = Window.partitionBy(*groups, "_bkt").orderBy(order_col)
    ranked = keyed.withColumn("_r", F.row_number().over(w_in))
    out = ranked.join(offsets, on=[*groups, "_bkt"], how="inner")
    return out.withColumn(name, (F.col("_off") + F.col("_r")).cast("long")).drop("_bkt", "_r", "_off")


def top_k_per_group(
    df: DataFrame, group_cols: Sequence[str], order: Sequence, k: int, rank_name: str | None = None
) -> DataFrame:
    """Top ``k`` rows per group.  ``row_number() <= k`` is planned with a
    partial WindowGroupLimit before the shuffle, so each map task forwards at
    most ``k`` rows per group."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    name = rank_name or "_rk"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
    return out if rank_name else out.drop(name)
