"""Source merge and de-duplication.

Semantics: every primary row is kept as is (primary is not de-duplicated
against itself); a secondary row is added when its normalised title is
non-empty, absent from the primary titles, and it is the first secondary row
with that title in input order.

Plan shape at scale: the secondary side is first collapsed to one row per key
with ``min_by`` (a partial aggregate, so a key holding a third of all rows is
reduced map-side before any shuffle), then anti-joined to the distinct primary
keys.  Both join inputs then hold one row per key, so the join cannot skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prismark.functions.text import normalize_title

KEY = "_title_key"


def with_title_key(df: DataFrame, title_col: str = "Title") -> DataFrame:
    return df.withColumn(KEY, normalize_title(F.col(title_col)))


def first_wins(df: DataFrame, key: str | list[str], order: str | Column) -> DataFrame:
    """Keep the first row per key by ``order`` (ties must not exist in ``order``).

    Uses ``min_by(struct(all), order)`` rather than a ranking window, so hot
    keys are combined per map task instead of landing whole in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order_col = F.col(order) if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(f"`{c}`") for c in rest])
    out = df.groupBy(*keys).agg(F.min_by(packed, order_col).alias("_first"))
    return out.select(*keys, "_first.*").select(*df.columns)


def dedup_against(primary: DataFrame, secondary: DataFrame, key: str = KEY) -> DataFrame:
    """Secondary rows whose key does not occur in primary (left anti join)."""
    pkeys = primary.select(key).where(F.col(key) != "").distinct()
    return secondary.join(pkeys, on=key, how="left_anti")


def merge_sources(
    primary: DataFrame,
    secondary: DataFrame,
    order: str,
    title_col: str = "Title",
    keep_key: bool = False,
) -> DataFrame:
    """Primary whole, plus first-per-key secondary rows not seen in primary."""
    p = with_title_key(primary, title_col)
    s = with_title_key(secondary, title_col).where(F.col(KEY) != "")
    added = dedup_against(p, first_wins(s, KEY, order))
    out = p.unionByName(added, allowMissingColumns=True)
    return out if keep_key else out.drop(KEY)


def merge_by_source(
    records: DataFrame,
    order: str,
    primary_source: str = "PubMed",
    source_col: str = "Source",
    title_col: str = "Title",
) -> DataFrame:
    """U1 over one table that holds both sources (primary = ``primary_source``)."""
    is_primary = F.col(source_col) == primary_source
    return merge_sources(
        records.where(is_primary), records.where(~is_primary | F.col(source_col).isNull()), order, title_col
    )


def dedup_report(primary: DataFrame, secondary: DataFrame, order: str, title_col: str = "Title") -> DataFrame:
    """One row ``kept, removed, added, total``.

    ``removed`` counts secondary rows with a non-empty key that were not
    added; rows with an empty key are dropped and counted nowhere.
    """
    p = with_title_key(primary, title_col)
    s = with_title_key(secondary, title_col).where(F.col(KEY) != "")
    added = dedup_against(p, first_wins(s, KEY, order))
    kept = primary.agg(F.count(F.lit(1)).alias("n")).scalar()
    candidates = s.agg(F.count(F.lit(1)).alias("n")).scalar()
    return added.agg(F.count(F.lit(1)).alias("added")).select(
        kept.alias("kept"),
        (candidates - F.col("added")).alias("removed"),
        F.col("added"),
        (kept + F.col("added")).alias("total"),
    )
