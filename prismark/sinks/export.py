"""Sinks: record tables and reference-manager export batches (K1-K6).

Upload itself is a network client and is not built; the batches are JSON
arrays ready for it, 50 items each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prismark.operators.ranking import dense_position
from prismark.operators.screen import included_flag


def write_records(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> bool:
    """K1: write a table (folders created); an empty input writes nothing.

    Returns whether anything was written.  Output is a directory of files;
    CSV gets a header and no byte-order mark, and keeps white space around values.
    """
    if df.isEmpty():
        return False
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    else:
        w.format(fmt).save(path)
    return True


def select_for_export(df: DataFrame, decision_col: str = "Manual_Decision") -> DataFrame:
    """K2: rows a human marked ``Included``; falls back to a case-insensitive match
    only when no exact one exists; without the decision column, ``Included == true``.

    The fallback is decided by one scalar (does any exact match exist), not by
    collecting anything.
    """
    if decision_col not in df.columns:
        return df.where(included_flag("Included"))
    d = F.col(decision_col)
    exact = F.coalesce(d == "Included", F.lit(False))
    loose = F.coalesce(F.lower(d.cast("string")) == "included", F.lit(False))
    any_exact = df.agg(F.max(exact.cast("int"))).scalar()
    return df.where(exact | (loose & (F.coalesce(any_exact, F.lit(0)) == 0)))


def _present(c: Column) -> Column:
    t = F.trim(c.cast("string"))
    return F.when((t != "") & (F.lower(t) != "nan"), t)


def parse_creators(authors: Column | str) -> Column:
    """K4: ``array<struct<creatorType, name, lastName, firstName>>``.

    Split on ``;``, trim, drop blanks; a name with a space -> ``name``, a
    single word -> ``lastName`` with an empty ``firstName``.
    """
    a = F.col(authors) if isinstance(authors, str) else authors
    names = F.filter(F.transform(F.split(F.coalesce(_present(a), F.lit("")), ";"), lambda s: F.trim(s)), lambda s: s != "")
    return F.transform(
        names,
        lambda s: F.struct(
            F.lit("author").alias("creatorType"),
            F.when(F.instr(s, " ") > 0, s).alias("name"),
            F.when(F.instr(s, " ") == 0, s).alias("lastName"),
            F.when(F.instr(s, " ") == 0, F.lit("")).alias("firstName"),
        ),
    )


def to_export_items(df: DataFrame, collection: str | None = None) -> DataFrame:
    """K3 (+K6): one item struct per row; missing fields are left out.

    ``title`` defaults to ``No Title``; ``date`` is the integer year as text.
    """
    year = F.col("Year").cast("string").try_cast("double").try_cast("long").cast("string")
    creators = parse_creators("Authors")
    item = F.struct(
        F.coalesce(_present(F.col("Title")), F.lit("No Title")).alias("title"),
        _present(F.col("DOI")).alias("DOI") if "DOI" in df.columns else F.lit(None).cast("string").alias("DOI"),
        _present(F.col("Abstract")).alias("abstractNote"),
        _present(F.col("Journal")).alias("publicationTitle"),
        year.alias("date"),
        _present(F.col("URL")).alias("url") if "URL" in df.columns else F.lit(None).cast("string").alias("url"),
        F.when(F.size(creators) > 0, creators).alias("creators"),
        (F.array(F.lit(collection)) if collection else F.lit(None).cast("array<string>")).alias("collections"),
    )
    return df.withColumn("item", item)


def tag_collection(items: DataFrame, name: str | None) -> DataFrame:
    """K6: attach a collection name to every item when one is given."""
    if not name:
        return items
    return items.withColumn("item", F.col("item").withField("collections", F.array(F.lit(name))))


def batch_items(items: DataFrame, order_col: str, size: int = 50) -> DataFrame:
    """K5: consecutive batches of ``size`` items in ``order_col`` order, each a JSON array.

    Batch ids come from :func:`dense_position` (no single-task window); each
    group then holds at most ``size`` items.
    """
    pos = dense_position(items, order_col, name="_pos")
    batch = F.floor((F.col("_pos") - 1) / size).cast("long").alias("batch")
    grouped = pos.groupBy(batch).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.min(order_col).alias("first_id"),
        F.max(order_col).alias("last_id"),
        F.sort_array(F.collect_list(F.struct("_pos", "item"))).alias("_items"),
    )
    return grouped.select(
        "batch", "n_items", "first_id", "last_id", F.to_json(F.transform("_items", lambda s: s["item"])).alias("payload")
    )
