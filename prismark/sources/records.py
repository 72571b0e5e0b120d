"""Record tables: CSV files (S1), missing sources (S2), conform (S6), per-source cap."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from prismark.operators.ranking import top_k_per_group
from prismark.schema import RECORD_FIELDS, RECORD_SCHEMA, clean_null

BOM = "\ufeff"


def read_records_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, an optional byte-order mark, quoted newlines and ``""`` quotes.

    Every column is read as text (no inference) and matched by name, so the
    column order of the file does not matter.
    """
    df = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )
    return df.toDF(*[c.lstrip(BOM) for c in df.columns])


def read_or_empty(spark: SparkSession, path: str, reader=read_records_csv) -> DataFrame:
    """A missing source becomes an empty canonical table; parse errors still raise."""
    try:
        return reader(spark, path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return spark.createDataFrame([], RECORD_SCHEMA)
        raise


def conform(df: DataFrame, source: str | None = None, keep_extra: bool = False) -> DataFrame:
    """The 27 canonical text columns in order (absent ones null), null rule applied.

    ``source`` fills ``Source`` where it is absent or blank.
    """
    cols = []
    for name in RECORD_FIELDS:
        if name in df.columns:
            c = clean_null(F.col(f"`{name}`").cast("string"))
        else:
            c = F.lit(None).cast("string")
        if name == "Source" and source is not None:
            c = F.coalesce(c, F.lit(source))
        cols.append(c.alias(name))
    extra = [F.col(f"`{c}`") for c in df.columns if c not in RECORD_FIELDS] if keep_extra else []
    return df.select(*cols, *extra)


def limit_per_source(df: DataFrame, n: int = 200, order: str = "rank", source_col: str = "Source") -> DataFrame:
    """The first ``n`` rows of each source by ``order`` (a top-k report per group)."""
    return top_k_per_group(df, [source_col], [F.asc(order)], n)
