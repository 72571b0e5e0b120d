"""Canonical bibliographic record and the one null rule applied at ingestion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The 27 canonical record fields, in the reference order.
RECORD_FIELDS = [
    "Source", "ID_Type", "DOI", "ID", "Title", "Abstract", "Authors", "Journal", "Year",
    "Volume", "Issue", "Pages", "URL", "Publication_Type", "Study_Type", "MeSH_Terms",
    "Keywords", "Open_Access", "PMC_Link", "PDF_Link", "Country", "Language",
    "Date_Online", "Date_Publication", "Citations_Scholar", "Funding", "Conflict_Interest",
]

RECORD_SCHEMA = T.StructType([T.StructField(name, T.StringType(), True) for name in RECORD_FIELDS])

SCREENED_FIELDS = ["Included", "Screening_Reason"]
DECISION_FIELD = "Manual_Decision"

# Source labels written by the two collectors.
SOURCE_PRIMARY = "PubMed"
SOURCE_SECONDARY = "Google Scholar"


def clean_null(c: Column) -> Column:
    """Blank or the text ``nan`` becomes null; everything else is trimmed."""
    t = F.trim(c)
    return F.when((t == "") | (F.lower(t) == "nan"), F.lit(None).cast("string")).otherwise(t)


def apply_null_rule(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Apply :func:`clean_null` to every string column (or the given ones)."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.select(*[clean_null(F.col(f"`{c}`")).alias(c) if c in names else F.col(f"`{c}`") for c in df.columns])


def year_as_int(c: Column) -> Column:
    """Year text (``2015``, ``2015.0``, blank) to a nullable int."""
    return c.try_cast("double").try_cast("int")
