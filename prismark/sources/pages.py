"""Page texts -> one document text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def assemble_pages(pages: DataFrame, doc_col: str = "doc_id", page_col: str = "page_no", text_col: str = "text") -> DataFrame:
    """Page texts of a document joined with ``\\n`` in page order.

    One group is one document's pages, so it is bounded by the document.
    """
    g = pages.groupBy(F.col(doc_col).alias("doc_id")).agg(
        F.sort_array(F.collect_list(F.struct(F.col(page_col).alias("p"), F.col(text_col).alias("t")))).alias("_p")
    )
    return g.select("doc_id", F.array_join(F.transform("_p", lambda s: F.coalesce(s["t"], F.lit(""))), "\n").alias("text"))
