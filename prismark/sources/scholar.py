"""Saved search-result pages -> one row per result (S5, then S11-S13 natively).

HTML parsing is the one per-row Python step here: ``mapInArrow`` over the
pages table with the standard library's ``html.parser``, emitting the raw
pieces of each result; the field rules that turn them into a record are
column expressions.
"""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from prismark.functions.fields import parse_byline, parse_cited_by

#: Pages whose results are Python objects at a time.
PARSED_PAGES = 64
RESULT_SCHEMA = (
    "page_id long, pos int, title string, link string, has_heading boolean, byline string, "
    "snippet string, footer_links array<string>, pdf_link string"
)

# Class names of the result blocks on a saved result page.
RESULT_CLASSES = {"gs_r", "gs_or", "gs_scl"}
TITLE_CLASS = "gs_rt"
BYLINE_CLASS = "gs_a"
SNIPPET_CLASS = "gs_rs"
FOOTER_CLASS = "gs_fl"
PDF_CLASS = "gs_or_ggsm"
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _ResultParser(HTMLParser):
    """Collects result blocks; each block records title, link, byline, snippet,
    footer link texts and the PDF link."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.results: list[dict] = []
        self.stack: list[tuple[str, set[str]]] = []
        self.cur: dict | None = None
        self.depth_result = -1
        self.field: str | None = None
        self.field_depth = -1
        self.in_a = False
        self.a_text: list[str] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        classes = set((a.get("class") or "").split())
        if tag in VOID:
            return
        self.stack.append((tag, classes))
        depth = len(self.stack)
        if tag == "div" and RESULT_CLASSES <= classes and self.cur is None:
            self.cur = {"title": None, "link": None, "has_heading": False, "byline": None, "snippet": None,
                        "footer_links": [], "pdf_link": None, "_t": [], "_b": [], "_s": []}
            self.depth_result = depth
            return
        if self.cur is None:
            return
        if tag == "h3" and TITLE_CLASS in classes and self.field is None:
            self.field, self.field_depth = "title", depth
            self.cur["has_heading"] = True
        elif tag == "div" and BYLINE_CLASS in classes and self.field is None:
            self.field, self.field_depth = "byline", depth
        elif tag == "div" and SNIPPET_CLASS in classes and self.field is None:
            self.field, self.field_depth = "snippet", depth
        elif tag == "div" and FOOTER_CLASS in classes and self.field is None:
            self.field, self.field_depth = "footer", depth
        elif tag == "div" and PDF_CLASS in classes and self.field is None:
            self.field, self.field_depth = "pdf", depth
        elif tag == "a":
            if self.field == "title" and self.cur["link"] is None and not self.in_a:
                self.cur["link"] = a.get("href")
                self.cur["_t_link"] = []
            if self.field == "pdf" and self.cur["pdf_link"] is None:
                self.cur["pdf_link"] = a.get("href") or ""
            self.in_a = True
            self.a_text = []

    def handle_endtag(self, tag):
        if tag in VOID or not self.stack:
            return
        depth = len(self.stack)
        if tag == "a" and self.cur is not None:
            if self.field == "footer":
                self.cur["footer_links"].append("".join(self.a_text))
            if self.field == "title" and "_t_link" in self.cur and self.cur.get("_link_done") is None:
                self.cur["_link_text"] = "".join(self.a_text)
                self.cur["_link_done"] = True
            self.in_a = False
        if self.field is not None and depth == self.field_depth:
            self.field, self.field_depth = None, -1
        if self.cur is not None and depth == self.depth_result:
            c = self.cur
            title_text = c.get("_link_text") if c["link"] is not None else ("".join(c["_t"]) if c["has_heading"] else None)
            self.results.append({
                "title": title_text, "link": c["link"], "has_heading": c["has_heading"],
                "byline": "".join(c["_b"]) if c["_b"] else None, "snippet": "".join(c["_s"]) if c["_s"] else None,
                "footer_links": c["footer_links"], "pdf_link": c["pdf_link"],
            })
            self.cur, self.depth_result = None, -1
        self.stack.pop()

    def handle_data(self, data):
        if self.cur is None:
            return
        if self.in_a:
            self.a_text.append(data)
        if self.field == "title":
            self.cur["_t"].append(data)
        elif self.field == "byline":
            self.cur["_b"].append(data)
        elif self.field == "snippet":
            self.cur["_s"].append(data)


def parse_result_page(html: str | None) -> list[dict]:
    p = _ResultParser()
    if html:
        p.feed(html)
        p.close()
    return p.results


def extract_search_results(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per result block ``(page_id, pos, title, link, has_heading, byline,
    snippet, footer_links, pdf_link)``; a few pages of an Arrow batch are parsed at a time."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, PARSED_PAGES):
                part = batch.slice(at, PARSED_PAGES)
                rows = [
                    {"page_id": pid, "pos": pos, **r}
                    for pid, html in zip(*(c.to_pylist() for c in part.columns)) for pos, r in enumerate(parse_result_page(html))
                ]
                yield pa.RecordBatch.from_pylist(rows, to_arrow_schema(kind))

    kind = T.StructType.fromDDL(RESULT_SCHEMA)
    return pages.select(F.col(id_col).cast("long").alias(id_col), html_col).mapInArrow(run, kind)


def scholar_records(results: DataFrame) -> DataFrame:
    """Result pieces -> canonical fields.

    Heading with a link -> ``ID_Type='URL'`` and ``ID`` = link; heading without
    one -> ``Publication_Type='Citation/Book'``; a PDF link -> ``Open_Access``.
    """
    by = parse_byline(F.col("byline"))
    has_link = F.col("link").isNotNull()
    return results.select(
        "page_id",
        "pos",
        F.lit("Google Scholar").alias("Source"),
        F.col("title").alias("Title"),
        F.when(has_link, F.col("link")).alias("URL"),
        F.when(has_link, F.lit("URL")).alias("ID_Type"),
        F.when(has_link, F.col("link")).alias("ID"),
        F.when(F.col("has_heading") & ~has_link, F.lit("Citation/Book")).alias("Publication_Type"),
        by["authors"].alias("Authors"),
        by["journal"].alias("Journal"),
        by["year"].alias("Year"),
        F.col("snippet").alias("Abstract"),
        parse_cited_by("footer_links").alias("Citations_Scholar"),
        F.col("pdf_link").alias("PDF_Link"),
        F.when(F.col("pdf_link").isNotNull(), F.lit("Likely (PDF found)")).alias("Open_Access"),
    )
