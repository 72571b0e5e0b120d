"""Field rules of the sources (S9-S19) as column expressions over nested data."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from prismark.functions.text import NBSP


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def format_authors_xml(authors: Column | str) -> Column:
    """S9 (article XML): ``LastName ForeName``, else ``LastName``, else dropped; ``"; "``-joined.

    A present but empty fore name still counts as present.
    """
    names = F.transform(
        _c(authors),
        lambda a: F.when(a["LastName"].isNotNull() & a["ForeName"].isNotNull(),
                         F.concat(a["LastName"], F.lit(" "), a["ForeName"]))
        .when(a["LastName"].isNotNull(), a["LastName"]),
    )
    return F.array_join(F.filter(names, lambda s: s.isNotNull()), "; ")


def format_authors_csl(authors: Column | str) -> Column:
    """S9 (citation JSON): ``literal``, else ``family given``, else ``family``; ``"; "``-joined."""
    names = F.transform(
        _c(authors),
        lambda a: F.when(a["literal"].isNotNull(), a["literal"])
        .when(a["family"].isNotNull() & a["given"].isNotNull(), F.concat(a["family"], F.lit(" "), a["given"]))
        .when(a["family"].isNotNull(), a["family"]),
    )
    return F.array_join(F.filter(names, lambda s: s.isNotNull()), "; ")


def first_date_part(date_parts: Column | str) -> Column:
    """First element of the first date part, else null."""
    return F.try_element_at(F.try_element_at(_c(date_parts), F.lit(1)), F.lit(1))


YEAR_PATTERN = r"(?U)\b(19|20)\d{2}\b"


def parse_byline(text: Column | str, nbsp_to_space: bool = True) -> Column:
    """``authors - journal, year - publisher``; the year is searched in part 2 only.

    ``nbsp_to_space=True`` turns non-breaking spaces into spaces first (trap
    T3: otherwise ``" - "`` misses the first separator).
    Returns ``struct<authors, journal, year>``.
    """
    t = _c(text)
    if nbsp_to_space:
        t = F.translate(t, NBSP, " ")
    parts = F.split(t, " - ")
    p1 = F.try_element_at(parts, F.lit(1))
    p2 = F.try_element_at(parts, F.lit(2))
    year = F.regexp_extract(p2, YEAR_PATTERN, 0)
    return F.struct(p1.alias("authors"), p2.alias("journal"), F.when(year != "", year).alias("year"))


def parse_cited_by(link_texts: Column | str) -> Column:
    """The last link text containing ``Cited by``, without ``Cited by ``."""
    hits = F.filter(_c(link_texts), lambda s: s.contains("Cited by"))
    last = F.try_element_at(hits, F.lit(-1))
    return F.replace(last, F.lit("Cited by "), F.lit(""))


def join_sections(sections: Column | str) -> Column:
    """Abstract sections joined with a space."""
    return F.array_join(F.transform(_c(sections), lambda s: s["_VALUE"]), " ")


def pick_doi(article_ids: Column | str, elocations: Column | str, which: str = "last") -> Column:
    """DOI from the article id list, else from ELocationID.

    ``which='last'`` follows the collector (last match wins); ``'first'``
    follows the repair step.
    """
    pos = F.lit(-1) if which == "last" else F.lit(1)
    ids = F.filter(_c(article_ids), lambda a: a["_IdType"] == "doi")
    el = F.filter(_c(elocations), lambda a: a["_EIdType"] == "doi")
    return F.coalesce(F.try_element_at(ids, pos)["_VALUE"], F.try_element_at(el, pos)["_VALUE"])


def id_type_pubmed(elocations: Column | str) -> Column:
    """``PMID``, plus ``/DOI`` once per ELocation DOI (the collector appends in its loop)."""
    n = F.size(F.filter(F.coalesce(_c(elocations), F.array()), lambda a: a["_EIdType"] == "doi"))
    return F.concat(F.lit("PMID"), F.repeat(F.lit("/DOI"), n))


def join_labels(values: Column | str, field: str | None = None) -> Column:
    """A list of labels (or of structs' ``field``) as a ``"; "`` list."""
    v = _c(values)
    if field:
        v = F.transform(v, lambda s: s[field])
    return F.array_join(v, "; ")


def build_url(pmid: Column | str) -> Column:
    """S17."""
    return F.format_string("https://pubmed.ncbi.nlm.nih.gov/%s/", _c(pmid))


def parse_result_count(text: Column | str) -> Column:
    """``About 1,200 results`` / ``18 200 résultats`` -> 1200 / 18200; no match -> 0."""
    num = F.regexp_extract(_c(text), r"(?iU)([\d,\.\s]+)\s+(results|résultats)", 1)
    digits = F.regexp_replace(num, r"(?U)\D", "")
    return F.coalesce(digits.try_cast("long"), F.lit(0).cast("long"))


def fallback_if_blank(a: Column | str, b: Column | str) -> Column:
    """``a`` unless it is null or blank, else ``b``."""
    return F.coalesce(F.when(F.trim(_c(a)) != "", _c(a)), _c(b))
