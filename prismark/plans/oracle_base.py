"""SQL building blocks shared by the DuckDB oracle strings.

DuckDB's regex is RE2 (ASCII ``\\s``/``\\w``/``\\b``, replace needs ``'g'``);
the Spark side uses Java regex with ``(?U)``.  The oracle views below are the
DuckDB spelling of the same derived tables the Spark queries build.
"""

from __future__ import annotations

from prismark.plans.fixtures import articles_sql


def norm_title_sql(x: str) -> str:
    return (
        "trim(regexp_replace(regexp_replace(lower(coalesce(replace(" + x + ", chr(160), ' '), '')), "
        "'[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g'))"
    )


ARTICLES_CTE = "articles as (\n" + articles_sql() + "\n)"

# U1 over the articles view: primary = PubMed rows, secondary = the rest.
MERGED_CTES = (
    ARTICLES_CTE
    + ",\nkeyed as (select *, "
    + norm_title_sql("Title")
    + " as _k from articles),\n"
    "prim as (select * from keyed where Source = 'PubMed'),\n"
    "sec as (select * from keyed where Source <> 'PubMed' and _k <> ''),\n"
    "sec_first as (select * from sec qualify row_number() over (partition by _k order by article_id) = 1),\n"
    "added as (select * from sec_first s where not exists "
    "(select 1 from prim p where p._k = s._k and p._k <> '')),\n"
    "merged as (select * exclude (_k) from prim union all select * exclude (_k) from added)"
)


def with_articles(body: str) -> str:
    return "with " + ARTICLES_CTE + "\n" + body


def with_merged(body: str) -> str:
    return "with " + MERGED_CTES + "\n" + body


def with_records(body: str) -> str:
    from prismark.plans.fixtures import DOI_LOOKUP_EXPRS, RECORD_ID_EXPRS

    return (
        "with " + ARTICLES_CTE + ",\nrecords as (select *, " + ", ".join(RECORD_ID_EXPRS) + " from articles),\n"
        "doi_lookup as (select " + ", ".join(DOI_LOOKUP_EXPRS) + " from documents)\n" + body
    )


# DuckDB spelling of the screening step (gate + verdict parse) over a table with Abstract, raw_verdict.
def screened_select(src: str) -> str:
    content = ("regexp_replace(replace(replace(coalesce(raw_verdict, ''), '```json', ''), '```', ''), "
               "'^\\s+|\\s+$', '', 'g')")
    return (
        "c0 as (select *, " + content + " as _content from " + src + "), "
        "c1 as (select *, regexp_extract(_content, '(?s)\\{.*\\}', 0) as _span from c0), "
        "screened as (select * exclude (_content, _span), "
        "case when Abstract is null or length(Abstract) < 20 then false when _span = '' then false "
        "when not json_valid(_span) then false "
        "else coalesce(lower(json_extract_string(_span, '$.included')) = 'true', false) end as Included, "
        "case when Abstract is null or length(Abstract) < 20 then 'No Abstract' "
        "when _span = '' then 'LLM Error (Format): ' || substr(_content, 1, 50) || '...' "
        "when not json_valid(_span) then 'LLM Connection Error: invalid JSON' "
        "else coalesce(json_extract_string(_span, '$.reason'), 'No reason provided') end as Screening_Reason from c1)"
    )


# J2 over screened: reviewer input `decision` (y/yes/n/no, any case, trimmed) for included rows.
DECIDED_CTE = (
    "decided as (select *, case when Included then case when lower(trim(decision)) in ('y', 'yes') then 'Included' "
    "when lower(trim(decision)) in ('n', 'no') then 'Excluded' end end as Manual_Decision from screened)"
)
