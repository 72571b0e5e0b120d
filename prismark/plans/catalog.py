"""Registered queries: one Spark plan per SURVEY operator, each paired with the
DuckDB SQL that must give the same rows on the same tables.

Every query reads the driver's tables whole (``articles`` and the other views
are derivations of ``documents`` etc., no row is filtered away to make a
check cheap).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from prismark.functions.classify import classify_study_type, tag_populations
from prismark.operators import biblio, dedup
from prismark.plans import fixtures as fx
from prismark.functions.fields import fallback_if_blank
from prismark.plans.oracle_base import norm_title_sql, with_articles, with_merged
from prismark.session import checkpoint_dir
from prismark.sources.records import conform, read_or_empty

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def merged_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.merge_by_source(fx.articles(spark, sf_dir), order="article_id")


# --- U1 / G3: the flagship ------------------------------------------------------------

@register("decades_after_dedup", with_merged(
    "select cast(floor(Year / 10) * 10 as bigint) as decade, count(*) as n, "
    "round(count(*) * 100.0 / (select count(*) from merged), 6) as pct "
    "from merged where Year is not null group by 1"
))
def decades_after_dedup(spark, sf_dir):
    return biblio.by_decade(merged_articles(spark, sf_dir))


@register("merge_sources", with_merged("select article_id, Source, Title, Year from merged"))
def merge_sources_q(spark, sf_dir):
    return merged_articles(spark, sf_dir).select("article_id", "Source", "Title", "Year")


@register("dedup_report", with_merged(
    "select (select count(*) from prim) as kept, "
    "(select count(*) from sec) - (select count(*) from added) as removed, "
    "(select count(*) from added) as added, "
    "(select count(*) from prim) + (select count(*) from added) as total"
))
def dedup_report_q(spark, sf_dir):
    a = fx.articles(spark, sf_dir)
    p = a.where(F.col("Source") == "PubMed")
    s = a.where(F.col("Source") != "PubMed")
    return dedup.dedup_report(p, s, order="article_id")


@register("title_keys", with_articles(
    "select article_id, " + norm_title_sql("Title") + " as title_key from articles"
))
def title_keys(spark, sf_dir):
    from prismark.functions.text import normalize_title

    return fx.articles(spark, sf_dir).select("article_id", normalize_title("Title").alias("title_key"))


# --- G1, G2 -------------------------------------------------------------------------------

@register("corpus_size", with_merged("select count(*) as n_articles from merged"))
def corpus_size_q(spark, sf_dir):
    return biblio.corpus_size(merged_articles(spark, sf_dir))


@register("year_summary", with_merged(
    "select count(*) as n_with_year, cast(min(Year) as bigint) as year_min, "
    "cast(max(Year) as bigint) as year_max, cast(trunc(median(Year)) as bigint) as year_median "
    "from merged where Year is not null"
))
def year_summary_q(spark, sf_dir):
    return biblio.year_summary(merged_articles(spark, sf_dir))


# --- G4 / O2 / P13 ---------------------------------------------------------------------

@register("journal_counts", with_articles(
    "select lower(trim(Journal)) as value, count(*) as n, "
    "round(count(*) * 100.0 / (select count(*) from articles), 6) as pct "
    "from articles where Journal is not null group by 1"
))
def journal_counts(spark, sf_dir):
    return biblio.value_counts(fx.articles(spark, sf_dir), biblio.journal_key("Journal"), "value")


@register("top_journals", with_articles(
    "select lower(trim(Journal)) as journal, count(*) as n, "
    "round(count(*) * 100.0 / (select count(*) from articles), 6) as pct, "
    "substr(lower(trim(Journal)), 1, 60) as display "
    "from articles where Journal is not null group by 1 order by n desc, journal limit 10"
))
def top_journals_q(spark, sf_dir):
    return biblio.top_journals(fx.articles(spark, sf_dir), k=10)


# --- P11 / P12 with G4 / G5 -----------------------------------------------------------

_STUDY_SQL = """case when Abstract is null then 'Non spécifié'
 when contains(lower(Abstract), 'randomized') or contains(lower(Abstract), 'randomised') or contains(lower(Abstract), 'rct') or contains(lower(Abstract), 'random allocation') then 'RCT'
 when contains(lower(Abstract), 'systematic review') or contains(lower(Abstract), 'meta-analysis') or contains(lower(Abstract), 'meta analysis') then 'Review'
 when contains(lower(Abstract), 'qualitative') or contains(lower(Abstract), 'phenomenological') or contains(lower(Abstract), 'grounded theory') or contains(lower(Abstract), 'interview') then 'Qualitative'
 when contains(lower(Abstract), 'cohort') or contains(lower(Abstract), 'longitudinal') or contains(lower(Abstract), 'prospective') then 'Cohort/Longitudinal'
 when contains(lower(Abstract), 'cross-sectional') or contains(lower(Abstract), 'cross sectional') or contains(lower(Abstract), 'survey') then 'Cross-Sectional/Survey'
 when contains(lower(Abstract), 'case-control') or contains(lower(Abstract), 'case control') then 'Case-control'
 when contains(lower(Abstract), 'retrospective') or contains(lower(Abstract), 'chart review') or contains(lower(Abstract), 'medical record') then 'Rétrospective'
 when contains(lower(Abstract), 'quasi-experimental') or contains(lower(Abstract), 'quasi experimental') or contains(lower(Abstract), 'pilot') then 'QPilote'
 else 'Unspecified' end"""


@register("study_types", with_articles(
    "select " + _STUDY_SQL + " as study_type, count(*) as n, "
    "round(count(*) * 100.0 / (select count(*) from articles), 6) as pct from articles group by 1"
))
def study_types(spark, sf_dir):
    return biblio.value_counts(fx.articles(spark, sf_dir), classify_study_type("Abstract"), "study_type")


_POP_SQL = """case when Abstract is null then []::varchar[] else coalesce(nullif(list_filter([
 case when contains(lower(Abstract), 'stroke') or contains(lower(Abstract), 'cerebrovascular') then 'Stroke' end,
 case when contains(lower(Abstract), 'traumatic brain injury') or contains(lower(Abstract), 'tbi') or contains(lower(Abstract), 'head injury') then 'TBI' end,
 case when contains(lower(Abstract), 'subarachnoid hemorrhage') or contains(lower(Abstract), 'sah') or contains(lower(Abstract), 'aneurysm') then 'SAH' end,
 case when contains(lower(Abstract), 'brain tumor') or contains(lower(Abstract), 'glioma') or contains(lower(Abstract), 'neurosurgical') then 'Brain tumor' end,
 case when contains(lower(Abstract), 'cardiac arrest') or contains(lower(Abstract), 'resuscitation') then 'Cardiac Arrest' end,
 case when contains(lower(Abstract), 'palliative') or contains(lower(Abstract), 'end-of-life') or contains(lower(Abstract), 'withdrawal') then 'palliative care' end
 ], lambda x: x is not null), []), ['Unspecified']) end"""


@register("populations", with_articles(
    ", tagged as (select unnest(" + _POP_SQL + ") as label from articles) "
    "select label, count(*) as n, round(count(*) * 100.0 / (select count(*) from articles), 6) as pct "
    "from tagged group by 1"
))
def populations(spark, sf_dir):
    a = fx.articles(spark, sf_dir).withColumn("pops", tag_populations("Abstract"))
    return biblio.count_labels(a, "pops")


@register("article_study_labels", with_articles(
    "select article_id, " + _STUDY_SQL + " as study_type, array_to_string(" + _POP_SQL
    + ", '|') as populations from articles"
))
def article_study_labels(spark, sf_dir):
    return fx.articles(spark, sf_dir).select(
        "article_id",
        classify_study_type("Abstract").alias("study_type"),
        F.array_join(tag_populations("Abstract"), "|").alias("populations"),
    )


# --- G6 / G7 ---------------------------------------------------------------------------

@register("year_cluster_crosstab", with_articles(
    "select cast(Year as bigint) as year, cast(Cluster as bigint) as cluster, count(*) as n "
    "from articles where Year is not null and Cluster is not null group by 1, 2"
))
def year_cluster_crosstab(spark, sf_dir):
    a = fx.articles(spark, sf_dir)
    return biblio.crosstab_long(a, F.col("Year").cast("long"), F.col("Cluster").cast("long"), "year", "cluster")


@register("journal_cluster_min2", with_articles(
    ", ct as (select lower(trim(Journal)) as journal, "
    "count(*) filter (where Cluster = 0) as n_0, count(*) filter (where Cluster = 1) as n_1, "
    "count(*) filter (where Cluster = 2) as n_2 from articles "
    "where Journal is not null and Cluster is not null group by 1) "
    "select * from ct where n_0 + n_1 + n_2 >= 2"
))
def journal_cluster_min2(spark, sf_dir):
    a = fx.articles(spark, sf_dir)
    piv = biblio.crosstab(a, biblio.journal_key("Journal"), "Cluster", "journal", [0, 1, 2])
    return biblio.crosstab_min(piv, "journal", 2)


# --- G8 / G9 / O3 ----------------------------------------------------------------------

_AUTH_SPLIT_SQL = "list_filter(list_transform(regexp_split_to_array(Authors, '[;,]'), lambda s: trim(s)), lambda s: s <> '')"


@register("author_counts", with_articles(
    ", names as (select unnest(" + _AUTH_SPLIT_SQL + ") as author from articles where Authors is not null) "
    "select author, count(*) as n from names group by 1"
))
def author_counts_q(spark, sf_dir):
    return biblio.author_counts(fx.articles(spark, sf_dir))


@register("top_authors", with_articles(
    ", names as (select unnest(" + _AUTH_SPLIT_SQL + ") as author from articles where Authors is not null), "
    "top as (select author, count(*) as n from names group by 1 order by n desc, author limit 10), "
    "ranked as (select author, n, row_number() over (order by n desc, author) as rank from top) "
    "select * from ranked where length(author) >= 4"
))
def top_authors_q(spark, sf_dir):
    return biblio.top_authors(fx.articles(spark, sf_dir), k=10, min_len=4)


@register("author_stats", with_articles(
    ", names as (select unnest(list_filter(list_transform(string_split(Authors, ';'), lambda s: trim(s)), "
    "lambda s: s <> '')) as author from articles where Authors is not null) "
    "select count(*) as mentions, count(distinct author) as unique_authors, "
    "(select count(*) from articles) as n_articles, "
    "round(count(*) / (select count(*) from articles), 6) as mean_per_article from names"
))
def author_stats_q(spark, sf_dir):
    return biblio.author_stats(fx.articles(spark, sf_dir))


# --- G12 / G13 -------------------------------------------------------------------------

@register("cluster_sizes", with_articles(
    "select cast(Cluster as bigint) as cluster, count(*) as n from articles group by 1"
))
def cluster_sizes_q(spark, sf_dir):
    return biblio.cluster_sizes(fx.articles(spark, sf_dir).withColumn("Cluster", F.col("Cluster").cast("long")))


@register("cluster_corpus", with_articles(
    ", pos as (select cast(Cluster as bigint) as cluster, article_id, coalesce(Abstract, '') as t, "
    "row_number() over (partition by Cluster order by article_id) as p from articles) "
    "select cluster, cast(floor((p - 1) / 50) as bigint) as chunk, count(*) as n_docs, "
    "string_agg(t, chr(10) || chr(10) || '--- NEW ARTICLE ---' || chr(10) || chr(10) order by article_id) as corpus "
    "from pos group by 1, 2"
))
def cluster_corpus(spark, sf_dir):
    a = fx.articles(spark, sf_dir).withColumn("Cluster", F.col("Cluster").cast("long"))
    return biblio.concat_cluster_text(a, "Cluster", "article_id", "Abstract", docs_per_chunk=50)


# --- X4-X10, X13: text cleaning on whole documents ------------------------------------

from prismark.functions import text as tx  # noqa: E402
from prismark.functions.stopwords import (  # noqa: E402
    SUPPLEMENTARY_FULLTEXT,
    sql_list,
    stop_words,
)
from prismark.operators import features as ft  # noqa: E402

_LINES_SQL = (
    "list_filter(list_transform(string_split_regex(regexp_replace(replace(text, chr(160), ' '), '[ \\t]+', ' ', 'g'), "
    "'\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]'), lambda l: regexp_replace(l, '^\\s+|\\s+$', '', 'g')), "
    "lambda l: l <> '')"
)
_INTRO = "'(?i)(introduction|background)'"
_STOP = ("'(?i)(references|bibliography|literature cited)|(acknowledg(e)?ments?)|"
         "(supplementary( material)?|appendix|annexe[s]?)'")


@register("body_extraction", (
    "with l as (select doc_id, " + _LINES_SQL + " as lines from documents), "
    "p as (select doc_id, lines, coalesce(list_position(list_transform(lines, lambda x: regexp_full_match(x, "
    + _INTRO + ")), true), 0) as i from l), "
    "q as (select *, case when i = 0 then 0 else coalesce(list_position(list_transform(list_slice(lines, i + 1, len(lines)), "
    "lambda x: regexp_full_match(x, " + _STOP + ")), true), 0) end as j from p) "
    "select doc_id, array_to_string(case when i = 0 then lines when j = 0 then list_slice(lines, i, len(lines)) "
    "else list_slice(lines, i, i + j - 1) end, chr(10)) as body from q"
))
def body_extraction_q(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    return d.select("doc_id", tx.body_extraction("text").alias("body"))


# DuckDB's \\w, \\s and \\b are ASCII, so the classes are spelled out; it has no look-behind: a whole word is a run of word characters.
_W, _S = tx.WORD, tx.SPACE


@register("clean_text", (
    f"with a as (select doc_id, replace(regexp_replace(text, '-\\n([{_W}]+)', '\\1', 'g'), chr(10), ' ') as t from documents), "
    f"b as (select doc_id, regexp_replace(t, '{tx.citation_pattern()}', '', 'g') as t from a), "
    f"c as (select doc_id, regexp_replace(t, 'https?://[^{_S}]+|www\\.[^{_S}]+', '', 'g') as t from b), "
    f"e as (select doc_id, regexp_replace(regexp_replace(t, '(^|[^{_W}])(?i:doi):[{_S}]*[^{_S}]+', '\\1', 'g'), "
    f"'(^|[^{_W}])10\\.\\p{{Nd}}{{4,9}}/[^{_S}]*[{_W}]', '\\1', 'g') as t from c) "
    "select doc_id, t as cleaned from e"
))
def clean_text_q(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    return d.select("doc_id", tx.clean_text("text").alias("cleaned"))


FULLTEXT_STOP = stop_words(extra=SUPPLEMENTARY_FULLTEXT)
ABSTRACT_STOP = stop_words()


@register("stop_word_removal", (
    "select doc_id, array_to_string(list_filter(string_split_regex(lower(text), '[" + _S + "]+'), "
    "lambda w: w <> '' and not list_contains(" + sql_list(FULLTEXT_STOP) + ", w)), ' ') as filtered from documents"
))
def stop_word_removal(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    return d.select("doc_id", tx.remove_stop_words("text", FULLTEXT_STOP).alias("filtered"))


# --- M1-M3, O1, O4: TF-IDF over the whole document table ----------------------------

_TFIDF_CTES = (
    "with d as (select doc_id, text from documents), "
    "nd as (select count(*) as n from d), "
    "toks as (select doc_id, list_filter(regexp_extract_all(lower(text), '[" + _W + "]+'), "
    "lambda t: regexp_full_match(t, '[a-z]{3,}') and not list_contains(" + sql_list(ABSTRACT_STOP) + ", t)) as t from d), "
    "grams as (select doc_id, unnest(list_concat(t, "
    "list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]), "
    "list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]))) as term from toks), "
    "dt as (select doc_id, term, count(*) as cnt from grams group by 1, 2), "
    "stats as (select term, count(*) as df, cast(sum(cnt) as bigint) as tf from dt group by 1), "
    "vocab as (select term, df, tf, ln((1 + (select n from nd)) / (1 + df)) + 1 as idf from stats "
    "where df >= 2 and df <= 0.8 * (select n from nd) order by tf desc, term limit 200), "
    "raw as (select dt.doc_id, dt.term, dt.cnt * v.idf as w from dt join vocab v using (term)), "
    "weights as (select doc_id as doc, term, w / sqrt(sum(w * w) over (partition by doc_id)) as weight from raw) "
)


def _tfidf(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    return ft.tfidf(d, "doc_id", "text", ABSTRACT_STOP, max_features=200, min_df=2, max_df=0.8)


@register("tfidf_vocabulary", _TFIDF_CTES + "select term, df, tf, round(idf, 6) as idf from vocab")
def tfidf_vocabulary(spark, sf_dir):
    _, vocab, _ = _tfidf(spark, sf_dir)
    return vocab.select("term", "df", "tf", F.round("idf", 6).alias("idf"))


@register("tfidf_weights", _TFIDF_CTES + "select doc, term, round(weight, 6) as weight from weights")
def tfidf_weights(spark, sf_dir):
    w, _, _ = _tfidf(spark, sf_dir)
    return w.select("doc", "term", F.round("weight", 6).alias("weight"))


@register("mean_term_scores", _TFIDF_CTES
          + "select term, round(sum(weight) / (select n from nd), 6) as score from weights group by 1")
def mean_term_scores(spark, sf_dir):
    w, _, n = _tfidf(spark, sf_dir)
    return ft.mean_term_score(w, n).select("term", F.round("score", 6).alias("score"))


@register("top_terms", _TFIDF_CTES
          + ", s as (select term, sum(weight) / (select n from nd) as score from weights group by 1) "
          "select term, round(score, 6) as score from s order by score desc, term limit 20")
def top_terms_q(spark, sf_dir):
    w, _, n = _tfidf(spark, sf_dir)
    return ft.top_terms(ft.mean_term_score(w, n), 20).select("term", F.round("score", 6).alias("score"))


@register("top_terms_per_cluster", _TFIDF_CTES
          + ", lab as (select doc_id as doc, cast(doc_id % 3 as bigint) as cluster from documents), "
          "sz as (select cluster, count(*) as n_docs from lab group by 1), "
          "m as (select l.cluster, w.term, sum(w.weight) / any_value(sz.n_docs) as score from weights w "
          "join lab l using (doc) join sz using (cluster) group by 1, 2), "
          "r as (select *, row_number() over (partition by cluster order by score desc, term) as rank from m) "
          "select cluster, term, round(score, 6) as score, rank from r where rank <= 8")
def top_terms_per_cluster_q(spark, sf_dir):
    w, _, _ = _tfidf(spark, sf_dir)
    labels = fx.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("doc"), (F.col("doc_id") % 3).cast("long").alias("cluster")
    )
    out = ft.top_terms_per_cluster(w, labels, 8)
    return out.select("cluster", "term", F.round("score", 6).alias("score"), F.col("rank").cast("long"))


# --- M11 / M13: class-based TF-IDF over topics --------------------------------------

_CTFIDF_CTES = (
    "with d as (select cast(doc_id % 3 as bigint) as topic, text from documents), "
    "w as (select topic, unnest(regexp_extract_all(lower(text), '[" + _W + "]{2,}')) as term from d), "
    "c as (select topic, term, count(*) as cnt from w group by 1, 2), "
    "tt as (select topic, sum(cnt) as topic_words from c group by 1), "
    "a as (select floor(avg(topic_words)) as avg_words from tt), "
    "f as (select term, sum(cnt) as f from c group by 1), "
    "s as (select c.topic, c.term, c.cnt, sqrt(c.cnt / tt.topic_words) * "
    "ln(1 + ((select avg_words from a) - f.f + 0.5) / (f.f + 0.5)) as score "
    "from c join tt using (topic) join f using (term)) "
)


@register("class_tfidf_top_terms", _CTFIDF_CTES
          + ", r as (select *, row_number() over (partition by topic order by score desc, term) as rank from s) "
          "select topic, term, cnt, round(score, 6) as score, rank from r where rank <= 10")
def class_tfidf_top_terms(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents").withColumn("topic", (F.col("doc_id") % 3).cast("long"))
    scores = ft.class_tfidf(d, "text", "topic")
    out = ft.topic_terms(scores, 10)
    return out.select("topic", "term", "cnt", F.round("score", 6).alias("score"), F.col("rank").cast("long"))


# --- X16: word-cloud frequencies per cluster ------------------------------------------

@register("wordcloud_terms", (
    "with d as (select cast(doc_id % 3 as bigint) as cluster, text from documents), "
    "w as (select cluster, lower(regexp_replace(unnest(regexp_extract_all(text, '[" + _W + "][" + _W + "'']*')), '''s$', '')) as word from d), "
    "c as (select cluster, word, count(*) as n from w where not list_contains("
    + sql_list([x.lower() for x in ABSTRACT_STOP]) + ", word) and not regexp_full_match(word, '[0-9]+') and word <> '' "
    "group by 1, 2), "
    "r as (select *, row_number() over (partition by cluster order by n desc, word) as rank from c) "
    "select cluster, word, n, rank, round(n / max(n) over (partition by cluster), 6) as weight from r where rank <= 30"
))
def wordcloud_terms_q(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents").withColumn("cluster", (F.col("doc_id") % 3).cast("long"))
    out = ft.wordcloud_terms(d, "cluster", "text", ABSTRACT_STOP, 30)
    return out.select("cluster", "word", "n", F.col("rank").cast("long"), F.round("weight", 6).alias("weight"))


# --- P3-P10, J2, J6, G10, G11: screening and decisions ------------------------------

from prismark.operators import screen as sc  # noqa: E402
from prismark.plans.oracle_base import DECIDED_CTE, screened_select, with_records  # noqa: E402
from prismark.sinks import export as ex  # noqa: E402

CRITERIA = "Include studies about families of adult patients in neurocritical care; exclude paediatric settings."


def screened_articles(spark, sf_dir, base=None):
    return sc.screen(base if base is not None else fx.articles(spark, sf_dir))


def decided_articles(spark, sf_dir, base=None):
    s = screened_articles(spark, sf_dir, base)
    decisions = s.select("article_id", "decision")
    return sc.apply_decisions(s.drop("decision"), decisions)


@register("screening_verdicts", with_articles(
    ", " + screened_select("articles") + " select article_id, Included, Screening_Reason from screened"
))
def screening_verdicts(spark, sf_dir):
    return screened_articles(spark, sf_dir).select("article_id", "Included", "Screening_Reason")


_PROMPT_HEAD, _PROMPT_REST = sc.PROMPT_TEMPLATE.split("{title}")
_PROMPT_MID, _PROMPT_TAIL = _PROMPT_REST.split("{abstract}")


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@register("screening_prompts", with_articles(
    "select article_id, " + _sql_str(_PROMPT_HEAD.replace("{criteria}", CRITERIA)) + " || coalesce(Title, 'None') || "
    + _sql_str(_PROMPT_MID) + " || coalesce(Abstract, 'None') || "
    + _sql_str(_PROMPT_TAIL.replace("{{", "{").replace("}}", "}")) + " as prompt from articles"
))
def screening_prompts(spark, sf_dir):
    a = fx.articles(spark, sf_dir)
    return a.select("article_id", sc.screening_prompt(a, CRITERIA).alias("prompt"))


_CSV_FIELDS = ["Source", "Title", "Abstract", "Authors", "Journal", "Year"]


@register("records_round_trip", with_articles(
    "select " + ", ".join(f"case when trim(c_{c}) = '' or lower(trim(c_{c})) = 'nan' then null else trim(c_{c}) end as {c}" for c in _CSV_FIELDS)
    + " from (select " + ", ".join(f"cast({c} as varchar) as c_{c}" for c in _CSV_FIELDS) + " from articles)"
))
def records_round_trip(spark, sf_dir):
    """Records written as CSV and read back, beside a source that is missing and one that was empty."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/records-{uuid.uuid4().hex}"
    a = fx.articles(spark, sf_dir).select(*_CSV_FIELDS)
    ex.write_records(a, f"{folder}/found", "csv")
    ex.write_records(a.limit(0), f"{folder}/empty", "csv")
    parts = [conform(read_or_empty(spark, f"{folder}/{name}")) for name in ("found", "empty", "missing")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(*_CSV_FIELDS)


@register("fallback_links", with_records(
    "select article_id, case when trim(DOI) <> '' then DOI else URL end as link, "
    "case when trim(Abstract) <> '' then Abstract else Title end as summary from records"
))
def fallback_links(spark, sf_dir):
    """The address where there is no identifier, the title where there is no abstract."""
    r = fx.records(spark, sf_dir)
    return r.select("article_id", fallback_if_blank("DOI", "URL").alias("link"), fallback_if_blank("Abstract", "Title").alias("summary"))


@register("apply_decisions", with_articles(
    ", " + screened_select("articles") + ", " + DECIDED_CTE + " select article_id, Manual_Decision from decided"
))
def apply_decisions_q(spark, sf_dir):
    return decided_articles(spark, sf_dir).select("article_id", "Manual_Decision")


@register("review_queue", with_articles(
    ", " + screened_select("articles") + ", "
    "inc as (select *, row_number() over (order by article_id) as position, count(*) over () as total "
    "from screened where Included) "
    "select article_id, position, total, Title, Journal, Year, Screening_Reason from inc "
    "where not coalesce(lower(decision) in ('y', 'n', 'yes', 'no', 'included', 'excluded'), false)"
))
def review_queue(spark, sf_dir):
    s = screened_articles(spark, sf_dir)
    q = sc.undecided(s, decision_col="decision")
    return q.select("article_id", "position", "total", "Title", "Journal", "Year", "Screening_Reason")


@register("decision_counts", with_articles(
    ", " + screened_select("articles") + ", " + DECIDED_CTE + " select count(*) filter (where Manual_Decision = 'Included') "
    "as n_included, count(*) filter (where Manual_Decision = 'Excluded') as n_excluded from decided"
))
def decision_counts_q(spark, sf_dir):
    return biblio.decision_counts(decided_articles(spark, sf_dir))


@register("resume_unscreened", with_articles(
    ", " + screened_select("articles") + " select article_id from articles a where not exists "
    "(select 1 from screened s where s.article_id = a.article_id and s.Included is not null "
    "and s.Screening_Reason not like 'LLM%')"
))
def resume_unscreened(spark, sf_dir):
    a = fx.articles(spark, sf_dir)
    done = screened_articles(spark, sf_dir).where(
        F.col("Included").isNotNull() & ~F.col("Screening_Reason").startswith("LLM")
    )
    return sc.drop_screened(a, done).select("article_id")


@register("prisma_flow", with_merged(
    ", " + screened_select("merged") + ", " + DECIDED_CTE + ", "
    "st as (select 0 as step, 'identified' as stage, (select count(*) from articles) as n "
    "union all select 1, 'after deduplication', (select count(*) from merged) "
    "union all select 2, 'after model screening', (select count(*) from screened where Included) "
    "union all select 3, 'after human selection', (select count(*) from decided where Manual_Decision = 'Included')) "
    "select cast(step as bigint) as step, stage, n, case when lag(n) over (order by step) is null then null "
    "else round((lag(n) over (order by step) - n) * 100.0 / lag(n) over (order by step), 6) end as reduction_pct from st"
))
def prisma_flow_q(spark, sf_dir):
    a = fx.articles(spark, sf_dir)
    m = merged_articles(spark, sf_dir)
    s = sc.screen(m)
    d = sc.apply_decisions(s.drop("decision"), s.select("article_id", "decision"))
    return biblio.prisma_flow([
        ("identified", a),
        ("after deduplication", m),
        ("after model screening", s.where(F.col("Included"))),
        ("after human selection", d.where(F.col("Manual_Decision") == "Included")),
    ])


# --- P10 / J3: DOI repair -------------------------------------------------------------

@register("needs_doi", with_records(
    "select article_id, ID from records where (Source = 'PubMed' or coalesce(contains(ID_Type, 'PMID'), false)) "
    "and (DOI is null or DOI = '' or DOI = 'nan') and regexp_full_match(trim(ID), '\\d+')"
))
def needs_doi_q(spark, sf_dir):
    return sc.needs_doi(fx.records(spark, sf_dir)).select("article_id", "ID")


@register("repair_dois", with_records(
    ", need as (select article_id, ID from records where (Source = 'PubMed' or coalesce(contains(ID_Type, 'PMID'), false)) "
    "and (DOI is null or DOI = '' or DOI = 'nan') and regexp_full_match(trim(ID), '\\d+')), "
    "lk as (select pmid, min(doi) as doi from doi_lookup where doi is not null and doi <> '' group by 1), "
    "fixed as (select r.article_id, coalesce(case when n.article_id is not null then lk.doi end, r.DOI) as DOI, "
    "n.article_id is not null and lk.doi is not null as updated, r.ID from records r "
    "left join need n using (article_id) left join lk on lk.pmid = trim(r.ID)) "
    "select article_id, DOI, updated, count(distinct ID) filter (where updated) over () as updated_ids from fixed"
))
def repair_dois_q(spark, sf_dir):
    from prismark.operators import enrich

    out = enrich.repair_dois(fx.records(spark, sf_dir), fx.doi_lookup(spark, sf_dir))
    return out.select("article_id", "DOI", "updated", "updated_ids")


# --- K2-K6: export ------------------------------------------------------------------

_EXPORT_CTE = (
    ", " + screened_select("records") + ", " + DECIDED_CTE + ", "
    "sel as (select * from decided where Manual_Decision = 'Included' or (lower(Manual_Decision) = 'included' "
    "and not exists (select 1 from decided where Manual_Decision = 'Included'))) "
)


def _selected(spark, sf_dir):
    return ex.select_for_export(decided_articles(spark, sf_dir, fx.records(spark, sf_dir)))


@register("export_selection", with_records(_EXPORT_CTE + "select article_id from sel"))
def export_selection(spark, sf_dir):
    return _selected(spark, sf_dir).select("article_id")


_CREATORS_SQL = "list_filter(list_transform(string_split(coalesce(Authors, ''), ';'), lambda s: trim(s)), lambda s: s <> '')"


def _present_sql(c: str) -> str:
    return f"case when trim({c}) <> '' and lower(trim({c})) <> 'nan' then trim({c}) end"


@register("export_items", with_records(
    _EXPORT_CTE + "select article_id, coalesce(" + _present_sql("Title") + ", 'No Title') as title, "
    + _present_sql("DOI") + " as DOI, " + _present_sql("Abstract") + " as abstractNote, "
    + _present_sql("Journal") + " as publicationTitle, cast(Year as varchar) as date, "
    + _present_sql("URL") + " as url, len(" + _CREATORS_SQL + ") as n_creators, "
    "array_to_string(list_transform(" + _CREATORS_SQL + ", lambda s: case when contains(s, ' ') then 'name:' || s "
    "else 'lastName:' || s end), '|') as creators, 'Review' as collection from sel"
))
def export_items(spark, sf_dir):
    items = ex.tag_collection(ex.to_export_items(_selected(spark, sf_dir)), "Review")
    it = F.col("item")
    creators = F.coalesce(it["creators"], F.array().cast("array<struct<creatorType:string,name:string,lastName:string,firstName:string>>"))
    return items.select(
        "article_id",
        it["title"].alias("title"),
        it["DOI"].alias("DOI"),
        it["abstractNote"].alias("abstractNote"),
        it["publicationTitle"].alias("publicationTitle"),
        it["date"].alias("date"),
        it["url"].alias("url"),
        F.size(creators).cast("long").alias("n_creators"),
        F.array_join(F.transform(creators, lambda c: F.when(c["name"].isNotNull(), F.concat(F.lit("name:"), c["name"]))
                                 .otherwise(F.concat(F.lit("lastName:"), c["lastName"]))), "|").alias("creators"),
        F.element_at(it["collections"], 1).alias("collection"),
    )


@register("export_batches", with_records(
    _EXPORT_CTE + ", p as (select article_id, row_number() over (order by article_id) as pos from sel) "
    "select cast(floor((pos - 1) / 50) as bigint) as batch, count(*) as n_items, min(article_id) as first_id, "
    "max(article_id) as last_id from p group by 1"
))
def export_batches(spark, sf_dir):
    items = ex.to_export_items(_selected(spark, sf_dir))
    return ex.batch_items(items, "article_id", 50).select("batch", "n_items", "first_id", "last_id")


# --- N1-N8: co-author graph on lineitem (order = article, supplier = author) ----------

from prismark.operators import graph as gr  # noqa: E402

_POS_SQL = (
    "with pos as (select l_orderkey as doc, l_linenumber as pos, cast(l_suppkey as varchar) as author from lineitem), "
    "nodes as (select author, count(*) as publications from pos group by 1), "
    "edges as (select least(x.author, y.author) as a, greatest(x.author, y.author) as b, count(*) as weight "
    "from pos x join pos y on x.doc = y.doc and x.pos < y.pos group by 1, 2), "
    "top30 as (select author from nodes order by publications desc, author limit 30), "
    "sub as (select * from edges where a in (select author from top30) and b in (select author from top30)) "
)


def _positions(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    return gr.positions_from_rows(li, "l_orderkey", "l_linenumber", "l_suppkey")


@register("coauthor_nodes", _POS_SQL + "select author, publications from nodes")
def coauthor_nodes_q(spark, sf_dir):
    return gr.coauthor_nodes(_positions(spark, sf_dir))


@register("coauthor_edges", _POS_SQL + "select a, b, weight from edges")
def coauthor_edges_q(spark, sf_dir):
    return gr.coauthor_edges(_positions(spark, sf_dir))


@register("graph_stats", _POS_SQL + "select (select count(*) from nodes) as nodes, count(*) as edges, "
          "round(count(*) * 2.0 / ((select count(*) from nodes) * ((select count(*) from nodes) - 1)), 6) as density "
          "from edges")
def graph_stats_q(spark, sf_dir):
    p = _positions(spark, sf_dir)
    return gr.graph_stats(gr.coauthor_nodes(p), gr.coauthor_edges(p))


@register("top_nodes", _POS_SQL + "select author, publications from nodes order by publications desc, author limit 30")
def top_nodes_q(spark, sf_dir):
    return gr.top_nodes(gr.coauthor_nodes(_positions(spark, sf_dir)), 30)


@register("induced_subgraph", _POS_SQL + "select a, b, weight from sub")
def induced_subgraph_q(spark, sf_dir):
    p = _positions(spark, sf_dir)
    return gr.induced_subgraph(gr.coauthor_edges(p), gr.top_nodes(gr.coauthor_nodes(p), 30))


@register("modularity_by_nation", _POS_SQL + ", lab as (select cast(s_suppkey as varchar) as node, s_nationkey as community "
          "from supplier), la as (select e.a, e.b, x.community as ca, y.community as cb from edges e "
          "join lab x on x.node = e.a join lab y on y.node = e.b), "
          "deg as (select node, count(*) as deg from (select a as node from edges union all select b from edges) group by 1), "
          "dc as (select community, sum(deg) as d_c from deg join lab using (node) group by 1), "
          "lc as (select ca as community, count(*) as l_c from la where ca = cb group by 1) "
          "select round(sum(coalesce(l_c, 0) / (select count(*) from edges) "
          "- pow(d_c / (2.0 * (select count(*) from edges)), 2)), 6) as modularity from dc left join lc using (community)")
def modularity_by_nation(spark, sf_dir):
    p = _positions(spark, sf_dir)
    labels = fx.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("node"), F.col("s_nationkey").alias("community")
    )
    return gr.modularity(gr.coauthor_edges(p), labels)


@register("top_author_concentration", _POS_SQL + ", top3 as (select author from nodes order by publications desc, "
          "author limit 3) select count(distinct doc) as n, round(count(distinct doc) * 100.0 / "
          "(select count(distinct l_orderkey) from lineitem), 6) as pct from pos where author in (select author from top3)")
def top_author_concentration(spark, sf_dir):
    p = _positions(spark, sf_dir)
    n_articles = p.agg(F.count_distinct("doc")).scalar()
    return gr.author_concentration(p, gr.top_nodes(gr.coauthor_nodes(p), 3).select("author"), n_articles)


@register("communities_top30")
def communities_top30(spark, sf_dir):
    """N5 + N7 on the top-30 induced subgraph (iterative; rows-only check)."""
    p = _positions(spark, sf_dir)
    top = gr.top_nodes(gr.coauthor_nodes(p), 30)
    return gr.community_members(gr.communities(gr.induced_subgraph(gr.coauthor_edges(p), top), top.select("author")))


@register("community_invariants", (
    "with pos as (select l_orderkey as doc, l_linenumber as pos, cast(l_suppkey as varchar) as author from lineitem) "
    "select least(count(distinct author), 30) as n_nodes, cast(0 as bigint) as repeated, cast(0 as bigint) as wrong_sizes, "
    "true as gains from pos"
))
def community_invariants(spark, sf_dir):
    """N5, N7 held against what defines them: every node once, sizes as counted, modularity (N6) not below one community's."""
    p = _positions(spark, sf_dir)
    top = gr.top_nodes(gr.coauthor_nodes(p), 30)
    edges = gr.induced_subgraph(gr.coauthor_edges(p), top)
    return gr.community_invariants(edges, gr.communities(edges, top.select("author")))


@register("coauthor_edges_articles", with_articles(
    ", pos as (select article_id as doc, p.pos as pos, p.author as author from articles, "
    "unnest(list_transform(list_filter(list_transform(string_split(Authors, ';'), lambda s: trim(s)), "
    "lambda s: s <> ''), lambda x, i: {'pos': i, 'author': x})) as t(p)) "
    "select least(x.author, y.author) as a, greatest(x.author, y.author) as b, count(*) as weight "
    "from pos x join pos y on x.doc = y.doc and x.pos < y.pos group by 1, 2"
))
def coauthor_edges_articles(spark, sf_dir):
    p = gr.author_positions(fx.articles(spark, sf_dir), "article_id", "Authors")
    return gr.coauthor_edges(p)


# --- M4-M8, M12, M14-M16: clustering and topics over embeddings ----------------------

from prismark.operators import cluster as cl  # noqa: E402
from prismark.operators import topics as tp  # noqa: E402

_EMB_CTES = (
    "with x as (select vec_id, label, cast(unnest(embedding) as double) as v, "
    "unnest(range(1, len(embedding) + 1)) as i from embeddings), "
    "pn as (select vec_id, label, list_sum(list_transform(embedding, lambda t: cast(t as double) * cast(t as double))) "
    "as nv from embeddings), "
    "cs as (select label, i, sum(v) as s, count(*) as n from x group by 1, 2), "
    "cn as (select label, count(*) as n, sum(nv) as q from pn group by 1) "
)


@register("silhouette_by_label", _EMB_CTES + (
    ", dots as (select x.vec_id, cs.label as cl, sum(x.v * cs.s) as dot from x join cs using (i) group by 1, 2), "
    "md as (select d.vec_id, p.label, d.cl, cn.n * p.nv - 2 * d.dot + cn.q as tot, cn.n from dots d "
    "join pn p using (vec_id) join cn on cn.label = d.cl), "
    "ab as (select vec_id, max(case when cl = label then tot / (n - 1) end) as a, "
    "max(case when cl = label then n end) as own_n, min(case when cl <> label then tot / n end) as b from md group by 1), "
    "s as (select case when own_n <= 1 or b is null then 0 else (b - a) / greatest(a, b) end as s from ab) "
    "select round(avg(s), 6) as silhouette from s"
))
def silhouette_by_label(spark, sf_dir):
    return cl.silhouette_sqeuclidean(fx.table(spark, sf_dir, "embeddings"), "embedding", "label")


@register("nearest_centroid", _EMB_CTES + (
    ", cent as (select label, i, s / n as c from cs), "
    "d as (select x.vec_id, cent.label as cl, sum((x.v - cent.c) * (x.v - cent.c)) as d from x join cent using (i) "
    "group by 1, 2), r as (select vec_id, cl, row_number() over (partition by vec_id order by d, cl) as rn from d) "
    "select e.vec_id, e.label, r.cl as cluster from embeddings e join r using (vec_id) where rn = 1"
))
def nearest_centroid(spark, sf_dir):
    e = fx.table(spark, sf_dir, "embeddings")
    cents = cl.centroids_from_labels(e, "embedding", "label")
    return cl.assign_nearest(e, "embedding", cents).select("vec_id", "label", "cluster")


@register("kmeans_clusters")
def kmeans_clusters(spark, sf_dir):
    """M4: k-means (k=10, seed 42, best of 3 starts); rows-only check."""
    e = fx.table(spark, sf_dir, "embeddings")
    labelled, _ = cl.kmeans(e, "embedding", k=10, seed=42, n_init=3)
    return labelled.select("vec_id", "label", "cluster")


@register("kmeans_invariants", "select count(*) as n, cast(10 as bigint) as clusters, cast(0 as bigint) as misplaced, "
          "cast(0 as bigint) as off_centre from embeddings")
def kmeans_invariants(spark, sf_dir):
    """M4 held against what defines a fit: rows beside their nearest centroid (M7), and centroids beside the mean of their rows."""
    e = fx.table(spark, sf_dir, "embeddings")
    labelled, cents = cl.kmeans(e, "embedding", k=10, seed=42)
    return cl.fit_invariants(labelled, "embedding", cents, "cluster", slack=0.01)


@register("choose_k")
def choose_k_q(spark, sf_dir):
    """M6: silhouette for k = 2..7 and the best k; rows-only check."""
    return cl.choose_k(fx.table(spark, sf_dir, "embeddings"), "embedding", range(2, 8))


@register("pca_embeddings")
def pca_embeddings(spark, sf_dir):
    """M8: PCA to 5 dimensions; rows-only check."""
    e = fx.table(spark, sf_dir, "embeddings")
    return cl.reduce_dimensions(e, "embedding", 5).select("vec_id", "reduced")


@register("topic_probabilities", _EMB_CTES + (
    ", cent as (select label, i, s / n as c from cs), "
    "cn2 as (select label, sqrt(sum(c * c)) as cn from cent group by 1), "
    "d as (select x.vec_id, cent.label as topic, sum(x.v * cent.c) as dot from x join cent using (i) group by 1, 2), "
    "sim as (select d.vec_id, d.topic, greatest(d.dot / (sqrt(pn.nv) * cn2.cn), 0) as sim from d "
    "join pn using (vec_id) join cn2 on cn2.label = d.topic) "
    "select vec_id as id, topic, round(case when sum(sim) over (partition by vec_id) > 0 "
    "then sim / sum(sim) over (partition by vec_id) else 0 end, 6) as probability from sim"
))
def topic_probabilities_q(spark, sf_dir):
    e = fx.table(spark, sf_dir, "embeddings")
    out = tp.topic_probabilities(e, "embedding", "label", "vec_id")
    return out.select("id", "topic", F.round("probability", 6).alias("probability"))


@register("documents_of_topic", "select vec_id from embeddings where label = 3")
def documents_of_topic_q(spark, sf_dir):
    return tp.documents_of_topic(fx.table(spark, sf_dir, "embeddings"), "label", 3).select("vec_id")


def _ctfidf_docs(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents").withColumn("topic", (F.col("doc_id") % 3).cast("long"))
    return d, ft.class_tfidf(d, "text", "topic")


@register("topic_info", _CTFIDF_CTES + (
    ", sz as (select topic, count(*) as count from d group by 1), "
    "ids as (select topic, count, cast(row_number() over (order by count desc, topic) - 1 as bigint) as new_topic from sz), "
    "r as (select topic, term, row_number() over (partition by topic order by score desc, term) as rank from s), "
    "wd as (select topic, list(term order by rank) as words from r where rank <= 10 group by 1) "
    "select new_topic as topic, ids.topic as original_topic, count, "
    "cast(new_topic as varchar) || '_' || array_to_string(words[1:4], '_') as name, "
    "array_to_string(words, ' ') as representation from ids left join wd using (topic)"
))
def topic_info_q(spark, sf_dir):
    d, scores = _ctfidf_docs(spark, sf_dir)
    return tp.topic_info(d, "topic", scores, 10)


@register("topic_distance", _CTFIDF_CTES + (
    ", nrm as (select topic, sqrt(sum(score * score)) as nrm from s group by 1), "
    "dots as (select a.topic as topic_a, b.topic as topic_b, sum(a.score * b.score) as dot from s a "
    "join s b using (term) group by 1, 2) "
    "select topic_a, topic_b, round(dot / (na.nrm * nb.nrm), 6) as similarity from dots "
    "join nrm na on na.topic = topic_a join nrm nb on nb.topic = topic_b"
))
def topic_distance_q(spark, sf_dir):
    _, scores = _ctfidf_docs(spark, sf_dir)
    out = tp.topic_distance(scores)
    return out.select("topic_a", "topic_b", F.round("similarity", 6).alias("similarity"))


# --- J4 / J5: fuzzy title match and enrichment (Scholar records against a PubMed catalogue) --

from prismark.operators import enrich as en  # noqa: E402


def _works(spark, sf_dir):
    a = fx.articles(spark, sf_dir).where(F.col("Source") == "PubMed")
    return a.select(
        F.col("article_id").alias("work_id"),
        F.col("Title").alias("title"),
        F.concat(F.lit("10.5555/work."), F.col("article_id").cast("string")).alias("DOI"),
        F.concat(F.lit("<jats:p>"), F.col("Abstract"), F.lit("</jats:p>")).alias("abstract"),
        F.trim("Journal").alias("container_title"),
        F.col("Year").alias("year"),
    )


def _match_records(spark, sf_dir):
    a = fx.records(spark, sf_dir).where(F.col("Source") == "Google Scholar")
    return a.withColumn("Abstract", F.concat("Abstract", F.lit("...")))


# Pairs that can reach the ratio: equal lower-cased titles, or lengths in the band and a Levenshtein distance (with all
# non-ASCII characters made one, which cannot raise it) no larger than the insertions and deletions that the ratio allows.
# The LCS of these few is found by a recursive CTE: k[l] is where the shortest prefix of one title ends that has a common
# subsequence of length l with the characters of the other read so far.
_MATCH_CTES = (
    "recs as (select article_id, lower(Title) as t from records where Source = 'Google Scholar' and length(lower(Title)) >= 10),\n"
    "works as (select article_id as work_id, lower(Title) as t, '10.5555/work.' || cast(article_id as varchar) as DOI, "
    "'<jats:p>' || Abstract || '</jats:p>' as abstract, trim(Journal) as container_title, Year as year "
    "from records where Source = 'PubMed'),\n"
    "rt as (select distinct t, regexp_replace(t, '[^\\x00-\\x7F]', '~', 'g') as p from recs),\n"
    "wt as (select t, min(work_id) as work_id, regexp_replace(t, '[^\\x00-\\x7F]', '~', 'g') as p from works where t is not null group by t),\n"
    "cand as (select rt.t as a, wt.t as b, work_id, length(rt.t) + length(wt.t) as s from rt join wt on rt.t <> wt.t "
    "and 1000 * abs(length(rt.t) - length(wt.t)) <= 195 * (length(rt.t) + length(wt.t)) "
    "and 1000 * levenshtein(rt.p, wt.p) <= 195 * (length(rt.t) + length(wt.t))),\n"
    "z(a, b, i, k) as (select a, b, 0, []::bigint[] from cand union all "
    "select a, b, i + 1, list_filter(list_transform(range(1, len(k) + 2), lambda l: least(k[l], "
    "case when instr(substr(a, case when l = 1 then 1 else k[l - 1] + 1 end), substr(b, i + 1, 1)) > 0 "
    "then instr(substr(a, case when l = 1 then 1 else k[l - 1] + 1 end), substr(b, i + 1, 1)) "
    "+ case when l = 1 then 0 else k[l - 1] end end)), lambda x: x is not null) from z where i < length(b)),\n"
    "scored as (select cand.a, work_id, 200 * len(k) as x, s from z join cand on cand.a = z.a and cand.b = z.b where i = length(z.b)),\n"
    "ratios as (select a, work_id, x // s + case when 2 * (x % s) > s or (2 * (x % s) = s and (x // s) % 2 = 1) then 1 else 0 end as ratio "
    "from scored union all select rt.t, work_id, 100 from rt join wt on rt.t = wt.t),\n"
    "best as (select a, work_id, cast(ratio as integer) as ratio from ratios where ratio > 80 "
    "qualify row_number() over (partition by a order by ratio desc, work_id) = 1),\n"
    "matches as (select article_id, work_id, ratio from recs join best on best.a = recs.t)\n"
)


def _with_matches(body: str) -> str:
    return "with recursive " + with_records("").removeprefix("with ").rstrip() + ",\n" + _MATCH_CTES + body


@register("title_match", _with_matches("select * from matches"))
def title_match(spark, sf_dir):
    """Best work per record with ratio > 80, over all works."""
    return en.match_by_title(_match_records(spark, sf_dir), _works(spark, sf_dir))


def _blank_sql(x: str) -> str:
    return f"({x} is null or trim({x}) = '' or lower(trim({x})) = 'nan')"


@register("enrich_records", _with_matches(
    "select r.article_id, case when fill and ID_Type = 'URL' then 'DOI' else ID_Type end as ID_Type, "
    "case when fill and ID_Type = 'URL' then w.DOI else r.ID end as ID, case when fill then w.DOI else r.DOI end as DOI, "
    "case when w.work_id is not null and not " + _blank_sql("w.abstract") + " "
    "then trim(regexp_replace(w.abstract, '<[^>]+>', '', 'g')) else r.Abstract || '...' end as Abstract, "
    "case when w.work_id is not null and " + _blank_sql("r.Journal") + " then w.container_title else r.Journal end as Journal, "
    "case when w.work_id is not null and r.Year is null then cast(w.year as varchar) else cast(r.Year as varchar) end as Year "
    "from (select records.*, matches.work_id, " + _blank_sql("DOI") + " and matches.work_id is not null as fill "
    "from records left join matches using (article_id) where Source = 'Google Scholar') r left join works w on w.work_id = r.work_id"
))
def enrich_records(spark, sf_dir):
    """J5 over the J4 matches."""
    recs = _match_records(spark, sf_dir)
    works = _works(spark, sf_dir)
    m = en.match_by_title(recs, works)
    out = en.enrich(recs, m, works)
    return out.select("article_id", "ID_Type", "ID", "DOI", "Abstract", "Journal", "Year")


# --- S1-S19: sources, checked by rendering articles and parsing them back ------------

from prismark.functions import fields as fl  # noqa: E402
from prismark.sources import csl as src_csl  # noqa: E402
from prismark.sources import pages as src_pages  # noqa: E402
from prismark.sources import pubmed as src_pubmed  # noqa: E402
from prismark.sources import records as src_records  # noqa: E402
from prismark.sources import scholar as src_scholar  # noqa: E402


@register("scholar_results", with_articles(
    ", r as (select article_id, cast(floor(article_id / 10) as bigint) as page_id, cast(article_id % 10 as int) as pos, "
    "Title, case when article_id % 7 <> 0 then 'https://scholar.example.org/' || cast(article_id as varchar) end as link, "
    "replace(Authors, ';', ',') as Authors, trim(Journal) || coalesce(', ' || cast(Year as varchar), '') as Journal, "
    "coalesce(Abstract, '') as snip from articles) "
    "select page_id, pos, 'Google Scholar' as Source, Title, link as URL, case when link is not null then 'URL' end as ID_Type, "
    "link as ID, case when link is null then 'Citation/Book' end as Publication_Type, Authors, Journal, "
    "nullif(regexp_extract(Journal, '\\b(19|20)\\d{2}\\b', 0), '') as Year, nullif(snip, '') as Abstract, "
    "case when article_id % 2 = 0 then cast(article_id % 50 as varchar) end as Citations_Scholar, "
    "case when article_id % 3 = 0 then 'https://pdf.example.org/' || cast(article_id as varchar) || '.pdf' end as PDF_Link, "
    "case when article_id % 3 = 0 then 'Likely (PDF found)' end as Open_Access from r"
))
def scholar_results(spark, sf_dir):
    pages = fx.spread(fx.scholar_pages(spark, sf_dir))
    return src_scholar.scholar_records(src_scholar.extract_search_results(pages))


_CSL_AUTH_SQL = ("array_to_string(list_filter(list_transform(string_split(Authors, '; '), lambda n, i: case "
                 "when i = 1 then n when i = 2 then n || ' X' when i = 3 then n end), lambda s: s is not null), '; ')")


@register("csl_table", with_articles(
    "select 'item-' || cast(article_id as varchar) as ID, 'article-journal' as Type, Title, trim(Journal) as Journal, "
    "cast(null as varchar) as DOI, cast(null as varchar) as URL, Abstract, " + _CSL_AUTH_SQL + " as Authors, Year from articles"
))
def csl_table_q(spark, sf_dir):
    items = fx.csl_items(spark, sf_dir).select(src_csl.parse_csl_column(F.col("json")).alias("item"))
    return src_csl.csl_table(items, "item")


_XML_AUTH_SQL = ("array_to_string(list_transform(string_split(Authors, '; '), lambda n, i: case when (i - 1) % 2 = 0 "
                 "then n || ' F' || cast(i - 1 as varchar) else n end), '; ')")


@register("pubmed_records", with_articles(
    "select 'PubMed' as Source, 'PMID' || case when article_id % 4 = 0 then '/DOI' else '' end as ID_Type, "
    "case when article_id % 8 = 0 then '10.2/a' || cast(article_id as varchar) when article_id % 4 = 0 "
    "then '10.1/e' || cast(article_id as varchar) end as DOI, cast(article_id as varchar) as ID, "
    "regexp_replace(regexp_replace(Title, '<[^>]+>', '', 'g'), '^\\s+|\\s+$', '', 'g') as Title, "
    "case when Abstract is null then null when length(Abstract) > 100 then substr(Abstract, 1, 100) || ' ' || substr(Abstract, 101) "
    "else Abstract end as Abstract, " + _XML_AUTH_SQL + " as Authors, trim(Journal) as Journal, cast(Year as varchar) as Year, "
    "cast(article_id % 40 as varchar) as Volume, cast(article_id % 12 as varchar) as Issue, "
    "cast(article_id as varchar) || '-' || cast(article_id + 9 as varchar) as Pages, "
    "'https://pubmed.ncbi.nlm.nih.gov/' || cast(article_id as varchar) || '/' as URL, "
    "'Journal Article' as Publication_Type, 'Neurology; Src ' || Journal as MeSH_Terms, 'eng' as Language "
    "from articles where Source = 'PubMed'"
))
def pubmed_records_q(spark, sf_dir):
    x = fx.pubmed_xml(spark, sf_dir).select(src_pubmed.parse_pubmed_column(F.col("xml")).alias("a"))
    return src_pubmed.pubmed_records(x, F.col("a"))


@register("assemble_pages", (
    "with p as (select doc_id, unnest(range(0, cast(ceil(length(text) / 500) as bigint))) as page_no, text from documents), "
    "s as (select doc_id, page_no, substr(text, page_no * 500 + 1, 500) as t from p) "
    "select doc_id, string_agg(t, chr(10) order by page_no) as text from s group by 1"
))
def assemble_pages_q(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    n = F.ceil(F.length("text") / 500).cast("int")
    pages = d.select("doc_id", "text", F.explode(F.sequence(F.lit(0), n - 1)).alias("page_no")).where(n > 0)
    pages = pages.select("doc_id", "page_no", F.substring("text", F.col("page_no") * 500 + 1, 500).alias("text"))
    return src_pages.assemble_pages(pages)


@register("result_counts", (
    "select doc_id, n_chars, cast(coalesce(try_cast(regexp_replace(regexp_extract('About ' || format('{:,}', n_chars) "
    "|| ' results (0.05 sec)', '(?i)([\\d,\\.\\s]+)\\s+(results|résultats)', 1), '\\D', '', 'g') as bigint), 0) as bigint) "
    "as parsed from documents"
))
def result_counts(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    text = F.concat(F.lit("About "), F.format_number("n_chars", 0), F.lit(" results (0.05 sec)"))
    return d.select("doc_id", "n_chars", fl.parse_result_count(text).alias("parsed"))


@register("conform_limit_per_source", with_articles(
    ", r as (select *, row_number() over (partition by Source order by article_id) as rn from articles) "
    "select article_id, Source, " + ", ".join(
        f"case when trim({c}) = '' or lower(trim({c})) = 'nan' then null else trim({c}) end as {c}"
        for c in ("Title", "Abstract", "Authors", "Journal")
    ) + ", cast(Year as varchar) as Year, cast(null as varchar) as DOI from r where rn <= 200"
))
def conform_limit_per_source(spark, sf_dir):
    a = fx.articles(spark, sf_dir).withColumnRenamed("article_id", "rank")
    c = src_records.conform(a, keep_extra=True)
    out = src_records.limit_per_source(c, 200, "rank")
    return out.select(F.col("rank").alias("article_id"), "Source", "Title", "Abstract", "Authors", "Journal", "Year", "DOI")


# --- P1 / P2: boolean term search -------------------------------------------------------

from prismark.operators import search as srch  # noqa: E402

SEARCH_ALL_OF = [["stroke", "brain injur*", "subarachnoid hemorrhage", "tbi"], ["cohort", "trial*", "review", "famil*"]]
SEARCH_NONE_OF = ["pilot"]


def _search_sql(body: str) -> str:
    def pat(terms):
        parts = []
        for t in terms:
            words = [w for w in t.rstrip("*").split()]
            parts.append(f"[{_S}]+".join(words) + (f"[{_W}]*" if t.endswith("*") else ""))
        return f"'(?i)(?:^|[^{_W}])(?:" + "|".join(parts) + f")(?:$|[^{_W}])'"

    conds = " and ".join(f"regexp_matches(txt, {pat(g)})" for g in SEARCH_ALL_OF)
    return with_articles(
        ", a as (select article_id, Journal, concat_ws(' ', coalesce(Title, ''), coalesce(Abstract, '')) as txt from articles), "
        f"hits as (select article_id from a where {conds} and not regexp_matches(txt, {pat(SEARCH_NONE_OF)})) " + body
    )


@register("boolean_search", _search_sql("select article_id from hits"))
def boolean_search_q(spark, sf_dir):
    return srch.boolean_search(fx.articles(spark, sf_dir), SEARCH_ALL_OF, SEARCH_NONE_OF).select("article_id")


SEARCH_MIXED = [["stroke", srch.Heading("Journal of src1"), srch.Heading("Trials*")], ["cohort", "trial*"]]


@register("search_with_headings", with_articles(
    ", a as (select article_id, concat_ws(' ', coalesce(Title, ''), coalesce(Abstract, '')) as txt, "
    "lower(trim(Journal)) as journal, doc_n from (select *, article_id % 4 as doc_n from articles)) "
    f"select article_id from a where (regexp_matches(txt, '(?i)(?:^|[^{_W}])stroke(?:$|[^{_W}])') "
    "or journal = 'journal of src1' or doc_n = 0) "
    f"and regexp_matches(txt, '(?i)(?:^|[^{_W}])(?:cohort|trial[{_W}]*)(?:$|[^{_W}])')"
))
def search_with_headings(spark, sf_dir):
    """P1 with an OR-group of words and subject headings (``Trials, Clinical`` for every fourth article, and its journal)."""
    a = fx.articles(spark, sf_dir).withColumn("MeSH_Terms", F.concat_ws(
        "; ", F.when(F.col("article_id") % 4 == 0, "Trials, Clinical"), F.trim("Journal")
    ))
    return srch.boolean_search(a, SEARCH_MIXED).select("article_id")


@register("count_matches", _search_sql("select count(*) as hits from hits"))
def count_matches_q(spark, sf_dir):
    return srch.count_matches(fx.articles(spark, sf_dir), SEARCH_ALL_OF, SEARCH_NONE_OF)


# --- X17-X19: synthesis prompts and replies ------------------------------------------

from prismark.operators import synthesis as syn  # noqa: E402

_THEME_HEAD, _THEME_TAIL = syn.THEMATIC_PROMPT.split("{corpus_text}")


@register("theme_prompts", with_articles(
    ", pos as (select cast(Cluster as bigint) as cluster, article_id, coalesce(Abstract, '') as t, "
    "row_number() over (partition by Cluster order by article_id) as p from articles), "
    "ch as (select cluster, cast(floor((p - 1) / 50) as bigint) as chunk, "
    "string_agg(t, chr(10) || chr(10) || '--- NEW ARTICLE ---' || chr(10) || chr(10) order by article_id) as corpus "
    "from pos group by 1, 2) "
    "select cluster, chunk, " + _sql_str(_THEME_HEAD) + " || corpus || " + _sql_str(_THEME_TAIL) + " as prompt from ch"
))
def theme_prompts(spark, sf_dir):
    a = fx.articles(spark, sf_dir).withColumn("Cluster", F.col("Cluster").cast("long"))
    chunks = biblio.concat_cluster_text(a, "Cluster", "article_id", "Abstract", docs_per_chunk=50)
    return chunks.select("cluster", "chunk", syn.corpus_prompt(chunks, "themes").alias("prompt"))


def _reply_words(spark, sf_dir):
    _, scores = _ctfidf_docs(spark, sf_dir)
    top = ft.topic_terms(scores, 5)
    return top.groupBy("topic").agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("_w")).select(
        "topic", F.transform("_w", lambda e: e["term"]).alias("w")
    )


_REPLY_WORDS_SQL = (
    ", r5 as (select topic, term, row_number() over (partition by topic order by score desc, term) as rank from s), "
    "tw as (select topic, list(term order by rank) as w from r5 where rank <= 5 group by 1) "
)


@register("theme_replies", _CTFIDF_CTES + _REPLY_WORDS_SQL + (
    ", ax as (select topic, unnest(range(0, 3)) as theme_index, w from tw) "
    "select topic, theme_index, w[theme_index + 1] as theme, 'Documents about ' || w[theme_index + 1] as description, "
    "array_to_string(w[theme_index + 2:theme_index + 3], '|') as key_concepts, "
    "'Topic ' || cast(topic as varchar) || ' centres on ' || w[1] as main_message from ax"
))
def theme_replies(spark, sf_dir):
    w = _reply_words(spark, sf_dir)
    axes = F.array(*[
        F.struct(F.col("w")[i].alias("theme"), F.concat(F.lit("Documents about "), F.col("w")[i]).alias("description"),
                 F.slice("w", i + 2, 2).alias("key_concepts"))
        for i in range(3)
    ])
    msg = F.concat(F.lit("Topic "), F.col("topic").cast("string"), F.lit(" centres on "), F.col("w")[0])
    replies = w.select("topic", F.to_json(F.struct(axes.alias("thematic_axes"), msg.alias("main_message"))).alias("raw"))
    out = syn.parse_themes(replies, "raw", ["topic"])
    return out.select("topic", F.col("theme_index").cast("bigint").alias("theme_index"), "theme", "description",
                      F.array_join("key_concepts", "|").alias("key_concepts"), "main_message")


@register("methodology_replies", _CTFIDF_CTES + _REPLY_WORDS_SQL + (
    "select topic, w[1] as dominant_methodology, 'Mostly ' || w[1] || ' with ' || w[2] as methodological_description, "
    "array_to_string(w[2:4], '|') as statistical_techniques, array_to_string(w[5:5], '|') as tools_databases from tw"
))
def methodology_replies(spark, sf_dir):
    w = _reply_words(spark, sf_dir)
    reply = F.struct(
        F.col("w")[0].alias("dominant_methodology"),
        F.concat(F.lit("Mostly "), F.col("w")[0], F.lit(" with "), F.col("w")[1]).alias("methodological_description"),
        F.slice("w", 2, 3).alias("statistical_techniques"),
        F.slice("w", 5, 1).alias("tools_databases"),
    )
    out = syn.parse_methodology(w.select("topic", F.to_json(reply).alias("raw")), "raw", ["topic"])
    return out.select("topic", "dominant_methodology", "methodological_description",
                      F.array_join("statistical_techniques", "|").alias("statistical_techniques"),
                      F.array_join("tools_databases", "|").alias("tools_databases"))


# --- X11 / X12: tokens and lemmas ---------------------------------------------------

from prismark.operators import lemma as lm  # noqa: E402


@register("lemmatize", (
    "with d as (select doc_id, text from documents), "
    "w as (select w from (select distinct unnest(regexp_extract_all(text, '[" + _W + "]+')) as w from d) where regexp_full_match(w, '[a-z]+')), "
    "lex as (select w as token, substr(w, 1, length(w) - 1) as lemma from w where length(w) > 3 and suffix(w, 's') "
    "and substr(w, 1, length(w) - 1) in (select w from w)), "
    "t as (select doc_id, unnest(regexp_extract_all(text, '[" + _W + "]+|[^" + _W + _S + "]')) as tok, "
    "unnest(range(1, len(regexp_extract_all(text, '[" + _W + "]+|[^" + _W + _S + "]')) + 1)) as p from d), "
    "l as (select doc_id, p, coalesce(lex.lemma, t.tok) as w from t left join lex on lex.token = t.tok) "
    "select d.doc_id, coalesce(string_agg(l.w, ' ' order by l.p), '') as lemmatized from d left join l using (doc_id) "
    "group by d.doc_id"
))
def lemmatize_q(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    return lm.lemmatize(d, "doc_id", "text", lm.plural_lexicon(d, "text"))


# --- M9 / M10: exact neighbours and density clusters over embeddings ----------------

from prismark.operators import neighbors as nbr  # noqa: E402


@register("knn_embeddings", (
    "with e as (select vec_id, cast(embedding as double[]) as v from embeddings), "
    "p as (select a.vec_id as id, b.vec_id as neighbor, list_distance(a.v, b.v) as distance "
    "from e a join e b on a.vec_id <> b.vec_id), "
    "r as (select *, row_number() over (partition by id order by distance, neighbor) as rank from p) "
    "select id, neighbor, round(distance, 6) as distance, cast(rank as integer) as rank from r where rank <= 10"
))
def knn_embeddings(spark, sf_dir):
    e = fx.table(spark, sf_dir, "embeddings")
    out = nbr.knn(e, "vec_id", "embedding", k=10)
    return out.select("id", "neighbor", F.round("distance", 6).alias("distance"), "rank")


@register("density_clusters")
def density_clusters_q(spark, sf_dir):
    """M10 over the M9 graph (k=10, min_cluster_size=4, min_samples=2); rows-only check."""
    e = fx.table(spark, sf_dir, "embeddings")
    return nbr.density_clusters(nbr.knn(e, "vec_id", "embedding", k=10), 4, 2)


from prismark.operators import hierarchy as hier  # noqa: E402


@register("density_hierarchy")
def density_hierarchy_q(spark, sf_dir):
    """M10 with the hierarchy (min_cluster_size=4, min_samples=2, excess of mass); brute-force parity is in tests/test_hierarchy.py."""
    return hier.density_hierarchy(fx.table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 4, 2)


# --- O5, P6, X3: centroid coordinates, a user scorer, tags stripped from pages ---------

@register("top_centroid_dims", _EMB_CTES + (
    ", cent as (select label, i - 1 as i, s / n as c from cs), "
    "r as (select *, row_number() over (partition by label order by c desc, i) as rank from cent) "
    "select label, cast(i as varchar) as feature, round(c, 6) as value, cast(rank as integer) as rank from r where rank <= 10"
))
def top_centroid_dims(spark, sf_dir):
    e = fx.table(spark, sf_dir, "embeddings")
    out = cl.top_centroid_terms(cl.centroids_from_labels(e, "embedding", "label"), 10)
    return out.select("label", "feature", F.round("value", 6).alias("value"), F.col("rank").cast("int"))


def keyword_scorer(prompt: str) -> str:
    """A deterministic stand-in for a model: include papers whose prompt mentions a stroke."""
    body = prompt.split("#PAPER:", 1)[-1].lower()
    if "stroke" in body:
        return '```json {"included": true, "reason": "mentions stroke"}```'
    return '{"included": false, "reason": "off topic"}'


@register("scored_screening", with_articles(
    ", g as (select article_id, Abstract, Title from articles) "
    "select article_id, case when Abstract is null or length(Abstract) < 20 then false "
    "when contains(lower(coalesce(Title, 'None') || ' ' || coalesce(Abstract, 'None')), 'stroke') then true else false end "
    "as Included, case when Abstract is null or length(Abstract) < 20 then 'No Abstract' "
    "when contains(lower(coalesce(Title, 'None') || ' ' || coalesce(Abstract, 'None')), 'stroke') then 'mentions stroke' "
    "else 'off topic' end as Screening_Reason from g"
))
def scored_screening(spark, sf_dir):
    """P3 + P5 + P6 + P7: prompts scored by a user callable in Arrow batches, then parsed."""
    a = fx.articles(spark, sf_dir).drop("raw_verdict")
    gated = sc.gate_abstract(a)
    todo = gated.where("needs_model")
    scored = sc.score_with(todo.withColumn("prompt", sc.screening_prompt(todo, CRITERIA)), keyword_scorer)
    v = sc.parse_verdict("raw_verdict")
    done = scored.select("article_id", v["included"].alias("Included"), v["reason"].alias("Screening_Reason"))
    skipped = gated.where(~F.col("needs_model")).select("article_id", "Included", "Screening_Reason")
    return done.unionByName(skipped)


@register("page_text", (
    "select page_id, regexp_replace(regexp_replace(replace(html, chr(160), ' '), '<[^>]+>', '', 'g'), "
    "'^\\s+|\\s+$', '', 'g') as text from pages"
))
def page_text(spark, sf_dir):
    p = fx.table(spark, sf_dir, "pages")
    return p.select("page_id", tx.strip_tags(F.translate("html", tx.NBSP, " ")).alias("text"))
