"""Table access and the derived views the queries run on.

The driver's tables have no bibliographic columns, so ``articles`` derives
them from ``documents`` (one article per document, every document kept).  The
same SELECT list runs in Spark and, as a CTE, in the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Tables whose rows carry whole texts (per-row work on them is CPU-heavy), with their id column.
TEXT_TABLES = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id", "benchmark": "item_id"}


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Repartition a scan that has fewer partitions than the cluster has cores.

    A large input already arrives in thousands of splits and is returned
    untouched (no extra shuffle); a small single-file input would otherwise
    run its CPU-heavy text work in one task.  With a key the rows are hash
    partitioned on it: deterministic on retry without the row sort that a
    round-robin repartition needs.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        n = 4 * cores  # several tasks per core even out documents of very different lengths
        return df.repartition(n, key) if key else df.repartition(n)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, TEXT_TABLES[name]) if name in TEXT_TABLES else df


# The articles view over documents (see FIXTURES.md); valid in both SQL dialects.
ARTICLES_EXPRS = [
    "doc_id as article_id",
    "case when cast(substr(source, 4) as int) % 2 = 0 then 'PubMed' else 'Google Scholar' end as Source",
    "split_part(text, chr(10), 1) as Title",
    """case when doc_id % 19 = 0 then null when doc_id % 23 = 0 then 'short'
   else text || ' ' || case cast(doc_id % 9 as int) when 0 then 'a randomized trial'
     when 1 then 'systematic review of stroke' when 2 then 'qualitative interview' when 3 then 'prospective cohort, tbi'
     when 4 then 'cross-sectional survey' when 5 then 'case-control of sah' when 6 then 'chart review palliative'
     when 7 then 'pilot of glioma and stroke' else 'infarct' end end as Abstract""",
    """concat_ws('; ', 'Author' || cast((doc_id*7) % 97 as string),
   case when doc_id % 4 >= 1 then 'Author' || cast((doc_id*7+13) % 97 as string) end,
   case when doc_id % 4 >= 2 then 'Author' || cast((doc_id*5+29) % 97 as string) end,
   case when doc_id % 4 >= 3 then 'Author' || cast((doc_id*3+41) % 97 as string) end) as Authors""",
    "case when doc_id % 2 = 0 then ' Journal of ' || source else 'JOURNAL OF ' || source || ' ' end as Journal",
    "cast(case when doc_id % 17 = 0 then null else 1990 + doc_id % 36 end as int) as Year",
    "cast(doc_id % 3 as int) as Cluster",
    """case cast(doc_id % 5 as int) when 0 then '```json {"included": true, "reason": "ok"}```'
   when 1 then 'Sure: {"included": false}' when 2 then 'no json here'
   when 3 then '{"included": "true", "reason": "text"}' else '{"included": tr' end as raw_verdict""",
    "case cast(doc_id % 4 as int) when 0 then 'y' when 1 then ' NO ' when 2 then '' else null end as decision",
]


def articles_sql() -> str:
    """The view as one SELECT over ``documents`` (for the DuckDB oracle CTE)."""
    return "select " + ",\n ".join(ARTICLES_EXPRS) + "\nfrom documents"


def articles_of(documents: DataFrame) -> DataFrame:
    return documents.selectExpr(*ARTICLES_EXPRS)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles_of(table(spark, sf_dir, "documents"))


# Identifier fields added to articles so the DOI rules have work.
RECORD_ID_EXPRS = [
    "case when Source = 'PubMed' then 'PMID' else 'URL' end as ID_Type",
    "case when Source = 'PubMed' then cast(article_id as string) "
    "else 'https://scholar.example.org/' || cast(article_id as string) end as ID",
    "case when Source = 'PubMed' then 'https://pubmed.ncbi.nlm.nih.gov/' || cast(article_id as string) || '/' "
    "else 'https://scholar.example.org/' || cast(article_id as string) end as URL",
    "case cast(article_id % 5 as int) when 0 then '10.' || cast(1000 + article_id % 9000 as string) || '/art.' "
    "|| cast(article_id as string) when 1 then 'nan' when 2 then '' end as DOI",
]

# A pmid -> doi lookup derived from documents (null = the lookup found none).
DOI_LOOKUP_EXPRS = [
    "cast(doc_id as string) as pmid",
    "case when n_chars % 3 = 0 then null else '10.' || cast(2000 + doc_id % 7000 as string) || '/lookup.' "
    "|| cast(doc_id as string) end as doi",
]


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir)
    return a.selectExpr("*", *RECORD_ID_EXPRS)


def doi_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(*DOI_LOOKUP_EXPRS)


def html_escape(c):
    """Text -> HTML text (``&``, ``<``, ``>``, ``"``)."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def scholar_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages rendered from the articles, ten results per page in id order.

    A result has a linked title unless ``id % 7 = 0``, a ``Cited by`` link for
    even ids and a PDF link for ids divisible by 3.
    """
    a = articles(spark, sf_dir)
    aid = F.col("article_id")
    url = F.concat(F.lit("https://scholar.example.org/"), aid.cast("string"))
    title = html_escape(F.col("Title"))
    heading = F.when(aid % 7 == 0, title).otherwise(F.concat(F.lit('<a href="'), url, F.lit('">'), title, F.lit("</a>")))
    byline = F.concat(
        F.replace(F.col("Authors"), F.lit(";"), F.lit(",")), F.lit(" - "), F.trim("Journal"),
        F.coalesce(F.concat(F.lit(", "), F.col("Year").cast("string")), F.lit("")), F.lit(" - example.org"),
    )
    snippet = F.coalesce(F.col("Abstract"), F.lit(""))
    cited = F.when(aid % 2 == 0, F.concat(F.lit('<a href="/cites">Cited by '), (aid % 50).cast("string"), F.lit("</a>")))
    pdf = F.when(aid % 3 == 0, F.concat(F.lit('<div class="gs_or_ggsm"><a href="https://pdf.example.org/'),
                                         aid.cast("string"), F.lit('.pdf">[PDF]</a></div>')))
    div = F.concat(
        F.lit('<div class="gs_r gs_or gs_scl"><div class="gs_ri"><h3 class="gs_rt">'), heading, F.lit("</h3>"),
        F.lit('<div class="gs_a">'), html_escape(byline), F.lit('</div><div class="gs_rs">'), html_escape(snippet),
        F.lit('</div><div class="gs_fl"><a href="#">Save</a>'), F.coalesce(cited, F.lit("")), F.lit("</div></div>"),
        F.coalesce(pdf, F.lit("")), F.lit("</div>"),
    )
    pages = a.select(F.floor(aid / 10).cast("long").alias("page_id"), aid, div.alias("div")).groupBy("page_id").agg(
        F.sort_array(F.collect_list(F.struct("article_id", "div"))).alias("_d")
    )
    body = F.array_join(F.transform("_d", lambda s: s["div"]), "")
    return pages.select("page_id", F.concat(F.lit("<html><body><div id=\"gs_res_ccl_mid\">"), body,
                                           F.lit("</div></body></html>")).alias("html"))


def xml_escape(c):
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def pubmed_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``PubmedArticle`` element per PubMed article, as XML text ``(article_id, xml)``."""
    a = articles(spark, sf_dir).where(F.col("Source") == "PubMed")
    aid = F.col("article_id").cast("string")
    names = F.split(F.col("Authors"), "; ")
    authors = F.array_join(F.transform(names, lambda n, i: F.concat(
        F.lit("<Author><LastName>"), n, F.lit("</LastName>"),
        F.when(i % 2 == 0, F.concat(F.lit("<ForeName>F"), i.cast("string"), F.lit("</ForeName>"))).otherwise(F.lit("")),
        F.lit("</Author>"))), "")
    ab = F.col("Abstract")
    sections = F.when(ab.isNull(), F.lit("")).otherwise(F.concat(
        F.lit("<Abstract><AbstractText Label=\"BACKGROUND\">"), xml_escape(F.substring(ab, 1, 100)), F.lit("</AbstractText>"),
        F.when(F.length(ab) > 100, F.concat(F.lit("<AbstractText Label=\"RESULTS\">"),
                                             xml_escape(F.expr("substring(Abstract, 101)")), F.lit("</AbstractText>")))
        .otherwise(F.lit("")),
        F.lit("</Abstract>")))
    year = F.coalesce(F.concat(F.lit("<PubDate><Year>"), F.col("Year").cast("string"), F.lit("</Year></PubDate>")), F.lit(""))
    xml = F.concat(
        F.lit("<PubmedArticle><MedlineCitation><PMID>"), aid, F.lit("</PMID><Article><Journal><JournalIssue><Volume>"),
        (F.col("article_id") % 40).cast("string"), F.lit("</Volume><Issue>"), (F.col("article_id") % 12).cast("string"),
        F.lit("</Issue>"), year, F.lit("</JournalIssue><Title>"), xml_escape(F.trim("Journal")),
        F.lit("</Title></Journal><ArticleTitle>"), xml_escape(F.col("Title")), F.lit("</ArticleTitle><Pagination><MedlinePgn>"),
        aid, F.lit("-"), (F.col("article_id") + 9).cast("string"), F.lit("</MedlinePgn></Pagination>"),
        F.when(F.col("article_id") % 4 == 0, F.concat(F.lit('<ELocationID EIdType="doi">10.1/e'), aid, F.lit("</ELocationID>")))
        .otherwise(F.lit("")),
        sections, F.lit("<AuthorList>"), authors, F.lit("</AuthorList><Language>eng</Language>"),
        F.lit("<PublicationTypeList><PublicationType>Journal Article</PublicationType></PublicationTypeList></Article>"),
        F.lit("<MeshHeadingList><MeshHeading><DescriptorName>Neurology</DescriptorName></MeshHeading>"),
        F.lit("<MeshHeading><DescriptorName>Src "), F.col("Journal"), F.lit("</DescriptorName></MeshHeading></MeshHeadingList>"),
        F.lit("</MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType=\"pubmed\">"), aid, F.lit("</ArticleId>"),
        F.when(F.col("article_id") % 8 == 0, F.concat(F.lit('<ArticleId IdType="doi">10.2/a'), aid, F.lit("</ArticleId>")))
        .otherwise(F.lit("")),
        F.lit("</ArticleIdList></PubmedData></PubmedArticle>"),
    )
    return a.select("article_id", xml.alias("xml"))


def csl_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSL-JSON item per article, as JSON text ``(article_id, json)``.

    Author k of an article: k=0 ``literal``, k=1 ``family``+``given``, k=2
    ``family`` only, k=3 ``given`` only (dropped by the reader).
    """
    a = articles(spark, sf_dir)
    names = F.split(F.col("Authors"), "; ")
    authors = F.transform(names, lambda n, i: F.struct(
        F.when(i == 0, n).alias("literal"), F.when((i == 1) | (i == 2), n).alias("family"),
        F.when((i == 1) | (i == 3), F.lit("X")).alias("given")))
    issued = F.when(F.col("Year").isNotNull(), F.struct(F.array(F.array(F.col("Year"), F.lit(1))).alias("date-parts")))
    item = F.struct(
        F.concat(F.lit("item-"), F.col("article_id").cast("string")).alias("id"),
        F.lit("article-journal").alias("type"),
        F.col("Title").alias("title"),
        F.trim("Journal").alias("container-title"),
        F.col("Abstract").alias("abstract"),
        authors.alias("author"),
        issued.alias("issued"),
    )
    return a.select("article_id", F.to_json(item).alias("json"))
