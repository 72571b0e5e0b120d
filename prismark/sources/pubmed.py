"""Article XML (``PubmedArticle`` elements) -> canonical records.

Text is kept exactly (no trimming of surrounding spaces), and always read with an explicit schema: inference turns the id into a number
and a title with inline markup into a struct (trap T12).  Book articles are
ignored, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from prismark.functions import fields as fl
from prismark.functions.text import strip_tags

S = T.StringType()
_ATTR = lambda a: T.StructType([T.StructField(a, S), T.StructField("_VALUE", S)])

PUBMED_SCHEMA = T.StructType([
    T.StructField("MedlineCitation", T.StructType([
        T.StructField("PMID", S),
        T.StructField("Article", T.StructType([
            T.StructField("ArticleTitle", S),
            T.StructField("Abstract", T.StructType([
                T.StructField("AbstractText", T.ArrayType(T.StructType([
                    T.StructField("_Label", S), T.StructField("_VALUE", S)]))),
            ])),
            T.StructField("AuthorList", T.StructType([
                T.StructField("Author", T.ArrayType(T.StructType([
                    T.StructField("LastName", S), T.StructField("ForeName", S)]))),
            ])),
            T.StructField("Journal", T.StructType([
                T.StructField("Title", S),
                T.StructField("JournalIssue", T.StructType([
                    T.StructField("Volume", S),
                    T.StructField("Issue", S),
                    T.StructField("PubDate", T.StructType([T.StructField("Year", S)])),
                ])),
            ])),
            T.StructField("Pagination", T.StructType([T.StructField("MedlinePgn", S)])),
            T.StructField("ELocationID", T.ArrayType(_ATTR("_EIdType"))),
            T.StructField("PublicationTypeList", T.StructType([
                T.StructField("PublicationType", T.ArrayType(S))])),
            T.StructField("Language", T.ArrayType(S)),
        ])),
        T.StructField("MeshHeadingList", T.StructType([
            T.StructField("MeshHeading", T.ArrayType(T.StructType([T.StructField("DescriptorName", S)]))),
        ])),
    ])),
    T.StructField("PubmedData", T.StructType([
        T.StructField("ArticleIdList", T.StructType([
            T.StructField("ArticleId", T.ArrayType(_ATTR("_IdType")))])),
    ])),
])


def pubmed_records(articles: DataFrame, root: Column | None = None, doi_rule: str = "last") -> DataFrame:
    """Canonical fields from parsed ``PubmedArticle`` structs."""
    r = root if root is not None else F.struct(F.col("MedlineCitation"), F.col("PubmedData"))
    mc = r["MedlineCitation"]
    art = mc["Article"]
    pmid = F.trim(mc["PMID"])
    issue = art["Journal"]["JournalIssue"]
    eloc = art["ELocationID"]
    ids = r["PubmedData"]["ArticleIdList"]["ArticleId"]
    return articles.select(
        F.lit("PubMed").alias("Source"),
        fl.id_type_pubmed(eloc).alias("ID_Type"),
        fl.pick_doi(F.coalesce(ids, F.array()), F.coalesce(eloc, F.array()), doi_rule).alias("DOI"),
        pmid.alias("ID"),
        strip_tags(art["ArticleTitle"]).alias("Title"),
        fl.join_sections(art["Abstract"]["AbstractText"]).alias("Abstract"),
        fl.format_authors_xml(art["AuthorList"]["Author"]).alias("Authors"),
        art["Journal"]["Title"].alias("Journal"),
        issue["PubDate"]["Year"].alias("Year"),
        issue["Volume"].alias("Volume"),
        issue["Issue"].alias("Issue"),
        art["Pagination"]["MedlinePgn"].alias("Pages"),
        fl.build_url(pmid).alias("URL"),
        fl.join_labels(art["PublicationTypeList"]["PublicationType"]).alias("Publication_Type"),
        fl.join_labels(mc["MeshHeadingList"]["MeshHeading"], "DescriptorName").alias("MeSH_Terms"),
        fl.join_labels(art["Language"]).alias("Language"),
    )


def read_pubmed_xml(spark: SparkSession, path: str, doi_rule: str = "last") -> DataFrame:
    """Bulk article XML files -> canonical records."""
    df = (
        spark.read.format("xml").option("rowTag", "PubmedArticle").option("ignoreSurroundingSpaces", False)
        .schema(PUBMED_SCHEMA).load(path)
    )
    return pubmed_records(df, doi_rule=doi_rule)


def parse_pubmed_column(c: Column) -> Column:
    """One ``PubmedArticle`` element held as XML text -> struct."""
    return F.from_xml(c, PUBMED_SCHEMA, {"ignoreSurroundingSpaces": "false"})
