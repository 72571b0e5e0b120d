"""Source field rules S9-S19, the result-page parser and the sample CSV."""

import os

import pytest
from pyspark.sql import functions as F

from prismark.functions import fields as fl
from prismark.sources import records, scholar

SAMPLE = os.environ.get("PRISMARK_SAMPLE_CSV", "")


def test_authors_and_dates(spark):
    df = spark.createDataFrame([([("Doe", "Jo"), ("Roe", None), (None, "X")],)],
                               "a array<struct<LastName:string,ForeName:string>>")
    assert df.select(fl.format_authors_xml("a").alias("r")).first().r == "Doe Jo; Roe"
    dp = spark.createDataFrame([([[2015, 3]],), ([[]],), ([],), (None,)], "d array<array<int>>")
    assert [r.r for r in dp.select(fl.first_date_part("d").alias("r")).collect()] == [2015, None, None, None]


def test_byline(spark):
    df = spark.createDataFrame([("J Smith, A Doe - Nature, 2020 - nature.com",),
                                ("J Smith, A Doe - Nature, 2020 - nature.com",)], "t string")
    rows = df.select(fl.parse_byline("t").alias("b")).collect()
    for r in rows:
        assert (r.b.authors, r.b.journal, r.b.year) == ("J Smith, A Doe", "Nature, 2020", "2020")


def test_pick_doi(spark):
    df = spark.createDataFrame([([("doi", "10.1/b")], [("doi", "10.1/a")]),
                                ([("doi", "10.1/c"), ("doi", "10.1/d")], [])],
                               "ids array<struct<_IdType:string,_VALUE:string>>, el array<struct<_EIdType:string,_VALUE:string>>")
    last = [r.r for r in df.select(fl.pick_doi("ids", "el", "last").alias("r")).collect()]
    first = [r.r for r in df.select(fl.pick_doi("ids", "el", "first").alias("r")).collect()]
    assert last == ["10.1/b", "10.1/d"] and first == ["10.1/b", "10.1/c"]
    assert df.select(fl.id_type_pubmed("el").alias("r")).first().r == "PMID/DOI"


def test_result_count(spark):
    df = spark.createDataFrame([("About 1,200 results (0.05 sec)",), ("18 200 résultats",), ("nothing",)], "t string")
    assert [r.n for r in df.select(fl.parse_result_count("t").alias("n")).collect()] == [1200, 18200, 0]


def test_result_page_parser():
    html = ('<div class="gs_r gs_or gs_scl"><h3 class="gs_rt"><a href="http://x">T <b>one</b></a></h3>'
            '<div class="gs_a">A B - J, 2001 - p</div><div class="gs_rs">snip &amp; more</div>'
            '<div class="gs_fl"><a>Cited by 3</a><a>Cited by 5</a></div>'
            '<div class="gs_or_ggsm"><a href="http://pdf">[PDF]</a></div></div>'
            '<div class="gs_r gs_or gs_scl"><h3 class="gs_rt">[BOOK] Plain</h3></div>')
    res = scholar.parse_result_page(html)
    assert res[0]["title"] == "T one" and res[0]["link"] == "http://x" and res[0]["snippet"] == "snip & more"
    assert res[0]["footer_links"] == ["Cited by 3", "Cited by 5"] and res[0]["pdf_link"] == "http://pdf"
    assert res[1]["title"] == "[BOOK] Plain" and res[1]["link"] is None and res[1]["has_heading"]


def test_missing_source_is_empty(spark, tmp_path):
    df = records.read_or_empty(spark, str(tmp_path / "nope.csv"))
    assert df.count() == 0 and len(df.columns) == 27


def test_records_csv_traits(spark, tmp_path):
    """Byte-order mark, quoted newlines, doubled quotes, DOI as the last column, blanks -> null."""
    header = "Source,Title,Abstract,Year,ID_Type,DOI"
    rows = [
        'Google Scholar,"A ""quoted"" title","line one\nline two …",2020,DOI,10.1/a',
        "Google Scholar,Second,,,URL,",
        "PubMed,Third,nan,2019.0,PMID,10.1/c",
    ]
    path = tmp_path / "records.csv"
    path.write_bytes(("\ufeff" + header + "\n" + "\n".join(rows) + "\n").encode("utf-8"))
    df = records.conform(records.read_records_csv(spark, str(path)))
    got = {r.Title: r for r in df.collect()}
    assert len(got) == 3 and list(df.columns)[:3] == ["Source", "ID_Type", "DOI"]
    assert got['A "quoted" title'].Abstract == "line one\nline two …" and got['A "quoted" title'].DOI == "10.1/a"
    assert got["Second"].DOI is None and got["Second"].Year is None and got["Third"].Abstract is None


@pytest.mark.skipif(not (SAMPLE and os.path.exists(SAMPLE)), reason="set PRISMARK_SAMPLE_CSV to a 50-record sample")
def test_sample_csv_facts(spark):
    df = records.conform(records.read_records_csv(spark, SAMPLE))
    assert df.count() == 50
    ids = {r.ID_Type: r["count"] for r in df.groupBy("ID_Type").count().collect()}
    assert ids == {"DOI": 39, "URL": 11}
    assert df.where(F.col("Year").isNull()).count() == 13
    assert df.where(F.col("PDF_Link").isNotNull()).count() == 25
    assert df.where(F.col("Citations_Scholar").isNotNull()).count() == 25


def test_csl_json_file(spark, tmp_path):
    import json

    from prismark.sources import csl

    items = [
        {"id": "a", "type": "article-journal", "title": "T1", "container-title": "J", "DOI": "10.1/x",
         "author": [{"literal": "Group"}, {"family": "Doe", "given": "Jo"}, {"family": "Roe"}, {"given": "X"}],
         "issued": {"date-parts": [[2015, 3]]}},
        {"id": "b", "title": "T2", "issued": {"date-parts": [[]]}},
    ]
    path = tmp_path / "items.json"
    path.write_text(json.dumps(items), encoding="utf-8")
    rows = {r.ID: r for r in csl.read_csl_json(spark, str(path)).collect()}
    assert rows["a"].Authors == "Group; Doe Jo; Roe" and rows["a"].Year == 2015 and rows["a"].DOI == "10.1/x"
    assert rows["b"].Authors == "" and rows["b"].Year is None


def test_pubmed_xml_file(spark, tmp_path):
    from prismark.sources import pubmed

    xml = """<PubmedArticleSet>
<PubmedArticle><MedlineCitation><PMID>123</PMID><Article>
<Journal><JournalIssue><Volume>5</Volume><Issue>2</Issue><PubDate><Year>2019</Year></PubDate></JournalIssue>
<Title>Neuro J</Title></Journal><ArticleTitle>A <i>bold</i> title</ArticleTitle>
<Pagination><MedlinePgn>1-9</MedlinePgn></Pagination><ELocationID EIdType="doi">10.1/e</ELocationID>
<Abstract><AbstractText Label="A">First.</AbstractText><AbstractText Label="B">Second.</AbstractText></Abstract>
<AuthorList><Author><LastName>Doe</LastName><ForeName>Jo</ForeName></Author><Author><LastName>Roe</LastName></Author>
<Author><CollectiveName>G</CollectiveName></Author></AuthorList><Language>eng</Language>
<PublicationTypeList><PublicationType>Journal Article</PublicationType></PublicationTypeList></Article>
<MeshHeadingList><MeshHeading><DescriptorName>Stroke</DescriptorName></MeshHeading></MeshHeadingList></MedlineCitation>
<PubmedData><ArticleIdList><ArticleId IdType="pubmed">123</ArticleId><ArticleId IdType="doi">10.1/a</ArticleId>
</ArticleIdList></PubmedData></PubmedArticle>
</PubmedArticleSet>"""
    path = tmp_path / "a.xml"
    path.write_text(xml, encoding="utf-8")
    r = pubmed.read_pubmed_xml(spark, str(path)).first()
    assert (r.ID, r.ID_Type, r.DOI, r.Year, r.Volume, r.Pages) == ("123", "PMID/DOI", "10.1/a", "2019", "5", "1-9")
    assert r.Authors == "Doe Jo; Roe" and r.MeSH_Terms == "Stroke" and r.Language == "eng"
    assert r.URL == "https://pubmed.ncbi.nlm.nih.gov/123/"
    assert r.Abstract == "First. Second."
    assert r.Title == "A bold title"  # T12: inline markup kept as text, then tags stripped


def test_result_pages_beyond_one_slice_and_without_an_id(spark):
    from prismark.sources import scholar

    div = '<div class="gs_r gs_or gs_scl"><h3 class="gs_rt">t{}</h3></div>'
    rows = [(k, div.format(k) * 2) for k in range(150)] + [(None, div.format("n")), (900, None)]
    pages = spark.createDataFrame(rows, "page_id long, html string").coalesce(1)
    got = {(r.page_id, r.pos, r.title) for r in scholar.extract_search_results(pages).collect()}
    assert got == {(k, p, f"t{k}") for k in range(150) for p in range(2)} | {(None, 0, "tn")}
