"""P3, P7-P10, J2, K2-K5 hand cases."""

from pyspark.sql import functions as F

from prismark.operators import screen as sc
from prismark.sinks import export as ex


def test_gate_abstract(spark):
    df = spark.createDataFrame([(1, None), (2, "x" * 19), (3, "x" * 20)], "id long, Abstract string")
    got = {r.id: (r.Included, r.Screening_Reason) for r in sc.gate_abstract(df).collect()}
    assert got[1] == (False, "No Abstract") and got[2] == (False, "No Abstract") and got[3] == (None, None)


def test_parse_verdict(spark):
    raws = ['```json {"included": true, "reason": "ok"}```', '{"included": false}', "no json here",
            '{"included": "true"}', '{"included": tr']
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    got = [tuple(r.v) for r in df.select(sc.parse_verdict("raw").alias("v")).collect()]
    assert got[0] == (True, "ok")
    assert got[1] == (False, "No reason provided")
    assert got[2] == (False, "LLM Error (Format): no json here...")
    assert got[3] == (True, "No reason provided")
    assert got[4] == (False, 'LLM Error (Format): {"included": tr...')


def test_decisions_and_queue(spark):
    df = spark.createDataFrame(
        [(1, True, "YES"), (2, True, "included"), (3, True, "n"), (4, True, " yes "), (5, True, "maybe"),
         (6, True, None), (7, False, None)], "article_id long, Included boolean, Manual_Decision string")
    q = sc.undecided(df).orderBy("article_id").collect()
    assert [r.article_id for r in q] == [4, 5, 6]
    assert [r.position for r in q] == [4, 5, 6] and q[0].total == 6
    dec = spark.createDataFrame([(5, "y"), (6, " NO "), (1, "n")], "article_id long, decision string")
    out = {r.article_id: r.Manual_Decision for r in sc.apply_decisions(df, dec).collect()}
    assert out[1] == "YES" and out[5] == "Included" and out[6] == "Excluded" and out[7] is None


def test_needs_doi(spark):
    df = spark.createDataFrame(
        [(1, "PubMed", "PMID", "123", None), (2, "PubMed", "PMID", "123.0", None), (3, "PubMed", "PMID", "7", "nan"),
         (4, "Google Scholar", "URL", "9", None), (5, "PubMed", "PMID", "8", "10.1/x")],
        "k long, Source string, ID_Type string, ID string, DOI string")
    assert sorted(r.k for r in sc.needs_doi(df).collect()) == [1, 3]


def test_export_selection_and_items(spark):
    lower_only = spark.createDataFrame([(1, "included"), (2, "Excluded")], "id long, Manual_Decision string")
    assert [r.id for r in ex.select_for_export(lower_only).collect()] == [1]
    mixed = spark.createDataFrame([(1, "included"), (2, "Included")], "id long, Manual_Decision string")
    assert [r.id for r in ex.select_for_export(mixed).collect()] == [2]
    df = spark.createDataFrame([("Doe Jo; Solo; ",)], "Authors string")
    cr = df.select(ex.parse_creators("Authors").alias("c")).first()["c"]
    assert cr[0]["name"] == "Doe Jo" and cr[0]["lastName"] is None
    assert cr[1]["lastName"] == "Solo" and cr[1]["firstName"] == "" and len(cr) == 2


def test_batches(spark):
    items = ex.to_export_items(spark.range(101).select(
        F.col("id"), F.lit(None).cast("string").alias("Title"), F.lit("2015.0").alias("Year"),
        F.lit("A B").alias("Authors"), F.lit("x").alias("Abstract"), F.lit("J").alias("Journal")))
    b = ex.batch_items(items, "id", 50).orderBy("batch").collect()
    assert [r.n_items for r in b] == [50, 50, 1]
    assert '"title":"No Title"' in b[0].payload and '"date":"2015"' in b[0].payload


def test_write_records(spark, tmp_path):
    empty = spark.createDataFrame([], "a string")
    assert ex.write_records(empty, str(tmp_path / "e")) is False and not (tmp_path / "e").exists()
    df = spark.createDataFrame([("x\ny", 1)], "a string, b int")
    assert ex.write_records(df, str(tmp_path / "c"), fmt="csv") is True
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "c"))
    assert back.first().a == "x\ny"


def test_fallback_if_blank(spark):
    from prismark.functions.fields import fallback_if_blank

    df = spark.createDataFrame([(" ", "b"), ("a", "b"), (None, "b")], "x string, y string")
    assert [r.r for r in df.select(fallback_if_blank("x", "y").alias("r")).collect()] == ["b", "a", "b"]


def test_a_scorer_that_raises_excludes_its_row_only(spark):
    def scorer(prompt):
        if "bad" in prompt:
            raise ValueError('no "reply"')
        return '{"included": true, "reason": "ok"}'

    df = spark.createDataFrame([(1, "good"), (2, "bad one"), (3, None)], "id long, prompt string")
    scored = sc.score_with(df, scorer)
    got = {r.id: tuple(r.v) for r in scored.where("id < 3").select("id", sc.parse_verdict("raw_verdict").alias("v")).collect()}
    assert got == {1: (True, "ok"), 2: (False, 'LLM Connection Error: no "reply"')}


def test_scoring_leaves_long_ids_beside_null_ones_as_they_are(spark):
    from prismark.operators import screen as sc

    rows = [(2**53 + 1, "stroke"), (None, None), *((k, "x") for k in range(600))]
    df = spark.createDataFrame(rows, "id long, prompt string").coalesce(1)
    got = {r.id: r.raw_verdict for r in sc.score_with(df, str.upper).collect()}
    assert got == {2**53 + 1: "STROKE", None: None} | {k: "X" for k in range(600)}
