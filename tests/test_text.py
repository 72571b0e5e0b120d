"""Scalar text rules: FIXTURES hand cases for X1, X3-X10, X13-X15 and traps T2, T11."""

import re

from pyspark.sql import functions as F

from prismark.functions import text as tx
from prismark.functions.classify import classify_study_type, tag_populations
from prismark.operators.features import WORD_PATTERN, WORDCLOUD_PATTERN
from prismark.operators.search import Heading, boolean_search


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_normalize_title(spark):
    assert one(spark, tx.normalize_title("x"), "Care: A  Study!") == "care a study"
    assert one(spark, tx.normalize_title("x"), None) == ""
    assert one(spark, tx.normalize_title("x"), "Neuroréa") == "neurora"
    assert one(spark, tx.normalize_title("x"), "a b") == "a b"  # T2: nbsp is white space


def test_strip_tags(spark):
    assert one(spark, tx.strip_tags("x"), "  <jats:p>Hello <i>world</i></jats:p>\n") == "Hello world"


def test_body_extraction(spark):
    assert one(spark, tx.body_extraction("x"), "A\nReferences\nIntroduction\nb\nREFERENCES\nr") == "Introduction\nb"
    assert one(spark, tx.body_extraction("x"), "no heading\n\n\nhere") == "no heading\nhere"
    assert one(spark, tx.body_extraction("x"), "q\nBackground") == "Background"
    assert one(spark, tx.body_extraction("x"), "1. Introduction\nx") == "1. Introduction\nx"


def test_page_lines_splitlines(spark):
    # Form feed and other separators split lines like str.splitlines()
    assert one(spark, tx.normalise_space("x"), "a\x0cb\r\nc \t d e") == "a\nb\nc d e"


def test_clean_text(spark):
    assert one(spark, tx.clean_text("x"), "particu-\nlarly") == "particularly"
    assert one(spark, tx.clean_text("x"), "see doi: 10.1234/x now") == "see  now"
    assert one(spark, tx.strip_citations("x"), "a [1, 2-4] b") == "a  b"
    assert one(spark, tx.strip_citations("x"), "a [12–14] b") == "a [12–14] b"
    assert one(spark, tx.strip_citations("x", en_dash=True), "a [12–14] b") == "a  b"
    assert one(spark, tx.strip_urls("x"), "go https://a.b/c and www.x.org.") == "go  and "
    assert one(spark, tx.strip_dois("x"), "id 10.1000/abc.def, end") == "id , end"


def test_stop_words_and_ngrams(spark):
    assert one(spark, tx.remove_stop_words("x", ["the", "of"]), "The  end OF it") == "end it"
    df = spark.createDataFrame([(["a", "b", "c"],)], "t array<string>")
    got = df.select(tx.ngrams(F.col("t"), 1, 3).alias("g")).first()["g"]
    assert got == ["a", "b", "c", "a b", "b c", "a b c"]
    df = spark.createDataFrame([([],)], "t array<string>")
    assert df.select(tx.ngrams(F.col("t"), 1, 3).alias("g")).first()["g"] == []


def test_term_tokens(spark):
    assert one(spark, tx.term_tokens("x"), "ICU care, in 2020: café ab abc") == ["icu", "care", "abc"]


def test_classes_follow_python(spark):
    """The rules against Python's ``re`` on texts with letters, marks, digits and white space of many kinds."""
    texts = [
        "caf\u00e9 na\u00efve \u0130stanbul 10.1234/\u00e9t\u00e9. \u0664\u0662 [\u0661, 2] x\u00b2",
        "e\u0301te\u0301 cur-\n\u00e9e a\u1680b\u2003c\u3000d\x1ce\x1ff\u200bg",
        "xdoi: 10.1/a Doi:\u00a010.12345/b\u00e9-, (10.9999/...) a10.1234/q \u4e2d\u6587abc abc\u4e2d\u6587 abc",
        "see http\u00e9 https://x.y/\u00e9\u2028z www.\u00fc.de! the\u3000The d'\u00e9t\u00e9's", "", "\u00e9",
    ]
    stop = ["the", "a"]

    def cleaned(t):
        t = re.sub(r"-\n(\w+)", r"\1", t).replace("\n", " ")
        t = re.sub(r"\[\s*\d+(?:\s*[-,]\s*\d+)*\s*\]", "", t)
        t = re.sub(r"https?://\S+|www\.\S+", "", t)
        return re.sub(r"\b10\.\d{4,9}/\S+\b", "", re.sub(r"\bdoi:\s*\S+", "", t, flags=re.I))

    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    got = df.orderBy("i").select(
        tx.clean_text("x").alias("c"), tx.tokenize("x").alias("t"), tx.term_tokens("x").alias("w"),
        tx.remove_stop_words("x", stop).alias("s"), F.regexp_extract_all("x", F.lit(WORD_PATTERN), 0).alias("v"),
        F.regexp_extract_all("x", F.lit(WORDCLOUD_PATTERN), 0).alias("k"),
    ).collect()
    for t, r in zip(texts, got):
        assert r["c"] == cleaned(t)
        assert r["t"] == re.findall(r"\w+|[^\w\s]", t)
        assert r["w"] == re.findall(r"\b[a-z]{3,}\b", t.lower())
        assert r["s"] == " ".join(w for w in t.lower().split() if w not in stop)
        assert r["v"] == re.findall(r"\b\w\w+\b", t)
        assert r["k"] == re.findall(r"\w[\w']*", t)


def test_search_mixes_words_and_headings(spark):
    rows = [
        (1, "A stroke trial", None, "Neurology; Brain Injuries"), (2, "Caf\u00e9s", "stroke\u00e9s", "stroke"),
        (3, None, "trials of care", " neurology ; Other"), (4, "pilot of trials", "", "Neurology"), (5, None, None, None),
    ]
    df = spark.createDataFrame(rows, "id int, Title string, Abstract string, MeSH_Terms string")

    def ids(*a, **k):
        return sorted(r["id"] for r in boolean_search(df, *a, **k).collect())

    assert ids([["stroke", Heading("neurology")]]) == [1, 3, 4]
    assert ids([["stroke", Heading("neurology")], ["trial*"]], ["pilot"]) == [1, 3]
    assert ids([[Heading("Brain*")]]) == [1]
    assert ids([["trial*"]], [Heading("neurology")]) == []
    assert ids([["trial*"]], mesh_all_of=["Neurology"]) == [1, 3, 4]
    assert ids([[]]) == []
    assert ids([]) == [1, 2, 3, 4, 5]


def test_study_type(spark):
    assert one(spark, classify_study_type("x"), "an infarct case") == "RCT"  # T8
    assert one(spark, classify_study_type("x"), "pilot randomised") == "RCT"
    assert one(spark, classify_study_type("x"), None) == "Non spécifié"
    assert one(spark, classify_study_type("x"), "nothing") == "Unspecified"
    assert one(spark, classify_study_type("x", word_boundary=True), "an infarct case") == "Unspecified"


def test_populations(spark):
    assert one(spark, tag_populations("x"), None) == []
    assert one(spark, tag_populations("x"), "nothing") == ["Unspecified"]
    assert one(spark, tag_populations("x"), "stroke after tbi") == ["Stroke", "TBI"]


def test_tfidf_shuffles_only_terms_that_can_be_chosen(spark):
    from pyspark.sql import functions as F

    from prismark.operators import features as ft

    rows = [(k % 50 if k % 9 else None, f"alpha beta gamma gamma word{chr(97 + k % 7)}x once{chr(97 + k % 26)}{chr(97 + k // 26)}y beta alpha") for k in range(70)]
    docs = spark.createDataFrame([*rows, (900, None), (901, "beta gamma")], "id long, text string")
    n = docs.count()
    terms = ft.doc_terms(docs, "id", "text", ["gamma"])
    for size, top in ((3, 0.99), (4, 0.99), (200, 0.8)):  # with 200 not enough words qualify, so nothing is ruled out
        weights, vocab, _ = ft.tfidf(docs, "id", "text", ["gamma"], max_features=size, min_df=2, max_df=top)
        want = ft.vocabulary(terms, F.lit(n), size, 2, top)
        assert sorted(map(tuple, vocab.collect())) == sorted(map(tuple, want.collect()))
        got = sorted((r.doc or -1, r.term) for r in weights.collect())
        held = terms.join(want.select("term"), "term").select("doc", "term")
        assert got == sorted((r.doc or -1, r.term) for r in held.collect())
    chosen, _ = ft.capped_terms(docs, "id", "text", ["gamma"], F.lit(n), 3, 2, 0.99, (1, 3))
    assert chosen.select("term").distinct().count() == 3 < terms.select("term").distinct().count()


def test_lemmatize_tokenises_the_corpus_once_for_the_empty_documents(spark):
    from prismark.operators import lemma as lm

    rows = [(1, "cats cat, Dogs"), (2, None), (2, " "), (3, "\t"), (4, "dogs"), (4, "")]
    docs = spark.createDataFrame(rows, "id long, text string")
    out = lm.lemmatize(docs, "id", "text", lm.plural_lexicon(docs, "text"))
    assert sorted(map(tuple, out.collect())) == [(1, "cat cat , Dogs"), (2, ""), (2, ""), (3, ""), (4, "dogs")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 2  # one explode, and its own non-empty check
