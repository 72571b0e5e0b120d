"""Edge cases of single operators: long match lists, overlapping spans, awkward markup, files over tasks."""

import random
import time

import pytest
from pyspark.sql import functions as F

from prismark.llm import html_extraction as html, pii
from prismark.llm.token_files import spread
from tests.llm import brute


def plain_redaction(text, spans):
    out, at = [], 0
    for kind, s, e in spans:
        if s >= at:
            out += [text[at:s], f"<{pii.KINDS[kind]}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def test_scans_of_every_length(spark):
    rng = random.Random(3)
    lists = [[rng.randrange(50) for _ in range(n)] for n in (0, 1, 2, 63, 64, 65, 128, 129, 4095, 4096, 4097, 5000)]
    df = spark.createDataFrame([(v,) for v in lists], "v array<int>")
    sums, tops = pii._scan(F.col("v"), lambda a, b: a + b), pii._scan(F.col("v"), lambda a, b: F.greatest(a, b))
    for v, r in zip(lists, df.select("v", sums.alias("s"), tops.alias("t")).collect()):
        assert list(r.v) == v
        assert list(r.s.out) == [sum(v[:k]) for k in range(len(v))] and r.s.at == sum(v)
        assert list(r.t.out) == [max(v[:k], default=0) for k in range(len(v))] and r.t.at == max(v, default=0)


def test_texts_without_overlapping_spans(spark):
    rng = random.Random(5)
    rows = []
    for n in (1, 4095, 4096, 4097, 8192, 20_000):
        text = "".join(rng.choice("abé\U0001f600\n ") for _ in range(n))
        spans = sorted({(rng.randrange(4), s, min(n, s + rng.randrange(1, 6000 if k % 7 == 0 else 9))) for k in range(60) for s in [rng.randrange(n)]},
                       key=lambda x: (x[1], x[0]))
        rows += [(text, spans), (text, [])]
    df = spark.createDataFrame(rows, "text string, spans array<struct<kind:int,s:int,e:int>>")
    got = df.select("text", "spans", pii.without(F.col("text"), F.col("spans")).alias("out")).collect()
    for r in got:
        assert r.out == plain_redaction(r.text, [tuple(x) for x in r.spans])


def test_a_text_of_many_addresses_takes_seconds(spark):
    n = 40_000
    text = " ".join(f"u{k}@ab{k}.org" for k in range(n))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string").cache()
    df.count()
    start = time.time()
    found = pii.report(df).first()
    assert found.n_email == n and found.base_sha256 == brute.span_digest(brute.pii_spans(text))
    assert pii.redact(df).first().text == " ".join(["<email>"] * n)
    assert time.time() - start < 30  # a fold that copies its array took over 70 s


@pytest.mark.parametrize("page, blocks", [
    ('<a title="a > b" href=x>link</a>', ["link"]),
    ("<p title='x>y' class=\"a>b\">t</p>", ["t"]),
    ("<p it's>a</p><p>b</p>", ["a", "b"]),
    ('<p a="not closed>t</p>', ["t"]),
    ("<a href=x=\">\">z</a>", ["z"]),
    *((f"<article><{h}>Buy<p>after</p></article><p>more</p>", ["after", "more"])
      for h in ("button", "select", "object", "canvas", "noscript", "svg", "math", "template")),
    *((f"<div><p>a</p><{h}><g>icon</div>b", ["a", "b"]) for h in ("button", "select", "svg")),
    ("<svg><svg></svg>icon</svg>x", ["x"]),
    ("<button><div>Buy</div></button><p>x</p>", ["x"]),
    ("<button>a<button>b</button>c", ["c"]),
    ("<select><option>a<option>b</select>t", ["t"]),
    ("<head><noscript><link></head><body>b</body>", ["b"]),
    ("<head><noscript><link><body>b</body>", ["b"]),
])
def test_html_quotes_and_hidden_elements_without_end(page, blocks):
    assert [b[1] for b in html.leaf_blocks(page)] == blocks


@pytest.mark.parametrize("part", ['<a ="', "<a b=", "<button><p>", "<canvas>", "<svg><p>", "<p a='", "<a \"'", "<p>t", "<select><option>"])
def test_html_time_grows_with_the_page(part):
    start = time.time()
    html.leaf_blocks(part * 50_000)
    assert time.time() - start < 5


def test_manifest_is_spread_over_tasks(spark):
    files = spark.range(40).select(F.col("id").cast("string").alias("file")).coalesce(1)
    assert spread(files).rdd.getNumPartitions() > 1
    assert spread(files.limit(0)).count() == 0
