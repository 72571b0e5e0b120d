"""Every operator on nulls, empty and long texts, ties, repeated rows, extra columns and empty tables, against brute force."""

import base64
import hashlib
import io
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from prismark.llm import bpe, exact_dedup, html_extraction as html, jaccard_join, language_id, pii, quality_classifier, quality_rules
from prismark.llm.packing import pack
from prismark.llm.token_files import TokenFileReader, TokenFileWriter, fetch, read_token_files, write_token_files
from tests.llm import brute

SF = "/root/testdata/sf0.001"
BYTE_BPE = P.path("byte_bpe_50k.json")
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_sha256 string, row int, value string, sig int"
LONG = " ".join(f"word{k % 700}" for k in range(20_000))
TEXTS = [
    None, "", " \n\t", "a", "A  b\n\n\nc  ", "a b c d e f g h i j k", "A B C D E F G H I J  K", "a b c d e f g h i j k l",
    LONG, LONG + " x", LONG, "1 " * 3000, "x" * 20_000, "mail me: x_@d.e, a@b.c_x@d.e.f or +1 (555) 123-4567", "1.2.3.4 999.1.1.1 1.2.3.4.5.6.7.8",
    "card 4111111111111111 and 4111-1111 1111 1111, 4111111111111112", "日本語テキスト 😀 1.2.3.4", "don't I'll we've  '", "\t\r\x0b\x0c z",
    "a b c d e f g h " * 3 + "t", "<script> & # * $ | %",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k, t, "en" if k % 2 else None, None if k % 3 else "s", 1, "x", 1, "v", 2) for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def library_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE_BPE)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


def test_packing_places_every_id_once_without_padding(spark, odd, docs):
    rows = odd.select("doc_id", "text").unionByName(docs.select(F.col("doc_id") + 1000, "text").toDF("doc_id", "text"))
    want = {k: np.array(library_ids(t) + [0], "<u4") for k, t in texts_of(rows).items()}
    got = pack(rows, BYTE_BPE).toPandas()
    for doc, g in got.groupby("doc_id"):
        g = g.sort_values("start")
        assert b"".join(g.ids) == want[doc].tobytes() and (g.doc_tokens == len(want[doc])).all()
        assert g.start.tolist() == [0, *np.cumsum(g.length)[:-1].tolist()]
    assert set(got.doc_id) == set(want)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        n = int(g.length.sum())
        assert n <= 1024 and (n == 1024 or n & (n - 1) == 0)
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1].tolist()]


def test_packing_bounds_its_open_windows(docs):
    got = pack(docs, BYTE_BPE, max_open=2).toPandas()
    assert got.groupby("doc_id").length.sum().equals(got.groupby("doc_id").doc_tokens.first().rename("length"))


def test_token_files_round_trip_and_random_access(spark, odd):
    want = {k: np.array(library_ids(t) + [0], "<u4") for k, t in texts_of(odd).items()}
    manifest = write_token_files(odd, BYTE_BPE)
    got = sorted(read_token_files(manifest).collect())
    assert [r.doc_id for r in got] == sorted(want)
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, bytes(r.ids)) == (at, len(want[r.doc_id]), want[r.doc_id].tobytes())
        at += r.n_tokens
    some = {r.doc_id: bytes(r.ids) for r in fetch(spark, manifest, [3, 8, 10**9]).collect()}
    assert some == {k: want[k].tobytes() for k in (3, 8)}


def test_token_file_checksums_and_null_ids():
    sink = io.BytesIO()
    writer = TokenFileWriter(sink, 2)
    for doc in (None, 4, 9):
        writer.add(doc, np.arange(50, dtype="<u4"))
    writer.finish()
    raw = bytearray(sink.getvalue())
    reader = TokenFileReader(io.BytesIO(bytes(raw)), len(raw))
    assert [d for d, _ in reader.documents()] == [None, 4, 9] and list(reader.get([9])[9][0]) == list(range(50))
    raw[int(reader.starts[1]) + 12] ^= 1
    with pytest.raises(Exception):
        list(TokenFileReader(io.BytesIO(bytes(raw)), len(raw)).documents())


def test_bpe_equals_the_rank_file_library(odd, docs):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = odd.select("doc_id", "text").unionByName(docs.select(F.col("doc_id") + 1000, "text").toDF("doc_id", "text"))
    texts = texts_of(rows)
    for r in bpe.round_trip(rows, RANKS, P.PATTERN).collect():
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    coded = bpe.encode(odd, RANKS, P.PATTERN)
    assert {r.doc_id: bytes(r.data).decode() for r in bpe.decode(coded, RANKS, P.PATTERN).collect()} == {
        k: t or "" for k, t in texts_of(odd).items()
    }


def test_jaccard_components_equal_brute_force(odd, docs):
    rows = odd.select("doc_id", "text").unionByName(docs.select(F.col("doc_id") + 1000, "text").toDF("doc_id", "text"))
    for n, p, q in ((3, 90, 100), (5, 80, 100)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(rows, n=n, p=p, q=q, lean=p == 80).collect()}
        assert got == brute.components(list(texts_of(rows).items()), n, p, q)


def test_jaccard_blocks_find_what_leaders_miss(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(base[: 60 - k] + [f"v{j}" for j in range(k)])) for k in range(30)]  # a chain of small changes
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df, n=3, p=90, q=100).collect()}
    assert got == brute.components(rows, 3, 90, 100)


def test_part_enum_shares_a_signature_at_the_threshold():
    rng = np.random.default_rng(1)
    for p, spare, weak in ((90, 0.05, 2), (80, 0.15, 1)):
        join = jaccard_join.PartEnum(p, 100, 2, 1, spare, weak)
        for size in [*range(4, 60), 300, 2000]:
            union = rng.integers(0, 2**63, size).astype(np.uint64)
            cut = (100 - p) * size // 100
            a, b = union[: size - cut // 2], union[cut - cut // 2 :]
            if len(a) + len(b) - size and 100 * (len(a) + len(b) - size) >= p * size and set(a) != set(b):
                assert set(join.signatures(a)) & set(join.signatures(b)), (p, size)


def test_exact_dedup_ties_and_collisions(spark, odd, monkeypatch):
    rows = {k: t or "" for k, t in texts_of(odd).items()}
    norm = {k: re.sub(r"[\x20\x09-\x0D]", "", t) for k, t in rows.items()}
    got = {r.doc_id: r for r in exact_dedup.exact_dedup(odd).collect()}
    for k, r in got.items():
        group = [j for j in rows if norm[j] == norm[k]]
        keep = min(group, key=lambda j: (-len(rows[j]), j))
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(group), keep == k)
        assert r.text_sha256 == hashlib.sha256(norm[k].encode()).hexdigest()
    assert exact_dedup.keep_first(odd).columns == odd.columns
    assert {r.doc_id for r in exact_dedup.keep_first(odd).collect()} == {k for k, r in got.items() if r.kept}
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.substring(F.hex(F.crc32(c)), 1, 1))
    again = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(odd).collect()}
    assert again == {k: (r.keep_id, r.group_size) for k, r in got.items()}  # many texts with one digest


def test_pii_base_spans_and_redaction(odd):
    texts = texts_of(odd)
    for r in pii.report(odd).collect():
        spans = brute.pii_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert r.base_sha256 == brute.span_digest(spans)
    clean = texts_of(pii.redact(odd))
    assert clean[15] == "card <card> and <card>, 4111111111111112" and clean[0] is None and clean[3] == "a"


def test_pii_contexts_discover_unseen_identifiers(spark):
    good = ["4111111111111111", "5500005555555559", "4012888888881881", "6011111111111117", "3530111333300000", "4222222222222220"]
    texts = [f"pay by card {c} today please" for c in good * 6] + ["pay by card 4111111111111112 today please", "ref 4111111111111113 x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_added, r.spans) for r in pii.report(df).collect()}
    assert got[36] == (1, "card:12:28") and got[37] == (0, "") and got[0] == (0, "card:12:28")


def test_pii_contexts_discover_formats_without_base_pattern(spark):
    texts = [f"you can call me on +1 (555) 010-{k:04d} after the meeting" for k in range(12)]
    texts += [f"write to the address user{k}@mail.example.com for any questions" for k in range(12)]
    planted = {
        len(texts): ("you can call me on ", "0171 555 88 99", " after the meeting", "phone"),
        len(texts) + 1: ("you can call me on ", "555-0199", " after the meeting", "phone"),
        len(texts) + 2: ("write to the address ", "jane.roe7@intranet", " for any questions", "email"),
    }
    texts += [a + v + b for a, v, b, _ in planted.values()]
    other = len(texts)
    texts += ["the desk has 0171 555 88 99 written down", "there were 2048 pages on 4096 sheets"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_added, r.spans) for r in pii.report(df).collect()}
    for k, (a, v, b, kind) in planted.items():
        assert got[k] == (1, f"{kind}:{len(a)}:{len(a) + len(v)}")
    assert got[other] == (1, "phone:13:27") and got[other + 1] == (0, "")
    assert all(got[k][0] == 0 for k in range(24))


def test_pii_contexts_are_learned_from_accepted_instances(spark):
    hops = 5
    contexts = [(f"one{c} two{c} three{c} ", f" four{c} five{c} six{c}") for c in "abcdef"]
    values = [[f"+1 (555) 010-{k:04d}" if c == 0 else f"0{c}71 555 88 {k}{c}" for k in range(4)] for c in range(hops + 1)]
    texts = [a + v + b for c, (a, b) in enumerate(contexts) for v in values[c] * 12]
    unseen = len(texts) - 4 * 12 * hops
    texts += [a + v + b for c, (a, b) in enumerate(contexts[:-1]) for v in values[c + 1]]
    texts += ["no context like onea 19-04-77 sixa before", "other 0371 555 77 00 words"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_added for r in pii.report(df).collect()}
    assert [got[k] for k in range(unseen)] == [0] * unseen
    assert [got[k] for k in range(unseen, len(texts) - 2)] == [1] * (len(texts) - 2 - unseen)
    assert got[len(texts) - 2] == got[len(texts) - 1] == 0


def test_language_id_held_out_accuracy(docs, odd):
    model = language_id.fit(docs)
    got = language_id.identify(docs, model).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 20 and sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)
    und = {r.doc_id for r in language_id.identify(odd, model).collect() if r.lang_pred == "und"}
    assert und == {k for k, t in texts_of(odd).items() if not any(c.isalpha() for c in t or "")}
    assert {r.doc_id for r in language_id.keep_identified(odd, model).collect()} == set(texts_of(odd)) - und


def test_pipeline_language_stage_drops_noise(spark, docs):
    import corpus_pipeline

    rng = np.random.default_rng(1)
    noise = ["".join(rng.choice(list(signs), n)) for signs in ("abcdefghijklmnopqrstuvwxyz    ", "ABCDEFGHabcdefghijklmnopqrstuvwxyz0123456789+/") for n in (60, 300, 3000)]
    noise += ["".join(rng.choice(list("%$#!*&()  "), n)) + "a" for n in (60, 300, 3000)]
    noise += ["Это обычный русский текст, который никто здесь не учил узнавать. " * 3]
    noise += ["Tämä on tavallinen suomenkielinen teksti, jota kukaan ei ole opetellut tunnistamaan. " * 3]
    clean = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    planted = spark.createDataFrame([(-k - 1, t) for k, t in enumerate(noise)], "doc_id long, text string")
    both = clean.unionByName(planted, allowMissingColumns=True)
    got = corpus_pipeline.language(spark, both, "")
    assert got.columns == clean.columns
    kept = {r.doc_id for r in got.select("doc_id").collect()}
    assert kept == {k for k, t in texts_of(clean).items() if any(c.isalpha() for c in t or "")}


def test_quality_classifier_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_classifier.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.quality == r.predicted for r in got) >= 0.93 * len(got) and all(0 <= r.score <= 1 for r in got)


def test_quality_rules_counts_and_outliers(spark, odd):
    texts = texts_of(odd)
    for r in quality_rules.quality_rules(odd).collect():
        t = texts[r.doc_id] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), brute.repeated_words(t))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 20 or 100 * want[4] > 30 * len(w)) and (not r.base_failed or not r.kept)
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_rules.quality_rules(docs).where("not base_failed").join(labels, "doc_id").collect()
    good, bad = ([r for r in got if r.quality == k] for k in (1, 0))
    assert sum(r.kept for r in good) >= 0.98 * len(good) and sum(r.kept for r in bad) <= 0.2 * len(bad)


def test_quality_rules_judge_rows_of_small_groups(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = docs.join(labels, "doc_id").where("lang = 'en' and text is not null").select("doc_id", "text", "quality").orderBy("doc_id").collect()
    rows = [r for r in rows if len(r.text.split()) >= 20 and 100 * brute.repeated_words(r.text) <= 30 * len(r.text.split())]
    good, bad = ([r for r in rows if r.quality == k] for k in (1, 0))
    bad = bad[:6]
    # one large source and a small one, a language that is small altogether, and a table of fewer than 100 rows
    large = [(r.doc_id, r.text, "en", "large") for r in good[:120]]
    small = [(r.doc_id, r.text, "en", "small") for r in good[120:125] + bad]
    other = [(r.doc_id, r.text, "xx", "small") for r in good[125:130] + bad]
    tiny = [(r.doc_id, r.text, "en", "large") for r in good[:70] + bad]
    assert len(good) >= 130 and len(bad) == 6
    for table, place in ((large + small, "small"), (large + other, "small"), (tiny, "large")):
        df = spark.createDataFrame(table, "doc_id long, text string, lang string, source string")
        got = {r.doc_id: r for r in quality_rules.quality_rules(df).collect()}
        judged = [got[k] for k, _, _, source in table if source == place]
        assert all(r.distance is not None for r in judged)
        kept = {r.doc_id for r in judged if r.kept}
        assert not kept & {r.doc_id for r in bad}
        assert len(kept) >= 0.95 * (len(judged) - len(bad))


def test_html_blocks_and_labeller(spark):
    page = (
        "<header><div>Site</div></header><div class='menu'><ul><li><a href=x>Home</a><li><a>About</a></ul></div><main><h1>Title</h1>"
        "<p>First &amp; <b>long</b>\n paragraph of the story.<p>Second one<br>here.</main><script>x<p></script>"
        "<section class=comments><div class='comment'><p>I like this a lot.</p></div></section><footer>(c)</footer>"
    )
    blocks = html.leaf_blocks(page)
    assert [b[1] for b in blocks] == [
        "Site", "Home", "About", "Title", "First & long paragraph of the story.", "Second one here.", "I like this a lot.", "(c)"
    ]
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = html.train_labeller(pages, sample_pages=60)
    extra = spark.createDataFrame([(-1, None, page), (-2, "u", None), (-3, "u", "")], pages.schema)
    got = {r.page_id: r for r in html.extract(pages.unionByName(extra), model).collect()}
    assert got[-2].text == got[-3].text == "" and got[-2].n_chars == 0
    right = 0
    rows = pages.collect()
    for r in rows:
        want = "\n".join(b[1] for b in html.leaf_blocks(r.html) if "article" in b[0])
        right += got[r.page_id].text == want
    assert right >= 0.95 * len(rows)


@pytest.mark.parametrize("page", [
    "<head><title>T</title></head><p>One</p><script>for(i=0;i<n;i++){go()}</script><article>Two</article><script>x</script><p>Three</p>",
    "<head></head><p>One<script>a = '<!--';</script><article>Two</article><p>Three",
    "<p>One</p><STYLE>a<b{}</Style ><p>Two</p><textarea><p>no</textarea><p>Three</p>",
    "<html><head><meta charset=utf-8><title>a <b</title><link href=x><body><p>One</p><p>Two</p><p>Three</p></body></html>",
    "<html><head><title>T</title><noscript><img src=x>no</noscript><style>p<q</style><script src=x /><p>One</p><p>Two</p><p>Three</p>",
    "<head><title>T</title>\n<!-- c -->\nOne<div>Two</div>Three",
    "<head><meta a></head><body><p>One<p>Two<!--><p>Three<!-- no",
    "<header>One</header><heading>Two</heading><scripted>Three</scripted>",
])
def test_html_raw_elements_and_open_heads(page):
    assert [b[1] for b in html.leaf_blocks(page)] == ["One", "Two", "Three"]


def test_html_head_elements_stay_hidden():
    for page in ("<head><title>T</title><template><p>no</p></template><script>x</script></head>", "<head></head>", "<p><script>One<p>Two"):
        assert html.leaf_blocks(page) == []


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert pack(empty, BYTE_BPE).count() == 0
    assert read_token_files(write_token_files(empty, BYTE_BPE)).count() == 0
    assert bpe.round_trip(empty, RANKS, P.PATTERN).count() == 0
    assert jaccard_join.jaccard_components(empty).count() == 0
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert quality_rules.quality_rules(empty).count() == 0
    assert quality_classifier.classify(empty, labels).count() == 0
    assert language_id.identify(empty, language_id.fit(empty)).count() == 0
    assert pii.report(empty).count() == 0 and pii.redact(empty).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html.extract(pages, html.train_labeller(pages)).count() == 0


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline

    rows = texts_of(spark.read.parquet(f"{SF}/documents.parquet"))
    kept = {k: t for k, t in rows.items() if any(c.isalpha() for c in t or "")}
    norm = {k: re.sub(r"[\x20\x09-\x0D]", "", t) for k, t in kept.items()}
    best = {}
    for k in kept:
        best[norm[k]] = min(best.get(norm[k], k), k, key=lambda j: (-len(kept[j]), j))
    kept = {k: kept[k] for k in best.values()}
    smallest = brute.components(list(kept.items()), 5, 80, 100)
    kept = {k: t for k, t in kept.items() if smallest[k][1] == k}
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert set(got.doc_id) == set(kept)
    for k, t in kept.items():
        if not brute.pii_spans(t):
            ids = np.array(library_ids(t) + [0], "<u4")
            pieces = got[got.doc_id == k].sort_values("start")
            assert pieces.length.sum() == len(ids)
            assert [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(pieces.start, pieces.length)] == pieces.ids_crc32.tolist()
