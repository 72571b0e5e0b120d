"""The join where ids are null or shared, and the scores of the language model, against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from prismark.llm import jaccard_join, language_id
from tests.llm import brute

WORDS = [f"w{k}" for k in range(40)]


def plain_components(rows, n, p, q):
    """Smallest id reachable by links and by rows that share an id, of every row."""
    sets = [brute.gram_set(t, n) for _, t in rows]
    part = list(range(len(rows)))

    def root(k):
        while part[k] != k:
            k = part[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            linked = sets[i] and sets[j] and q * len(sets[i] & sets[j]) >= p * len(sets[i] | sets[j])
            if linked or rows[i][0] is not None and rows[i][0] == rows[j][0]:
                part[root(i)] = root(j)
    ids = {}
    for k, (d, _) in enumerate(rows):
        ids.setdefault(root(k), []).extend([] if d is None else [d])
    return [(d, len(sets[k]), min(ids[root(k)], default=None)) for k, (d, _) in enumerate(rows)]


@pytest.mark.parametrize("lean", [False, True])
def test_null_and_shared_ids_lose_no_link(spark, lean):
    rng = random.Random(4)
    base = [" ".join(rng.choice(WORDS) for _ in range(60)) for _ in range(6)]

    def near(t):
        return t + " " + rng.choice(WORDS)

    rows = [
        (None, base[0]), (7, near(base[0])), (None, near(base[0])), (None, base[1]), (None, near(base[1])),
        (5, base[2]), (5, base[3]), (9, near(base[3])), (3, near(base[2])), (8, base[4]), (8, base[4]), (2, base[4]),
        (2, base[5]), (11, near(base[5])), (None, None), (None, ""), (12, None), (12, base[1]), (13, "a b"), (None, "A B"), (14, "zz"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.jaccard_components(df, n=3, p=80, q=100, lean=lean).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(plain_components(rows, 3, 80, 100), key=key)


def test_ids_that_tell_texts_apart_take_the_short_way(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "_by_id_and_text", None)
    df = spark.createDataFrame([(1, "a b c d"), (2, "a b c d"), (2, "A b c d"), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id) for r in jaccard_join.jaccard_components(df, n=3).collect()) == [(0, None), (1, 1), (2, 1), (2, 1)]


def plain_bayes(texts, log, langs):
    out = []
    bits = int(math.log2(len(log)))
    for t in texts:
        sums = [0.0] * len(langs)
        for g in language_id.gram_buckets(t, bits).tolist():
            for k in range(len(langs)):
                sums[k] += log[g, k]
        best = max(range(len(langs)), key=lambda k: (sums[k], -k))
        out.append((langs[best], 1 / sum(math.exp(s - sums[best]) for s in sums)))
    return out


def test_sparse_batches_score_like_a_plain_naive_bayes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    langs, log = language_id.fit(docs)
    texts = [r.text for r in docs.where(F.col("text").rlike("[a-z]")).orderBy("doc_id").limit(40).collect()] + ["a", "é è", "ΑΣ İ"]
    pred, score, unlikely = language_id.predict([*texts, None, "", "12 34"], langs, log)
    for (lang, p), a, b in zip(plain_bayes(texts, log, langs), pred, score):
        assert (lang, round(p, 9)) == (a, round(b, 9))
    assert pred[-3:] == ["und"] * 3 and score[-3:] == [0.0] * 3
    one_by_one = [language_id.predict([t], langs, log) for t in texts]
    assert np.allclose([x[1][0] for x in one_by_one], score[: len(texts)]) and np.allclose([x[2][0] for x in one_by_one], unlikely[: len(texts)])


def test_pieces_of_a_long_text_count_every_gram_once():
    rng = random.Random(2)
    for n in (1, 2, 3, 7, 8, 9, 15, 16, 17, 100):
        text = "".join(rng.choice("abcéΣß .1") for _ in range(n))
        used, count = language_id._grams(text, 12, piece=8)
        whole = np.bincount(language_id.gram_buckets(text.lower(), 12), minlength=1 << 12)
        assert used.tolist() == np.flatnonzero(whole).tolist() and count.tolist() == whole[used].tolist()


def test_nothing_learned_keeps_all_and_too_many_languages_are_refused(spark):
    df = spark.createDataFrame([(k, f"text {k}", None) for k in range(30)], "doc_id long, text string, lang string")
    model = language_id.fit(df)
    assert model[0] == [] and {r.lang_pred for r in language_id.identify(df, model).collect()} == {"und"}
    assert language_id.keep_identified(df, model).count() == 30
    dirty = df.withColumn("lang", F.concat(F.lit("l"), F.col("doc_id").cast("string")))
    with pytest.raises(ValueError):
        language_id.fit(dirty, most_languages=5)


def test_texts_that_spell_a_special_token_are_encoded_as_the_library_does():
    import public_tokenizers
    from tokenizers import Tokenizer

    from prismark.llm.tokens import library_encoder

    path = public_tokenizers.path("byte_bpe_50k.json")
    mark = next(iter(Tokenizer.from_file(path).get_added_tokens_decoder().values())).content
    texts = [mark, f"a {mark} b", f"a{mark}{mark}\n\nb  c", "a b", f"{mark[:-1]} x", " x", "  x", "x y"]
    want = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in library_encoder(path).encode(texts)] == want
