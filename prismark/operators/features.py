"""Corpus text features: vocabulary, TF-IDF, mean scores, c-TF-IDF (M1-M3, M11,
O1, O4, M13, X16).

Data layout: a long ``(doc, term, cnt)`` table instead of a sparse matrix, made
only of terms that can enter the vocabulary.  An n-gram is no more frequent than
any word in it, so once ``max_features`` words are known to qualify, a term less
frequent than the last of them is out, and so is every n-gram with such a word.
Words are counted first (few different ones, pre-summed per task), then the
n-grams of the words that are left.  Of a document whose id stands in one row the
terms are told apart in the row; only rows that share an id (or have none) are
shuffled by ``(doc, term)`` to count documents.  Once the vocabulary is capped by
``max_features`` it has a proven size and is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from prismark.functions.text import WORD, drop_tokens, ngrams, term_tokens
from prismark.operators.ranking import top_k_per_group
from prismark.session import written

WORD_PATTERN = f"[{WORD}]{{2,}}"  # default token rule of the count vectoriser behind c-TF-IDF


def _count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def doc_terms(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    stop_words: Iterable[str] = (),
    ngram_range: tuple[int, int] = (1, 3),
) -> DataFrame:
    """X14 -> stop words -> X15, counted per document: ``(doc, term, cnt)``."""
    toks = docs.select(F.col(id_col).alias("doc"), drop_tokens(term_tokens(F.col(text_col)), stop_words).alias("_t"))
    return _counted(toks.select("doc", ngrams(F.col("_t"), *ngram_range).alias("_g")))


def _counted(grams: DataFrame) -> DataFrame:
    """``(doc, term, cnt)`` of rows ``(doc, _g)``; null terms are none."""
    exploded = grams.select("doc", F.explode("_g").alias("term")).where(F.col("term").isNotNull())
    return exploded.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("cnt"))


#: Words at most that are held against a document's words one row at a time.
FREQUENT = 1 << 14


def _stats(grams: DataFrame) -> DataFrame:
    """``(term, df, tf)`` of rows ``(doc, _again, _g)``; ``_again`` marks rows whose id does not stand for one row."""
    own = grams.where("not _again").select(F.sort_array("_g").alias("_g")).select(
        F.explode(F.transform("_g", lambda w, i: F.struct(
            w.alias("term"), F.when((i == 0) | (F.get("_g", i - 1) != w), 1).otherwise(0).cast("long").alias("first"),
        ))).alias("e")
    ).select("e.term", F.col("e.first").alias("df"), F.lit(1).cast("long").alias("tf"))
    shared = _counted(grams.where("_again").select("doc", "_g")).select("term", F.lit(1).cast("long").alias("df"), F.col("cnt").alias("tf"))
    return own.unionByName(shared).where("term is not null").groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))


def _selected(stats: DataFrame, n_docs: Column, max_features: int | None, min_df: int | float, max_df: int | float) -> DataFrame:
    lo = F.lit(min_df) if isinstance(min_df, int) else F.lit(float(min_df)) * n_docs
    hi = F.lit(max_df) if isinstance(max_df, int) else F.lit(float(max_df)) * n_docs
    kept = stats.where((F.col("df") >= lo) & (F.col("df") <= hi))
    if max_features is not None:
        kept = kept.orderBy(F.desc("tf"), F.asc("term")).limit(max_features)
    return kept


def _idf(n_docs: Column) -> Column:
    return F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)


def vocabulary(
    terms: DataFrame,
    n_docs: Column,
    max_features: int | None = 200,
    min_df: int | float = 2,
    max_df: int | float = 0.8,
) -> DataFrame:
    """M1: ``(term, df, tf, idf)``; df/tf pruning, then the ``max_features`` most frequent.

    Integer bounds are document counts, float bounds are shares of ``n_docs``.
    Ties on total frequency go to the alphabetically first term.
    """
    stats = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("cnt").alias("tf"))
    kept = _selected(stats, n_docs, max_features, min_df, max_df)
    return kept.select("term", "df", "tf", _idf(n_docs).alias("idf"))


def capped_terms(
    docs: DataFrame, id_col: str, text_col: str, stop_words: Iterable[str], n_docs: Column,
    max_features: int, min_df: int | float, max_df: int | float, ngram_range: tuple[int, int],
) -> tuple[DataFrame, DataFrame]:
    """``doc_terms`` of the vocabulary's terms only, and the ``vocabulary`` of all of them."""
    lo, hi = ngram_range
    tokens = docs.select(F.col(id_col).alias("doc"), drop_tokens(term_tokens(F.col(text_col)), stop_words).alias("_t"))
    again = written(docs.groupBy(F.col(id_col).alias("_d")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 or _d is null").select("_d"))
    if again.isEmpty():
        tokens = tokens.withColumn("_again", F.lit(False))
    else:
        tokens = tokens.join(again.withColumn("_again", F.lit(True)), F.col("doc").eqNullSafe(F.col("_d")), "left").select(
            "doc", "_t", F.coalesce("_again", F.lit(False)).alias("_again")
        )
    tokens = written(tokens)
    frequent = None
    if lo == 1:
        words = written(_stats(tokens.select("doc", "_again", F.col("_t").alias("_g"))))
        sure = _selected(words, n_docs, max_features, min_df, max_df).agg(F.count(F.lit(1)).alias("n"), F.min("tf").alias("tf")).first()
        if sure.n == max_features:
            left = words.where(F.col("tf") >= sure.tf).select("term").limit(FREQUENT + 1).collect()
            frequent = [r.term for r in left] if len(left) <= FREQUENT else None
    if frequent is None:
        grams = tokens.select("doc", "_again", ngrams(F.col("_t"), lo, hi).alias("_g"))
    else:  # a null word makes null n-grams, which are none
        held = tokens.select("doc", "_again", F.transform("_t", lambda w: F.when(w.isin(*frequent), w)).alias("_t"))
        held = held.select("doc", "_again", ngrams(F.col("_t"), lo, hi).alias("_g"))
        grams = held.select("doc", "_again", F.filter("_g", lambda w: w.isNotNull()).alias("_g"))
    vocab = written(_selected(_stats(grams), n_docs, max_features, min_df, max_df).select("term", "df", "tf", _idf(n_docs).alias("idf")))
    chosen = [r.term for r in vocab.select("term").collect()]  # at most max_features
    return _counted(grams.select("doc", F.filter("_g", lambda w: w.isin(*chosen)).alias("_g"))), vocab


def tfidf(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    stop_words: Iterable[str] = (),
    max_features: int | None = 200,
    min_df: int | float = 2,
    max_df: int | float = 0.8,
    ngram_range: tuple[int, int] = (1, 3),
) -> tuple[DataFrame, DataFrame, Column]:
    """M2: smooth-idf TF-IDF with L2-normalised rows.

    Returns ``(weights(doc, term, weight), vocabulary, n_docs)``; documents
    with no vocabulary term have no rows but still count in ``n_docs``.
    """
    n_docs = _count(docs)
    if max_features is not None:
        terms, vocab = capped_terms(docs, id_col, text_col, stop_words, n_docs, max_features, min_df, max_df, ngram_range)
    else:
        terms = doc_terms(docs, id_col, text_col, stop_words, ngram_range)
        vocab = vocabulary(terms, n_docs, max_features, min_df, max_df)
    v = F.broadcast(vocab) if max_features is not None else vocab
    raw = terms.join(v.select("term", "idf"), "term").select("doc", "term", (F.col("cnt") * F.col("idf")).alias("w"))
    # At most max_features rows per document, so the per-document window is small.
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc")))
    weights = raw.select("doc", "term", (F.col("w") / norm).alias("weight"))
    return weights, vocab, n_docs


def mean_term_score(weights: DataFrame, n_docs: Column) -> DataFrame:
    """M3: column mean over all documents (absent = 0)."""
    return weights.groupBy("term").agg((F.sum("weight") / n_docs).alias("score"))


def top_terms(scores: DataFrame, k: int = 20) -> DataFrame:
    """O1."""
    return scores.orderBy(F.desc("score"), F.asc("term")).limit(k)


def top_terms_per_cluster(
    weights: DataFrame, labels: DataFrame, n: int = 8, doc_col: str = "doc", cluster_col: str = "cluster"
) -> DataFrame:
    """Mean weight of each term over the members of a cluster, top ``n`` per cluster."""
    lab = labels.select(F.col(doc_col).alias("doc"), F.col(cluster_col).alias("cluster"))
    sizes = lab.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_docs"))
    sums = weights.join(lab, "doc").groupBy("cluster", "term").agg(F.sum("weight").alias("s"))
    means = sums.join(sizes, "cluster").select(
        "cluster", "term", (F.col("s") / F.col("n_docs")).alias("score")
    )
    return top_k_per_group(means, ["cluster"], [F.desc("score"), F.asc("term")], n, "rank")


def class_tfidf(
    docs: DataFrame,
    text_col: str,
    topic_col: str,
    bm25: bool = True,
    reduce_frequent_words: bool = True,
) -> DataFrame:
    """Class-based TF-IDF, ``(topic, term, cnt, score)`` for every term used by a topic.

    Per topic ``c`` and term ``t``: ``tf = cnt / sum_t cnt`` (square-rooted when
    ``reduce_frequent_words``); ``A`` = integer part of the mean word count per
    topic, ``f`` = the term's count over all topics;
    ``idf = ln(1 + (A - f + .5) / (f + .5))`` with ``bm25``, else ``ln(1 + A / f)``.
    """
    toks = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(WORD_PATTERN), 0)
    counts = (
        docs.select(F.col(topic_col).alias("topic"), F.explode(toks).alias("term"))
        .groupBy("topic", "term")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    topic_tot = counts.groupBy("topic").agg(F.sum("cnt").alias("topic_words"))
    avg_words = F.floor(topic_tot.agg(F.avg("topic_words")).scalar())
    term_tot = counts.groupBy("term").agg(F.sum("cnt").alias("f"))
    if bm25:
        idf = F.log(F.lit(1.0) + (avg_words - F.col("f") + F.lit(0.5)) / (F.col("f") + F.lit(0.5)))
    else:
        idf = F.log(F.lit(1.0) + avg_words / F.col("f"))
    tf = F.col("cnt") / F.col("topic_words")
    if reduce_frequent_words:
        tf = F.sqrt(tf)
    return (
        counts.join(topic_tot, "topic")
        .join(term_tot, "term")
        .select("topic", "term", "cnt", (tf * idf).alias("score"))
    )


def topic_terms(ctfidf: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` best (term, score) per topic."""
    return top_k_per_group(ctfidf, ["topic"], [F.desc("score"), F.asc("term")], n, "rank")


WORDCLOUD_PATTERN = f"[{WORD}][{WORD}']*"


def wordcloud_terms(
    docs: DataFrame, cluster_col: str, text_col: str, stop_words: Iterable[str], k: int = 30
) -> DataFrame:
    """The ``k`` most frequent words per cluster, scaled to the largest count.

    Words: ``\\w[\\w']*``, trailing ``'s`` removed, compared lower-case against
    the stop list, pure digits dropped; unigrams only.
    """
    stop = sorted({w.lower() for w in stop_words})
    words = F.transform(
        F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORDCLOUD_PATTERN), 0),
        lambda w: F.lower(F.regexp_replace(w, "'s$", "")),
    )
    kept = F.filter(words, lambda w: ~w.isin(*stop) & ~w.rlike("^[0-9]+$") & (w != ""))
    counts = (
        docs.select(F.col(cluster_col).alias("cluster"), F.explode(kept).alias("word"))
        .groupBy("cluster", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    top = top_k_per_group(counts, ["cluster"], [F.desc("n"), F.asc("word")], k, "rank")
    return top.withColumn("weight", F.col("n") / F.max("n").over(Window.partitionBy("cluster")))
