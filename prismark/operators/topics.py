"""Topic tables over labelled documents.

Topic labels come from any clustering (``-1`` = outliers, kept as a class of
its own); term scores come from ``features.class_tfidf``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from prismark.operators.cluster import _dot, _sqnorm, as_double_array, centroids_from_labels
from prismark.operators.features import topic_terms


def topic_info(docs: DataFrame, topic_col: str, ctfidf: DataFrame, n_words: int = 10) -> DataFrame:
    """Topics renumbered by size (largest = 0, ``-1`` stays), with count, name and top words.

    ``name`` is ``<id>_<w1>_<w2>_<w3>_<w4>``.  One row per topic; the renumbering
    window runs over the topic table (one row per topic), never over documents.
    """
    sizes = docs.groupBy(F.col(topic_col).alias("topic")).agg(F.count(F.lit(1)).alias("count"))
    w = Window.orderBy(F.desc("count"), F.asc("topic"))
    ranked = sizes.where(F.col("topic") != -1).withColumn("new_topic", (F.row_number().over(w) - 1).cast("long"))
    outl = sizes.where(F.col("topic") == -1).withColumn("new_topic", F.lit(-1).cast("long"))
    ids = ranked.unionByName(outl)
    words = (
        topic_terms(ctfidf, n_words)
        .groupBy("topic")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("_w"))
        .select("topic", F.transform("_w", lambda e: e["term"]).alias("words"))
    )
    out = ids.join(words, "topic", "left")
    name = F.concat_ws("_", F.col("new_topic").cast("string"), F.array_join(F.slice("words", 1, 4), "_"))
    return out.select(
        F.col("new_topic").alias("topic"),
        F.col("topic").alias("original_topic"),
        "count",
        name.alias("name"),
        F.array_join("words", " ").alias("representation"),
    )


def topic_probabilities(df: DataFrame, vec_col: str, topic_col: str, id_col: str) -> DataFrame:
    """Soft membership from cosine similarity to each topic centroid.

    Negative similarities count as 0; the rest are scaled to sum to 1 (an
    approximation of the density model's membership vector).  Long form
    ``(id, topic, probability)``.
    """
    cents = centroids_from_labels(df.where(F.col(topic_col) != -1), vec_col, topic_col)
    cs = cents.agg(F.sort_array(F.collect_list(F.struct("label", "centroid"))).alias("c")).scalar()
    v = as_double_array(vec_col)
    sims = F.transform(
        F.col("_cents"),
        lambda c: F.struct(
            c["label"].alias("topic"),
            F.greatest(
                _dot(v, c["centroid"]) / (F.sqrt(_sqnorm(v)) * F.sqrt(_sqnorm(c["centroid"]))), F.lit(0.0)
            ).alias("sim"),
        ),
    )
    rows = df.withColumn("_cents", cs).select(F.col(id_col).alias("id"), F.explode(sims).alias("t"))
    total = F.sum(F.col("t.sim")).over(Window.partitionBy("id"))  # one row per topic per document
    return rows.select(
        "id",
        F.col("t.topic").alias("topic"),
        F.when(total > 0, F.col("t.sim") / total).otherwise(F.lit(0.0)).alias("probability"),
    )


def topic_distance(ctfidf: DataFrame) -> DataFrame:
    """Cosine similarity between topics' c-TF-IDF term vectors ``(topic_a, topic_b, similarity)``.

    Joined on the term: a term group holds one row per topic, so each group
    emits at most topics^2 products.
    """
    t = ctfidf.select("topic", "term", "score")
    norms = t.groupBy("topic").agg(F.sqrt(F.sum(F.col("score") * F.col("score"))).alias("nrm"))
    a = t.select(F.col("topic").alias("topic_a"), "term", F.col("score").alias("sa"))
    b = t.select(F.col("topic").alias("topic_b"), "term", F.col("score").alias("sb"))
    dots = a.join(b, "term").groupBy("topic_a", "topic_b").agg(F.sum(F.col("sa") * F.col("sb")).alias("dot"))
    na = norms.select(F.col("topic").alias("topic_a"), F.col("nrm").alias("na"))
    nb = norms.select(F.col("topic").alias("topic_b"), F.col("nrm").alias("nb"))
    return dots.join(na, "topic_a").join(nb, "topic_b").select(
        "topic_a", "topic_b", (F.col("dot") / (F.col("na") * F.col("nb"))).alias("similarity")
    )


def documents_of_topic(docs: DataFrame, topic_col: str, topic_id: int) -> DataFrame:
    """M16."""
    return docs.where(F.col(topic_col) == topic_id)
