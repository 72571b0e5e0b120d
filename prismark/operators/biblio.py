"""Descriptive tables over a corpus of articles.

Every percentage is over *all* rows of the input (the reference divides by
``len(df)``), taken as a scalar subquery: one small aggregate job whose value
is inlined, no join and no global window.  Ties are broken by name ascending
everywhere (trap T9).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from prismark.operators.ranking import dense_position


def _total(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def pct(n: Column, total: Column, digits: int = 6) -> Column:
    return F.round(n.cast("double") * 100.0 / total, digits)


def corpus_size(df: DataFrame) -> DataFrame:
    """G1."""
    return df.agg(F.count(F.lit(1)).alias("n_articles"))


def year_summary(df: DataFrame, year_col: str = "Year") -> DataFrame:
    """Min, max and exact median of the non-null years, each truncated to an integer.

    The exact median keeps one counter per distinct value (a few hundred
    years), so its buffer stays small at any row count.
    """
    y = F.col(year_col)
    return df.where(y.isNotNull()).agg(
        F.count(F.lit(1)).alias("n_with_year"),
        F.min(y).cast("long").alias("year_min"),
        F.max(y).cast("long").alias("year_max"),
        F.median(y).cast("long").alias("year_median"),
    )


def by_decade(df: DataFrame, year_col: str = "Year") -> DataFrame:
    """``floor(Year / 10) * 10``, count, % of all rows; null decade dropped."""
    decade = (F.floor(F.col(year_col) / 10) * 10).cast("long").alias("decade")
    counts = df.groupBy(decade).agg(F.count(F.lit(1)).alias("n")).where(F.col("decade").isNotNull())
    return counts.select("decade", "n", pct(F.col("n"), _total(df)).alias("pct"))


def value_counts(df: DataFrame, col: str | Column, name: str = "value", k: int | None = None) -> DataFrame:
    """G4 (and O2 with ``k``): count and % of all rows per value, count desc then value."""
    c = (F.col(col) if isinstance(col, str) else col).alias(name)
    counts = df.groupBy(c).agg(F.count(F.lit(1)).alias("n")).where(F.col(name).isNotNull())
    out = counts.select(name, "n", pct(F.col("n"), _total(df)).alias("pct"))
    out = out.orderBy(F.desc("n"), F.asc(name))
    return out.limit(k) if k is not None else out


def journal_key(x: str | Column) -> Column:
    """Trim + lower."""
    c = F.col(x) if isinstance(x, str) else x
    return F.lower(F.trim(c))


def top_journals(df: DataFrame, k: int = 10, journal_col: str = "Journal") -> DataFrame:
    """O2: top ``k`` journals by article count with % of all articles."""
    out = value_counts(df, journal_key(journal_col), "journal", k)
    return out.withColumn("display", F.substring("journal", 1, 60))


def count_labels(df: DataFrame, labels_col: str, name: str = "label") -> DataFrame:
    """Explode a multi-label column; % of documents (may sum past 100)."""
    exploded = df.select(F.explode(F.col(labels_col)).alias(name))
    counts = exploded.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(name, "n", pct(F.col("n"), _total(df)).alias("pct"))


def crosstab_long(df: DataFrame, a: str | Column, b: str | Column, a_name: str, b_name: str) -> DataFrame:
    """G6 in long form: ``(a, b, n)``; null keys dropped."""
    ca = (F.col(a) if isinstance(a, str) else a).alias(a_name)
    cb = (F.col(b) if isinstance(b, str) else b).alias(b_name)
    return (
        df.select(ca, cb)
        .where(F.col(a_name).isNotNull() & F.col(b_name).isNotNull())
        .groupBy(a_name, b_name)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def crosstab(df: DataFrame, a: str | Column, b: str, a_name: str, values: Sequence) -> DataFrame:
    """G6 pivoted: one row per ``a``, one count column per listed ``b`` value (0 when absent).

    The value list is explicit so the plan needs no extra job to discover it.
    """
    ca = (F.col(a) if isinstance(a, str) else a).alias(a_name)
    base = df.select(ca, F.col(b)).where(F.col(a_name).isNotNull() & F.col(b).isNotNull())
    piv = base.groupBy(a_name).pivot(b, list(values)).agg(F.count(F.lit(1)))
    out = piv.na.fill(0)
    return out.select(a_name, *[F.col(f"`{v}`").cast("long").alias(f"n_{v}") for v in values])


def crosstab_min(piv: DataFrame, key: str, min_total: int = 2) -> DataFrame:
    """Keep pivoted rows whose row total is at least ``min_total``."""
    counts = [F.col(c) for c in piv.columns if c != key]
    total = sum(counts[1:], counts[0])
    return piv.where(total >= min_total)


def author_list(x: str | Column, seps: str = ";", trim: bool = True) -> Column:
    """Split an author string; trims and drops blanks unless ``trim=False`` (trap T7)."""
    c = F.col(x) if isinstance(x, str) else x
    parts = F.split(c, "[" + seps + "]")
    if not trim:
        return parts
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != "")


def author_counts(df: DataFrame, authors_col: str = "Authors") -> DataFrame:
    """Split on ``;`` or ``,``, trim, count articles per author name."""
    names = df.select(F.explode(author_list(authors_col, ";,")).alias("author"))
    return names.groupBy("author").agg(F.count(F.lit(1)).alias("n"))


def top_authors(df: DataFrame, k: int = 10, min_len: int = 4, authors_col: str = "Authors") -> DataFrame:
    """O3: rank the top ``k`` first, then drop names shorter than ``min_len``; ranks keep gaps."""
    top = author_counts(df, authors_col).orderBy(F.desc("n"), F.asc("author")).limit(k)
    w = Window.orderBy(F.desc("n"), F.asc("author"))  # k rows at most
    ranked = top.withColumn("rank", F.row_number().over(w).cast("long"))
    return ranked.where(F.length("author") >= min_len)


def author_stats(df: DataFrame, authors_col: str = "Authors", trim: bool = True, approx: bool = False) -> DataFrame:
    """Author mentions, distinct authors, mean authors per article (all articles).

    ``approx=True`` counts distinct authors with a HyperLogLog sketch instead
    of an exact distinct aggregate.
    """
    lists = df.select(author_list(authors_col, ";", trim).alias("a"))
    mentions = lists.select(F.explode("a").alias("author"))
    n_articles = _total(df)
    distinct = F.approx_count_distinct("author") if approx else F.count_distinct("author")
    return mentions.agg(
        F.count(F.lit(1)).alias("mentions"),
        distinct.alias("unique_authors"),
    ).select(
        "mentions",
        "unique_authors",
        n_articles.alias("n_articles"),
        F.round(F.col("mentions") / n_articles, 6).alias("mean_per_article"),
    )


def decision_counts(df: DataFrame, decision_col: str = "Manual_Decision") -> DataFrame:
    """Included / excluded totals of the human decision."""
    d = F.col(decision_col)
    return df.agg(
        F.count(F.when(d == "Included", 1)).alias("n_included"),
        F.count(F.when(d == "Excluded", 1)).alias("n_excluded"),
    )


def cluster_sizes(df: DataFrame, cluster_col: str = "Cluster") -> DataFrame:
    """G12."""
    return df.groupBy(F.col(cluster_col).alias("cluster")).agg(F.count(F.lit(1)).alias("n")).orderBy("cluster")


ARTICLE_SEP = "\n\n--- NEW ARTICLE ---\n\n"


def concat_cluster_text(
    df: DataFrame,
    cluster_col: str,
    id_col: str,
    text_col: str,
    sep: str = ARTICLE_SEP,
    docs_per_chunk: int = 50,
) -> DataFrame:
    """The texts of a cluster joined by ``sep`` in id order, as numbered chunks.

    A cluster may hold a third of the corpus, which cannot be one row.  The
    corpus is therefore emitted as consecutive chunks of ``docs_per_chunk``
    whole texts; joining the chunks in ``chunk`` order with ``sep`` gives the
    full corpus.  Positions come from :func:`dense_position`, so no task sees
    more than one bucket of a cluster.
    """
    pos = dense_position(
        df.select(F.col(cluster_col).alias("cluster"), F.col(id_col).alias("_id"), F.col(text_col).alias("_t")),
        "_id",
        ["cluster"],
    )
    chunk = F.floor((F.col("position") - 1) / docs_per_chunk).cast("long").alias("chunk")
    grouped = pos.groupBy("cluster", chunk).agg(
        F.sort_array(F.collect_list(F.struct("_id", "_t"))).alias("_docs"),
        F.count(F.lit(1)).alias("n_docs"),
    )
    text = F.array_join(F.transform("_docs", lambda s: F.coalesce(s["_t"], F.lit(""))), sep)
    return grouped.select("cluster", "chunk", "n_docs", text.alias("corpus"))


def prisma_flow(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Count after each stage and the drop from the previous one.

    Each stage count is a scalar subquery; the stage list is fixed and short,
    so the final window runs over a handful of rows.
    """
    first, *rest = stages
    spark = first[1].sparkSession
    rows = None
    for i, (name, d) in enumerate(stages):
        r = spark.range(1).select(F.lit(i).cast("long").alias("step"), F.lit(name).alias("stage"),
                                  _total(d).alias("n"))
        rows = r if rows is None else rows.unionByName(r)
    w = Window.orderBy("step")
    prev = F.lag("n").over(w)
    return rows.select(
        "step", "stage", "n",
        F.when(prev.isNull(), F.lit(None).cast("double"))
        .otherwise(F.round((prev - F.col("n")).cast("double") * 100.0 / prev, 6)).alias("reduction_pct"),
    )
