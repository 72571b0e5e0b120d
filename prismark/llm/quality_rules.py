"""Operator 7: quality rules and robust multivariate outliers.

Base rules fail a text with fewer than 20 words or with more than 30 % of its
words in repeated windows.  Of the others, the vectors of transformed
statistics are compared within their language and source by a
minimum-covariance-determinant estimate: from coordinatewise medians and
quartiles, a few concentration steps re-estimate mean and covariance from the
``share`` of rows with the smallest Mahalanobis distances.  Every step is a
Spark aggregate of sums per group (a third of all rows in one group is summed
task by task), and the distances' quantiles are mergeable sketches.  A
noise floor is added to the variances, so a statistic that hardly varies in a
group does not reject rows for tiny differences.  Squared distances are scaled
to the median that a normal distribution would have, and by n / (n +
``short_words``) for a text of n words, whose shares are the noisier the fewer
words it has; a row is rejected beyond ``cutoff``.  In a pool of n rows, fewer
than ``min_rows``, they are also scaled by n / ``min_rows``, as its estimate is
the less certain the fewer rows it has.

Defined cases: null text has no words and fails the base rules; null languages
and sources are groups of their own; groups with fewer than ``min_rows`` rows
are pooled per language; what is then still too small is compared with the whole
language, large sources included, languages that are too small are pooled, and if
that is not enough compared with the whole table, however small it is; long texts
count whole; repeated rows get equal verdicts; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from prismark.llm.docstats import FEATURES, with_stats
from prismark.llm.runtime import stored

#: Standard deviation below which a statistic counts as noise, by statistic.
NOISE = {
    "log_words": 1.0, "word_length": 0.08, "symbols": 0.08, "dup_lines": 0.10, "repeats": 0.10, "upper": 0.08,
    "digits": 0.25, "marks": 0.15, "stops": 0.06, "variety": 0.05, "stutter": 0.05, "line_words": 0.5,
}


def base_failed():
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _params_from_sums(d: int, noise: np.ndarray):
    """From count, sums and products of a group: its mean and inverse covariance."""
    upper = np.triu_indices(d)

    @F.pandas_udf("m array<double>, w array<double>")
    def params(n: pd.Series, s: pd.Series, p: pd.Series) -> pd.DataFrame:
        means, inverses = [], []
        for count, total, products in zip(n, s, p):
            mean = np.asarray(total) / count
            cov = np.zeros((d, d))
            cov[upper] = products
            cov = cov + cov.T - np.diag(np.diag(cov))
            cov = cov / count - np.outer(mean, mean) + np.diag(noise**2)
            means.append(mean)
            inverses.append(np.linalg.pinv(cov, hermitian=True).ravel())
        return pd.DataFrame({"m": means, "w": inverses})

    return params


def _distance(x: str, m: str, w: str):
    """Squared Mahalanobis distance, as a column."""

    @F.pandas_udf("double")
    def distance(x: pd.Series, m: pd.Series, w: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        diff = np.stack(x.to_numpy()) - np.stack(m.to_numpy())
        inverse = np.stack(w.to_numpy()).reshape(len(diff), diff.shape[1], diff.shape[1])
        return pd.Series(np.einsum("ni,nij,nj->n", diff, inverse, diff))

    return distance(x, m, w)


def _assign_groups(rows: DataFrame, min_rows: int) -> DataFrame:
    """``lang, source, g, fits``: the pool that judges each language and source, and the pools that its rows are part of."""
    sizes = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    small = F.col("n") < min_rows
    by_lang = sizes.groupBy(F.col("lang").alias("l")).agg(
        F.sum("n").alias("all_rows"), F.sum(F.when(small, F.col("n")).otherwise(0)).alias("small_rows")
    )
    placed = sizes.join(by_lang, F.col("lang").eqNullSafe(F.col("l")))
    rest = F.coalesce(placed.agg(F.sum(F.when(F.col("all_rows") < min_rows, F.col("n")))).scalar(), F.lit(0))
    own = (
        F.when(~small, F.concat(F.lit("source "), F.to_json(F.struct("lang", "source"))))
        .when(F.col("small_rows") >= min_rows, F.concat(F.lit("small "), F.to_json(F.struct("lang"))))
        .when((F.col("all_rows") < min_rows) & (rest >= min_rows), F.lit("rest"))
    )
    # a whole language and the whole table are estimated only if some rows are judged by them
    left = (F.col("all_rows") >= min_rows) & F.col("small_rows").between(1, min_rows - 1)
    language = F.when(left, F.concat(F.lit("lang "), F.to_json(F.struct("lang"))))
    table = F.when(rest.between(1, min_rows - 1), F.lit("table"))
    return placed.select("lang", "source", F.coalesce(own, language, table).alias("g"), F.array_compact(F.array(own, language, table)).alias("fits"))


def outlier_params(rows: DataFrame, d: int, noise: np.ndarray, share: float, steps: int) -> DataFrame:
    """``g, m, w, scale, size``: robust centre, inverse covariance, median distance and rows of every pool; ``rows``: g, x."""
    x = F.col("x")
    quart = rows.groupBy("g").agg(*(F.percentile_approx(x[i], [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(d)))
    var = [F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2) + float(noise[i] ** 2) for i in range(d)]
    params = quart.select(
        "g", F.array(*(F.col(f"q{i}")[1] for i in range(d))).alias("m"),
        F.array(*(1 / var[i] if i == j else F.lit(0.0) for i in range(d) for j in range(d))).alias("w"),
    )
    from_sums = _params_from_sums(d, noise)
    for _ in range(steps):
        params = stored(params, "outlier-params")
        far = rows.join(params, "g").select("g", "x", _distance("x", "m", "w").alias("d2"))
        cut = far.groupBy("g").agg(F.percentile_approx("d2", share, 1000).alias("cut"))
        core = far.join(cut, "g").where(F.col("d2") <= F.col("cut"))
        sums = core.groupBy("g").agg(
            F.count(F.lit(1)).alias("n"), F.array(*(F.sum(x[i]) for i in range(d))).alias("s"),
            F.array(*(F.sum(x[i] * x[j]) for i in range(d) for j in range(i, d))).alias("p"),
        )
        params = sums.select("g", from_sums("n", "s", "p").alias("_p")).select("g", "_p.m", "_p.w")
    params = stored(params, "outlier-params")
    far = rows.join(params, "g").select("g", _distance("x", "m", "w").alias("d2"))
    scale = far.groupBy("g").agg(F.percentile_approx("d2", 0.5, 1000).alias("scale"), F.count(F.lit(1)).alias("size"))
    return params.join(scale, "g")


def chi2_median(d: int) -> float:
    return d * (1 - 2 / (9 * d)) ** 3


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    share: float = 0.75, steps: int = 3, cutoff: float = 150.0, short_words: int = 50, min_rows: int = 100, noise: dict[str, float] = NOISE,
) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``distance`` (null: not compared) and ``kept`` of every row."""
    d = len(FEATURES)
    floor = np.array([noise[f] for f in FEATURES])
    stats = stored(
        with_stats(docs, id_col, text_col, keep=(lang_col, source_col))
        .withColumnsRenamed({lang_col: "lang", source_col: "source"})
        .withColumn("base_failed", base_failed()),
        "rule-stats",
    )
    passed = stats.where(~F.col("base_failed"))
    pools = _assign_groups(passed, min_rows)
    pools = pools.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "g", "fits")
    rows = stored(
        stats.join(
            pools, stats["lang"].eqNullSafe(pools["_l"]) & stats["source"].eqNullSafe(pools["_s"]), "left"
        ).drop("_l", "_s", "lang", "source"),
        "rule-rows",
    )
    fitted = rows.where(~F.col("base_failed")).select(F.explode("fits").alias("g"), "x")
    params = stored(outlier_params(fitted, d, floor, share, steps), "rule-params")
    compared = rows.where(~F.col("base_failed")).join(params, "g")
    typical = chi2_median(d)
    scaled = F.col("d2") * typical / F.greatest(F.col("scale"), F.lit(typical * 0.05))
    scaled = scaled * F.col("n_words") / (F.col("n_words") + short_words) * F.least(F.col("size") / min_rows, F.lit(1.0))
    compared = compared.withColumn("d2", _distance("x", "m", "w")).withColumn("distance", scaled)
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = compared.select(*counts, "distance", (F.col("distance") <= cutoff).alias("kept"))
    others = rows.where("base_failed").select(
        *counts, F.lit(None).cast("double").alias("distance"), (~F.col("base_failed")).alias("kept")
    )
    return judged.unionByName(others)
