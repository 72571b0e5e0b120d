"""Lemmatisation against a lexicon table (X11 + X12).

``lexicon(token, lemma)`` is an input (no dictionary data ships with the
engine).  Tokens are looked up case-sensitively; a token without an entry
stays as it is.  The lookup is a left join, so Catalyst broadcasts the lexicon
when its size allows and shuffles otherwise; each document is reassembled
from its own tokens (a group bounded by the document).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prismark.functions.text import ENDS_WORD, STARTS_WORD, TOKEN_PATTERN, tokenize
from prismark.session import written


def lemmatize(docs: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, out_col: str = "lemmatized") -> DataFrame:
    """``(id, lemmatized)`` with tokens (X11) replaced by their lemma, space-joined."""
    # one lemma per token, chosen deterministically when the lexicon lists several
    lex = lexicon.groupBy(F.col("token").alias("_tok")).agg(F.min("lemma").alias("_lem"))
    toks = docs.select(F.col(id_col).alias("_id"), F.posexplode(tokenize(F.coalesce(F.col(text_col), F.lit("")))).alias("_p", "_tok"))
    looked = toks.join(lex, "_tok", "left").select("_id", "_p", F.coalesce("_lem", "_tok").alias("_w"))
    grouped = looked.groupBy("_id").agg(F.sort_array(F.collect_list(F.struct("_p", "_w"))).alias("_ws"))
    out = grouped.select(F.col("_id").alias(id_col), F.array_join(F.transform("_ws", lambda s: s["_w"]), " ").alias(out_col))
    # documents with no token at all still get a row (empty text); a first token tells, none is looked up again
    held = docs.where(F.coalesce(F.col(text_col), F.lit("")).rlike(TOKEN_PATTERN)).select(id_col).distinct()
    empty = docs.select(F.col(id_col)).join(held, id_col, "left_anti").withColumn(out_col, F.lit(""))
    return out.unionByName(empty)


def plural_lexicon(docs: DataFrame, text_col: str) -> DataFrame:
    """A lexicon derived from a corpus: ``xs -> x`` for lower-case words whose stem also occurs."""
    words = docs.select(F.explode(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")),
                                                       F.lit(f"{STARTS_WORD}[a-z]++{ENDS_WORD}"), 0)).alias("w")).distinct()
    words = written(words)  # different words only; the corpus is read once for both sides of the join
    plural = words.where((F.length("w") > 3) & F.col("w").endswith("s")).select(
        F.col("w").alias("token"), F.expr("substring(w, 1, length(w) - 1)").alias("lemma"))
    return plural.join(words.select(F.col("w").alias("lemma")), "lemma", "left_semi")
