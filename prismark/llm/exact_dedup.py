"""Operator 6: exact dedup by skew-safe combining (DataFrame functions only).

Texts are equal when they are identical after deleting the six ASCII
white-space characters.  Copies are combined in three stages, each of which
compares the full normalised text, never the digest alone:

1. *local*: Spark's partial aggregate keeps one row per text and task;
2. *salted*: the local winners of one text meet per (digest, salt, text), the
   salt coming from the row's id, so a text held by a third of all rows is
   spread over ``salts`` tasks;
3. *global*: at most ``salts`` winners per text are combined.

The outcome (one small row per different text) is joined back to the ids by
digest.  If a digest ever belonged to two texts, the rows of that digest are
joined by the full text instead.

Defined cases: a null text counts as empty; empty and white-space-only texts
are equal to each other; of equal texts the one with the most code points in
the original stays, then the smallest id, a null id being the last choice;
repeated rows (same id, same text) share the group, count in its size, and of
rows with the same id as the winner all are kept; an empty table gives no rows;
other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prismark.llm.runtime import small_enough, stored

#: The characters that do not count, deleted before texts are compared.
BLANKS = " \t\n\x0b\x0c\r"


def _normalised(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    norm = F.translate(text, BLANKS, "")
    return docs.select(
        F.col(id_col).alias("doc_id"), F.length(text).alias("_len"), norm.alias("_norm")
    ).withColumn("text_sha256", F.sha2(F.col("_norm").cast("binary"), 256))


def text_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64) -> DataFrame:
    """One row per different normalised text: digest, ``_norm``, the winner and the number of rows."""
    best = F.struct((-F.col("_len")).alias("l"), F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("d"))
    rows = _normalised(docs, id_col, text_col).select(
        "text_sha256", "_norm", best.alias("_best"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("_salt"),
    )
    salted = rows.groupBy("text_sha256", "_salt", "_norm").agg(F.min("_best").alias("_best"), F.count(F.lit(1)).alias("_n"))
    return salted.groupBy("text_sha256", "_norm").agg(F.min("_best").alias("_best"), F.sum("_n").alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``."""
    groups = text_groups(docs, id_col, text_col, salts)
    small = stored(
        groups.select("text_sha256", F.xxhash64("_norm").alias("_twin"), F.col("_best.d").alias("keep_id"), "group_size"),
        "exact-groups",
    )
    twins = small.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("text_sha256")
    rows = _normalised(docs, id_col, text_col)
    found = (
        rows.select("doc_id", "text_sha256")
        .join(small.drop("_twin"), "text_sha256")
    )
    if not twins.isEmpty():  # two texts with one digest: these rows by their full text
        exact = groups.select("text_sha256", "_norm", F.col("_best.d").alias("keep_id"), "group_size").join(
            twins, "text_sha256", "left_semi"
        )
        found = found.join(twins, "text_sha256", "left_anti").unionByName(
            rows.select("doc_id", "text_sha256", "_norm").join(exact, ["text_sha256", "_norm"]).drop("_norm")
        )
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rows equal in id and text stay or go together."""
    gone = exact_dedup(docs, id_col, text_col).where(~F.col("kept")).select(
        F.col("doc_id").alias("_gone_id"), F.col("text_sha256").alias("_gone_text")
    )
    gone = small_enough(stored(gone.distinct(), "exact-gone"))
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))  # no name of the input can clash
    row = F.col("doc")
    norm = F.translate(F.coalesce(row[text_col], F.lit("")), BLANKS, "")
    same = row[id_col].eqNullSafe(F.col("_gone_id")) & (F.sha2(norm.cast("binary"), 256) == F.col("_gone_text"))
    return held.join(gone, same, "left_anti").select("doc.*")


ORACLE_SQL = """
with n as (
  select doc_id, coalesce(text, '') as t,
    translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') as norm
  from documents),
g as (
  select norm, count(*) as group_size,
    first(doc_id order by length(t) desc, doc_id nulls last) as keep_id
  from n group by norm)
select n.doc_id, g.keep_id, g.group_size, n.doc_id is not distinct from g.keep_id as kept, sha256(n.norm) as text_sha256
from n join g on n.norm = g.norm
"""
