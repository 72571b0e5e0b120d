"""Screening and human decisions as table operations.

The model call is the only per-row Python (``score_with``); everything else
is a column expression or a join.  A user's scorer is any Python callable
``prompt -> reply text``; the engine ships no model.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from prismark.functions.text import py_strip
from prismark.operators.ranking import dense_position

# Reasons written by the screening step.
NO_ABSTRACT = "No Abstract"
NO_ABSTRACT_INCLUDE = "No abstract available - Included for manual check"
NO_REASON = "No reason provided"
FORMAT_ERROR = "LLM Error (Format): "
SCORER_ERROR = "LLM Connection Error"
PARSE_ERROR = SCORER_ERROR + ": invalid JSON"
INCLUDED = "Included"
EXCLUDED = "Excluded"
# Decision words accepted from a reviewer.
YES_WORDS = ["y", "yes"]
NO_WORDS = ["n", "no"]
DECIDED_WORDS = ["y", "n", "yes", "no", "included", "excluded"]


def ensure_columns(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add each missing column with its default (decided at plan time)."""
    for name, value in defaults.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    return df


def gate_abstract(
    df: DataFrame, abstract_col: str = "Abstract", min_len: int = 20, on_missing: str = "exclude"
) -> DataFrame:
    """A null or short abstract is decided without the model.

    ``on_missing='exclude'`` (the pipeline's rule) -> ``Included=false``,
    reason ``No Abstract``; ``'include'`` -> kept for a human.  Other rows get
    ``Included``/``Screening_Reason`` null, meaning *to be scored*.
    """
    a = F.col(abstract_col)
    missing = a.isNull() | (F.length(a) < min_len)
    inc, why = (False, NO_ABSTRACT) if on_missing == "exclude" else (True, NO_ABSTRACT_INCLUDE)
    return df.withColumn("needs_model", ~missing).withColumn(
        "Included", F.when(missing, F.lit(inc))
    ).withColumn("Screening_Reason", F.when(missing, F.lit(why)))


# The screening prompt layout.
PROMPT_TEMPLATE = """
        You are a research assistant screening papers for a systematic review.

        # CRITERIA:
        {criteria}

        #PAPER:
        Title: {title}
        Abstract: {abstract}

        # TASK:
        Decide if this paper should be INCLUDED or EXCLUDED based on the criteria.
        Explain your reasoning briefly.

        # OUTPUT FORMAT:
        Return a single JSON object:
        {{
          "included": true,
          "reason": "Brief explanation..."
        }}
        """


def screening_prompt(df: DataFrame, criteria: str, title_col: str = "Title", abstract_col: str = "Abstract") -> Column:
    """P5: the prompt text per row (null fields print as ``None``, as in Python)."""
    head, rest = PROMPT_TEMPLATE.split("{title}")
    mid, tail = rest.split("{abstract}")
    head = head.replace("{criteria}", criteria)
    tail = tail.replace("{{", "{").replace("}}", "}")
    t = F.coalesce(F.col(title_col), F.lit("None"))
    a = F.coalesce(F.col(abstract_col), F.lit("None"))
    return F.concat(F.lit(head), t, F.lit(mid), a, F.lit(tail))


#: Prompts that are Python objects at a time.
SCORED_ROWS = 256


def score_with(
    df: DataFrame,
    scorer: Callable[[str], str],
    prompt_col: str = "prompt",
    out_col: str = "raw_verdict",
    partitions: int | None = None,
) -> DataFrame:
    """Apply a user scorer to every prompt, a few at a time from Arrow batches (``mapInArrow``).

    ``partitions`` bounds how many scorer calls run at once (rate limit).  A call
    that raises gives its row a verdict of exclusion with the error as the reason;
    the other rows and the job go on.
    """
    src = df.repartition(partitions) if partitions else df
    # A new StructType: ``schema.add`` would mutate the input's cached schema.
    schema = T.StructType([*src.schema.fields, T.StructField(out_col, T.StringType())])

    def verdict(prompt) -> str | None:
        if not isinstance(prompt, str):
            return None
        try:
            return scorer(prompt)
        except Exception as error:  # whatever a user's scorer raises belongs to this row
            return json.dumps({"included": False, "reason": f"{SCORER_ERROR}: {error}"})

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, SCORED_ROWS):
                part = batch.slice(at, SCORED_ROWS)
                verdicts = pa.array([verdict(p) for p in part.column(prompt_col).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, verdicts], [*part.schema.names, out_col])

    return src.mapInArrow(run, schema)


def parse_verdict(raw: Column | str) -> Column:
    """Model reply -> ``struct<included: boolean, reason: string>``.

    Code fences are removed and the text stripped; the greedy ``{...}`` span
    is parsed.  No braces -> false with the first 50 characters quoted;
    invalid JSON -> false with an error reason.  ``included`` is true for the
    JSON literal ``true`` and for the string ``"true"`` in any case.
    """
    r = F.col(raw) if isinstance(raw, str) else raw
    content = py_strip(F.replace(F.replace(F.coalesce(r, F.lit("")), F.lit("```json"), F.lit("")), F.lit("```"), F.lit("")))
    span = F.regexp_extract(content, r"(?s)\{.*\}", 0)
    valid = F.get_json_object(span, "$").isNotNull()
    inc = F.lower(F.get_json_object(span, "$.included")) == "true"
    reason = F.coalesce(F.get_json_object(span, "$.reason"), F.lit(NO_REASON))
    included = F.when(span == "", F.lit(False)).when(~valid, F.lit(False)).otherwise(F.coalesce(inc, F.lit(False)))
    why = (
        F.when(span == "", F.concat(F.lit(FORMAT_ERROR), F.substring(content, 1, 50), F.lit("...")))
        .when(~valid, F.lit(PARSE_ERROR))
        .otherwise(reason)
    )
    return F.struct(included.alias("included"), why.alias("reason"))


def screen(df: DataFrame, raw_col: str = "raw_verdict", abstract_col: str = "Abstract") -> DataFrame:
    """P3 + P7: gate short abstracts, parse the reply for the rest."""
    g = gate_abstract(df, abstract_col)
    v = parse_verdict(raw_col)
    return g.withColumn("Included", F.when(F.col("needs_model"), v["included"]).otherwise(F.col("Included"))).withColumn(
        "Screening_Reason", F.when(F.col("needs_model"), v["reason"]).otherwise(F.col("Screening_Reason"))
    ).drop("needs_model")


def decision_normalise(x: Column | str) -> Column:
    """y/yes -> Included, n/no -> Excluded (trimmed, any case); else null."""
    c = F.lower(F.trim(F.col(x) if isinstance(x, str) else x))
    return F.when(c.isin(*YES_WORDS), F.lit(INCLUDED)).when(c.isin(*NO_WORDS), F.lit(EXCLUDED))


def is_decided(x: Column | str) -> Column:
    """A decision already recorded: listed words only, any case, no trim; null is undecided."""
    c = F.col(x) if isinstance(x, str) else x
    return F.coalesce(F.lower(c).isin(*DECIDED_WORDS), F.lit(False))


def included_flag(x: Column | str) -> Column:
    """``Included`` read back from text or boolean: true when its text is ``true``."""
    c = F.col(x) if isinstance(x, str) else x
    return F.coalesce(F.lower(c.cast("string")) == "true", F.lit(False))


def undecided(
    df: DataFrame, id_col: str = "article_id", decision_col: str = "Manual_Decision", included_col: str = "Included"
) -> DataFrame:
    """The human work queue, with ``position`` k of ``total`` among included rows."""
    inc = df.where(included_flag(included_col))
    numbered = dense_position(inc, id_col, name="position")
    total = inc.agg(F.count(F.lit(1))).scalar()
    return numbered.where(~is_decided(decision_col)).withColumn("total", total)


def apply_decisions(
    screened: DataFrame,
    decisions: DataFrame,
    id_col: str = "article_id",
    decision_col: str = "decision",
    out_col: str = "Manual_Decision",
) -> DataFrame:
    """Merge reviewer answers; a decision already present is kept (resume).

    Only rows the model included are offered to the reviewer.
    """
    base = ensure_columns(screened, {out_col: None})
    new = decisions.select(F.col(id_col).alias("_id"), decision_normalise(decision_col).alias("_new"))
    # Several answers for one article resolve deterministically (Included > Excluded);
    # a partial aggregate, so a hot id is combined map-side.
    new = new.where(F.col("_new").isNotNull()).groupBy("_id").agg(F.max("_new").alias("_new"))
    joined = base.join(new, base[id_col] == new["_id"], "left")
    existing = F.col(out_col)
    keep = F.when(is_decided(existing), existing)
    merged = F.coalesce(keep, F.when(included_flag("Included"), F.col("_new")), existing.cast("string"))
    return joined.withColumn(out_col, merged).drop("_id", "_new")


def drop_screened(df: DataFrame, done: DataFrame, id_col: str = "article_id") -> DataFrame:
    """Rows not yet present in ``done`` (left anti join)."""
    return df.join(done.select(id_col).distinct(), id_col, "left_anti")


def needs_doi(df: DataFrame) -> DataFrame:
    """P10: PubMed (or PMID-typed) rows without a DOI whose id is all digits."""
    doi = F.col("DOI")
    src = (F.col("Source") == "PubMed") | F.coalesce(F.col("ID_Type").contains("PMID"), F.lit(False))
    missing = doi.isNull() | (doi == "") | (doi == "nan")
    return df.where(src & missing & F.trim(F.col("ID")).rlike(r"^\d+$"))
