"""Keyword rules over abstracts: study type (P11) and populations.

Matching is a substring test on the lower-cased text, as in the reference;
``word_boundary=True`` switches to whole-word matching (trap T8: ``rct`` is
inside ``infarct``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Study-type groups, in the order they are tried (first match wins).
STUDY_TYPES = [
    ("RCT", ["randomized", "randomised", "rct", "random allocation"]),
    ("Review", ["systematic review", "meta-analysis", "meta analysis"]),
    ("Qualitative", ["qualitative", "phenomenological", "grounded theory", "interview"]),
    ("Cohort/Longitudinal", ["cohort", "longitudinal", "prospective"]),
    ("Cross-Sectional/Survey", ["cross-sectional", "cross sectional", "survey"]),
    ("Case-control", ["case-control", "case control"]),
    ("Rétrospective", ["retrospective", "chart review", "medical record"]),
    ("QPilote", ["quasi-experimental", "quasi experimental", "pilot"]),
]
STUDY_TYPE_NULL = "Non spécifié"
STUDY_TYPE_NONE = "Unspecified"

# Population groups (multi-label, reported in this order).
POPULATIONS = [
    ("Stroke", ["stroke", "cerebrovascular"]),
    ("TBI", ["traumatic brain injury", "tbi", "head injury"]),
    ("SAH", ["subarachnoid hemorrhage", "sah", "aneurysm"]),
    ("Brain tumor", ["brain tumor", "glioma", "neurosurgical"]),
    ("Cardiac Arrest", ["cardiac arrest", "resuscitation"]),
    ("palliative care", ["palliative", "end-of-life", "withdrawal"]),
]
POPULATION_NONE = "Unspecified"


def _any_of(text: Column, words: list[str], word_boundary: bool) -> Column:
    if word_boundary:
        pattern = "(?U)\\b(" + "|".join(re.escape(w) for w in words) + ")\\b"
        return text.rlike(pattern)
    cond = None
    for w in words:
        hit = text.contains(w)
        cond = hit if cond is None else (cond | hit)
    return cond


def classify_study_type(x: Column | str, word_boundary: bool = False) -> Column:
    """First matching group; null -> ``Non spécifié``; no match -> ``Unspecified``."""
    c = F.col(x) if isinstance(x, str) else x
    text = F.lower(c)
    expr = F.when(c.isNull(), F.lit(STUDY_TYPE_NULL))
    for label, words in STUDY_TYPES:
        expr = expr.when(_any_of(text, words, word_boundary), F.lit(label))
    return expr.otherwise(F.lit(STUDY_TYPE_NONE))


def tag_populations(x: Column | str, word_boundary: bool = False) -> Column:
    """``array<string>`` of every matching group; null -> []; none -> [Unspecified]."""
    c = F.col(x) if isinstance(x, str) else x
    text = F.lower(c)
    # array_compact (native) drops the nulls; no lambda, so the row stays in generated code.
    hits = F.array_compact(
        F.array(*[F.when(_any_of(text, words, word_boundary), F.lit(label)) for label, words in POPULATIONS])
    )
    return (
        F.when(c.isNull(), F.array().cast("array<string>"))
        .when(F.size(hits) == 0, F.array(F.lit(POPULATION_NONE)))
        .otherwise(hits)
    )
