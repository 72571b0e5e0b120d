"""Boolean term search over records (P1) and hit counts.

The user passes term lists, not query text: ``all_of`` is an AND of OR-groups,
``none_of`` removes rows.  A term ending in ``*`` matches any word suffix; a
term with spaces is a phrase (any white space between its words).  Matching is
case-insensitive on whole words over the chosen fields.  A term wrapped in
``Heading`` tests membership in the ``"; "``-separated subject headings instead
(``Heading("Trials*")``: a heading that begins so); words and headings may stand
in one OR-group.  Null fields count as empty; a group without terms matches no row.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from prismark.functions.text import ENDS_WORD, SPACE, STARTS_WORD, WORD


class Heading(str):
    """A term that is looked for among the subject headings."""


def term_pattern(terms: Sequence[str]) -> str:
    parts = []
    for t in terms:
        wild = t.endswith("*")
        words = [re.escape(w) for w in t.rstrip("*").split()]
        parts.append(f"[{SPACE}]+".join(words) + (f"[{WORD}]*" if wild else ""))
    return f"(?iu){STARTS_WORD}(?:" + "|".join(parts) + f"){ENDS_WORD}"


def _begins(start: str):
    return lambda h: h.startswith(start)


def any_of(terms: Sequence[str], text: Column, headings: Column) -> Column:
    """Whether a row has one of the terms; ``headings``: lower-case array."""
    words = [t for t in terms if not isinstance(t, Heading)]
    found = text.rlike(term_pattern(words)) if words else F.lit(False)
    for t in terms:
        if isinstance(t, Heading):
            name = t.lower().strip()
            if name.endswith("*"):
                found = found | F.exists(headings, _begins(name[:-1]))
            else:
                found = found | F.array_contains(headings, name)
    return found


def search_predicate(
    all_of: Sequence[Sequence[str]],
    none_of: Sequence[str] = (),
    fields: Sequence[str] = ("Title", "Abstract"),
    mesh_all_of: Sequence[str] = (),
    mesh_col: str = "MeSH_Terms",
) -> Column:
    text = F.concat_ws(" ", *[F.coalesce(F.col(f), F.lit("")) for f in fields])
    heads = F.transform(F.split(F.coalesce(F.col(mesh_col), F.lit("")), "; "), lambda s: F.lower(F.trim(s)))
    cond = F.lit(True)
    for group in [*all_of, *([Heading(t)] for t in mesh_all_of)]:
        cond = cond & any_of(group, text, heads)
    return cond & ~any_of(none_of, text, heads) if none_of else cond


def boolean_search(df: DataFrame, all_of, none_of=(), fields=("Title", "Abstract"), **kw) -> DataFrame:
    """Rows matching the term lists."""
    return df.where(search_predicate(all_of, none_of, fields, **kw))


def count_matches(df: DataFrame, all_of, none_of=(), fields=("Title", "Abstract"), **kw) -> DataFrame:
    """Number of hits only."""
    return boolean_search(df, all_of, none_of, fields, **kw).agg(F.count(F.lit(1)).alias("hits"))
