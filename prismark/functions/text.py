"""Scalar text functions as native column expressions.

Python's ``\\s``, ``\\w``, ``\\b`` and ``\\d`` are Unicode-aware; Java's are
ASCII unless the pattern carries ``(?U)``, which counts marks as word characters
and U+001C to U+001F as none of white space.  The text rules therefore spell
Python's classes out (``WORD``, ``SPACE``); other patterns that use a class say
``(?U)``.  Nothing in this module leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

NBSP = "\u00a0"

# Members of Python's \w and \s, for use inside a character class (valid in Java and RE2).
WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: No word character before, none after.
STARTS_WORD, ENDS_WORD = f"(?<![{WORD}])", f"(?![{WORD}])"

# Line breaks recognised by Python's str.splitlines().
_LINE_BREAKS = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(x: Column | str) -> Column:
    """``str.strip()``: drop leading and trailing Unicode white space."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def normalize_title(x: Column | str) -> Column:
    """Lower, keep ``[a-z0-9\\s]``, collapse white space, trim; null -> ''."""
    t = F.lower(F.coalesce(_c(x), F.lit("")))
    t = F.regexp_replace(t, r"(?U)[^a-z0-9\s]", "")
    t = F.regexp_replace(t, r"(?U)\s+", " ")
    return F.trim(t)


def strip_tags(x: Column | str) -> Column:
    """Remove ``<...>`` tags, then strip."""
    return py_strip(F.regexp_replace(_c(x), r"<[^>]+>", ""))


def page_lines(x: Column | str) -> Column:
    """Nbsp -> space, runs of space/tab -> one, split lines, strip each, drop empty.

    Returns ``array<string>``.  Runs of three or more newlines only produce
    empty lines, which are dropped anyway.
    """
    t = F.regexp_replace(F.translate(_c(x), NBSP, " "), r"[ \t]+", " ")
    lines = F.split(t, _LINE_BREAKS)
    return F.filter(F.transform(lines, lambda ln: py_strip(ln)), lambda ln: ln != "")


def normalise_space(x: Column | str) -> Column:
    """X4 as text: the cleaned lines joined with ``\\n``."""
    return F.array_join(page_lines(x), "\n")


# Section headings that open and close an article body.
INTRO_HEADING = r"(?i)^(introduction|background)$"
STOP_HEADINGS = [
    r"(?i)^(references|bibliography|literature cited)$",
    r"(?i)^(acknowledg(e)?ments?)$",
    r"(?i)^(supplementary( material)?|appendix|annexe[s]?)$",
]


def body_extraction(x: Column | str) -> Column:
    """Lines from the first intro heading up to the first later stop heading.

    No intro heading -> every line.  The intro heading itself is kept.
    """
    lines = page_lines(x)
    n = F.size(lines)
    i = F.array_position(F.transform(lines, lambda ln: ln.rlike(INTRO_HEADING)), True)
    after = F.slice(lines, i + 1, F.greatest(n - i, F.lit(1)))
    stop = "|".join(p.replace("(?i)", "") for p in STOP_HEADINGS)
    j = F.array_position(F.transform(after, lambda ln: ln.rlike("(?i)" + stop)), True)
    keep_len = F.when(j == 0, n - i + 1).otherwise(j)
    kept = F.when(i == 0, lines).otherwise(F.slice(lines, F.greatest(i, F.lit(1)), keep_len))
    return F.array_join(kept, "\n")


def dehyphenate(x: Column | str) -> Column:
    """Join words split over a line end, then every newline becomes a space."""
    return F.regexp_replace(F.regexp_replace(_c(x), rf"-\n([{WORD}]+)", "$1"), "\n", " ")




def citation_pattern(dashes: str = "-") -> str:
    """Numbers in square brackets, listed with commas or joined by one of ``dashes``."""
    return rf"\[[{SPACE}]*\p{{Nd}}+(?:[{SPACE}]*[{dashes},][{SPACE}]*\p{{Nd}}+)*[{SPACE}]*\]"


def strip_citations(x: Column | str, en_dash: bool = False) -> Column:
    """Remove ``[1]``, ``[3, 4-6]``; ``en_dash=True`` also removes ``[12–14]``."""
    return F.regexp_replace(_c(x), citation_pattern("-–" if en_dash else "-"), "")


def strip_urls(x: Column | str) -> Column:
    """X8."""
    return F.regexp_replace(_c(x), rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+", "")


def strip_dois(x: Column | str) -> Column:
    """``doi: ...`` (any case), then bare ``10.xxxx/...``."""
    t = F.regexp_replace(_c(x), rf"{STARTS_WORD}(?i:doi):[{SPACE}]*[^{SPACE}]+", "")
    return F.regexp_replace(t, rf"{STARTS_WORD}10\.\p{{Nd}}{{4,9}}/[^{SPACE}]*[{WORD}]", "")


def clean_text(x: Column | str, en_dash: bool = False) -> Column:
    """X6 -> X7 -> X8 -> X9, in the reference order."""
    return strip_dois(strip_urls(strip_citations(dehyphenate(x), en_dash)))


TOKEN_PATTERN = rf"[{WORD}]+|[^{WORD}{SPACE}]"


def tokenize(x: Column | str) -> Column:
    """X11: word tokens and single punctuation marks (a simple rule, not Treebank)."""
    return F.regexp_extract_all(_c(x), F.lit(TOKEN_PATTERN), 0)


def remove_stop_words(x: Column | str, stop_words: Iterable[str]) -> Column:
    """Lower, split on white space, drop exact stop words, rejoin with a space."""
    stop = sorted(set(stop_words))
    words = F.split(F.lower(_c(x)), f"[{SPACE}]+")
    return F.array_join(F.filter(words, lambda w: (w != "") & ~w.isin(*stop)), " ")


TERM_PATTERN = rf"{STARTS_WORD}[a-z]{{3,}}+{ENDS_WORD}"


def term_tokens(x: Column | str) -> Column:
    """Lower case, then words of three or more ASCII letters."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(x), F.lit(""))), F.lit(TERM_PATTERN), 0)


def drop_tokens(tokens: Column, stop_words: Iterable[str]) -> Column:
    """Drop listed tokens; ``isin`` over many literals is planned as a hash-set lookup."""
    stop = sorted(set(stop_words))
    if not stop:
        return tokens
    return F.filter(tokens, lambda w: ~w.isin(*stop))


def ngrams(tokens: Column, lo: int = 1, hi: int = 3) -> Column:
    """Every n-gram for n in [lo, hi], space-joined; n-grams span adjacent tokens.

    Built from shifted slices combined with ``zip_with``: linear in the token
    count.  Pass a column reference (not a long expression) as ``tokens``.
    """
    parts = []
    size = F.size(tokens)
    for n in range(lo, hi + 1):
        m = F.greatest(size - n + 1, F.lit(0))
        acc = F.slice(tokens, 1, m)
        for k in range(1, n):
            acc = F.zip_with(acc, F.slice(tokens, k + 1, m), lambda x, y: F.concat(x, F.lit(" "), y))
        parts.append(acc)
    return F.flatten(F.array(*parts))
