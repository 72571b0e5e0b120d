"""Stop-word lists (U4).

The base English list is a parameter.  Its default is the list Spark MLlib
publishes for ``StopWordsRemover``, spelled out here so that importing the
package needs neither a session nor Spark's jar files.  The reference used
scikit-learn's list, which is not installed here; pass it as ``base`` to
reproduce its vocabulary exactly.
"""

from __future__ import annotations

from collections.abc import Iterable

# Domain words the reference adds to the English list (abstract analysis).
SUPPLEMENTARY_ABSTRACT = ["care", "ICU", "study", "studies", "hospital", "method", "result", "admission", "admitted"]
# Extra words added for the full-text analysis.
SUPPLEMENTARY_FULLTEXT = SUPPLEMENTARY_ABSTRACT + [
    "Introduction", "Background", "Methods", "Results", "Discussion", "Conclusion",
]

# The English list published with Spark MLlib's StopWordsRemover.
ENGLISH_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split())


def stop_words(
    base: Iterable[str] | None = None,
    extra: Iterable[str] = SUPPLEMENTARY_ABSTRACT,
    lowercase_extra: bool = False,
) -> list[str]:
    """Union of a base list and extra words, sorted.

    ``lowercase_extra=False`` keeps the reference behaviour where ``ICU`` and
    capitalised extras never match lower-cased tokens (trap T6).
    """
    words = set(ENGLISH_STOP_WORDS if base is None else base)
    words |= {w.lower() for w in extra} if lowercase_extra else set(extra)
    return sorted(words)


def sql_list(words: Iterable[str]) -> str:
    """A SQL list literal ``['a', 'b']`` for the oracle strings."""
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"
