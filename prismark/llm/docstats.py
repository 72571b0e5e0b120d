"""Statistics of whole texts for the quality operators.

Words are the runs of characters other than the six ASCII white-space ones.
A word is repeated if it lies in a window of eight words that occurs at least
twice in its text, the first occurrence included; windows are compared by a
64-bit hash of the words' numbers within the text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = b"0123456789"
WINDOW = 8

#: Counts of a text, in this order.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Transformed statistics of a text, in this order.
FEATURES = (
    "log_words", "word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "marks", "stops", "variety", "stutter", "line_words",
)


def _count(raw: bytes, signs: bytes) -> int:
    return len(raw) - len(raw.translate(None, signs))


def repeated_words(numbers: np.ndarray) -> int:
    """Words in windows of ``WINDOW`` words that occur twice or more."""
    n = len(numbers) - WINDOW + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        mixed = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        key = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            key = key * np.uint64(0xD1342543DE82EF95) + mixed[k : k + n]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(twice), 1)
    np.add.at(cover, np.flatnonzero(twice) + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def text_stats(text: str | None) -> tuple[list[int], list[float]]:
    """The counts and the transformed statistics of one text; null counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    word_chars = len(text) - _count(raw, BLANKS)
    symbols = _count(raw, SYMBOLS)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    seen: dict[bytes, int] = {}
    numbers = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    repeats = repeated_words(numbers)
    upper, lower = _count(raw, UPPER), _count(raw, LOWER)
    per_word = 1 / max(n, 1)
    stutter = int((numbers[1:] == numbers[:-1]).sum())
    features = [
        np.log1p(n),
        np.log1p(word_chars * per_word),
        np.log1p(symbols * per_word),
        dup_lines / max(len(lines), 1),
        repeats * per_word,
        upper / max(upper + lower, 1),
        np.log1p(_count(raw, DIGITS) * per_word),
        np.log1p(_count(raw, b"!?;:=\"'()[]{}/\\_-+") * per_word),
        np.log1p(_count(raw, b".,") * per_word),
        np.log1p(len(seen)) / np.log1p(max(n, 1)) if n else 0.0,
        stutter * per_word,
        np.log1p(n / max(len(lines), 1)),
    ]
    return [n, word_chars, symbols, dup_lines, repeats], [float(x) for x in features]


def with_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns of ``keep``, the counts and ``x`` (array of the statistics) of every row."""
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = [StructField("doc_id", docs.schema[id_col].dataType)]
    fields += [StructField(f"_k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    out = StructType(
        fields + [StructField(c, LongType()) for c in COUNTS] + [StructField("x", ArrayType(DoubleType(), False))]
    )
    arrow = to_arrow_schema(out)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                stats = [text_stats(t) for t in part.column(part.num_columns - 1).to_pylist()]
                columns = [part.column(i).cast(arrow.field(i).type) for i in range(part.num_columns - 1)]
                columns += [pa.array([s[0][i] for s in stats], pa.int64()) for i in range(len(COUNTS))]
                columns.append(pa.array([s[1] for s in stats], arrow.field(len(arrow) - 1).type))
                yield pa.RecordBatch.from_arrays(columns, names=arrow.names)

    rows = docs.select(
        F.col(id_col).alias("doc_id"), *(F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)), F.col(text_col).alias("_text")
    ).mapInArrow(run, out)
    return rows.withColumnsRenamed({f"_k{i}": c for i, c in enumerate(keep)})
