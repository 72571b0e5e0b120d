"""Operator 9: multinomial naive Bayes over hashed character n-grams.

Lower-cased texts are read as code points; ASCII signs other than letters
count as spaces.  The 1-, 2- and 3-grams are hashed into ``buckets``; counts per
language are summed by Spark and smoothed, and the matrix of log
probabilities (languages x buckets) is broadcast.  Texts are scored in batches,
as a sparse matrix of bucket counts times the log probabilities, in numpy; the
score is the posterior of the best language under equal priors.  ``fit`` refuses
a table of more than ``most_languages`` languages, which bounds the matrix.

Learning uses labelled rows that are not held out, about ``docs_per_language``
of each language (a documented, bounded sample: rows are taken by a hash of
their id, with the rate that the counts per language give).

Defined cases: ``und`` with score 0 for null texts and texts without a letter,
and for every text if nothing can be learned; ties go to the language that
comes first by name; null languages are not learned; long texts count whole;
repeated rows are predicted alike; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from prismark.llm.quality_classifier import held_out
from prismark.llm.runtime import tidy

UNKNOWN = "und"
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def gram_buckets(text: str, bits: int) -> np.ndarray:
    """Bucket of every 1-, 2- and 3-gram of the text."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    code = np.where((code < 97) | (code > 122) & (code < 128), 32, code).astype(np.uint32)
    if not len(code):
        return code
    a, b, c = (np.uint32(m) for m in MULTIPLIERS)
    shift = np.uint32(32 - bits)
    with np.errstate(over="ignore"):
        one = code * a
        two = (one[:-1] ^ (code[1:] * b)) * c
        three = (two[:-1] ^ (code[2:] * a)) * b
        return np.concatenate([(h ^ (h >> np.uint32(15))) * a >> shift for h in (one, two, three)])


def fit(
    docs: DataFrame, docs_per_language: int = 2000, bits: int = 15, smoothing: float = 0.5, most_languages: int = 512,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> tuple[list[str], np.ndarray]:
    """Languages by name and their log probabilities (buckets x languages)."""
    rows = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull())
    found = rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")).limit(most_languages + 1).collect()
    if len(found) > most_languages:
        raise ValueError(f"column {lang_col} holds more than {most_languages} languages")
    counts = {r["lang"]: r["n"] for r in found}
    langs = sorted(counts)
    if not langs:
        return [], np.zeros((1 << bits, 0))
    rate = F.create_map(*(F.lit(v) for k in langs for v in (k, min(1.0, docs_per_language / counts[k]))))
    dice = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_003)) / 1_000_003
    sample = rows.where(dice < rate[F.col(lang_col)]).select(
        F.col(lang_col).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    place = {k: i for i, k in enumerate(langs)}

    def count(batches):
        import pyarrow as pa

        total = np.zeros((len(langs), 1 << bits), np.int64)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[place[lang]] += np.bincount(gram_buckets(text, bits), minlength=1 << bits)
        for k in range(len(langs)):
            used = np.flatnonzero(total[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), k, np.int32)), pa.array(used.astype(np.int32)), pa.array(total[k][used])],
                names=["k", "bucket", "n"],
            )

    table = sample.mapInArrow(tidy(count), "k int, bucket int, n long").groupBy("k", "bucket").agg(F.sum("n").alias("n"))
    n = np.full((1 << bits, len(langs)), smoothing)
    got = table.toPandas()  # languages x buckets rows at most
    n[got["bucket"].to_numpy(), got["k"].to_numpy()] += got["n"].to_numpy()
    return langs, np.log(n) - np.log(n.sum(axis=0))


def _grams(text: str, bits: int, piece: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """The different buckets of a text's n-grams and how often each occurs; a long text is read in pieces."""
    text, total = text.lower(), np.zeros(1 << bits, np.int64)
    for at in range(0, len(text), piece):
        # the two characters before a piece begin n-grams of it; those that lie in them whole were counted with the piece before
        back = min(at, 2)
        total += np.bincount(gram_buckets(text[at - back : at + piece], bits), minlength=len(total))
        if back:
            total -= np.bincount(gram_buckets(text[at - back : at], bits), minlength=len(total))
    used = np.flatnonzero(total)
    return used, total[used]


def sparse_batches(texts, bits: int, most: int = 1 << 18):
    """Texts as sparse rows, some at a time: ``(row starts, buckets, counts)`` of at most about ``most`` entries."""
    rows, size = [], 0
    for text in texts:
        rows.append(_grams(text, bits))
        size += len(rows[-1][0])
        if size >= most:
            yield _stacked(rows)
            rows, size = [], 0
    if rows:
        yield _stacked(rows)


def _stacked(rows):
    lengths = np.array([len(r[0]) for r in rows])
    return np.concatenate(([0], np.cumsum(lengths)[:-1])), np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])


def predict(texts, langs: list[str], log: np.ndarray) -> tuple[list[str], list[float], list[float]]:
    """Language and posterior of every text, and by how many nats an n-gram it is less likely than text of its language.

    A batch is a sparse matrix (texts x buckets) times the log probabilities
    (buckets x languages), one language at a time.
    """
    bits = int(log.shape[0]).bit_length() - 1
    letter = re.compile(r"[^\W\d_]")
    texts = list(texts)
    pred, score, unlikely = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
    known = [k for k, t in enumerate(texts) if t and langs and any(m.group().isalpha() for m in letter.finditer(t))]
    if not known:
        return pred, score, unlikely
    expected = (np.exp(log) * log).sum(axis=0)
    by_lang = np.ascontiguousarray(log.T)
    at = 0
    for starts, buckets, counts in sparse_batches((texts[k] for k in known), bits):
        sums = np.stack([np.add.reduceat(row[buckets] * counts, starts) for row in by_lang], axis=1)
        n = np.add.reduceat(counts, starts)
        best = sums.argmax(axis=1)
        top = sums[np.arange(len(best)), best]
        share = 1 / np.exp(sums - top[:, None]).sum(axis=1)
        apart = expected[best] - top / n
        for k, b, p, u in zip(known[at:], best.tolist(), share.tolist(), apart.tolist()):
            pred[k], score[k], unlikely[k] = langs[b], p, u
        at += len(best)
    return pred, score, unlikely


def identify(
    docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    from pyspark.sql.pandas.types import to_arrow_schema

    langs, table = model
    weights = docs.sparkSession.sparkContext.broadcast(table)
    schema = StructType([
        StructField("doc_id", docs.schema[id_col].dataType), StructField("held_out", BooleanType()),
        StructField("lang_pred", StringType()), StructField("score", DoubleType()),
    ])
    arrow = to_arrow_schema(schema)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            pred, score, _ = predict(batch.column(2).to_pylist(), langs, weights.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow.field(0).type), batch.column(1), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                names=arrow.names,
            )

    return docs.select(
        F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text")
    ).mapInArrow(tidy(run), schema)


def letter_share(text: str) -> float:
    """Share of letters in the characters that are no white space."""
    return sum(map(str.isalpha, text)) / max(1, sum(map(len, text.split())))


def keep_identified(
    docs: DataFrame, model: tuple[list[str], np.ndarray], min_score: float = 0.0, text_col: str = "text",
    max_unlikely: float = float("inf"), min_letters: float = 0.0,
) -> DataFrame:
    """The rows of ``docs`` whose language is known with ``min_score`` or more, with all their columns.

    If no language was learned (no labelled row outside the held-out ones), nothing
    can be told apart and every row is kept.

    The posterior only compares the learned languages and is near 1 for any long
    text.  Noise and other languages are told by the likelihood: a text of n
    characters is dropped if it is less likely than text of its language by more
    than ``max_unlikely + 6 / sqrt(n)`` nats an n-gram (short texts vary more), and
    one of signs if less than ``min_letters`` of it are letters.
    """
    langs, table = model
    if not langs:
        return docs
    weights = docs.sparkSession.sparkContext.broadcast(table)
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(at).to_pylist()
            keep = [
                p != UNKNOWN and s >= min_score and u <= max_unlikely + 6 / len(t) ** 0.5 and letter_share(t) >= min_letters
                for t, p, s, u in zip(texts, *predict(texts, langs, weights.value))
            ]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
