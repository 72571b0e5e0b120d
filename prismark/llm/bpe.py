"""Operator 3: byte-level BPE encoding and decoding by backtracking.

A rank file lists tokens (byte strings) by rank.  Bytes are mapped to Latin-1
characters, and the tokens that merging can produce go into an Aho-Corasick
automaton, which gives the longest token at every position in one pass over a
match.  The encoder walks from the left: it takes the longest token that fits
after the last one, falls back to its next shorter prefix token, and steps
back over the last token when none fits; positions known to lead nowhere are
not tried again.  Two neighbours fit if merging would leave the border between
them alone, which is decided by undoing their merges from the highest rank
down and memoised per pair.  The result is that of merging by rank, in time
linear in the length of the match.

A match that is itself a token is that token, as the rank-file libraries do.

Defined cases: null and empty texts have no ids; text of any length is encoded
match by match; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from prismark.llm.runtime import worker_cached
from prismark.llm.tokens import BatchEncoder


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge_by_rank(token: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """Parts left when ``token`` is merged by ranks under ``below``: the definition, used to build the tables."""
    parts = [token[k : k + 1] for k in range(len(token))]
    while len(parts) > 1:
        best, at = below, -1
        for k in range(len(parts) - 1):
            rank = ranks.get(parts[k] + parts[k + 1], below)
            if rank < best:
                best, at = rank, k
        if at < 0:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class BacktrackingBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.above = max(self.token, default=0) + 1
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.reached: set[bytes] = set()
        for token, rank in ranks.items():
            if len(token) > 1:
                parts = merge_by_rank(token, ranks, rank)
                if len(parts) != 2:
                    continue  # merging never makes this token; it stands only for a whole match
                left, right = ranks[parts[0]], ranks[parts[1]]
                self.halves[rank] = left, right
                self.merged[left, right] = rank
            self.automaton.add_word(token.decode("latin-1"), rank)
            self.reached.add(token)
        if self.reached:
            self.automaton.make_automaton()
        self.shorter: dict[int, int | None] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        #: Pairs remembered; the memo starts anew beyond that.
        self.fits_kept = 1_000_000

    def _prefix(self, rank: int) -> int | None:
        """The longest token that is a proper prefix of this one."""
        if rank not in self.shorter:
            token = self.token[rank]
            self.shorter[rank] = next(
                (self.ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.reached), None
            )
        return self.shorter[rank]

    def _fit(self, left: int, right: int) -> bool:
        key = left, right
        if (known := self.fits.get(key)) is None:
            if len(self.fits) >= self.fits_kept:
                self.fits.clear()
            known = self.fits[key] = self._border_stays(left, right)
        return known

    def _border_stays(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both never merges across their border.

        Going back in time, the younger of the two tokens at the border is
        undone; a merge across the border of what stood there would have
        happened if its rank is lower than that of the merge undone last
        (at equal rank the leftmost comes first).
        """
        limit = self.above
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < limit:
                return False
            if left > right and left in self.halves or right not in self.halves:
                if left not in self.halves:
                    return True
                limit = left
                left = self.halves[left][1]
            else:
                limit = right + 1
                right = self.halves[right][0]

    def _longest(self, text: str) -> list[int]:
        """The longest token at every position of the match."""
        found = [-1] * len(text)
        ends = [0] * len(text)
        for end, rank in self.automaton.iter(text):
            start = end - len(self.token[rank]) + 1
            if end + 1 > ends[start]:
                ends[start], found[start] = end + 1, rank
        return found

    def encode_bytes(self, match: bytes) -> list[int]:
        """Ids of one match of the split pattern."""
        whole = self.ranks.get(match)
        if whole is not None:
            return [whole]
        n = len(match)
        longest = self._longest(match.decode("latin-1"))
        size = self.token
        alive = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        at, candidate = 0, longest[0] if n else None
        while at < n:
            last = out[-1] if out else None
            rank = candidate
            while rank is not None and rank >= 0:
                end = at + len(size[rank])
                if alive[end] and (last is None or self._fit(last, rank)):
                    break
                rank = self._prefix(rank)
            if rank is None or rank < 0:  # nothing fits here: step back
                if last is None:
                    raise ValueError("the rank file does not cover these bytes")
                alive[at] = 0
                out.pop()
                at -= len(size[last])
                candidate = last
            else:
                out.append(rank)
                at = end
                candidate = longest[at] if at < n else None
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def text_encoder(path: str, pattern: str) -> tuple[BacktrackingBpe, BatchEncoder]:
    def build():
        bpe = BacktrackingBpe(read_ranks(path))
        return bpe, BatchEncoder(lambda match: bpe.encode_bytes(match.encode("utf-8", "surrogatepass")), pattern)

    return worker_cached(("backtracking_bpe", path, pattern), build)


def _arrow_map(docs, id_col, value_col, schema_value, fn):
    """``doc_id`` and what ``fn(values)`` makes of a batch's values, at most 512 values at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
    from pyspark.sql.types import StructField, StructType

    kind = docs.schema[id_col].dataType
    head = to_arrow_type(kind)
    schema = StructType([StructField("doc_id", kind), *schema_value])
    names = schema.names
    arrow = to_arrow_schema(schema)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                columns = fn(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(head), *(pa.array(c, arrow.field(k + 1).type) for k, c in enumerate(columns))],
                    names=names,
                )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(value_col).alias("value")).mapInArrow(run, schema)


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int) for every text."""
    from pyspark.sql.types import ArrayType, IntegerType, StructField

    def fn(texts):
        _, encoder = text_encoder(rank_path, pattern)
        return [[ids.astype(np.int32) for ids in encoder.encode(texts)]]

    return _arrow_map(docs, id_col, text_col, [StructField("ids", ArrayType(IntegerType(), False))], fn)


def decode(coded: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, data`` (the bytes that the ids stand for)."""
    from pyspark.sql.types import BinaryType, StructField

    def fn(rows):
        bpe, _ = text_encoder(rank_path, pattern)
        return [[bpe.decode(ids or []) for ids in rows]]

    return _arrow_map(coded, id_col, ids_col, [StructField("data", BinaryType())], fn)


def round_trip(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    from pyspark.sql.types import LongType, StringType, StructField

    def fn(texts):
        bpe, encoder = text_encoder(rank_path, pattern)
        names = worker_cached(("id_names", rank_path), lambda: {r: str(r) for r in bpe.token})
        n, ids_hash, text_hash = [], [], []
        for ids in encoder.encode(texts):
            ids = ids.tolist()
            n.append(len(ids))
            ids_hash.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
            text_hash.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
        return [n, ids_hash, text_hash]

    return _arrow_map(
        docs, id_col, text_col,
        [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())],
        fn,
    )
