"""Operator 1: sum-of-squares online packing.

Every document becomes its token ids and an end id, and is placed into windows
of ``window`` ids.  Whole windows of a long document stand alone; what is left
goes to the open fill level that makes the sum of the squared counts of partly
filled windows smallest.  The counts are held in one array indexed by fill
level, so placing a document costs one vector operation whatever the number
of open windows; ties go to the fullest window.

Each task packs its own input partition.  Windows that are still open when the
input ends (or when more than ``max_open`` are open, which bounds memory) are
laid end to end, cut into full windows, and the rest is cut into windows whose
lengths are powers of two.  So no window needs padding: every one holds
``window`` ids or a power of two.

Defined cases: null and empty texts are the end id alone; long texts are cut
as often as needed; equal rows are packed each for itself; a null id is passed
on; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from prismark.llm.runtime import tidy
from prismark.llm.tokens import library_encoder

PIECES = (
    "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


class SumOfSquares:
    """Windows by fill level; ``place`` chooses one and returns its sequence and offset."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]
        self.fresh = 0
        self.n_open = 0

    def new(self) -> int:
        self.fresh += 1
        return self.fresh - 1

    def place(self, size: int) -> tuple[int, int]:
        """Sequence and offset for ``size`` ids, 0 < size < window."""
        n, w = self.count, self.window
        grown = 2 * n[size + 1 : w + 1] + 1
        grown[-1] = 0  # a full window is no longer counted
        cost = grown - 2 * n[1 : w - size + 1] + 1
        cost[n[1 : w - size + 1] == 0] = np.iinfo(np.int64).max
        level = 0
        if len(cost):
            best = len(cost) - 1 - int(np.argmin(cost[::-1]))
            if cost[best] <= 2 * n[size] + 1:
                level = best + 1
        if level:
            seq = self.open[level].pop()
            n[level] -= 1
            self.n_open -= 1
        else:
            seq = self.new()
        if level + size < w:
            self.open[level + size].append(seq)
            n[level + size] += 1
            self.n_open += 1
        return seq, level

    def clear(self) -> None:
        self.count[:] = 0
        self.open = [[] for _ in range(self.window + 1)]
        self.n_open = 0


def powers_of_two(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack_stream(docs: Iterator[tuple[object, np.ndarray]], window: int, max_open: int) -> Iterator[tuple]:
    """``(doc_id, start, ids, doc_tokens, sequence, offset)`` of every piece; ``docs``: id and ids."""
    packer = SumOfSquares(window)
    held: dict[int, list[tuple]] = {}

    def relay() -> Iterator[tuple]:
        """Lay the open windows end to end and cut them anew."""
        pieces = [p for seq in sorted(held) for p in held[seq]]
        held.clear()
        packer.clear()
        total = sum(len(p[2]) for p in pieces)
        room = [window] * (total // window) + powers_of_two(total % window)
        at, left, seq = 0, 0, -1
        sizes = iter(room)
        for doc, start, ids, n in pieces:
            while len(ids):
                if not left:
                    left, at, seq = next(sizes), 0, packer.new()
                part, ids = ids[:left], ids[left:]
                yield doc, start, part, n, seq, at
                start, at, left = start + len(part), at + len(part), left - len(part)

    for doc, ids in docs:
        n = len(ids)
        whole = n // window * window
        for start in range(0, whole, window):
            yield doc, start, ids[start : start + window], n, packer.new(), 0
        if n == whole:
            continue
        seq, offset = packer.place(n - whole)
        held.setdefault(seq, []).append((doc, whole, ids[whole:], n))
        if offset + n - whole == window:
            at = 0
            for d, start, part, m in held.pop(seq):
                yield d, start, part, m, seq, at
                at += len(part)
        elif packer.n_open > max_open:
            yield from relay()
    yield from relay()


def pack(
    docs: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int = 0, max_open: int = 4096,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of packed sequences.

    ``ids`` are little-endian unsigned 32-bit ids; ``start`` counts the ids of
    the document before the piece, ``doc_tokens`` all of them with the end id.
    ``sequence_id`` is unique over the table: the task's partition in the upper
    bits.
    """
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = library_encoder(tokenizer_path)
        first = TaskContext.get().partitionId() << 33
        end = np.array([end_id], "<u4")

        def stream():
            for batch in batches:
                texts, keys = batch.column(1), batch.column(0).to_pylist()
                for at in range(0, len(keys), 2048):
                    rows = encoder.encode(texts.slice(at, 2048).to_pylist())
                    for key, ids in zip(keys[at : at + 2048], rows):
                        yield key, np.concatenate((ids, end))

        def table(rows):
            doc, start, ids, n, seq, offset = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, id_type), pa.array(start, pa.int64()), pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([i.tobytes() for i in ids], pa.binary()), pa.array(n, pa.int64()),
                    pa.array([first + s for s in seq], pa.int64()), pa.array(offset, pa.int64()),
                ],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        from pyspark.sql.pandas.types import to_arrow_type

        id_type = to_arrow_type(id_kind)
        rows, size = [], 0
        for row in pack_stream(stream(), window, max_open):
            rows.append(row)
            size += len(row[2])
            if size >= 1 << 20 or len(rows) >= 8192:
                yield table(rows)
                rows, size = [], 0
        if rows:
            yield table(rows)

    id_kind = docs.schema[id_col].dataType
    schema = PIECES.format(id=id_kind.simpleString())
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(run, cached=True), schema)
