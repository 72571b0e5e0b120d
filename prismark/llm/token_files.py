"""Operator 2: token files of independent zstandard frames with a seek table.

A file holds one zstandard frame per document (ids as little-endian unsigned
integers, 16 bits wide where the vocabulary fits, else 32), then two skippable
frames: an index of the document ids, and the seek table of the public
seekable format (per frame: compressed size, content size and the low 32 bits
of the content's XXH64; then the frame count, a descriptor byte and the magic
number).  A reader fetches the two tables from the end of the file and
decompresses only the frames of the documents it wants, checking each frame's
checksum.

Rows are dealt out by ranges of the id and sorted inside a task, so the files,
ordered by their first id, hold the documents in ascending order (a null id
first, equal ids by text).  A task that is run again writes a new file under a
name of its own; only files named by finished tasks are in the manifest.

Defined cases: null and empty texts hold the end id alone; every repeated row
has a frame of its own; an empty table gives no file; other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from prismark.llm.runtime import shared_path, stored, tidy
from prismark.llm.tokens import library_encoder

# Fixed values of the public formats: skippable frames, seek table.
INDEX_MAGIC, SEEK_MAGIC, SEEKABLE_NUMBER, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
#: Index header: mark, bytes per id, number of documents.
HEADER, HEADER_SIZE = "<4sII", 12
MARK = b"TOKF"

MANIFEST = "file string, n_docs long, n_tokens long, first_doc long"


def open_store(uri: str):
    """File system and path of a shared folder or file."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


class TokenFileWriter:
    def __init__(self, sink, width: int, level: int = 3):
        import zstandard

        self.sink, self.width = sink, width
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=False).compress
        self.docs: list[int | None] = []
        self.frames: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        import xxhash

        raw = ids.astype(f"<u{self.width}").tobytes()
        frame = self.compress(raw)
        self.sink.write(frame)
        self.docs.append(doc_id)
        self.frames.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def finish(self) -> None:
        n = len(self.docs)
        index = struct.pack(HEADER, MARK, self.width, n)
        index += np.array([d or 0 for d in self.docs], "<i8").tobytes()
        index += np.packbits([d is None for d in self.docs]).tobytes()
        table = np.array(self.frames, "<u4").reshape(n, 3).tobytes()
        table += struct.pack("<IBI", n, CHECKSUMS, SEEKABLE_NUMBER)
        self.sink.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self.sink.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)


class TokenFileReader:
    """Random access by document; ``source`` needs ``seek`` and ``read``."""

    def __init__(self, source, size: int):
        import zstandard

        self.source = source
        self.expand = zstandard.ZstdDecompressor().decompress
        n, descriptor, number = struct.unpack("<IBI", self._at(size - 9, 9))
        if number != SEEKABLE_NUMBER or not descriptor & CHECKSUMS:
            raise ValueError("not a token file: no seek table with checksums at its end")
        length = 12 * n + 9
        magic, held = struct.unpack("<II", self._at(size - length - 8, 8))
        if magic != SEEK_MAGIC or held != length:
            raise ValueError("broken seek table")
        self.frames = np.frombuffer(self._at(size - length, 12 * n), "<u4").reshape(n, 3)
        self.starts = np.concatenate(([0], np.cumsum(self.frames[:, 0], dtype=np.int64)))
        at = int(self.starts[-1])
        magic, held = struct.unpack("<II", self._at(at, 8))
        mark, self.width, docs = struct.unpack(HEADER, self._at(at + 8, HEADER_SIZE))
        if magic != INDEX_MAGIC or mark != MARK or docs != n:
            raise ValueError("broken index")
        body = self._at(at + 8 + HEADER_SIZE, held - HEADER_SIZE)
        self.doc_ids = np.frombuffer(body[: 8 * n], "<i8")
        self.null = np.unpackbits(np.frombuffer(body[8 * n :], np.uint8), count=n).astype(bool)
        self.n_tokens = self.frames[:, 1].astype(np.int64) // self.width

    def _at(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def frame(self, k: int) -> np.ndarray:
        import xxhash

        size, content, check = (int(x) for x in self.frames[k])
        raw = self.expand(self._at(int(self.starts[k]), size), max_output_size=content)
        if len(raw) != content or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k}: wrong checksum")
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for k in range(len(self.frames)):
            yield (None if self.null[k] else int(self.doc_ids[k])), self.frame(k)

    def get(self, doc_ids: Iterable[int]) -> dict[int, list[np.ndarray]]:
        """The ids of the wanted documents; no other frame is read."""
        order = len(self.null) and int(self.null.sum())  # null ids come first
        ids = self.doc_ids[order:]
        out = {}
        for d in doc_ids:
            a, b = np.searchsorted(ids, d, "left"), np.searchsorted(ids, d, "right")
            out[d] = [self.frame(int(k) + order) for k in range(a, b)]
        return out


def write_token_files(
    docs: DataFrame, tokenizer_path: str, end_id: int = 0, folder: str | None = None, vocabulary: int = 50_257,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write the files and return their manifest with ``base``, the ids in all files before."""
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "token-files")
    width = 2 if max(vocabulary - 1, end_id) < 1 << 16 else 4

    def run(batches):
        import pyarrow as pa

        encoder = library_encoder(tokenizer_path)
        end = np.array([end_id], "<u4")
        writer, sink, tokens = None, None, 0
        name = f"{folder}/{uuid.uuid4().hex}.tok.zst"
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(keys), 2048):
                if writer is None:
                    store, path = open_store(name)
                    store.create_dir(path.rpartition("/")[0], recursive=True)
                    sink = store.open_output_stream(path, compression=None)
                    writer = TokenFileWriter(sink, width)
                for key, ids in zip(keys[at:], encoder.encode(texts.slice(at, 2048).to_pylist())):
                    writer.add(key, np.concatenate((ids, end)))
                    tokens += len(ids) + 1
        if writer is not None:
            writer.finish()
            sink.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(writer.docs)]), pa.array([tokens]), pa.array(writer.docs[:1], pa.int64())],
                names=["file", "n_docs", "n_tokens", "first_doc"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    made = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(tidy(run, cached=True), MANIFEST)
    manifest = stored(made, "token-manifest")  # one row per file
    before = Window.orderBy(F.col("first_doc").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def spread(files: DataFrame) -> DataFrame:
    """The rows of a manifest over as many tasks as there are files, or four for each core of the cluster."""
    cores = files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(max(1, min(files.count(), 4 * cores)), "file")  # by number: small rows would be coalesced into one task


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, read back from the files of a manifest."""

    def run(batches):
        import pyarrow as pa

        def table(rows):
            doc, start, n, ids = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "start", "n_tokens", "ids"],
            )

        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, path = open_store(name)
                with store.open_input_file(path) as source:
                    reader, rows, size = TokenFileReader(source, source.size()), [], 0
                    for doc, ids in reader.documents():
                        rows.append((doc, base, len(ids), ids.tobytes()))
                        base += len(ids)
                        size += len(ids)
                        if size >= 1 << 20 or len(rows) >= 8192:
                            yield table(rows)
                            rows, size = [], 0
                    if rows:
                        yield table(rows)

    files = spread(manifest.select("file", "base"))
    return files.mapInArrow(tidy(run), "doc_id long, start long, n_tokens long, ids binary")


def fetch(spark: SparkSession, manifest: DataFrame, doc_ids: list[int]) -> DataFrame:
    """``doc_id, ids`` of a stated list of documents, decompressing their frames only."""
    wanted = sorted(set(doc_ids))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, path = open_store(name)
                with store.open_input_file(path) as source:
                    got = TokenFileReader(source, source.size()).get(wanted)
                rows = [(d, ids.tobytes()) for d, many in got.items() for ids in many]
                if rows:
                    doc, ids = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "ids"]
                    )

    return spread(manifest.select("file")).mapInArrow(tidy(run), "doc_id long, ids binary")
