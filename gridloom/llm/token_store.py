"""Token ids of a corpus in binary files, documents in ascending doc_id order.

A file holds, one after the other: the ids of all its documents, concatenated (little-endian, 2 bytes each if the
vocabulary allows, else 4); the document boundaries, in Elias-Fano code; the ascending doc_ids less their first, in the
same code; and a tail of fixed size that says where each part starts.  Files are named by range of doc_ids, then number,
so that their names sort as their documents do.  Each is written under a name of its own and then renamed: a task that
runs twice leaves one file, and the same one.

Defined cases: a null or empty text has the end id only; rows that repeat a doc_id stand side by side, by text; a null
doc_id comes first; an empty table gives no file, and no rows when read; other columns play no part.
"""

from __future__ import annotations

import posixpath
import struct
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.llm import tokens as T
from gridloom.llm.common import n_shuffle
from gridloom.llm.elias_fano import EliasFano

MAGIC = b"GLTOKEN1"
TAIL = struct.Struct("<BQQqQQ8s")  # bytes an id, ids, documents without doc_id, first doc_id, start of boundaries, start of doc_ids
#: Ids in a file, about; documents and ids that a reader holds at a time (one document may have more).
FILE_IDS, RUN, RUN_IDS = 8_000_000, 2000, 1_000_000


class Writer:
    """Writes one file: documents come one by one, and only boundaries and doc_ids are held."""

    def __init__(self, out: pa.NativeFile, width: int) -> None:
        self.out, self.width, self.total, self.without = out, width, 0, 0
        self.ends, self.known = array("Q", [0]), array("q")

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.out.write(ids.astype(f"<u{self.width}").tobytes())
        self.total += len(ids)
        self.ends.append(self.total)
        if doc_id is None:
            self.without += 1  # these come first
        else:
            self.known.append(doc_id)

    def close(self) -> None:
        known = np.frombuffer(self.known, np.int64)
        first = int(known[0]) if len(known) else 0
        boundaries = EliasFano.of(np.frombuffer(self.ends, np.uint64)).to_bytes()
        self.out.write(boundaries)
        self.out.write(EliasFano.of(known.astype(np.uint64) - np.uint64(first % (1 << 64))).to_bytes())
        at = self.total * self.width
        self.out.write(TAIL.pack(self.width, self.total, self.without, first, at, at + len(boundaries), MAGIC))
        self.out.close()


class Shard:
    """A file, open for reading: boundaries and doc_ids stay packed in memory, ids stay in the file."""

    def __init__(self, source: pa.NativeFile) -> None:
        self.source = source
        end = source.size() - TAIL.size
        width, self.total, self.without, self.first, at, at_ids, magic = TAIL.unpack(self._bytes(end, TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.width = width
        self.boundaries, _ = EliasFano.from_bytes(self._bytes(at, at_ids - at))
        self.known, _ = EliasFano.from_bytes(self._bytes(at_ids, end - at_ids))

    def __len__(self) -> int:
        return self.boundaries.count - 1

    def _bytes(self, at: int, size: int) -> memoryview:
        self.source.seek(at)
        return memoryview(self.source.read_buffer(size))

    def tokens(self, start: int, end: int) -> np.ndarray:
        """The ids at these places."""
        return np.frombuffer(self._bytes(start * self.width, (end - start) * self.width), f"<u{self.width}")

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document of the file."""
        return self.tokens(self.boundaries.select(i), self.boundaries.select(i + 1))

    def doc_ids(self, a: int, b: int) -> list[int | None]:
        """The doc_ids of the documents from a up to b."""
        low, high = max(a - self.without, 0), max(b - self.without, 0)
        known = self.known.span(low, high) + np.uint64(self.first % (1 << 64))
        return [None] * (b - a - (high - low)) + known.view(np.int64).tolist()


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> DataFrame:
    """Writes the files into ``path``; a row a file: (file, documents, ids).  The rows are the files' record: keep them."""
    width = T.id_width(tokenizer, end_id)

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(path)
        encoder, part = T.encoder(tokenizer), TaskContext.get().partitionId()
        writer, number, made = None, 0, []

        def finish() -> None:
            writer.close()
            store.move(posixpath.join(folder, scratch), posixpath.join(folder, final))
            made.append((final, len(writer.ends) - 1, writer.total))

        for batch in batches:
            for a, texts in T.chunks(batch.column(1)):
                for doc_id, ids in zip(batch.column(0).slice(a, len(texts)).to_pylist(), encoder.encode(texts), strict=True):
                    if writer is None:
                        final, scratch = f"part-{part:07d}-{number:05d}.tok", f"_scratch-{uuid.uuid4().hex}"
                        store.create_dir(folder, recursive=True)
                        writer, number = Writer(store.open_output_stream(posixpath.join(folder, scratch)), width), number + 1
                    writer.add(doc_id, np.append(ids, np.uint32(end_id)))
                    if writer.total >= FILE_IDS:
                        finish()
                        writer = None
        if writer is not None:
            finish()
        T.release()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*made, strict=True)) or [[], [], []], (pa.string(), pa.int64(), pa.int64()), strict=True)], ["file", "documents", "ids"])

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(n_shuffle(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(save, "file string, documents bigint, ids bigint")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, doc_id, start, n_tokens, ids) from the files: start counts from the file's first id, ids are 32-bit little-endian bytes.

    Spark lists and deals the files; a task reads each in runs of documents, whose places ``span`` gives.
    """

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(path)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                with store.open_input_file(posixpath.join(folder, file)) as source:
                    yield from _rows(file, Shard(source))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").schema("path string, modificationTime timestamp, length bigint, content binary").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file")).mapInArrow(load, "file string, doc_id bigint, start bigint, n_tokens bigint, ids binary")


def _rows(file: str, shard: Shard) -> Iterator[pa.RecordBatch]:
    a = 0
    while a < len(shard):
        ends = shard.boundaries.span(a, min(a + RUN, len(shard)) + 1).astype(np.int64)
        n = max(1, int(np.searchsorted(ends, ends[0] + RUN_IDS, side="right")) - 1)  # documents that fit in a run
        ends = ends[: n + 1]
        ids = shard.tokens(int(ends[0]), int(ends[-1])).astype("<u4")
        raw = [ids[i:j].tobytes() for i, j in zip(ends[:-1] - ends[0], ends[1:] - ends[0], strict=True)]
        columns = [pa.array([file] * n), pa.array(shard.doc_ids(a, a + n), pa.int64()), pa.array(ends[:-1]), pa.array(np.diff(ends)), pa.array(raw, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["file", "doc_id", "start", "n_tokens", "ids"])
        a += n


def file_starts(files: DataFrame) -> DataFrame:
    """(name, before): how many ids stand in the files before each.  The window is over one row a file."""
    before = F.sum("ids").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1))
    return files.select(F.col("file").alias("name"), F.coalesce(before, F.lit(0)).alias("before"))


def stored(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> tuple[DataFrame, DataFrame]:
    """Writes the files, and gives their record and what they hold."""
    from gridloom.llm.common import cut

    files = cut(write(docs, path, tokenizer, end_id))
    if files.isEmpty():
        nothing = docs.sparkSession.createDataFrame([], "file string, doc_id bigint, start bigint, n_tokens bigint, ids binary")
        return files, nothing
    return files, read(docs.sparkSession, path)
