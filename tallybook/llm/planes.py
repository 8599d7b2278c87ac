"""Token ids in files of compressed bit or byte planes, with a chunk index.

A file holds whole documents, about ``FILE_IDS`` ids of them, cut into chunks of
``CHUNK_IDS`` ids whatever the document borders are.  The ids of a chunk are
transposed: plane k of a chunk holds bit k (or byte k) of all its ids, one after
the other, which puts the bits that hardly vary side by side.  Every plane is
one zstandard frame; a plane of zeros is not stored.

    magic, then per chunk its planes, then as one zstandard frame the document
    table (id, a flag for a null id, number of ids), then the chunk index (place
    and size of every plane, number of ids), then the tail: places of both, the
    counts, the file's place in the order of all files, plane width, magic.

A reader opens the tail, and by the chunk index decodes only the chunks it needs
(``ids_between``).  Files are written by Spark's text writer, one record to a
file, so no task writes to a disk of its own.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_path
from .common import batches_of, fresh, rows_of, store
from .tokens import GROUP_CHARS, encoder

MAGIC = b"TBPLANE1"
END_ID = 2
#: ids to a chunk, all of one chunk transposed at once
CHUNK_IDS = 1 << 16
#: ids after which a file is closed; bounds what a task holds and reads at once
FILE_IDS = 4 << 20
LEVEL = 3
ID_BITS = 32
#: documents place, chunk index place, number of documents, chunks, ids, partition, file, bits a plane
_TAIL = struct.Struct("<8Q8s")


def to_planes(ids: np.ndarray, bits: int) -> np.ndarray:
    """One row per plane of ``bits`` (1 or 8) bits, lowest first."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits == 8:
        return np.ascontiguousarray(raw.T)
    planes = np.unpackbits(np.ascontiguousarray(raw.T), axis=1, bitorder="little").reshape(4, -1, 8)
    return np.packbits(planes.transpose(0, 2, 1), axis=2, bitorder="little").reshape(32, -1)


def from_planes(planes: np.ndarray, count: int, bits: int) -> np.ndarray:
    """The inverse of ``to_planes`` for ``count`` ids."""
    if bits == 1:
        each = np.unpackbits(planes, axis=1, bitorder="little")[:, :count].reshape(4, 8, count)
        planes = np.packbits(each.transpose(0, 2, 1), axis=2, bitorder="little").reshape(4, count)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class Writer:
    """Collects documents; ``finish`` gives the bytes of one file."""

    def __init__(self, part: int, number: int, bits: int, level: int = LEVEL):
        import zstandard

        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.part, self.number, self.bits = part, number, bits
        self.body, self.at = [MAGIC], len(MAGIC)
        self.documents: list[tuple[int | None, int]] = []
        self.index: list[list[int]] = []
        self.held: list[np.ndarray] = []
        self.waiting = self.total = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.documents.append((doc_id, len(ids)))
        self.total += len(ids)
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= CHUNK_IDS:
            ids = np.concatenate(self.held)
            whole = len(ids) - len(ids) % CHUNK_IDS
            for at in range(0, whole, CHUNK_IDS):
                self._chunk(ids[at:at + CHUNK_IDS])
            self.held, self.waiting = [ids[whole:]], len(ids) - whole

    def _put(self, data: bytes) -> int:
        self.body.append(data)
        self.at += len(data)
        return len(data)

    def _chunk(self, ids: np.ndarray) -> None:
        place = self.at
        sizes = [self._put(self.pack(p.tobytes())) if p.any() else 0 for p in to_planes(ids, self.bits)]
        self.index.append([place, len(ids), *sizes])

    def finish(self) -> bytes:
        if self.waiting:
            self._chunk(np.concatenate(self.held))
        table = np.array([(d or 0, d is None, n) for d, n in self.documents], "<i8").reshape(-1, 3)
        documents = self.at
        self._put(self.pack(table.tobytes()))
        chunks = self.at
        self._put(np.array(self.index, "<i8").tobytes())
        self._put(_TAIL.pack(documents, chunks, len(self.documents), len(self.index), self.total, self.part, self.number,
                             self.bits, MAGIC))
        return b"".join(self.body)


class Reader:
    """One file's documents and chunks."""

    def __init__(self, data: bytes):
        import zstandard

        self.data = data[:-1]  # the writer of Spark ends the record with a line break
        if self.data[:len(MAGIC)] != MAGIC or self.data[-len(MAGIC):] != MAGIC or data[-1:] != b"\n":
            raise ValueError("not a file of id planes")
        tail = _TAIL.unpack(self.data[-_TAIL.size:])
        self.at, index, n_documents, n_chunks, self.total, self.part, self.number, self.bits, _ = tail
        self.unpack = zstandard.ZstdDecompressor().decompress
        planes = ID_BITS // self.bits
        self.chunks = np.frombuffer(self.data, "<i8", n_chunks * (2 + planes), index).reshape(n_chunks, 2 + planes)
        table = np.frombuffer(self.unpack(self.data[self.at:index]), "<i8").reshape(n_documents, 3)
        self.documents = [(None if none else d, n) for d, none, n in table.tolist()]
        self.firsts = np.cumsum(self.chunks[:, 1]) - self.chunks[:, 1]
        if self.total != self.chunks[:, 1].sum() or self.total != table[:, 2].sum():
            raise ValueError("a file's counts of ids differ")

    def chunk(self, k: int) -> np.ndarray:
        """The ids of chunk k."""
        place, count, *sizes = self.chunks[k].tolist()
        planes = np.zeros((len(sizes), -(-count * self.bits // 8)), np.uint8)
        for plane, size in zip(planes, sizes, strict=True):
            if size:
                plane[:] = np.frombuffer(self.unpack(self.data[place:place + size]), np.uint8)
            place += size
        return from_planes(planes, count, self.bits)

    def ids_between(self, first: int, end: int) -> np.ndarray:
        """Ids first .. end - 1 of the file, decoding only the chunks that hold them."""
        own = np.flatnonzero((self.firsts < end) & (self.firsts + self.chunks[:, 1] > first)).tolist()
        if not own:
            return np.zeros(0, np.uint32)
        base = int(self.firsts[own[0]])
        return np.concatenate([self.chunk(k) for k in own])[max(first - base, 0):end - base]

    def texts(self) -> Iterator[tuple[int | None, int, int, list[np.ndarray]]]:
        """``(doc_id, start in the file, number of ids, runs of ids)``, one chunk in memory at a time."""
        at, k, rest = 0, 0, np.zeros(0, np.uint32)
        for doc_id, n in self.documents:
            runs, lacking = [], n
            while lacking:
                if not len(rest):
                    rest, k = self.chunk(k), k + 1
                runs.append(rest[:lacking])
                lacking -= len(runs[-1])
                rest = rest[len(runs[-1]):]
            yield doc_id, at, n, runs
            at += n


def _groups(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Runs of rows with about as many characters as are split at once."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[1] or "")
        if chars >= GROUP_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


_FILE = pa.schema([("value", pa.binary())])


def _filer(tokenizer: str, bits: int, file_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        out = Writer(part, number, bits)
        end = np.array([END_ID], np.uint32)
        for group in _groups(rows_of(batches)):
            for (doc_id, _), ids in zip(group, encoder(tokenizer).arrays([t or "" for _, t in group]), strict=True):
                out.add(doc_id, np.concatenate([ids, end]))
                if out.total >= file_ids:
                    yield pa.record_batch([pa.array([out.finish()], pa.binary())], schema=_FILE)
                    number += 1
                    out = Writer(part, number, bits)
        if out.documents:
            yield pa.record_batch([pa.array([out.finish()], pa.binary())], schema=_FILE)
    return write


def write_ids(docs: DataFrame, tokenizer: str, text_col: str = "text", id_col: str = "doc_id", bits: int = 8,
              file_ids: int = FILE_IDS) -> str:
    """Write the ids of all texts, an end id after each, in ascending order of id; returns the folder.

    A null text counts as empty.  Null ids come first; rows of equal ids follow
    each other in the order they are read in.  An id that a third of all rows
    share is dealt over many tasks, since the range is cut by id and row.  An
    empty table writes no file of planes.
    """
    if bits not in (1, 8):
        raise ValueError("planes are of 1 or 8 bits")
    path = shared_path(docs.sparkSession, "llm", f"planes-{uuid.uuid4().hex}")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                         F.monotonically_increasing_id().alias("row"))
    (source.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")
     .mapInArrow(_filer(tokenizer, bits, file_ids), "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).text(path))
    return path


_DOC = pa.schema([("part", pa.int64()), ("number", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()),
                  ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])


def _reader(with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (content,) in rows_of(batches):
                if not content:
                    continue  # the file of a task without rows
                file = Reader(content)
                for doc_id, at, n, runs in file.texts():
                    crc = 0
                    for run in runs:
                        crc = zlib.crc32(np.ascontiguousarray(run).data, crc)
                    yield (file.part, file.number, doc_id, at, n, crc,
                           np.concatenate(runs).tobytes() if with_ids else None)
        return batches_of(rows(), _DOC)
    return read


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of every document in the files of a folder.

    ``start`` counts the ids of all documents before, whichever file holds them.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("content")
    rows = store(files.mapInArrow(_reader(with_ids), "part long, number long, doc_id long, at long, n_tokens long, "
                                                     "ids_crc32 long, ids binary"), "planes-read")
    of_file = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("n"))
    # one row a task of the writer, then the files of each
    of_part = of_file.groupBy("part").agg(F.sum("n").alias("all")).select(
        "part", (F.sum("all").over(Window.orderBy("part")) - F.col("all")).alias("base"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("number")) - F.col("n")
    firsts = of_file.select("part", "number", inside.alias("inside")).join(of_part, "part").select(
        "part", "number", (F.col("base") + F.col("inside")).alias("first"))
    out = rows.join(firsts, ["part", "number"]).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "ids")
    return out if with_ids else out.drop("ids")
