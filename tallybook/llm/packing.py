"""Bounded-space online packing of documents into token sequences.

Every task holds ``OPEN`` windows of ``SEQUENCE`` tokens.  A document that is
longer than a window fills windows of its own with its head; the rest goes to
the open window with the least room that still holds it.  When none does, the
fullest window is emitted, after the head of the document has filled its gap if
that is worth a cut.  The windows left open at the end of the tasks are taken
apart again and merged, a bounded number of tasks at a time, until one group is
left.

Only piece descriptions (document, start, length) leave the first pass, never
the texts.  That pass is stored before it is used twice, so a lost executor
cannot change what the merge has already seen.
"""

from __future__ import annotations

import itertools
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, rows_of, store
from .tokens import GROUP_CHARS, encoder

SEQUENCE = 4096
OPEN = 64
END_ID = 2
#: a gap of fewer tokens is left as padding rather than cutting a document for it
LEAST_CUT = 64
#: tasks (then groups) whose open windows are merged together
FAN_IN = 16


class Windows:
    """At most ``limit`` open windows; places lengths, returns the windows closed.

    ``place`` returns ``(piece start, piece length, window, offset)`` of the
    pieces it makes; closed windows are never written to again.
    """

    def __init__(self, limit: int = OPEN, size: int = SEQUENCE):
        self.limit, self.size = limit, size
        self.room: list[tuple[int, int]] = []  # (room left, window), ascending
        self.made = 0

    def _new(self) -> int:
        self.made += 1
        return self.made - 1

    def place(self, length: int, start: int = 0, cut: bool = True) -> list[tuple[int, int, int, int]]:
        out = []
        while length >= self.size and cut:
            out.append((start, self.size, self._new(), 0))
            start, length = start + self.size, length - self.size
        while length:
            at = bisect_left(self.room, (length, -1))
            if at == len(self.room):
                if len(self.room) >= self.limit:
                    room, window = self.room.pop(0)
                    if cut and room >= LEAST_CUT:
                        out.append((start, room, window, self.size - room))
                        start, length = start + room, length - room
                        continue
                self.room.append((self.size, self._new()))  # empty, so it has the most room
                at = len(self.room) - 1
            room, window = self.room.pop(at)
            out.append((start, length, window, self.size - room))
            if room > length:
                insort(self.room, (room - length, window))
            break
        return out


_PIECE = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("window", pa.int64()),
                    ("offset", pa.int64()), ("ids", pa.binary())])


def _group(source: Iterator[tuple]) -> list[tuple]:
    """The next rows of ``(doc_id, text)``, about as many characters as are split at once."""
    held, chars = [], 0
    for row in source:
        held.append(row)
        chars += len(row[1] or "")
        if chars >= GROUP_CHARS:
            break
    return held


def _packer(path: str, with_ids: bool):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        windows = Windows()
        counter = itertools.count()

        def rows():
            source = rows_of(batches)
            end = array("I", [END_ID]).tobytes()
            while group := _group(source):
                encoded = encoder(path).ids([text or "" for _, text in group])
                for (doc_id, _), ids in zip(group, encoded, strict=True):
                    ids += end
                    n = len(ids) // 4
                    for start, length, window, offset in windows.place(n):
                        piece = ids[4 * start:4 * (start + length)]
                        yield (base + next(counter), doc_id, start, length, zlib.crc32(piece), n,
                               base + window, offset, piece if with_ids else None)
            for _, window in windows.room:  # marks of the windows still open
                yield None, None, 0, 0, 0, 0, base + window, 0, None
        return batches_of(rows(), _PIECE)
    return pack


_PLACED = pa.schema([("key", pa.int64()), ("length", pa.int64()), ("grp", pa.int64()), ("window", pa.int64()),
                     ("offset", pa.int64()), ("open", pa.bool_())])


def _merger(level: int, last: bool):
    """Repack the pieces of each group, longest first; the emptiest windows stay open."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def group_rows(grp, pieces):
            windows = Windows(limit=len(pieces))
            placed = [(key, length, *windows.place(length, cut=False)[0][2:]) for key, length in pieces]
            still = set() if last else {w for _, w in windows.room[-OPEN:]}
            base = (level << 56) | (grp << 28)
            for key, length, window, offset in placed:
                yield key, length, grp, base + window, offset, window in still

        def rows():
            for grp, run in itertools.groupby(rows_of(batches), key=lambda r: r[0]):
                yield from group_rows(grp, [(key, length) for _, _, key, length in run])
        return batches_of(rows(), _PLACED)
    return merge


def pack(docs: DataFrame, tokenizer: str, text_col: str = "text", id_col: str = "doc_id",
         with_ids: bool = False) -> DataFrame:
    """Pieces of all rows of ``docs`` in sequences of at most 4096 tokens.

    Columns: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset`` and, if asked for, ``ids`` (little-endian unsigned 32-bit).  A null
    text counts as empty and is its end id alone.  Repeated rows are packed
    each; null ids stay null.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    pieces = store(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _packer(tokenizer, with_ids), "key long, doc_id long, start long, length long, ids_crc32 long, "
        "doc_tokens long, window long, offset long, ids binary"), "pieces")
    marks = pieces.where("key is null").select("window")
    real = pieces.where("key is not null")
    most = marks.agg(F.max(F.shiftright("window", 32))).first()[0]
    if most is None:
        merged = spark.createDataFrame([], "key long, sequence_id long, at long")
    else:
        waiting = real.join(marks, "window", "left_semi").select(
            (F.shiftright("key", 32).cast("long")).alias("grp"), "key", "length")
        level, groups, closed = 1, int(most) + 1, None
        while True:
            groups = -(-groups // FAN_IN)
            placed = store(waiting.select(F.expr(f"grp div {FAN_IN}").alias("grp"), (-F.col("length")).alias("order"),
                                          "key", "length")
                           .repartition(groups, "grp").sortWithinPartitions("grp", "order", "key")
                           .mapInArrow(_merger(level, groups == 1),
                                       "key long, length long, grp long, window long, offset long, open boolean"),
                           f"merged-{level}")
            part = placed.where("not open").select("key", F.col("window").alias("sequence_id"), F.col("offset").alias("at"))
            closed = part if closed is None else closed.union(part)
            if groups == 1:
                break
            waiting, level = placed.where("open").select("grp", "key", "length"), level + 1
        merged = closed
    out = real.join(merged, "key", "left").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.coalesce("sequence_id", "window").alias("sequence_id"), F.coalesce("at", "offset").alias("offset"), "ids")
    return out if with_ids else out.drop("ids")
