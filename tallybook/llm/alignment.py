"""Alignment of two tokenizers' tokens by byte offsets, on Arrow columns.

Tokenizer A reads space + text, B the text and adds the space itself, so both
cover the same bytes.  A task takes its documents in blocks.  In each, the ids
of all texts are list columns, which are flattened with their parents' numbers;
byte lengths are looked up by id, and their running sum less the sum at the
parent's start is each token's end.  One Acero hash join of both sides on
(document, end) gives the links, and ``group_by`` counts every id pair of the
block.  Spark adds those partial counts up, marks the best A of every B, and
sends each block the counts of its own pairs only, where they are taken by the
link's pair number and summed by document.

Texts are cut at a space that follows a character other than white space: A's
pattern ends a token there, and no piece of B goes on across it.  So the ids of
a text are those of its words in turn, and a worker encodes only words it has
not met.  A very long text is aligned in runs of words.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, rows_of, store
from .tokens import LINE, Met, ragged

#: characters that are aligned at once; bounds a worker's memory
BLOCK_CHARS = 2 << 20
#: words a worker remembers (about 100 bytes each)
WORDS = 500_000
SPACE = "▁"
_CUT = re.compile(r"(?<=\S) ")
#: words that are encoded on their own: empty, white space at the end, or B's mark of a space
_ALONE = "^$|[\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]$|▁"
#: a space that does not follow a character other than white space
_UNEVEN = "(^|[\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]) "


def byte_level_bytes() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Pair:
    """Both tokenizers, the bytes of their ids, and the words a worker knows."""

    def __init__(self, path_a: str, path_b: str, limit: int = WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.met = Met(2, limit)
        byte = byte_level_bytes()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for word, k in self.a.get_vocab().items():
            self.bytes_a[k] = bytes(map(byte.__getitem__, word)) if all(c in byte for c in word) else b""
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else b"" if self.b.is_control(k) or self.b.is_unknown(k)
                        else p.replace(SPACE, " ").encode() for k, p in ((k, self.b.id_to_piece(k)) for k in range(len(self.b)))]
        if any(b" " in p.lstrip(b" ") for p in self.bytes_b):
            raise ValueError("a piece of B goes on across a space, so texts can't be cut there")
        self.widths = [np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b)]
        self.lengths = [pa.array(n) for n in self.widths]
        # an id's text with what follows it in a group: a comma, or the end of its side
        self.names = [pa.array([f"{k}{mark}" for mark in (",", end) for k in range(len(t))])
                      for t, end in ((self.bytes_a, "|"), (self.bytes_b, ";"))]

    def _same(self, ids_a: list[int], ids_b: list[int], text: str) -> bool:
        raw = f" {text}".encode()
        return (b"".join(map(self.bytes_a.__getitem__, ids_a)) == raw
                and b"".join(map(self.bytes_b.__getitem__, ids_b)) == raw)

    def _encode(self, words: pa.Array):
        """Ids and sizes of every word for A and B; no ids where the bytes of either are others."""
        alone = pc.match_substring_regex(words, _ALONE).to_numpy(zero_copy_only=False)
        texts, sizes = words.to_numpy(zero_copy_only=False), pc.binary_length(words).to_numpy()
        single = np.flatnonzero(alone).tolist()
        order, ids, counts = [], ([], []), ([], [])  # of words as they come, not as they stand
        for own in np.split(lined := np.flatnonzero(~alone), np.arange(LINE, len(lined), LINE)):
            line = " ".join(texts[own])
            pair = self.a.encode_batch_fast([f" {line}"], add_special_tokens=False)[0].ids, self.b.encode(line)
            if not self._same(*pair, line):  # find out which word it is
                single += own.tolist()
                continue
            order.append(own)
            cuts = np.cumsum(1 + sizes[own])
            for side in (0, 1):
                ids[side].append(np.array(pair[side], np.uint32))
                ends = np.cumsum(self.widths[side][ids[side][-1]])
                counts[side].append(np.diff(np.searchsorted(ends, cuts) + 1, prepend=0))
        for k in single:
            found = self._word(texts[k])
            order.append([k])
            for side in (0, 1):
                ids[side].append(np.array(found[side], np.uint32))
                counts[side].append([len(found[side])])
        back = np.argsort(np.concatenate(order))
        out = []
        for side in (0, 1):
            flat, each = np.concatenate(ids[side]), np.concatenate(counts[side]).astype(np.int64)
            out.append((flat[ragged((np.cumsum(each) - each)[back], each[back])], each[back]))
        return out

    def _word(self, word: str) -> tuple[list[int], list[int]]:
        if SPACE in word:
            return [], []
        a = self.a.encode(f" {word}", add_special_tokens=False).ids
        b = self.b.encode(word) if word else [self.b.piece_to_id(SPACE)]  # B adds no space to nothing
        return (a, b) if self._same(a, b, word) else ([], [])

    def lists(self, texts: list[str]) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """List columns of the A and the B ids of all texts, and which texts have tokens."""
        array = pa.array(texts, pa.large_string())
        uneven = pc.match_substring_regex(array, _UNEVEN).to_numpy(zero_copy_only=False)
        even = pc.split_pattern(pc.if_else(pa.array(uneven), "", array), " ")
        words, counts = pc.list_flatten(even), np.diff(even.offsets.to_numpy())
        if uneven.any():
            odd = [_CUT.split(texts[k]) for k in np.flatnonzero(uneven).tolist()]
            keep = np.repeat(~uneven, counts)
            lengths = counts.copy()
            lengths[uneven] = [len(o) for o in odd]
            where = np.zeros(int(lengths.sum()), np.int64)
            fill = np.repeat(uneven, lengths)
            where[~fill] = np.flatnonzero(keep)
            where[fill] = len(words) + np.arange(int(fill.sum()))
            words = pa.concat_arrays([words, pa.array([w for o in odd for w in o], pa.large_string())]).take(pa.array(where))
            counts = lengths
        words = words.dictionary_encode()
        place = self.met.places(words.dictionary, lambda new, _: self._encode(new))
        number = place[words.indices.to_numpy()]
        lost = np.add.reduceat(self.met.sizes[0][number] == 0, np.cumsum(counts) - counts) > 0 if len(number) else counts > 0
        good = ~lost & (np.array([len(t) for t in texts]) > 0)
        number = number[np.repeat(good, counts)]
        out, of_text = [], np.repeat(np.arange(len(texts)), np.where(good, counts, 0))
        for pool in (0, 1):
            ids, sizes = self.met.ids(number, pool)
            each = np.bincount(of_text, sizes, len(texts)).astype(np.int64)
            out.append(pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(each)])), pa.array(ids)))
        return out[0], out[1], good

    def align(self, texts: list[str]) -> tuple[pa.Table, pa.Table]:
        """Of every text: tokens, links and the text of its groups; and (text, pair) of every link."""
        lists = self.lists(texts)[:2]
        sides, ends = [], []
        for ids, lengths in zip(lists, self.lengths, strict=True):
            flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids)
            upto = pc.cumulative_sum(pc.take(lengths, flat))
            sums = np.concatenate([[0], upto.to_numpy()])
            end = pc.subtract(upto, pc.take(pa.array(sums[ids.offsets.to_numpy()]), parent))
            ends.append((flat, parent, end))
            sides.append(pa.table({"text": parent, "end": end, "id": flat, "at": np.arange(len(flat))}))
        links = sides[0].join(sides[1], keys=["text", "end"], join_type="inner", right_suffix="_b", use_threads=False)
        order = np.argsort(links["at"].to_numpy(), kind="stable")
        at_a, at_b = links["at"].to_numpy()[order], links["at_b"].to_numpy()[order]
        pair = links["id"].to_numpy()[order].astype(np.int64) << 32 | links["id_b"].to_numpy()[order]
        of = links["text"].to_numpy()[order]
        n = len(texts)
        return (pa.table({"n_a": pc.list_value_length(lists[0]), "n_b": pc.list_value_length(lists[1]),
                          "n_links": np.bincount(of, minlength=n), "groups": self._groups(ends, at_a, at_b, n)}),
                pa.table({"text": of, "pair": pair}))

    def _groups(self, ends, at_a: np.ndarray, at_b: np.ndarray, n: int) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` of every text: tokens up to each common end, A before B."""
        places, names, of = [], [], []
        sizes = [len(flat) for flat, _, _ in ends]
        closes = [np.isin(np.arange(size), at, assume_unique=True) for size, at in zip(sizes, (at_a, at_b), strict=True)]
        group = [np.cumsum(c) - c for c in closes]
        before_a = np.searchsorted(group[1], np.arange(len(at_a) + 1))  # B tokens of earlier groups
        before_b = np.searchsorted(group[0], np.arange(len(at_b) + 1), side="right")  # A tokens of this group and earlier
        for side, (flat, parent, _) in enumerate(ends):
            shift = (before_a, before_b)[side][group[side]]
            places.append(np.arange(sizes[side]) + shift)
            text = flat.to_numpy().astype(np.int64) + np.where(closes[side], len(self.names[side]) // 2, 0)
            names.append(self.names[side].take(pa.array(text)))
            of.append(parent.to_numpy())
        place = np.concatenate(places)
        back = np.empty(len(place), np.int64)
        back[place] = np.arange(len(place))
        parts = pa.chunked_array(names).combine_chunks().take(pa.array(back))
        each = np.bincount(np.concatenate(of), minlength=n) if len(place) else np.zeros(n, np.int64)
        runs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(each)]), pa.int32()), parts)
        return pc.binary_join(runs, "")


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(path_a: str, path_b: str) -> Pair:
    key = (path_a, path_b)
    if key not in _PAIRS:
        _PAIRS[key] = Pair(path_a, path_b)
    return _PAIRS[key]


def _runs(text: str) -> Iterator[str]:
    """A long text in runs of words whose spaces between them are left out, as between words."""
    at = 0
    while len(text) - at > BLOCK_CHARS:
        cut = _CUT.search(text, at + BLOCK_CHARS)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:]


def _blocks(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[1] or "")
        if chars >= BLOCK_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


_DOC = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                  ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("links", pa.binary()),
                  ("number", pa.int64()), ("pair", pa.int64()), ("count", pa.int64())])


def _aligner(path_a: str, path_b: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        for k, rows in enumerate(_blocks(rows_of(batches))):
            yield from _block(pair_of(path_a, path_b), base + k, rows)
    return align


def _block(both: Pair, block: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of documents with the numbers of their links' pairs, then one row a pair."""
    plain = [k for k, (_, text) in enumerate(rows) if len(text or "") <= BLOCK_CHARS]
    made: dict[int, tuple] = {}
    counts = []
    if plain:
        found, links = both.align([rows[k][1] or "" for k in plain])
        counts.append(links.group_by("pair", use_threads=False).aggregate([("pair", "count")]))
        ends = np.cumsum(found["n_links"].to_numpy())[:-1]
        for k, a, b, n, groups, pairs in zip(plain, found["n_a"].to_pylist(), found["n_b"].to_pylist(),
                                             found["n_links"].to_pylist(), found["groups"].to_pylist(),
                                             np.split(links["pair"].to_numpy(), ends), strict=True):
            made[k] = a, b, n, hashlib.sha256(groups[:-1].encode()).hexdigest() if groups else "", pairs
    for k in range(len(rows)):
        if k not in made:
            made[k], own = _long(both, rows[k][1])
            counts += own
    merged = pa.concat_tables(counts).group_by("pair", use_threads=False).aggregate([("pair_count", "sum")])
    distinct = merged["pair"].combine_chunks()
    width = np.uint16 if len(distinct) <= 1 << 16 else np.uint32
    for at in range(0, len(rows), 1024):
        own = [made[k] for k in range(at, min(at + 1024, len(rows)))]
        flat = pc.index_in(pa.array(np.concatenate([m[4] for m in own])), value_set=distinct).to_numpy().astype(width)
        cuts = np.cumsum([len(m[4]) for m in own])[:-1]
        yield from batches_of(((block, rows[at + j][0], *m[:4], numbers.tobytes(), len(distinct), None, None)
                               for j, (m, numbers) in enumerate(zip(own, np.split(flat, cuts), strict=True))), _DOC, 1024)
    n, none = len(distinct), lambda kind: pa.nulls(len(distinct), kind)
    yield pa.record_batch([pa.array(np.full(n, block)), none(pa.int64()), none(pa.int64()), none(pa.int64()),
                           none(pa.int64()), none(pa.string()), none(pa.binary()), pa.array(np.arange(n)), distinct,
                           merged["pair_count_sum"].combine_chunks()], schema=_DOC)


def _long(both: Pair, text: str) -> tuple[tuple, list[pa.Table]]:
    """The same of one very long text, a run of words at a time."""
    n_a = n_b = n = 0
    digest, pairs, counts = hashlib.sha256(), [], []
    for k, run in enumerate(_runs(text)):
        found, links = both.align([run])
        if not found["n_a"][0].as_py():
            return (0, 0, 0, "", np.zeros(0, np.int64)), []
        n_a, n_b, n = n_a + found["n_a"][0].as_py(), n_b + found["n_b"][0].as_py(), n + len(links)
        digest.update((";" * (k > 0) + found["groups"][0].as_py()[:-1]).encode())
        pairs.append(links["pair"].to_numpy())
        counts.append(links.group_by("pair", use_threads=False).aggregate([("pair", "count")]))
    return (n_a, n_b, n, digest.hexdigest(), np.concatenate(pairs)), counts


_OUT = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                  ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])


def _summer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by block, its pairs in the order of their numbers before its documents."""
    now, held, best = None, [], None
    for batch in batches:
        block = batch["block"].to_numpy()
        is_doc = batch["is_doc"].to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((np.diff(block) != 0) | (np.diff(is_doc.astype(np.int8)) != 0)) + 1
        for part in (batch.slice(a, b - a) for a, b in zip([0, *edges], [*edges, len(block)], strict=True)):
            if not part.num_rows:
                continue
            if part["block"][0].as_py() != now:
                now, held, best = part["block"][0].as_py(), [], None
            if not part["is_doc"][0].as_py():
                held.append((part["count"].to_numpy(), part["best"].to_numpy(zero_copy_only=False)))
                continue
            if best is None:
                count, best = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (np.zeros(0, np.int64),) * 2
                width = np.uint16 if len(count) <= 1 << 16 else np.uint32
                held = []
            data = part["links"].to_pylist()
            numbers = np.frombuffer(b"".join(data), width)
            ends = np.cumsum([0, *map(len, data)]) // np.dtype(width).itemsize
            sums = [np.diff(np.concatenate([[0], np.cumsum(x[numbers], dtype=np.int64)])[ends]) for x in (best, count)]
            yield pa.record_batch([part["doc_id"], part["n_a"], part["n_b"], part["n_links"], part["n_links"],
                                   pa.array(sums[0]), pa.array(sums[1]), part["groups_sha256"]], schema=_OUT)


def align(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    Texts that are null or empty, or whose tokens' bytes are others than space
    + text (the mark ``▁`` in them, for one), have no tokens: zeros and an empty
    digest.  Repeated rows are aligned each, and count each; null ids stay null.
    An empty table gives an empty result.  ``groups_sha256`` is of
    ``a1,a2|b1;a3|b2,b3``.
    """
    made = store(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _aligner(path_a, path_b), "block long, doc_id long, n_a long, n_b long, n_links long, groups_sha256 string, "
        "links binary, number long, pair long, count long"), "aligned")
    pairs = made.where("pair is not null").select("block", "number", "pair", F.col("count").alias("n"),
                                                  F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"))
    counts = store(pairs.groupBy("pair", "b").agg(F.sum("n").alias("count")), "pair-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    judged = counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    nothing = {"doc_id": "long", "n_a": "long", "n_b": "long", "n_links": "long", "groups_sha256": "string", "links": "binary"}
    own = pairs.join(judged, "pair").select("block", F.lit(False).alias("is_doc"), "number", "count", "best",
                                            *(F.lit(None).cast(t).alias(c) for c, t in nothing.items()))
    texts = made.where("pair is null").select("block", F.lit(True).alias("is_doc"), F.lit(0).cast("long").alias("number"),
                                              F.lit(0).cast("long").alias("count"), F.lit(False).alias("best"), *nothing)
    return (own.unionByName(texts).repartition("block").sortWithinPartitions("block", "is_doc", "number")
            .mapInArrow(_summer, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                 "count_sum long, groups_sha256 string"))
