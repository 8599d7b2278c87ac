"""Token ids of whole texts, encoded by the distinct words of a group of texts.

The tokenizer drops white space and splits there, so the ids of a text are those
of its white-space separated words in turn.  Arrow splits the texts of a group
and numbers their distinct words; a word of Latin letters with closing ASCII
punctuation is split once more and put in lower case, as the tokenizer's own
pattern and normaliser do.  Only parts that the worker has not met are encoded,
many to a line; their ids are told apart by the ids that end a word.  Anything
else is encoded on its own by the unchanged tokenizer.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: characters of text that are split at once; bounds a worker's memory
GROUP_CHARS = 8 << 20
#: parts a worker remembers (about 50 bytes each) before it forgets the unused ones
PARTS = 1_000_000
#: parts encoded in one line
LINE = 512
#: letters that every stage of the tokenizer keeps together, and punctuation it takes as one run
_WORD = "^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]*)(?P<marks>[!-/:-@\\[-`{-~]*)$"


class Met:
    """Texts a worker has met, in one Arrow array, with ids of each in one or more pools.

    When ``limit`` is passed, what was not used since the last time is forgotten.
    """

    def __init__(self, pools: int, limit: int):
        self.limit = limit
        self.texts, self.used = pa.array([], pa.large_string()), np.zeros(0, bool)
        self.pools = [np.zeros(0, np.uint32) for _ in range(pools)]
        self.sizes = [np.zeros(0, np.int64) for _ in range(pools)]

    def places(self, texts: pa.Array, encode) -> np.ndarray:
        """Number of each of the distinct ``texts``.

        ``encode`` gets those not met, with a mask over all, and returns ids and sizes for every pool.
        """
        if len(self.texts) > self.limit:
            kept = self.used if self.used.sum() <= self.limit // 2 else np.zeros(len(self.used), bool)
            self.pools = [p[np.repeat(kept, n)] for p, n in zip(self.pools, self.sizes, strict=True)]
            self.sizes = [n[kept] for n in self.sizes]
            self.texts, self.used = self.texts.filter(pa.array(kept)), np.zeros(int(kept.sum()), bool)
        place = pc.fill_null(pc.index_in(texts, value_set=self.texts), -1).to_numpy().astype(np.int64)
        lacking = place < 0
        if lacking.any():
            place[lacking] = len(self.texts) + np.arange(int(lacking.sum()))
            new = texts.filter(pa.array(lacking))
            for k, (ids, sizes) in enumerate(encode(new, lacking)):
                self.pools[k] = np.concatenate([self.pools[k], ids])
                self.sizes[k] = np.concatenate([self.sizes[k], sizes])
            self.texts = pa.concat_arrays([self.texts, new])
            self.used = np.concatenate([self.used, np.ones(len(new), bool)])
        self.used[place] = True
        return place

    def ids(self, place: np.ndarray, pool: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts one after the other, and how many each has."""
        sizes = self.sizes[pool]
        own = sizes[place]
        return self.pools[pool][ragged((np.cumsum(sizes) - sizes)[place], own)], own


class Parts:
    """The tokenizer, and the parts whose ids a worker knows."""

    def __init__(self, path: str, limit: int = PARTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)  # the same model, for parts that need no normalising or pattern
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.whole.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for word, i in vocab.items() if word.endswith("</w>")]] = True
        self.met = Met(1, limit)

    def places(self, plain: pa.Array, odd: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of parts in lower case without white space, and of any other texts; all are distinct."""
        at = len(plain)

        def encode(new: pa.Array, lacking: np.ndarray):
            cut, texts = int(lacking[:at].sum()), _strings(new)
            (a, m), (b, n) = self._lines(texts[:cut]), self._alone(texts[cut:])
            return [(np.concatenate([a, b]), np.concatenate([m, n]))]
        place = self.met.places(pa.concat_arrays([plain, odd]), encode)
        return place[:at], place[at:]

    def _lines(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.zeros(0, np.uint32)]
        for at in range(0, len(parts), LINE):
            line = self.plain.encode_batch_fast([" ".join(parts[at:at + LINE])], add_special_tokens=False)[0]
            found.append(np.array(line.ids, np.uint32))
        ids = np.concatenate(found)
        ends = np.flatnonzero(self.ends[ids]) + 1
        empty = np.array([not part for part in parts], bool)
        sizes = np.zeros(len(parts), np.int64)
        if len(ends) != len(parts) - empty.sum() or ends[-1:].sum() != len(ids):
            raise ValueError("a part is not one word to the tokenizer")
        sizes[~empty] = np.diff(ends, prepend=0)
        return ids, sizes

    def _alone(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        return (np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64))


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, .. start + size - 1 of every pair, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Whole texts to token ids."""

    def __init__(self, path: str, limit: int = PARTS):
        self.parts = Parts(path, limit)

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text; no null among them."""
        return [ids.tobytes() for ids in self.arrays(texts)]

    def arrays(self, texts: list[str]) -> list[np.ndarray]:
        """Unsigned 32-bit ids of every text, as views of one array a group."""
        out: list[np.ndarray] = []
        held, chars = [], 0
        for text in texts:
            if len(text) > GROUP_CHARS:
                out += self._group(held)
                out.append(np.concatenate([a for part in _cut(text) for a in self._group([part])]))
                held, chars = [], 0
                continue
            held.append(text)
            chars += len(text)
            if chars >= GROUP_CHARS:
                out += self._group(held)
                held, chars = [], 0
        return out + self._group(held)

    def _group(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        words = pc.list_flatten(split).dictionary_encode()
        ids, sizes = self._words(words.dictionary)
        number = words.indices.to_numpy()
        each = sizes[number]
        flat = ids[ragged((np.cumsum(sizes) - sizes)[number], each)]
        ends = np.concatenate([[0], np.cumsum(each)])[split.offsets.to_numpy()[1:] - split.offsets[0].as_py()]
        return np.split(flat, ends[:-1])

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the distinct words one after the other, and how many each has."""
        found = pc.extract_regex(words, _WORD)
        odd = pc.fill_null(pc.is_null(found), True).to_numpy(zero_copy_only=False)
        plain = pa.chunked_array([pc.fill_null(pc.utf8_lower(pc.struct_field(found, 0)), ""),
                                  pc.fill_null(pc.struct_field(found, 1), "")]).combine_chunks().dictionary_encode()
        place, alone = self.parts.places(plain.dictionary, words.filter(pa.array(odd)))
        halves = np.split(place[plain.indices.to_numpy()], 2)
        halves[0][odd] = alone
        ids, sizes = self.parts.met.ids(np.column_stack(halves).ravel())  # the empty part has no ids
        return ids, sizes[0::2] + sizes[1::2]


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


def _cut(text: str):
    """A very long text in runs of about a group's size that end at a space."""
    at = 0
    while at < len(text):
        end = text.find(" ", at + GROUP_CHARS)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
