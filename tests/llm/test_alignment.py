"""Alignment of two tokenizers against both plain tokenizers, byte by byte."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
from tallybook.llm import alignment as A
from tallybook.llm.common import read
from tallybook.llm.queries import ship, tokenizer_path

SMALL = "/root/testdata/sf0.001"
PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = ["a b", " a", "  a b", "a  b c ", "a\n b", "a \nb", "word\n\n  x", "\u2581 x", "x \u2581", "<s> </s> <unk> <0x41> <|endoftext|> z",
       "\x00 \x01", "e\u0301 \ufb01 \u00bd ", "\ud55c\uad6d \u4e2d\u6587 \U0001f600 \U0001f600x", " ", " \n", "\n", "a\xa0 b \xa0c \u3000 d",
       "don't 's it's", "1234 56 7890", "x" * 500, "tab\t tab \t\t y", "\r\n a\r\n\x1c b \x1c", "", "a   ", "   x \ufeffy", "\x85 x\x85 y"]


@pytest.fixture(scope="module")
def plain():
    """(n_a, n_b, groups, links) of a text by both tokenizers as they are."""
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    # of the vocabulary's 256 signs for bytes, in the order of their bytes after the printable ones
    signs = sorted(w for w in a.get_vocab() if len(w) == 1)
    byte = {w: ord(w) for w in signs if ord(w) < 256}
    byte |= dict(zip((w for w in signs if ord(w) >= 256), sorted(set(range(256)) - set(byte.values())), strict=True))
    word = {i: bytes(byte[c] for c in w) for w, i in a.get_vocab().items() if all(c in byte for c in w)}
    assert len(byte) == 256

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("\u2581", " ").encode()

    def of(text):
        nothing = 0, 0, "", []
        if not text:
            return nothing
        sides = [(i, word[i]) for i in a.encode(" " + text, add_special_tokens=False).ids], [(i, piece(i)) for i in b.encode(text)]
        if any(b"".join(x for _, x in side) != (" " + text).encode() for side in sides):
            return nothing
        ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in sides]
        groups, links, at = [], [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            own = []
            for k in (0, 1):
                upto = ends[k].index(end) + 1
                own.append([i for i, _ in sides[k][at[k]:upto]])
                at[k] = upto
            groups.append("|".join(",".join(map(str, o)) for o in own))
            links.append((own[0][-1], own[1][-1]))
        return len(sides[0]), len(sides[1]), ";".join(groups), links
    return of


def check(rows, made):
    """Rows against the plain results of every (doc_id, text), repeated rows included."""
    count = Counter(link for _, *_, links in made for link in links)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    want = Counter((d, n_a, n_b, len(links), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(groups.encode()).hexdigest() if links else "") for d, n_a, n_b, groups, links in made)
    assert Counter(tuple(r) for r in rows) == want


def test_links_and_groups_equal_the_plain_tokenizers(plain):
    rng = random.Random(1)
    letters = "ab cX\u00e9 '\"!9\n\t \u4e2d\U0001f600\xa0  .,st\u2581"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(1500)]
    pair = A.Pair(*PATHS, limit=300)  # it forgets words in between
    for at in range(0, len(texts), 100):
        own = texts[at:at + 100]
        found, links = pair.align(own)
        of, pairs = links["text"].to_numpy(), links["pair"].to_numpy()
        for k, text in enumerate(own):
            n_a, n_b, groups, want = plain(text)
            assert (found["n_a"][k].as_py(), found["n_b"][k].as_py(), found["groups"][k].as_py()[:-1]) == (n_a, n_b, groups)
            assert [(p >> 32, p & 0xFFFFFFFF) for p in pairs[of == k].tolist()] == want


def test_every_document(spark, plain):
    docs = read(spark, SMALL, "documents").collect()
    rows = E.queries()["op13_token_alignment"](spark, SMALL).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    check(rows, [(d.doc_id, *plain(d.text)) for d in docs])


def test_nulls_repeats_long_texts_and_clashing_names(spark, plain, monkeypatch):
    ship(spark)
    made = [*enumerate(ODD), (1, "a b"), (1, "a b"), (None, None), (None, "x y"), (70, "word and words\n" * 3000), (71, "y" * 30000)]
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(3).withColumns(
        {c: F.lit("x") for c in ("block", "pair", "links", "count", "number", "is_doc")})
    check(A.align(docs, *PATHS).collect(), [(d, *plain(t)) for d, t in made])
    assert A.align(docs.where("false"), *PATHS).count() == 0


def test_a_long_text_is_aligned_in_runs(plain, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_CHARS", 64)
    pair = A.Pair(*PATHS)
    rows = [(1, "some words in  a row\n and more of them " * 9), (2, "short"), (3, "with the mark \u2581 " * 9), (4, None)]
    batches = list(A._block(pair, 0, rows))
    docs = [r for b in batches for r in b.to_pylist() if r["pair"] is None]
    counts = {r["number"]: r["pair"] for b in batches for r in b.to_pylist() if r["pair"] is not None}
    for (d, text), r in zip(rows, sorted(docs, key=lambda r: r["doc_id"]), strict=True):
        n_a, n_b, groups, links = plain(text)
        assert (r["n_a"], r["n_b"], r["n_links"]) == (n_a, n_b, len(links)), d
        assert r["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if links else "")
        assert [(counts[k] >> 32, counts[k] & 0xFFFFFFFF) for k in np.frombuffer(r["links"], np.uint16).tolist()] == links
