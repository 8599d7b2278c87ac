"""Files of id planes: exact round trips on odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import planes as B
from tallybook.llm.queries import ship, tokenizer_path


@pytest.mark.parametrize("bits", [1, 8])
@pytest.mark.parametrize("count", [0, 1, 7, 9, 1000])
def test_transposing_is_one_to_one(bits, count):
    ids = np.random.default_rng(count).integers(0, 1 << 32, count, dtype=np.uint32)
    assert (B.from_planes(B.to_planes(ids, bits), count, bits) == ids).all()


@pytest.mark.parametrize("bits", [1, 8])
def test_a_file_gives_back_documents_and_ranges(bits, monkeypatch):
    monkeypatch.setattr(B, "CHUNK_IDS", 100)
    rng = np.random.default_rng(3)
    docs = [(k if k % 7 else None, rng.integers(0, 50000, n, dtype=np.uint32))
            for k, n in enumerate([1, 0, 99, 100, 101, 350, 3, 1])]
    out = B.Writer(4, 2, bits)
    for d, ids in docs:
        out.add(d, ids)
    data = out.finish() + b"\n"
    file = B.Reader(data)
    assert (file.part, file.number, file.total) == (4, 2, 655) and len(file.chunks) == 7
    got = [(d, at, n, np.concatenate([np.zeros(0, np.uint32), *runs])) for d, at, n, runs in file.texts()]
    flat, at = np.concatenate([ids for _, ids in docs]), 0
    for (d, ids), (e, place, n, back) in zip(docs, got, strict=True):
        assert (d, at, len(ids)) == (e, place, n) and (ids == back).all()
        at += len(ids)
    for first, end in ((0, 655), (0, 0), (99, 101), (100, 200), (640, 655), (5, 5)):
        assert (file.ids_between(first, end) == flat[first:end]).all()
    for broken in (data[:-1], data[:50], b"x" + data[1:], b"\n"):
        with pytest.raises(Exception):  # noqa: B017 -- each is refused, whatever notices it first
            list(B.Reader(broken).texts())


@pytest.mark.parametrize("bits", [1, 8])
def test_nulls_repeats_long_texts_and_clashing_names(spark, bits):
    from tokenizers import Tokenizer

    ship(spark)
    whole = Tokenizer.from_file(tokenizer_path())
    rows = [(5, "b c", "x"), (None, "none", "x"), (5, "b c", "x"), (1, None, "x"), (9, "", "x"), (-3, "long word " * 9000, "x"),
            *((7, f"hot {k}", "x") for k in range(40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(5)
    docs = docs.withColumns({"part": F.lit(1), "at": F.lit("a"), "start": F.lit(0), "value": F.lit("v")})
    path = B.write_ids(docs, tokenizer_path(), bits=bits, file_ids=50)
    got = sorted(B.read_ids(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    want = sorted((d is not None, d or 0, tuple(whole.encode(t or "", add_special_tokens=False).ids) + (2,)) for d, t, _ in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == [w[:2] for w in want]
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids) // 4, zlib.crc32(r.ids))
        at += r.n_tokens
    none = B.read_ids(spark, B.write_ids(docs.where("false"), tokenizer_path()))
    assert none.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and none.count() == 0
    with pytest.raises(ValueError, match="1 or 8"):
        B.write_ids(docs, tokenizer_path(), bits=4)
