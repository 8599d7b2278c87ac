"""Corpus operators on small tables: nulls, empty and repeated rows, clashing columns, empty tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallybook.llm import cover_tree, exact_dedup, langid, main_text, mixing, order_minhash, packing, resampling, surrogates, warc
from tallybook.llm.queries import ship, tokenizer_path

LONG = " ".join(f"word{i}" for i in range(6000))
ROWS = [(1, "one two three four five six seven", "en", "a"), (2, "one two three four five six seven", "en", "a"),
        (3, None, None, None), (4, "", "en", "a"), (5, LONG, "en", "b"), (6, LONG, "en", "b"), (7, LONG + " more", "en", "b"),
        (None, "no id here at all, is there", "en", "a"), (8, "x" * 9000, "en", "c"), (8, "x" * 9000, "en", "c"),
        (9, "x" * 8999 + "y", "en", "c")]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    # clashing names among the columns that an operator does not read
    return df.withColumns({"row": F.lit("r"), "name": F.lit("n"), "kept": F.lit("k"), "tokens": F.lit("t"), "epoch": F.lit("e")})


def test_exact_groups(docs):
    rows = exact_dedup.exact_groups(docs, block_bytes=64).collect()
    groups = defaultdict(list)
    for i, t, *_ in ROWS:
        groups[t or ""].append(i)
    assert len(rows) == len(ROWS) and sum(r.kept for r in rows) == len(groups)
    want = Counter((i, hashlib.sha256((t or "").encode()).hexdigest(), len(groups[t or ""])) for i, t, *_ in ROWS)
    assert Counter((r.doc_id, r.text_sha256, r.group_size) for r in rows) == want
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.exact_groups(docs.where("false")).count() == 0


def test_near_duplicates(docs):
    rows = order_minhash.near_duplicates(docs).collect()
    groups = Counter((r.doc_id, r.group_id, r.group_size) for r in rows)
    assert groups == Counter({(1, 1, 2): 1, (2, 1, 2): 1, (3, 3, 2): 1, (4, 3, 2): 1, (5, 5, 3): 1, (6, 5, 3): 1,
                              (7, 5, 3): 1, (None, None, 1): 1, (8, 8, 2): 2, (9, 9, 1): 1})
    assert sum(r.kept for r in rows) == 6
    assert order_minhash.near_duplicates(docs.where("false")).count() == 0


def test_packing_is_an_exact_round_trip(docs):
    rows = packing.pack(docs, tokenizer_path(), with_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(tokenizer_path())
    for i, t, *_ in ROWS:
        want = len(whole.encode(t or "", add_special_tokens=False).ids) + 1
        assert sum(r.length for r in by_doc[i]) == want * (2 if i == 8 else 1)
    for spans in by_sequence.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= packing.SEQUENCE
    assert packing.pack(docs.where("false"), tokenizer_path()).count() == 0


def test_mixing_meets_its_budgets(spark, docs):
    made = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c d e").alias("text"), F.when(
        F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid").otherwise("low").alias("source"))
    got = {r.source: r.n for r in mixing.draws(made, entropy=1.0, repeats=2.0).groupBy("source").agg(
        F.sum("tokens").alias("n")).collect()}
    assert got["low"] <= 2.0 * 2000 * 1.03 and sum(got.values()) == pytest.approx(20000, rel=0.03)
    same = {r.source: r.n for r in mixing.draws(made, entropy=0.0, repeats=9.0, budget_ratio=1.0).groupBy("source").agg(
        F.sum("tokens").alias("n")).collect()}
    assert same == pytest.approx({"big": 14000, "mid": 4000, "low": 2000}, rel=0.03)  # exponent 1: as they are
    assert mixing.mix_sources(docs).columns == docs.columns
    assert mixing.mix_sources(docs.where("false")).count() == 0


def test_vectors(spark):
    ship(spark)
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (4, [0.0, 1.0]), (5, None), (6, [0.0, 0.0]),
            (7, [float("nan"), 1.0]), (8, [1.0, None]), (9, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover_tree.near_vectors(df).collect()}
    linked = {i: (3, 1, i == 1) for i in (1, 2, 3, 9)}
    assert got == linked | {i: (0, i, True) for i in (4, 5, 6, 7, 8, 10, 11)}
    assert cover_tree.near_vectors(df.where("false")).count() == 0


def test_vectors_of_many_lengths_and_chunks(spark, monkeypatch):
    import numpy as np

    ship(spark)
    monkeypatch.setattr(cover_tree, "CHUNK", 64)
    rng, rows = np.random.default_rng(3), []
    for width in (3, 8, 8, 8, 16):
        centres = rng.normal(size=(6, width))
        rows += [(len(rows) + k, (centres[k % 6] + 0.15 * rng.normal(size=width)).tolist()) for k in range(300)]
    rows += [(len(rows) + k, [float(k + 1)] * (40 + k % 30)) for k in range(60)]
    want = {}
    for width in {len(v) for _, v in rows}:
        own = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows if len(v) == width]
        units = np.array([u for _, u in own])
        want |= dict(zip([i for i, _ in own], ((units @ units.T >= 0.9).sum(axis=1) - 1).tolist(), strict=True))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {r.vec_id: r.n_links for r in cover_tree.near_vectors(df).collect()} == want and sum(want.values()) > 50000


def test_archive_round_trip(spark):
    ship(spark)
    rows = [(3, "http://a/\r\nx", "<p>é</p>\r\n\r\nWARC/1.1\r\n"), (1, None, "<p>é</p>\r\n\r\nWARC/1.1\r\n"), (2, "u", None),
            (4, "u", ""), (None, "u", "alone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    records, payloads = warc.build_archive(pages)
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_warc(
        spark, warc.write_warc(records, payloads)).collect()}
    n = len("<p>é</p>\r\n\r\nWARC/1.1\r\n".encode())
    assert got == {1: (n, "response", None), 3: (n, "revisit", 1), 2: (0, "response", None), 4: (0, "revisit", 2),
                   None: (5, "response", None)}
    assert payloads.count() == 3
    back = Counter((r.page_id, r.payload) for r in warc.reconstruct(records, payloads).collect())
    assert back == Counter((i, h or "") for i, _, h in rows)


def test_files_of_an_archive_are_bounded_by_bytes(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(warc, "LARGE", 1000)
    monkeypatch.setattr(warc, "LARGE_RECORDS", 2)
    monkeypatch.setattr(warc, "FILE_RECORDS", 10)
    pages = spark.createDataFrame([(k, "u", f"{k} é " * (500 if k % 4 else 1)) for k in range(40)] + [(99, "u", "1 é " * 500), (100, None, None)],
                                  "page_id long, url string, html string").coalesce(1)
    path = warc.write_warc(*warc.build_archive(pages))
    import gzip
    sizes = {"records": [], "large": []}
    for folder, found in sizes.items():
        for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(f"{path}/{folder}").collect():
            found.append(sum(1 for _ in warc.parse_warc(gzip.GzipFile(fileobj=__import__("io").BytesIO(bytes(r.content))))))
    assert max(sizes["large"]) == 2 and sum(sizes["large"]) == 30 and max(sizes["records"]) <= 10 and sum(sizes["records"]) == 12
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_warc(spark, path).collect()}
    assert len(got) == 42 and got[99] == ("revisit", 1) and got[100] == ("response", None) and warc.read_warc(
        spark, warc.write_warc(*warc.build_archive(pages.where("false")))).count() == 0


def test_a_revisit_needs_its_response(spark):
    ship(spark)
    pages = spark.createDataFrame([(1, "u", "one"), (2, "u", "one"), (3, "u", "two")], "page_id long, url string, html string")
    records, payloads = warc.build_archive(pages)
    urn = {r.page_id: f"<urn:x-page:{r.page_id}:{r.row}>" for r in records.collect()}
    for other in (urn[3], "<urn:x-page:9:9>"):  # another payload's response, none
        changed = F.regexp_replace("warc_header", f"(?<=Refers-To: ){urn[1]}", other)
        with pytest.raises(ValueError, match="does not match the response"):
            warc.read_warc(spark, warc.write_warc(records.withColumn("warc_header", changed), payloads))


def test_selection_and_empty_tables(spark, docs):
    df = spark.createDataFrame([(float(x),) for x in (5, 1, 3, 3, 9, -2)], "v double")
    assert [resampling.kth_largest(df, "v", k) for k in (1, 2, 3, 4, 5)] == [9, 5, 3, 3, 1]
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert resampling.drop_low_quality(docs, labels).count() == len(ROWS)  # one class only: nothing is rejected
    none = docs.where("false")
    assert resampling.drop_low_quality(none, labels).count() == 0
    assert langid.identify(none, langid.train(none)).count() == 0
    assert surrogates.anonymise(docs).where("n_entities > 0").count() == 0
    pages = spark.createDataFrame([(1, None, None), (None, "u", "<p>t</p>")], "page_id long, url string, html string")
    assert {(r.page_id, r.text, r.n_chars) for r in main_text.main_text(pages).collect()} == {(1, "", 0), (None, "t", 1)}


def test_empty_tables_repeated_rows_and_extra_columns(spark, docs):
    ship(spark)
    none = docs.where("false")
    assert surrogates.anonymise(none).count() == 0 and mixing.draws(none).count() == 0
    pages = spark.createDataFrame([(1, "u", "<p>one</p>"), (1, "u", "<p>one</p>"), (2, "u", "<p>two</p>")],
                                  "page_id long, url string, html string")
    assert main_text.main_text(pages.where("false")).count() == 0
    odd = pages.withColumns({c: F.lit("x") for c in ("row", "digest", "text", "n_chars", "value", "payload")})
    assert Counter((r.page_id, r.text) for r in main_text.main_text(odd).collect()) == Counter({(1, "one"): 2, (2, "two"): 1})
    got = Counter((r.page_id, r.record_type, r.refers_to) for r in warc.read_warc(
        spark, warc.write_warc(*warc.build_archive(odd))).collect())
    assert got == Counter({(1, "response", None): 1, (1, "revisit", 1): 1, (2, "response", None): 1})
    twice = spark.createDataFrame([(1, "Mary Smith"), (1, "Mary Smith")], "doc_id long, text string").withColumn("entities", F.lit(1))
    a, b = surrogates.anonymise(twice).collect()
    assert a == b and a.n_entities == 1
