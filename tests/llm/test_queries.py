"""Registered corpus queries that SQL cannot express, on whole small tables."""

import string
from bisect import bisect_left
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as E
import corpus_pipeline
from tallybook.llm.common import read

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: E.queries()[name](spark, SMALL).collect()


@pytest.fixture(scope="module")
def docs(spark):
    return read(spark, SMALL, "documents").collect()


def units(text):
    """Five-word shingles with their occurrence number, and the place of each."""
    words = [w.lower().strip(string.punctuation) or w for w in (text or "").split()]
    size, seen, out = min(5, len(words)), Counter(), {}
    for i in range(len(words) - size + 1 if words else 0):
        s = tuple(words[i:i + size])
        out[s, seen[s]] = i
        seen[s] += 1
    return tuple(words), out


def similar(a, b):
    line, ends = [b[u] for u in a if u in b], []
    for x in line:
        k = bisect_left(ends, x)
        ends[k:k + 1] = [x]
    return len(ends) >= 0.8 * (len(a) + len(b) - len(ends)) - 1e-9


def test_near_duplicates_equal_all_pairs(run, docs):
    made = [(d.doc_id, *units(d.text)) for d in docs]
    root = {d.doc_id: d.doc_id for d in docs}
    for k, (i, wi, a) in enumerate(made):
        for j, wj, b in made[:k]:
            if root[i] != root[j] and (wi == wj or a and b and len(a.keys() & b.keys()) * 2 > len(a) and similar(a, b)):
                low, high = sorted((root[i], root[j]))
                root = {d: low if r == high else r for d, r in root.items()}
    rows = run("op9_order_minhash")
    assert {r.doc_id: r.group_id for r in rows} == root
    assert all(r.kept == (r.doc_id == r.group_id) for r in rows)


def test_every_row_has_its_result(run, docs, spark):
    ids = Counter(d.doc_id for d in docs)
    for name in ("op3_surrogates", "op6_language_id", "op10_resampling"):
        assert Counter(r.doc_id for r in run(name)) == ids, name
    pages = read(spark, SMALL, "pages").collect()
    assert Counter(r.page_id for r in run("op7_main_text")) == Counter(p.page_id for p in pages)
    assert {r.doc_id for r in run("op1_temperature_mixing")} <= set(ids)


def test_languages_of_held_out_documents(run, docs):
    lang = {d.doc_id: d.lang for d in docs}
    held = [r for r in run("op6_language_id") if r.held_out and r.lang_pred != "und" and lang[r.doc_id]]
    assert held and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.9 * len(held)


def test_pieces_cover_every_document_once(run, docs):
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in run("op8_packing"):
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens))
        windows[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == {d.doc_id for d in docs}
    for parts in (*pieces.values(), *windows.values()):
        end = 0
        for start, length, *_ in sorted(parts):
            assert start == end
            end += length
        assert end == parts[0][2] if len(parts[0]) == 3 else end <= 4096


def test_pipeline_stages_keep_rows_and_columns_of_their_input(spark):
    docs = read(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        assert out.exceptAll(docs).select("doc_id").join(docs, "doc_id", "left_anti").count() == 0
        assert out.count() > 0
    assert corpus_pipeline.run(spark, SMALL).count() > 0
