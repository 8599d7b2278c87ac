"""Queries and pipeline stages without SQL against brute-force versions, on whole small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from tallybook.llm import mixing as M
from tallybook.llm import resampling as R
from tallybook.llm import surrogates as S
from tallybook.llm.common import read, store
from tallybook.llm.queries import tokenizer_path

from test_queries import SMALL, similar, units


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after every stage, each run on its predecessor's output; the last stage's are run()'s."""
    docs, out = read(spark, SMALL, "documents"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = store(stage(spark, docs, SMALL), "brute")
        out[name], docs = (docs.collect(), made.collect()), made
    out["sequences"] = out["mix"][1], corpus_pipeline.run(spark, SMALL).collect()
    return out


def ids(rows):
    return Counter(r.doc_id for r in rows)


def noise(spark, rows):
    """The fixed Gumbel noise of every row."""
    frame = spark.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id long, text string")
    bits = [r[0] for r in frame.select(F.xxhash64(F.lit(R.SEED), "doc_id", "text")).collect()]
    return [-math.log(-math.log((((b & (1 << 64) - 1) >> 11) + 0.5) / 2.0 ** 53)) for b in bits]


def resampled(spark, rows):
    """Log weight and whether it is kept, of every row in order."""
    labels = defaultdict(list)
    for r in read(spark, SMALL, "labels").collect():
        if r.doc_id is not None and r.quality in (0, 1):
            labels[r.doc_id].append(r.quality)
    assert len(labels) < R.LABELLED  # the sample is every label
    quality = [min(labels[r.doc_id]) if r.doc_id in labels else None for r in rows]
    found = [R.features(r.text) for r in rows]
    spans = ((0, R.WORDS), (R.WORDS, R.WORDS + R.PAIRS), (R.WORDS + R.PAIRS, R.BUCKETS))
    scores = np.zeros(len(rows))
    for kind, (lo, hi) in enumerate(spans):
        raw, target = Counter(), Counter()
        for f, q in zip(found, quality, strict=True):
            raw.update(f[kind].tolist())
            if q == 1:
                target.update(f[kind].tolist())
        all_raw, all_target = sum(raw.values()) + 0.5 * (hi - lo), sum(target.values())
        for k, f in enumerate(found):
            logs = []
            for b in f[kind].tolist():
                p = (raw[b] + 0.5) / all_raw
                logs.append(math.log((target[b] + R.PRIOR * p) / (all_target + R.PRIOR)) - math.log(p))
            scores[k] += sum(logs) / len(logs) if logs else 0.0
    judged = [(s, q) for s, q in zip(scores, quality, strict=True) if q is not None]
    lo, hi = min(s for s, _ in judged), max(s for s, _ in judged)
    step = (hi - lo) / 4096
    bins = [(math.floor((s - lo) / step), q) for s, q in judged]
    errors = [sum(b >= j if q == 0 else b < j for b, q in bins) for j in range(4099)]
    best = [j for j, e in enumerate(errors) if e == min(errors)]
    k = int((scores >= lo + step * (best[0] + best[-1]) / 2).sum())
    weights = scores * R.EVIDENCE
    keys = weights + np.array(noise(spark, rows))
    kept = keys >= (np.sort(keys)[::-1][k - 1] if k else math.inf)
    return weights, kept


def mixture(rows):
    """How often each document is drawn, and the draws of every source."""
    tokens, blocks, sources = Counter(), defaultdict(list), Counter()
    for r in rows:
        n = len(re.findall("[^ \t\n\r\f]+", r.text or ""))
        name = "null" if r.source is None else f"s{r.source}"
        block = str(r.doc_id // M.BLOCK_IDS)
        tokens[name, block] += n
        blocks[name, block].append(r.doc_id)
        sources[name] += n
    sources = {s: n for s, n in sources.items() if n}
    total = sum(sources.values())
    shares = [n / total for n in sources.values()]

    def flat(a):
        z = sum(s ** a for s in shares)
        return -sum(s ** a / z * math.log(s ** a / z) for s in shares) >= M.ENTROPY * math.log(len(shares))

    def often(a):
        return min(shares) ** (a - 1) / sum(s ** a for s in shares) > M.REPEATS

    def largest(holds):
        lo, hi = 0.0, 1.0
        if holds(hi):
            return hi
        for _ in range(M.HALVINGS):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if holds(mid) else (lo, mid)
        return lo

    exponent = max(largest(flat), largest(often))
    z, drawn = sum(s ** exponent for s in shares), Counter()
    for name, have in sources.items():
        full, rest = divmod(math.floor((have / total) ** exponent / z * total + 0.5), have)
        own = [b for s, b in blocks if s == name]
        for b in own:
            drawn.update({i: full * c for i, c in Counter(blocks[name, b]).items()})
        place = {b: hashlib.sha256(f"{M.SEED}|{name}|{full}|{b}".encode()).hexdigest() + b for b in own}
        sofar = 0
        for b in sorted(own, key=place.get):
            if rest and sofar + tokens[name, b] / 2 <= rest:
                drawn.update(blocks[name, b])
            sofar += tokens[name, b]
    return +drawn


def nearest(rows):
    """The smallest id of every document's group, by comparing all pairs."""
    made = [(r.doc_id, *units(r.text)) for r in rows]
    root = {r.doc_id: r.doc_id for r in rows}
    for k, (i, wi, a) in enumerate(made):
        for j, wj, b in made[:k]:
            if root[i] != root[j] and (wi == wj or a and b and similar(a, b)):
                low, high = sorted((root[i], root[j]))
                root = {d: low if r == high else r for d, r in root.items()}
    return root


def test_quality_stage_and_query_keep_what_brute_force_keeps(spark, stages):
    before, after = stages["quality"]
    weights, kept = resampled(spark, before)
    assert 0 < kept.sum() < len(before)
    assert ids(after) == ids(r for r, k in zip(before, kept, strict=True) if k)
    rows = {r.doc_id: r for r in E.queries()["op10_resampling"](spark, SMALL).collect()}
    for r, w, k in zip(before, weights, kept, strict=True):
        assert rows[r.doc_id].kept == k and rows[r.doc_id].log_weight == pytest.approx(w, abs=1e-6)


def test_exact_stage_keeps_one_of_each_text(stages):
    before, after = stages["exact"]
    assert not ids(after) - ids(before)
    text = {r.doc_id: r.text for r in before}
    assert all(r.text == text[r.doc_id] for r in after)
    assert Counter(r.text or "" for r in after) == Counter({r.text or "" for r in before})
    assert len(after) < len(before)


def test_near_stage_keeps_one_of_each_group_of_all_pairs(stages):
    before, after = stages["near"]
    assert ids(after) == Counter(set(nearest(before).values()))


def test_mix_stage_and_query_draw_what_brute_force_draws(spark, stages):
    before, after = stages["mix"]
    assert ids(after) == mixture(before)
    docs = read(spark, SMALL, "documents").collect()
    rows = E.queries()["op1_temperature_mixing"](spark, SMALL).collect()
    assert ids(rows) == mixture(docs)


def test_sequences_hold_every_piece_of_every_draw(stages):
    before, after = stages["sequences"]
    want = ids(before)
    places, windows = Counter(), defaultdict(list)
    for r in after:
        places[r.doc_id] += r.length
        windows[r.sequence_id].append((r.offset, r.length))
    length = {r.doc_id: r.doc_tokens for r in after}
    assert set(places) == set(want)
    assert all(places[d] == n * length[d] for d, n in want.items())
    for parts in windows.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= 4096


def test_surrogates_of_every_document(spark):
    docs = {r.doc_id: r.text for r in read(spark, SMALL, "documents").collect()}
    rows = E.queries()["op3_surrogates"](spark, SMALL).collect()
    assert len(rows) == len(docs) and sum(r.n_entities for r in rows)
    for r in rows:
        text, new, at, new_at = docs[r.doc_id], r.text, 0, 0
        assert r.n_entities == len(r.entities) == len(S.rewritten(text)[1])
        for e in r.entities:  # all between the entities is as it was, no entity is
            assert text[at:e.start] == new[new_at:e.new_start]
            at, new_at = e.start + e.length, e.new_start + e.new_length
            assert text[e.start:at] != new[e.new_start:new_at]
        assert (text or "")[at:] == (new or "")[new_at:]
        planted = re.findall(r"[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}|token = \"[0-9a-f]{40}\"", text or "")
        assert not any(p in new for p in planted)


def test_main_text_is_the_article_of_every_page(spark):
    from html import unescape
    pages = {p.page_id: p.html for p in read(spark, SMALL, "pages").collect()}
    rows = E.queries()["op7_main_text"](spark, SMALL).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article\b[^>]*>(.*?)</article>", pages[r.page_id], re.S)[1]
        inner = re.sub(r"<!--.*?-->|<(script|style)\b.*?</\1>", "", inner, flags=re.S)
        inner = re.sub(r"</?(?:p|h\d|div|ul|ol|li|table|tr|td|th|br|section|blockquote|pre)\b[^>]*>", " ", inner)
        assert r.text.split() == unescape(re.sub(r"<[^>]*>", "", inner)).split(), r.page_id
        assert r.n_chars == len(r.text)


def whole_ids(spark):
    """Ids of every document by the plain tokenizer, the end id after each."""
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(tokenizer_path())
    return {r.doc_id: np.array(whole.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
            for r in read(spark, SMALL, "documents").collect()}


def test_every_piece_holds_its_ids(spark):
    ids, at = whole_ids(spark), Counter()
    rows = E.queries()["op8_packing"](spark, SMALL).collect()
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        own = ids[r.doc_id]
        assert (r.start, r.doc_tokens) == (at[r.doc_id], len(own))
        assert r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())
        at[r.doc_id] += r.length
    assert at == {d: len(own) for d, own in ids.items()}
    windows = len({r.sequence_id for r in rows})
    assert windows * 4096 <= 1.02 * sum(map(len, ids.values())) + 4096


def test_planes_hold_all_ids_in_order(spark):
    ids, start, want = whole_ids(spark), 0, []
    for d in sorted(ids):
        want.append((d, start, len(ids[d]), zlib.crc32(ids[d].tobytes())))
        start += len(ids[d])
    rows = E.queries()["op11_id_planes"](spark, SMALL).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == want
