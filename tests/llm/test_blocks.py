"""Chunks of vectors are sent once for each block that they have a partner in, not for each partner."""

import itertools

import numpy as np

from tallybook.llm import cover_tree as V


def test_a_chunk_is_sent_once_to_each_pair_of_blocks(spark):
    n, of = 24, 6  # chunks, chunks of a block
    pairs = [(i // of, j // of, 0, i, 0, j) for i, j in itertools.combinations_with_replacement(range(n), 2)]
    sent = V._sent(spark.createDataFrame(pairs, "block_a long, block_b long, a long, ca int, b long, cb int")).collect()
    assert len(sent) == sum(of if a == b else 2 * of for a, b in itertools.combinations_with_replacement(range(n // of), 2))
    assert len(sent) < len(pairs) / 2  # each unit was sent two chunks, or one
    assert sorted((p.a, p.ca, r.cell, r.chunk) for r in sent for p in r.partners) == sorted((a, ca, b, cb) for _, _, a, ca, b, cb in pairs)
    assert all((r.side == 1) == (r.block_a != r.block_b and r.chunk // of == r.block_b) for r in sent)


def test_links_of_many_blocks_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(V, "CHUNK", 16)
    monkeypatch.setattr(V, "BLOCK", 4 * 64)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 4))
    held = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    u = x / np.sqrt((x * x).sum(axis=1))[:, None]
    near = u @ u.T >= V.COSINE
    np.fill_diagonal(near, False)
    got = {r.vec_id: r.n_links for r in V.near_vectors(held).collect()}
    assert got == {i: int(k) for i, k in enumerate(near.sum(axis=1))}
    assert sum(got.values()) > 1000
