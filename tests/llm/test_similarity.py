"""Similarity joins against comparing everything with everything."""

import random

import duckdb
import numpy as np
import pytest

import plain
from snaplake.llm import common, embed_dedup, ngram_join
from snaplake.llm import queries as Q


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100, 100 + i) for i in range(1, 40)] + [(i, i + 1) for i in range(200, 230)]
    df = spark.createDataFrame(edges, "src long, dst long")
    want = plain.components({x for e in edges for x in e}, edges)
    got = {r.node: r.component for r in common.connected_components(df).collect()}
    assert got == {i: c for i, c in want.items() if any(a != b and i in (a, b) for a, b in edges)}
    assert common.connected_components(df.where("false")).count() == 0


def test_ngram_query(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{plain.SF}/documents.parquet'").fetchall()
    want = plain.similar(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in Q.SPARK["op10_ngram_join"](spark, plain.SF).collect()}
    assert got == {i: (len(plain.shingles(t)), want[i]) for i, t in docs}


def near_copies(seed=1):
    """A chain and a large group of near copies, hot passages, and a threshold tie."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    docs = []
    for _ in range(40):  # a large group, some beyond the threshold of each other
        own = list(base)
        for _ in range(rng.randrange(0, 4)):
            own[rng.randrange(120)] = word()
        docs.append(own)
    chain = list(base[:60])
    for _ in range(6):
        chain = chain[2:] + [word(), word()]
        docs.append(list(chain))
    passage = [word() for _ in range(60)]
    docs += [[word() for _ in range(rng.randrange(5, 200))] + passage for _ in range(30)]
    docs += [[f"t{i}" for i in range(13)], [f"t{i}" for i in range(12)], [f"t{i}" for i in range(11)]]  # 9 shingles, 8, 7: 8/9, 7/8, 7/9
    return [(i * 3, " ".join(d)) for i, d in enumerate(docs)]


def test_ngram_groups_chains_and_passages(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SHORT", 4)
    monkeypatch.setattr(ngram_join, "BLOCK", 10)
    docs = near_copies()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = plain.similar(docs)
    assert {r.doc_id: r.component_id for r in ngram_join.similar_documents(df).collect()} == want
    kept = {r.doc_id for r in ngram_join.keep_one(df).collect()}
    assert kept == set(want.values())


def test_ngram_edges(spark):
    docs = plain.edge_docs(spark)
    want = plain.similar(plain.edge_texts(spark))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.similar_documents(docs).collect()), key=str)
    assert got == sorted(((i, len(plain.shingles(t)), want.get(i)) for i, t in plain.edge_texts(spark)), key=str)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("doc_id IS NULL").count() == 1
    assert ngram_join.similar_documents(docs.where("false")).count() == 0


def brute_vectors(rows, threshold=0.9):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    edges = [(i, j) for i in good for j in good if i < j and len(good[i]) == len(good[j])
             and good[i] @ good[j] >= threshold * np.linalg.norm(good[i]) * np.linalg.norm(good[j])]
    comp = plain.components({i for i, _ in rows if i is not None}, edges)
    return {i: (sum(i in e for e in edges), comp[i]) for i in comp}


@pytest.mark.parametrize("block", [2048, 40])
def test_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    rng = np.random.default_rng(4)
    center = rng.normal(size=(6, 32))
    rows = [(i, (center[i % 6] + 0.25 * rng.normal(size=32)).tolist()) for i in range(150)]
    rows += [(i, rng.normal(size=32).tolist()) for i in range(150, 300)]
    rows += [(300 + i, rows[0][1]) for i in range(60)]
    rows += [(400, None), (401, []), (402, [0.0] * 32), (403, [None] + [1.0] * 31), (404, [float("nan")] + [1.0] * 31),
             (405, [float("inf")] + [1.0] * 31), (406, [1.0, 0.0]), (407, [2.0, 0.0]), (None, rows[0][1])]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, n_links int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(df).collect() if r.vec_id is not None}
    want = brute_vectors(rows)
    right = sum(got[i][0] for i in want) / max(1, sum(v[0] for v in want.values()))
    assert right >= 0.999 and all(got[i][0] <= want[i][0] for i in want)
    assert np.mean([got[i] == want[i] for i in want]) >= 0.99


def test_vector_repeats_and_empty(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in embed_dedup.near_duplicates(df).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert embed_dedup.near_duplicates(df.where("false")).count() == 0
