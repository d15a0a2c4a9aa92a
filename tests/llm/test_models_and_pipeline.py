"""Held-out accuracy of the fitted models, and the pipeline's stages."""

import os
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import plain
from snaplake.llm import quality, toxicity
from snaplake.llm.common import settle

FITTED = "/root/testdata/sf0.1"
LARGER = "/root/testdata/check_s"


def rows_of(label, parts, held, limit):
    rows = duckdb.sql(f"SELECT doc_id, text, {label} FROM '{FITTED}/documents.parquet' JOIN '{FITTED}/labels.parquet' USING (doc_id) "
                      f"ORDER BY hash(doc_id) LIMIT {limit}").fetchall()
    side = lambda r: zlib.crc32(str(r[0]).encode()) % parts == held
    return [r[1:] for r in rows if not side(r)], [r[1:] for r in rows if side(r)]


@pytest.fixture(scope="module")
def machine():
    train, test = rows_of("toxic", 3, 1, 4000)
    return toxicity.train(train), test


def test_toxicity_held_out(machine):
    model, test = machine
    y = np.array([t for _, t in test])
    said = model.scores([t for t, _ in test]) >= 0.7
    assert (said == y).mean() >= 0.92 and said[y == 0].mean() <= 0.01


@pytest.mark.skipif(not os.path.exists(LARGER), reason="needs a table with more labelled rows than sf0.1 has")
def test_toxicity_finds_held_out_toxic_documents():
    """Fitted on up to ``SAMPLE`` rows of each label; sf0.1 has too few labels."""
    assert toxicity.SAMPLE[1] >= 2500 and toxicity.SAMPLE[0] >= 4000
    read = f"FROM '{LARGER}/documents.parquet/*' JOIN '{LARGER}/labels.parquet/*' USING (doc_id)"
    rows = duckdb.sql(f"SELECT doc_id, text, toxic {read} ORDER BY hash(doc_id) LIMIT 40000").fetchall()
    side = lambda r: zlib.crc32(str(r[0]).encode()) % 3 == 1
    train = [r[1:] for v, n in toxicity.SAMPLE.items() for r in [r for r in rows if r[2] == v and not side(r)][:n]]
    test = [r[1:] for r in rows if side(r)][:3000]
    y = np.array([t for _, t in test])
    said = toxicity.train(train).scores([t for t, _ in test]) >= 0.7
    got = len(train), (said == y).mean(), said[y == 1].mean()
    print(got)
    assert got[1] >= 0.97 and got[2] >= 0.9, got


def test_toxicity_gaps_and_empty_texts(machine):
    model, _ = machine
    plain_, marked, spelled = model.margins(["you idiot there", "you i.d-i*o.t there", "you i d i o t there"])
    assert plain_ == marked == spelled
    kernel = toxicity.Kernel(["idiot"])
    same, inserted, other = kernel(["idiot", "idxiot", "thornwood"])[:, 0]
    assert 1 <= same < 1.2 and inserted > 0.3 > 0.1 > other  # repeated triples lift a word's value with itself over 1
    empty, null = model.scores(["", None])
    assert empty == null < 0.5
    assert toxicity.train([]).scores(["x"])[0] == 0 and toxicity.train([("a", 1)]).scores([None])[0] == 1


def test_kernel_folds_exactly():
    words, marks = ["thisisidiotic", "moron", "abc", "trashes"], ["idiot", "moron", "trash"]
    kernel, beta = toxicity.Kernel(marks), np.array([0.5, -1.0, 2.0], np.float32)
    assert np.allclose(toxicity.word_scores(words, kernel.fold(beta)), kernel(words) @ beta, atol=1e-5)


def test_quality_held_out():
    train, test = rows_of("quality", 5, 0, 2500)
    good = np.array([quality.describe(t) for t, q in train if q])
    web = np.array([quality.describe(t) for t, _ in train + test])
    model = quality.train(good, web, np.mean([q for _, q in train]), rounds=1200)
    y = np.array([q for _, q in test])
    assert ((model.scores([t for t, _ in test]) >= 0.3) == y).mean() >= 0.97
    assert np.isfinite(model.scores(["", None])).all()


def test_quality_sample_takes_each_id_once(spark, monkeypatch):
    """The id with the smallest hash holds most rows; it fills one place of the unlabelled sample."""
    ids = spark.range(1, 41).select(F.col("id").alias("doc_id"))
    hot = ids.orderBy(F.xxhash64("doc_id", F.lit("web"))).first().doc_id
    docs = spark.createDataFrame([(i, f"text number {i}") for i in [*range(1, 41), *[hot] * 60]], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(quality, "train", lambda good, web, prior: seen.append(web))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    quality.fit_quality(docs, labels, unlabelled=8)
    quality.fit_quality(docs.distinct(), labels, unlabelled=8)
    assert seen[0].shape[0] == 8 and np.array_equal(*seen)


def test_models_score_every_row(spark, machine):
    docs = plain.edge_docs(spark)
    got = toxicity.score_toxicity(docs, machine[0])
    assert got.columns == [c for c in docs.columns if c != "toxicity"] + ["toxicity"]
    assert got.where("toxicity BETWEEN 0 AND 1").count() == docs.count()
    flat = quality.Model(None, None, None, None, None, 0.4)
    assert {r.score for r in quality.score_quality(docs, flat, out="score").collect()} == {0.4}
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.fit_toxicity(docs, labels).scores(["x"])[0] == 0
    assert 0 < quality.fit_quality(docs, labels).scores(["x"])[0] < 1


def test_stages_keep_rows_columns_and_decisions(spark, tmp_path):
    """Each stage on an input with every odd case, and the stages one after another."""
    labels = spark.createDataFrame([(i, 1, 0) for i in range(9)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10")], "item_id long, text string")
    docs = settle(plain.edge_docs(spark).unionByName(spark.createDataFrame(
        [(20, "write to a@b.de or 10.0.0.1", "en", None, 27, "p", "t", 1, 2, 3, 4)], plain.EXTRA)), "edge")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    columns, ids = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0, name
        docs = settle(stage(spark, docs, str(tmp_path)), "stage")
        ids.append(sorted(r.doc_id or -1 for r in docs.select("doc_id").distinct().collect()))
        if name != "packing":
            assert docs.columns == columns, name
        if name == "personal data":
            assert docs.where("doc_id = 20").first().text == "write to <email> or <ip>"
            assert docs.where("text IS NOT NULL AND n_chars <> length(text)").count() == 0
    assert ids == [[-1, 1, 2, 3, 4, 5, 6, 7, 8, 20], [-1, 1, 2, 3, 4, 6, 7, 20], *[[-1, 1, 2, 4, 6, 7, 20]] * 3]


def test_run_equals_its_plain_version(spark):
    model = toxicity.fit_toxicity(spark.read.parquet(f"{plain.SF}/documents.parquet"), spark.read.parquet(f"{plain.SF}/labels.parquet"))
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{plain.SF}/documents.parquet'").fetchall()
    docs = [d for d, s in zip(docs, model.scores([t for _, t in docs])) if s < corpus_pipeline.REJECT]
    comp = plain.similar(docs)
    docs = [d for d in docs if comp[d[0]] == d[0]]
    items = duckdb.sql(f"SELECT item_id, text FROM '{plain.SF}/benchmark.parquet'").fetchall()
    clean = {r[0] for r in plain.contamination(docs, items) if not r[-1]}
    got = corpus_pipeline.run(spark, plain.SF)
    assert {r.doc_id for r in got.select("doc_id").distinct().collect()} == clean
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0
