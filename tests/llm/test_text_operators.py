"""Decontamination, personal data and url rules against plain versions."""

import hashlib
import itertools
import time

import duckdb
import pytest
from pyspark.sql import functions as F

import plain
from snaplake.llm import decontaminate, pii, url_filter
from snaplake.llm import queries as Q


def keyed(rows):
    return sorted(map(tuple, rows), key=str)


def found(df):
    return keyed(df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect())


def test_decontaminate_query(spark):
    docs, items = (duckdb.sql(f"SELECT * FROM '{plain.SF}/{t}.parquet'").fetchall() for t in ("documents", "benchmark"))
    want = keyed(plain.contamination([r[:2] for r in docs], items))
    assert found(Q.SPARK["op1_decontaminate"](spark, plain.SF)) == want and any(r[-1] for r in want)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_decontaminate_edges(spark, block_bytes):
    """Short items, items without words, repeated and null ids, items inside items, any number of blocks."""
    items = [(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"), (2, "three WORDS"), (2, "three words"), (None, "tail"), (3, "..."), (4, None),
             (5, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 not this"), (6, "words only")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(plain.edge_docs(spark), bench, block_bytes=block_bytes)
    assert got.columns[-1] == "contamination" and got.schema["contamination"].dataType.typeName() == "struct"
    assert found(got.select("doc_id", "contamination.*")) == keyed(plain.contamination(plain.edge_texts(spark), items))
    left = decontaminate.decontaminate(plain.edge_docs(spark), bench)
    assert left.columns == plain.edge_docs(spark).columns
    assert left.count() == sum(not r[-1] for r in plain.contamination(plain.edge_texts(spark), items))


def test_decontaminate_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = plain.edge_docs(spark)
    assert decontaminate.decontaminate(docs, bench).count() == docs.count()
    assert decontaminate.find_contamination(docs.where("false"), bench).count() == 0


def test_longest_match(spark):
    docs = spark.createDataFrame([(1, "z " + " ".join(f"w{i}" for i in range(14)) + " q")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(20)))], "item_id long, text string")
    assert decontaminate.find_contamination(docs, bench).first().contamination.longest == 14


def test_pii_query_and_edges(spark):
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{plain.SF}/documents.parquet'").fetchall()
    got = {r.doc_id: r for r in Q.SPARK["op8_pii"](spark, plain.SF).collect()}
    for i, t in texts:
        base = plain.base_spans(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert got[i].n_email == sum(x.startswith("email") for x in base)
    edges = [t for _, t in plain.edge_texts(spark)] + [
        "a@b.c_d@e.f g@h", "x@y.z@q.r", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.004", "é 4111 1111 1111 1111, 4111111111111112",
        "+1 (262) 555-3752 and +12 3", "ünïcode 😀 a.b@c.de +44 20 7946 0958", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6"]
    df = spark.createDataFrame(list(enumerate(edges)), "doc_id long, text string")
    for r in pii.pii_report(df).collect():
        assert r.base_sha256 == hashlib.sha256(",".join(plain.base_spans(edges[r.doc_id])).encode()).hexdigest(), r
        assert [s for s in r.spans.split(",") if s.split(":")[0] in pii.BASE] == plain.base_spans(edges[r.doc_id])


def test_pii_checksums_and_context(spark):
    df = spark.createDataFrame([
        (1, "pay to DE89 3704 0044 0532 0130 00 now"), (2, "pay to DE89 3704 0044 0532 0130 01 now"),
        (3, "my account 123456789 is"), (4, "order 123456789 is"), (5, "mail me: a@b.com"), (6, "x a@b.com")], "doc_id long, text string")
    got = {r.doc_id: r.pii for r in pii.with_spans(df).collect()}
    assert [s.kind for s in got[1]] == ["iban"] and got[2] == []
    assert [s.kind for s in got[3]] == ["account"] and got[4] == []
    assert got[5][0].score > got[6][0].score


def test_redact(spark):
    df = spark.createDataFrame([(1, "a b@c.de, 1.2.3.4 end"), (2, None), (3, "clean"), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(pii.with_spans(df)).collect()}
    assert got == {1: "a <email>, <ip> end", 2: None, 3: "clean", 4: ""}
    docs = plain.edge_docs(spark)
    assert pii.redact(pii.with_spans(docs, out="spans__"), spans_col="spans__").drop("spans__").columns == docs.columns


def rule_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut].translate(plain.LOW), rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    best = None
    for action, rule in rules:
        h, p = rule.split("/", 1)
        if ("." + host).endswith("." + h) and path.startswith("/" + p):
            best = max(best or (0, "", ""), (len(rule), rule, action))
    return host, path, best and best[1], best[2] if best else "allow"


def test_url_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{plain.SF}/pages.parquet'")
    want = con.sql(Q.ORACLE["op7_url_filter"])
    cols = sorted(want.columns)
    got = Q.SPARK["op7_url_filter"](spark, plain.SF)
    assert keyed(got.select(*cols).collect()) == keyed(want.select(*cols).fetchall())
    for r in con.sql("SELECT page_id, url FROM pages").fetchall():
        assert rule_verdict(r[1], Q.URL_RULES)  # the plain version reads every url


def test_url_nested_rules(spark):
    rules = [("block", "com/"), ("allow", "a.com/"), ("block", "a.com/x"), ("allow", "a.com/x/y/"), ("block", "a.com/x/y/z"),
             ("block", "b.a.com/"), ("allow", "b.a.com/x/y/zz"), ("allow", "org/"), ("block", "org/"), ("allow", "/nohost"), ("block", "nopath")]
    hosts = ["a.com", "A.com", "b.a.com", "c.b.a.com", "xa.com", "com", "z.org", "other.net", "", "."]
    paths = ["", "/", "/x", "/xx/y", "/x/y", "/x/y/", "/x/y/z", "/x/y/zz?q=/", "/é#f", "?x=/", "/x/y/zzz"]
    urls = [f"http://{h}{p}" for h, p in itertools.product(hosts, paths)] + [None, "", "no scheme", "http://a.com/x", "a://b://c/d", "x" * 50_000]
    df = spark.createDataFrame([(i if i % 9 else None, u, "v") for i, u in enumerate(urls)] + [(3, urls[3], "v")], "page_id long, url string, rule string")
    got = keyed(url_filter.url_verdicts(df, spark.createDataFrame(rules, "action string, rule string"))
                .select("page_id", "host", "path", "rule", "verdict").collect())
    held = [r for r in rules if r[1] not in ("/nohost", "nopath") and r != ("allow", "org/")]
    want = keyed((r.page_id, *rule_verdict(r.url, held)) for r in df.collect())
    assert got == want


def test_url_empty_tables(spark):
    none = spark.createDataFrame([], "action string, rule string")
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert [r.verdict for r in url_filter.url_verdicts(pages, none).collect()] == ["allow"]
    assert url_filter.url_verdicts(pages.where("false"), none).count() == 0
    assert F  # keep import


def test_pii_long_texts_grow_in_proportion(spark):
    def seconds(n):
        text = "".join(f"call +44 20 7946 {i % 10000:04d} or mail a{i}@b.example, no {i % 90 + 10}. " for i in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        found = pii.with_spans(df).select(F.size("pii").alias("n")).first().n
        pii.redact(pii.with_spans(df)).select(F.length("text")).first()
        assert found >= 2 * n
        return time.perf_counter() - start

    seconds(100)
    one, four = seconds(5_000), seconds(20_000)
    assert four < 8 * one + 4


def test_pii_walk_over_many_runs(spark, monkeypatch):
    monkeypatch.setattr(pii, "RUN", 3)
    text = " é ".join(f"a{i}@b.example 10.0.0.{i} +44 20 7946 0{i:03d} 4111 1111 1111 1111" for i in range(40))
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "x@y.zz")], "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.pii_report(df).collect()}
    assert rows[1].spans.split(",") == plain.base_spans(text) and rows[2].spans == rows[3].spans == "" and rows[4].spans == "email:0:6"
    clean = {r.doc_id: r.text for r in pii.redact(pii.with_spans(df)).collect()}
    spans, want, at = plain.base_spans(text), "", 0
    for kind, a, b in (s.split(":") for s in spans):
        if int(a) >= at:
            want += text[at:int(a)] + f"<{kind}>"
        at = max(at, int(b))
    assert clean == {1: want + text[at:], 2: None, 3: "", 4: "<email>"}


def test_pii_column_names_may_clash(spark):
    df = spark.createDataFrame([(1, "mail a@b.example", "x", "y")], "doc_id long, text string, __pii_email string, __pii_flat string")
    got = pii.redact(pii.with_spans(df)).first()
    assert got.text == "mail <email>" and (got["__pii_email"], got["__pii_flat"]) == ("x", "y")
