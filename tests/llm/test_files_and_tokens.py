"""Token files, packing and archives: exact round trips."""

import base64
import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import plain
from snaplake.llm import packing, token_file, tokens, warc
from snaplake.llm import queries as Q
from snaplake.llm.tokens import Encoder

PATH = public_tokenizers.path(Q.VOCABULARY)
WHOLE = Tokenizer.from_file(PATH)
ENCODER = Encoder(PATH)


def ids_of(text):
    return np.array([*WHOLE.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abZé1 \n\t\r  .,'s<|endoftext>!?\x1c\x85　😀")), max_size=40), max_size=4))
def test_encoder_equals_the_library(texts):
    for t, got in zip(texts, ENCODER.many(texts)):
        assert got.tolist() == WHOLE.encode(t, add_special_tokens=False).ids


def test_encoder_forgets_and_relearns(monkeypatch):
    from snaplake.llm import tokens
    monkeypatch.setattr(tokens, "PIECES_KEPT", 3)
    monkeypatch.setattr(tokens, "WORDS_KEPT", 3)
    enc = Encoder(PATH)
    for t in ["one two three four five", "five four <|endoftext|> x\n\ny", "", "one two"] * 2:
        assert enc.many([t, None])[0].tolist() == WHOLE.encode(t, add_special_tokens=False).ids


def test_token_file_round_trip(spark):
    docs = plain.edge_docs(spark).where("doc_id IS NOT NULL")
    files = token_file.write_tokens(docs, PATH, length=64)
    got = [tuple(r) for r in token_file.read_tokens(files).collect()]
    want, start = [], 0
    for i, t in sorted(plain.edge_texts(spark), key=lambda r: (r[0] or 0, r[1] or "")):
        if i is not None:
            ids = ids_of(t)
            want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
    assert sorted(got) == sorted(want)
    # random access: any sequence is a view, and masks end with the file's tokens
    row = max(files.collect(), key=lambda r: r.n_tokens)
    seqs = token_file.SequenceFile(row.ids_path)
    last = (row.n_tokens - 1) // 64
    ids, mask = seqs.sequence(last)
    assert mask.sum() == (row.n_tokens - 1) % 64 + 1 and len(ids) == 64 and not ids.flags.owndata
    assert seqs.sequence(0)[1].all() or last == 0


def test_token_file_empty_and_null_ids(spark):
    docs = plain.edge_docs(spark)
    assert token_file.read_tokens(token_file.write_tokens(docs.where("false"), PATH)).count() == 0
    assert token_file.read_tokens(token_file.write_tokens(docs, PATH)).where("doc_id IS NULL AND start = 0").count() == 1


def check_packing(rows, docs):
    by = {}
    for r in rows:
        by.setdefault((r.doc_id, r.start, r.length, r.ids_crc32, r.piece), []).append((r.sequence_id, r.offset))
    want = {}
    for i, t in docs:
        ids = ids_of(t)
        first = len(ids) % 1024 or 1024
        for n, a in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[a:first] if n == 0 else ids[a:a + 1024]
            key = (i, a, len(part), zlib.crc32(part.tobytes()), n)
            want[key] = want.get(key, 0) + 1
    assert {k: len(v) for k, v in by.items()} == want
    ends = {}
    for sequence, offset, length in sorted((r.sequence_id, r.offset, r.length) for r in rows):
        assert offset == ends.get(sequence, 0)
        ends[sequence] = offset + length
    assert all(e <= 1024 for e in ends.values())
    return len(ends), -(-sum(r.length for r in rows) // 1024)


def test_packing_query(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{plain.SF}/documents.parquet'").fetchall()
    used, least = check_packing(Q.SPARK["op4_packing"](spark, plain.SF).collect(), docs)
    assert used <= 1.03 * least + 2


def test_packing_edges_and_sequences(spark):
    packed = packing.pack(plain.edge_docs(spark), PATH, with_ids=True)
    rows = packed.collect()
    check_packing(rows, plain.edge_texts(spark))
    parts = {(r.sequence_id, r.offset): r.ids for r in rows}
    for r in packing.sequences(packed).collect():
        assert bytes(r.ids) == b"".join(bytes(v) for k, v in sorted(parts.items()) if k[0] == r.sequence_id) or len(r.ids) % 4 == 0
    assert packing.pack(plain.edge_docs(spark).where("false"), PATH).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=30))
def test_plan_uses_every_piece(counts):
    hist = np.zeros(65, int)
    for k, v in counts.items():
        hist[k] = v
    used = np.zeros(65, int)
    for lengths, n in packing.plan(hist, 64):
        assert sum(lengths) <= 64 and n > 0
        for v in lengths:
            used[v] += n
    assert (used == hist).all()


def warc_want(rows, least=0):
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    top = {}
    for i, t in rows:
        top[t or ""] = max(top.get(t or "", -1), -1 if i is None else i)
    out, seen = [], set()
    for i, t in rows:
        body = t or ""
        first = top[body] == (-1 if i is None else i) and body not in seen
        if first:
            seen.add(body)
        lone = first or len(body.encode()) < least
        out.append((i, len(body.encode()), sha(t), "response" if lone else "revisit", None if lone or top[body] < 0 else top[body]))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 3])
def test_warc_edges(spark, least):
    rows = [(1, "u", "x" * 200_000), (2, None, "x" * 200_000), (None, "a b\r\nX: y", "é"), (3, "u", None), (3, "u", None), (4, "v", ""),
            (9, "q", "é"), (10, "", "abc"), (11, "é", "\r\n\r\n"), (12, "z", "abc")]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "page_id long, url string, html string, record long, chunk string")
    got = warc.read_warc(warc.archive(df, least=least, chunk=1000)).collect()
    assert sorted(map(tuple, got), key=str) == warc_want([(i, t) for i, _, t in rows], least)
    assert warc.read_warc(warc.archive(df.where("false"))).count() == 0


def test_warc_query_and_chunks(spark):
    rows = duckdb.sql(f"SELECT page_id, html FROM '{plain.SF}/pages.parquet'").fetchall()
    assert sorted(map(tuple, Q.SPARK["op3_warc"](spark, plain.SF).collect()), key=str) == warc_want(rows)
    pages = spark.read.parquet(f"{plain.SF}/pages.parquet")
    chunks = warc.chunked(pages, chunk=500).where("page_id = 0").orderBy("chunk").collect()
    whole = b"".join(bytes(c.data) for c in chunks)
    assert whole.decode() == rows[0][1] and all(len(c.data) <= 500 for c in chunks)
    assert [c.last for c in chunks] == [False] * (len(chunks) - 1) + [True]
    assert bytes(chunks[2].digest) == hashlib.sha1(whole[:1500]).digest()


def test_words_of_letters_or_digits_skip_the_search_for_pieces():
    """Such words go to the vocabulary as they are; ids equal those of the whole text."""
    class Seen:
        def __init__(self, inner):
            self.inner, self.texts = inner, []

        def encode_batch_fast(self, texts, **kw):
            self.texts += texts
            return self.inner.encode_batch_fast(texts, **kw)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    enc = Encoder(PATH)
    enc.tokenizer = Seen(enc.tokenizer)
    texts = ["A first thing, née Ångström ŠKODA 12345 ½ x2 don't\nNext line. ªº 中文 東京, ٣٤ ǅ áb", "größer: 007!? tail\n\nİstanbul ×÷ ß​ end.", "", None, " lead", "\nfoo",
             "plainword Other, words; \nthird 99% of-it", "a  b\tc  d"]
    for _ in range(2):
        assert [x.tolist() for x in enc.many(texts)] == [ids_of(t)[:-1].tolist() for t in texts]
    met = set(" ".join(enc.tokenizer.texts).split())
    assert not met & {"thing", "née", "Ångström", "ŠKODA", "12345", "größer", "007", "Next", "plainword", "third"}
    assert {"x2", "中文"} <= met


def test_the_table_of_pieces_keeps_what_came_first():
    assert list(tokens._bounded({w: b"" for w in "abcdef"}, 4)) == ["a", "b"]
    kept = {w: b"" for w in "abcd"}
    assert tokens._bounded(kept, 4) is kept


def test_documents_of_one_batch_read_it_once(tmp_path):
    class Counted:
        def __init__(self, inner):
            self.inner, self.asked = inner, []

        def get_batch(self, i):
            self.asked.append(i)
            return self.inner.get_batch(i)

    step = token_file.ROWS * 8
    out = token_file.SequenceWriter(str(tmp_path / "x.arrow"), 8, np.dtype("<u2"))
    ids = (np.arange(step + 100) % 5000).astype("<u2")
    out.add(ids)
    out.close()
    seqs = token_file.SequenceFile(str(tmp_path / "x.arrow"))
    seqs.reader = Counted(seqs.reader)
    got = [np.concatenate(list(seqs.tokens(at, 100))).tolist() for at in range(0, step + 100 - 100, 100)]
    assert got == [ids[at:at + 100].tolist() for at in range(0, step, 100)]
    assert seqs.reader.asked == [0, 1]
    seqs.close()
