"""The registered queries on the smallest tables: against SQL where there is some, else against brute force."""

import math
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from test_sharding import brute as brute_shard
from test_simhash import brute_fingerprint, roots
from tokenizers import Tokenizer

from turnmeter.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES

TABLES = ("documents", "benchmark", "labels")


@pytest.fixture(scope="module")
def texts(spark, small_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}


def rows(spark, name, small_dir):
    return LLM_QUERIES[name](spark, small_dir).collect()


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_against_sql(spark, small_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    found = con.execute(LLM_ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    want = sorted(map(tuple, found.fetchall()))
    df = LLM_QUERIES[name](spark, small_dir)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == want


def test_every_query_returns_each_document(spark, small_dir, texts):
    for name in sorted(LLM_QUERIES):
        if name in ("op2_passages", "op3_packing", "op11_divergence", "op13_html_text"):  # passages, pieces, groups, pages
            continue
        got = rows(spark, name, small_dir)
        assert sorted(r.doc_id for r in got) == sorted(texts), name


def test_op1(spark, small_dir, texts):
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    want = roots(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows(spark, "op1_simhash", small_dir)} == {
        i: (f"{prints[i]:016x}", want[i]) for i in texts}


def test_op2(spark, small_dir, texts):
    """Documents that share 50 words in a row are found and connected, and spans hold what they say."""
    words = {i: t.encode().lower().split() for i, t in texts.items()}
    where = {}
    for i, w in words.items():
        for k in range(len(w) - 49):
            where.setdefault(tuple(w[k:k + 50]), set()).add(i)
    got = rows(spark, "op2_passages", small_dir)
    component = {i: r.component_id for r in got for i in (r.doc_id, r.other_doc_id)}
    shared = [s for s in where.values() if len(s) > 1]
    assert shared and all(len({component[i] for i in s}) == 1 for s in shared)
    for r in got:
        a, b = words[r.doc_id][r.start:r.end], words[r.other_doc_id][r.other_start:r.other_end]
        assert min(len(a), len(b)) >= 50 and r.n_equal >= 0.8 * r.n_steps
        if r.n_equal == r.n_steps:
            assert a == b


def test_op3(spark, small_dir, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: np.array(library.encode(t, add_special_tokens=False).ids + [2], "<u4") for i, t in texts.items()}
    covered, sequences = dict.fromkeys(ids, 0), {}
    for r in sorted(rows(spark, "op3_packing", small_dir), key=lambda r: (r.doc_id, r.start)):
        assert r.start == covered[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        covered[r.doc_id] += r.length
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert covered == {i: len(x) for i, x in ids.items()}
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0


def test_op4(spark, small_dir, texts):
    got = rows(spark, "op4_sharding", small_dir)
    slots = {}
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert (r.shard, r.grown_shard) == (brute_shard(r.doc_id, 40), brute_shard(r.doc_id, 41))
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_op7(spark, small_dir, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in rows(spark, "op7_token_count", small_dir):
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)


def test_op8(spark, small_dir, texts):
    for r in rows(spark, "op8_quality", small_dir):
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and math.isfinite(r.score) and r.predicted == (r.score >= 0.7)
