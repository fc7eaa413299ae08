"""The pipeline's stages against brute force, each on the rows that the one before it kept."""

import pytest
from test_decontam import brute as brute_hits
from test_secrets import brute as brute_spans
from test_simhash import brute_fingerprint, roots

import corpus_pipeline
from turnmeter.llm import packing, quality_ftrl

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, small_dir, tmp_path_factory):
    """Rows before and after each stage."""
    out, docs = [], spark.read.parquet(f"{small_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, small_dir).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs.collect(), after.collect(), after.columns))
        docs = after
    return out


def test_stages_and_columns(stages):
    assert [n for n, *_ in stages] == ["quality classifier", "simhash near-dedup", "benchmark decontamination",
                                       "secret scans", "packing"]
    assert all(columns == COLUMNS for *_, columns in stages[:-1])


def test_quality(spark, small_dir, stages):
    _, before, after, _ = stages[0]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small_dir}/labels.parquet").collect()}
    score = quality_ftrl.scorer(quality_ftrl.fit(spark.read.parquet(f"{small_dir}/documents.parquet"),
                                                 spark.read.parquet(f"{small_dir}/labels.parquet")))
    kept = {r.doc_id for r in after}
    assert kept == {r.doc_id for r in before if score(r.text) >= 0.7}
    assert sum(i in kept for i, q in labels.items() if q) >= 0.95 * sum(labels.values())
    assert sum(i in kept for i, q in labels.items() if not q) <= 0.1 * sum(not q for q in labels.values())


def test_near_duplicates(stages):
    _, before, after, _ = stages[1]
    prints = {r.doc_id: brute_fingerprint(r.text) for r in before}
    want = roots(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert sorted(r.doc_id for r in after) == sorted(set(want.values()))
    assert len(after) < len(before)


def test_decontamination(spark, small_dir, stages):
    _, before, after, _ = stages[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    assert sorted(after) == sorted(r for r in before if not brute_hits(r.text, items)[1])


def test_secrets(stages):
    _, before, after, _ = stages[3]
    got = {r.doc_id: r for r in after}
    assert len(got) == len(before)
    changed = 0
    for r in before:
        spans, text, at = brute_spans(r.text)[1], "", 0
        for start, _, end in spans:
            if start >= at:
                text += r.text[at:start] + "[SECRET]"
            at = max(at, end)
        text += r.text[at:]
        changed += bool(spans)
        assert got[r.doc_id].text == text and got[r.doc_id].n_chars == len(text)
        assert (got[r.doc_id].lang, got[r.doc_id].source) == (r.lang, r.source)
    assert changed


def test_packing(stages):
    _, before, after, _ = stages[4]
    encode, docs = packing.encoder(corpus_pipeline.VOCABULARY, 2), {}
    for p in sorted(after, key=lambda p: (p.doc_id, p.start)):
        assert p.start == len(docs.setdefault(p.doc_id, b"")) // 4
        docs[p.doc_id] += bytes(p.ids)
    assert docs == {r.doc_id: encode(r.text) for r in before}
    lengths = {}
    for p in after:
        lengths[p.sequence_id] = lengths.get(p.sequence_id, 0) + p.length
    assert all(0 < n <= 4096 and n & (n - 1) == 0 for n in lengths.values())


def test_run_applies_all_stages(spark, small_dir, stages):
    got = corpus_pipeline.run(spark, small_dir).collect()
    assert sum(p.length for p in got) == sum(p.length for p in stages[4][2])
    assert {p.doc_id for p in got} == {p.doc_id for p in stages[4][2]}


def test_each_stage_takes_odd_and_empty_rows(spark, odd_docs, no_docs, small_dir):
    for docs in (odd_docs.select(*COLUMNS, "score"), no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, small_dir)
            assert name == "packing" or out.columns == docs.columns
            assert out.count() <= 2 * docs.count() + 40
