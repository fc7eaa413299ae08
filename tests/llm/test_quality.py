import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from turnmeter.llm import quality_ftrl, rule_cascade
from turnmeter.llm.queries import op8_quality
from turnmeter.llm.rule_cascade import RULES, STATISTICS, Rule, Text


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    lines, dup, seen = t.split("\n"), 0, set()
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside))


def test_statistics_against_brute_force(spark, odd_docs):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab \n\t#é\xa0|") for _ in range(rng.randrange(60))) for _ in range(300)]
    for t in texts + ["a b c a b c", "a a a a", "a b\na b\n\n\n", "x y z", None, ""]:
        assert tuple(getattr(Text(t), n) for n in STATISTICS) == brute(t), t
    got = odd_docs.select("text", rule_cascade.verdict("text", RULES, statistics=True).alias("v")).collect()
    assert len(got) == odd_docs.count()
    assert all(tuple(r.v[n] for n in STATISTICS) == brute(r.text) for r in got)


def test_order_is_by_rejections_per_cost_and_leaves_verdicts_alone(spark, small_dir, no_docs):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    a, b, c = (Rule(n, lambda t: False) for n in "abc")
    assert [r.name for r in rule_cascade.order([a, b, c], {"a": (10, .1), "b": (1000, .2), "c": (1, .05)})] == ["c", "a", "b"]
    found = rule_cascade.estimate(docs, RULES, 100)
    assert set(found) == {r.name for r in RULES} and all(c > 0 and 0 <= s <= 1 for c, s in found.values())
    assert rule_cascade.estimate(no_docs, RULES) == {}
    assert rule_cascade.order(RULES, {}) == list(RULES)
    kept = []
    for rules in (RULES, RULES[::-1], rule_cascade.order(RULES, found)):
        kept.append({r.doc_id: r.v.kept for r in docs.select("doc_id", rule_cascade.verdict("text", rules).alias("v")).collect()})
    assert kept[0] == kept[1] == kept[2] and 0 < sum(kept[0].values()) < len(kept[0])


def test_short_circuit():
    calls = []
    rules = [Rule("no", lambda t: calls.append(1) or True), Rule("never", lambda t: calls.append(2) or True)]
    assert rule_cascade.first_rejection(Text("x"), rules) == ("no", 1) and calls == [1]
    assert rule_cascade.first_rejection(Text("x"), []) == (None, 0)


def test_ftrl_separates_and_is_sparse():
    rng = random.Random(0)
    words = ["w%d" % i for i in range(300)]
    good = [" ".join(rng.choices(words, k=40)) for _ in range(150)]
    bad = [" ".join(w.upper() + "!!" for w in rng.choices(words, k=40)) for _ in range(150)]
    w = quality_ftrl.train([(t, 1) for t in good[:100]] + [(t, 0) for t in bad[:100]], bits=14)
    score = quality_ftrl.scorer(w)
    assert min(map(score, good[100:])) > 0.7 > 0.3 > max(map(score, bad[100:]))
    assert (w == 0).sum() > 0
    assert quality_ftrl.scorer(quality_ftrl.train([]))("a") > 0.99
    assert quality_ftrl.scorer(quality_ftrl.train([("a", 0)]))("b") < 0.01


def test_sparse_score_is_the_dense_dot_product():
    f, rng = quality_ftrl.Features(8), np.random.default_rng(1)
    w = rng.normal(size=257).astype(np.float32)
    i, x = f("The the the cat!! SAT on the mat 42")
    dense = np.zeros(256)
    np.add.at(dense, i, x)
    want = 1 / (1 + np.exp(-(dense @ w[:256] + w[256])))
    assert abs(quality_ftrl.scorer(w)("The the the cat!! SAT on the mat 42") - want) < 1e-5


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = op8_quality(spark, d).where("held_out").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    right = sum(r.predicted == r.quality for r in got)
    assert len(got) > 50 and right / len(got) > 0.95


def test_labels_nulls_repeats_and_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (8, 1), (8, 1), (99, 0)],
                                   "doc_id bigint, quality int")
    w = quality_ftrl.fit(odd_docs, labels, bits=10)
    got = odd_docs.select("doc_id", "score", quality_ftrl.score_column(odd_docs, w).alias("s")).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.s <= 1 and r.score == "own" for r in got)
    assert quality_ftrl.fit(no_docs, labels, bits=10)[-1] > 0
    assert no_docs.select(quality_ftrl.score_column(no_docs, w)).collect() == []


def test_sample_is_bounded(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    labels = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    assert len(quality_ftrl.fit(docs, labels, max_rows=20, bits=8)) == 257
