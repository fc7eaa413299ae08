import random
import re

import pytest

from turnmeter.llm import decontam

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DOCS = "doc_id bigint, text string, h string, n_hit string, `key` string"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, item_text in items:
        v = words(item_text)
        n = min(10, len(v))
        wins = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in wins:
                hit.update(range(i, i + n))
                if item is not None:
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def case(seed):
    rng = random.Random(seed)
    vocab = "the of and a b c Dé é1 ß x-y Zed".split()

    def say(n):
        return " ".join(rng.choices(vocab, k=n))
    items = [(i, say(rng.choice([0, 1, 2, 3, 9, 10, 11, 30]))) for i in range(12)]
    items += [(3, items[3][1]), (77, items[5][1]), (None, say(12)), (5, None), (8, " ,;")]
    docs = [(i, say(rng.randrange(80)) + ("" if rng.random() < .5 else " " + rng.choice(items)[1].__str__().upper()
                                           if rng.random() < .5 else "")) for i in range(120)]
    return items, docs


@pytest.mark.parametrize("seed, block", [(1, None), (2, 200)])
def test_against_brute_force(spark, monkeypatch, seed, block):
    if block:
        monkeypatch.setattr(decontam, "BLOCK_BYTES", block * 20)
    items, docs = case(seed)
    items = [i for i in items if len(words(i[1])) != 1 or seed == 1]
    docs += [(None, docs[1][1]), (None, docs[2][1]), (3, docs[3][1]), (3, docs[9][1]), (500, None), (501, "")]
    df = spark.createDataFrame([(i, t, "h", "n", "k") for i, t in docs], DOCS)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontam.contamination(df, bench).collect()
    want = sorted(((i, *brute(t, items)) for i, t in docs), key=str)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got), key=str) == want
    kept = decontam.decontaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted(
        (str(i), str(t)) for i, t in docs if not brute(t, items)[1])


def test_empty_tables_and_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "word word word word word word word word word word"), (2, "é")],
                                  "item_id bigint, text string")
    none = bench.limit(0)
    assert decontam.contamination(no_docs, bench).collect() == []
    got = decontam.contamination(odd_docs, none).collect()
    assert len(got) == odd_docs.count() and all(r.n_hit == 0 and r.item_ids == [] for r in got)
    got = {r.doc_id: r for r in decontam.contamination(odd_docs, bench).collect()}
    assert (got[8].n_words, got[8].n_hit, got[8].item_ids) == (30_000, 30_000, ["1"])
    assert (got[4].n_hit, got[4].item_ids) == (1, ["2"])
    assert decontam.decontaminated(odd_docs, none).count() == odd_docs.count()
