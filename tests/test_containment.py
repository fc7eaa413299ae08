"""Needles in long texts: the indexed way gives what plain search gives, and does not search for each."""

import random
import time

import pytest
from pyspark.sql import functions as F

from turnmeter.operators import relevance as rel

ALPHABET = "ab c\n\"é\U0001F600日"


def found(spark, needles, text, index_from):
    df = spark.createDataFrame([(needles, text)], "needles array<string>, text string")
    return df.select(rel.contained(F.col("needles"), F.col("text"), index_from).alias("x")).first().x


@pytest.mark.parametrize("seed", range(6))
def test_both_ways_are_plain_search(spark, seed):
    rng = random.Random(seed)
    text = "".join(rng.choices(ALPHABET, k=rng.choice([0, 1, 3, 4, 5, 300])))
    needles = ["".join(rng.choices(ALPHABET, k=rng.randrange(0, 9))) for _ in range(200)]
    for _ in range(100):
        i = rng.randrange(len(text) + 1)
        needles.append(text[i:i + rng.randrange(0, 12)])
    want = [n for n in needles if n in text]
    assert found(spark, needles, text, 0) == want == found(spark, needles, text, 1 << 60)


def test_nothing_to_look_for_or_in(spark):
    for index_from in (0, 1 << 60):
        assert found(spark, [], "text", index_from) == []
        assert found(spark, ["a", ""], "", index_from) == [""]
    assert found(spark, ["a"], None, 0) in (None, []) and found(spark, None, "a", 0) is None


def test_many_lines_in_a_long_response(spark):
    """20,000 lines against a response of 1 MB: the same lines, in a fraction of the time."""
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(30_000)]
    text = " ".join(rng.choices(words[:15_000], k=150_000))
    needles = [" ".join(("~" if i % 4 else "") + w for w in rng.choices(words, k=2)) for i in range(19_000)] + text.split(" ")[:1000]

    def timed(index_from):
        began = time.monotonic()
        return found(spark, needles, text, index_from), time.monotonic() - began
    timed(0)
    (plain, slow), (indexed, fast) = timed(1 << 60), timed(0)
    print(f"plain {slow:.1f} s, indexed {fast:.1f} s")
    assert indexed == plain and len(plain) >= 1000 and fast < slow
