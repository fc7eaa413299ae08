"""Fixed values pinned by value, independent of both the engine's and the oracle's use of them."""

import pytest
from pyspark.sql import functions as F

from turnmeter.functions import text as tx
from turnmeter.functions import tokens as tk


@pytest.mark.parametrize("models, ratio", [
    (["claude-9", "my-Anthropic-model"], 3.5), (["gemini-x", "GEMINI"], 4.0), (["grok-2"], 4.0),
    (["deepseek-x", "glm-9", "Zhipu", "llama-1", "mistral-7b", "qwen", "Kimi", "gpt-9", "o7", "unheard-of", "", None], 3.8)])
def test_bytes_per_token(spark, models, ratio):
    df = spark.createDataFrame([(m,) for m in models], "m string")
    assert {r.x for r in df.select(tk.token_ratio("m").alias("x")).collect()} == {ratio}


def test_white_space():
    points = [*range(0x09, 0x0E), 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]
    assert sorted(map(ord, tx.JS_WHITESPACE)) == points


def test_threshold_of_large_outputs(spark):
    df = spark.createDataFrame([("x" * 10_239,), ("x" * 10_240,), ("é" * 5_120,)], "t string").coalesce(1)
    assert [r.x for r in df.select(tk.is_large_output(F.col("t")).alias("x")).collect()] == [False, True, True]


def test_patterns():
    assert tx.QUOTED_RE == "[\"']([^\"']{4,}?)[\"']"
    assert tk.CLAUDE_VERSION_RE == r"(?i)claude.*?(\d+)\.(\d+)"
    assert tk.OPENAI_RE == "^(gpt|openai|o[1-9])"
