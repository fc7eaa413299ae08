"""Token counts, family detection and cost (reference tokenizer facts)."""

import pytest
from pyspark.sql import functions as F

from turnmeter.functions import tokens as tk


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ",".join(f"{k} string" for k in cols))
    return df.select(expr.alias("v")).first()["v"]


def test_gemini_hello_world_is_three(spark):
    # 11 bytes / 4.0 -> ceil 2.75 = 3
    assert one(spark, tk.estimate_tokens("t", "m"), t="Hello world", m="gemini-2.0-flash") == 3
    assert one(spark, tk.token_method("t", "m"), t="Hello world", m="gemini-2.0-flash") == "heuristic"


def test_llama_and_unknown_ratios(spark):
    assert one(spark, tk.estimate_tokens("t", "m"), t="Hello world", m="llama-3-8b") == 3  # ceil(11/3.8)
    assert one(spark, tk.token_ratio("m"), m="unknown-model") == 3.8
    assert one(spark, tk.token_ratio("m"), m="claude-3-5-sonnet") == 3.5
    assert one(spark, tk.token_ratio("m"), m="grok-2") == 4.0
    assert one(spark, tk.token_ratio("m"), m="mistral-large") == 3.8


def test_empty_text_is_zero_and_exact(spark):
    assert one(spark, tk.estimate_tokens("t", "m"), t="", m="gpt-4o") == 0
    assert one(spark, tk.token_method("t", "m"), t="", m="gpt-4o") == "exact"
    assert one(spark, tk.estimate_tokens("t", "m"), t=None, m="gpt-4o") == 0


def test_utf8_bytes_not_chars(spark):
    # 'é' is 2 bytes: 5 chars, 6 bytes -> ceil(6/3.8) = 2
    assert one(spark, tk.estimate_tokens("t", "m"), t="éabcd", m="x") == 2


@pytest.mark.parametrize("model,family", [
    ("gpt-4o", "openai"), ("o3-mini", "openai"), ("OpenAI/gpt", "openai"), ("my-gpt", "unknown"),
    ("claude-opus-4.7", "claude"), ("anthropic/claude", "claude"), ("deepseek-r1", "deepseek"),
    ("gemini-2.5-pro", "gemini"), ("glm-4", "glm"), ("zhipu-x", "glm"), ("llama-3-8b", "llama"),
    ("qwen3", "qwen"), ("kimi-k2", "qwen"), ("mistral-large", "unknown"), ("", "unknown"),
])
def test_family(spark, model, family):
    assert one(spark, tk.model_family("m"), m=model) == family


@pytest.mark.parametrize("model,flag", [
    ("claude-opus-4.7", True), ("claude-4.10", True), ("claude-3.5-sonnet", False),
    ("claude-4-20260701", False), ("opus-4.7", False), ("gpt-4.7", False),
])
def test_claude_47_plus(spark, model, flag):
    assert one(spark, tk.claude_47_plus("m"), m=model) is flag


def test_glm_warning(spark):
    w = one(spark, tk.token_warning("t", "m"), t="Hello world", m="glm-4")
    assert "GLM" in w
    assert one(spark, tk.token_warning("t", "m"), t="Hello world", m="gpt-4o") is None


def test_claude_warning_only_with_tokenizer(spark):
    assert one(spark, tk.token_warning("t", "m"), t="hi", m="claude-opus-4.7") is None
    w = one(spark, tk.token_warning("t", "m", ("claude",)), t="hi", m="claude-opus-4.7")
    assert w == tk.CLAUDE_47_WARNING


def test_estimate_cost(spark):
    df = spark.createDataFrame([(1000, 500, 2000, 100)], "i long, o long, cr long, cw long")
    v = df.select(tk.estimate_cost("i", "o", "cr", "cw", F.lit(0.00001), F.lit(0.00003), F.lit(0.000001),
                                   F.lit(0.00001)).alias("c")).first()["c"]
    assert v == pytest.approx(0.028)


def test_total_tokens(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "a long, b long, c long, d long, e long")
    assert df.select(tk.total_tokens("a", "b", "c", "d", "e").alias("t")).first()["t"] == 15


def test_large_output_threshold(spark):
    df = spark.createDataFrame([("x" * 10239,), ("x" * 10240,)], "t string")
    assert [r["f"] for r in df.select(tk.is_large_output("t").alias("f")).collect()] == [False, True]


def test_tokenizer_udf_hook(spark):
    udf = tk.tokenizer_udf(lambda: {"openai": lambda s: len(s.split())})
    df = spark.createDataFrame([("a b c", "openai"), ("a b", "gemini")], "t string, f string")
    got = [r["n"] for r in df.select(udf("t", "f").alias("n")).collect()]
    assert got == [3, None]
