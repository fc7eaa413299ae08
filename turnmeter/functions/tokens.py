"""Heuristic token counts and cost arithmetic.

Counts are ``ceil(utf8_bytes / ratio)`` with a per-family ratio, written as
native ``when`` chains so they run inside codegen for every row of a table.
Exact vocabularies are not bundled; a caller may plug an Arrow-batched
tokenizer in through :func:`tokenizer_udf` (X1).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Model-family tests, checked in this order; the first that
# matches names the family. OpenAI is tested on the lower-cased id.
OPENAI_RE = r"^(gpt|openai|o[1-9])"
FAMILY_RULES = [
    ("claude", r"(?i)claude|anthropic"),
    ("deepseek", r"(?i)deepseek"),
    ("gemini", r"(?i)gemini"),
    ("glm", r"(?i)glm|zhipu"),
    ("llama", r"(?i)llama"),
    ("qwen", r"(?i)qwen|kimi"),
]

# Bytes-per-token fallback ratios, first match wins, default 3.8.
FALLBACK_RATIOS = [
    (r"(?i)claude|anthropic", 3.5),
    (r"(?i)deepseek", 3.8),
    (r"(?i)glm|zhipu", 3.8),
    (r"(?i)llama|mistral", 3.8),
    (r"(?i)qwen|kimi", 3.8),
    (r"(?i)gemini", 4.0),
    (r"(?i)grok", 4.0),
]
DEFAULT_RATIO = 3.8

# Per-family ratios that bypass the fallback table.
FAMILY_RATIOS = {"gemini": 4.0, "llama": 3.8, "qwen": 3.8}

# Warning texts.
GLM_WARNING = "GLM 5.x tokenizer may differ from ChatGLM3 base vocab"
CLAUDE_47_WARNING = "Claude 4.7+ uses a new tokenizer; count may be slightly low"
CLAUDE_VERSION_RE = r"(?i)claude.*?(\d+)\.(\d+)"

# Fixed value: large-output threshold in bytes (outputs at or above it are flagged).
COMPRESS_THRESHOLD_BYTES = 10_240


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def model_family(model) -> Column:
    """Family label of a model id (P1); 'unknown' when nothing matches."""
    m = F.coalesce(_c(model), F.lit(""))
    expr = F.when(F.lower(m).rlike(OPENAI_RE), F.lit("openai"))
    for name, pattern in FAMILY_RULES:
        expr = expr.when(m.rlike(pattern), F.lit(name))
    return expr.otherwise(F.lit("unknown"))


def fallback_ratio(model) -> Column:
    """Bytes per token from the fallback table (P3), a DOUBLE."""
    m = F.coalesce(_c(model), F.lit(""))
    expr = None
    for pattern, ratio in FALLBACK_RATIOS:
        cond = m.rlike(pattern)
        expr = F.when(cond, F.lit(float(ratio))) if expr is None else expr.when(cond, F.lit(float(ratio)))
    return expr.otherwise(F.lit(float(DEFAULT_RATIO)))


def token_ratio(model, family=None) -> Column:
    """Bytes per token used for the heuristic count of ``model``.

    Pass an already computed ``family`` column to skip re-matching the id.
    """
    fam = model_family(model) if family is None else _c(family)
    expr = None
    for name, ratio in FAMILY_RATIOS.items():
        cond = fam == name
        expr = F.when(cond, F.lit(float(ratio))) if expr is None else expr.when(cond, F.lit(float(ratio)))
    return expr.otherwise(fallback_ratio(model))


def utf8_bytes(text) -> Column:
    """UTF-8 byte length."""
    return F.octet_length(_c(text))


def estimate_tokens(text, model) -> Column:
    """Heuristic token count (P2/P6): 0 for NULL or empty text."""
    return tokens_at_ratio(text, token_ratio(model))


def tokens_at_ratio(text, ratio) -> Column:
    """Token count for a precomputed bytes-per-token ``ratio`` column.

    Operators that count several texts of one row compute the ratio once
    (a column) and reuse it, so the model-id matching runs once per row.
    """
    t = _c(text)
    count = F.ceil(F.octet_length(t) / _c(ratio)).cast("bigint")
    return F.when(t.isNull() | (t == ""), F.lit(0).cast("bigint")).otherwise(count)


def tokens_of_bytes(n_bytes, ratio) -> Column:
    """Token count of a text of ``n_bytes`` UTF-8 bytes; 0 for NULL and for no bytes."""
    return F.coalesce(F.ceil(_c(n_bytes) / _c(ratio)).cast("bigint"), F.lit(0).cast("bigint"))


def claude_47_plus(model) -> Column:
    """Dotted Claude version with major 4 and minor >= 7 (P5)."""
    m = F.coalesce(_c(model), F.lit(""))
    major = F.regexp_extract(m, CLAUDE_VERSION_RE, 1).try_cast("bigint")
    minor = F.regexp_extract(m, CLAUDE_VERSION_RE, 2).try_cast("bigint")
    return F.coalesce(m.rlike(CLAUDE_VERSION_RE) & (major == 4) & (minor >= 7), F.lit(False))


def token_method(text, model, tokenizer_families: tuple[str, ...] = ()) -> Column:
    """How a count was derived.

    Without a plugged tokenizer every non-empty text is 'heuristic' -- the
    ratios are never labelled exact. Families listed in
    ``tokenizer_families`` report 'exact' (openai) or 'near-exact'.
    """
    t = _c(text)
    fam = model_family(model)
    expr = F.when(t.isNull() | (t == ""), F.lit("exact"))
    if "openai" in tokenizer_families:
        expr = expr.when(fam == "openai", F.lit("exact"))
    for name in ("claude", "deepseek"):
        if name in tokenizer_families:
            expr = expr.when(fam == name, F.lit("near-exact"))
    return expr.otherwise(F.lit("heuristic"))


def token_warning(text, model, tokenizer_families: tuple[str, ...] = ()) -> Column:
    """Warning label (P5): GLM always; Claude 4.7+ only when its tokenizer ran."""
    t = _c(text)
    fam = model_family(model)
    expr = F.when(t.isNull() | (t == ""), F.lit(None).cast("string"))
    if "claude" in tokenizer_families:
        expr = expr.when((fam == "claude") & claude_47_plus(model), F.lit(CLAUDE_47_WARNING))
    return expr.when(fam == "glm", F.lit(GLM_WARNING)).otherwise(F.lit(None).cast("string"))


def estimate_cost(input_tokens, output_tokens, cache_read_tokens, cache_write_tokens,
                  cost_input, cost_output, cost_cache_read, cost_cache_write) -> Column:
    """Sum of tokens times per-token rate, left to right."""
    return (_c(input_tokens) * _c(cost_input) + _c(output_tokens) * _c(cost_output)
            + _c(cache_read_tokens) * _c(cost_cache_read)
            + _c(cache_write_tokens) * _c(cost_cache_write))


def total_tokens(input_tokens, output_tokens, reasoning_tokens, cache_read_tokens,
                 cache_write_tokens) -> Column:
    """input + output + reasoning + cache read + cache write."""
    return (_c(input_tokens) + _c(output_tokens) + _c(reasoning_tokens)
            + _c(cache_read_tokens) + _c(cache_write_tokens))


def is_large_output(text) -> Column:
    """Output at or above the 10 KiB threshold (P13); size is uncompressed."""
    return F.octet_length(_c(text)) >= COMPRESS_THRESHOLD_BYTES


def tokenizer_udf(load: Callable[[], dict[str, Callable[[str], int]]]):
    """Wrap user-supplied exact tokenizers as an Arrow-batched UDF.

    ``load`` runs once per Python worker and returns ``{family: encode_len}``.
    The UDF takes (text, family) and yields the exact count, or NULL when no
    tokenizer exists for the family, so callers can ``coalesce`` with
    :func:`estimate_tokens`.
    """
    @F.pandas_udf(T.LongType())
    def _count(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        encoders = load()
        for text, family in batches:
            out = []
            for t, fam in zip(text, family):
                enc = encoders.get(fam)
                if enc is None or t is None:
                    out.append(None)
                else:
                    try:
                        out.append(int(enc(t)) if t else 0)
                    except Exception:  # fall back to the heuristic for this row
                        out.append(None)
            yield pd.Series(out, dtype="Int64")

    return _count


def with_token_counts(df, text, model, load: Callable[[], dict[str, Callable[[str], int]]]):
    """Token counts with tokenizers by family where there are any.

    Adds token_count, token_method and token_warning. ``load`` is that of
    :func:`tokenizer_udf`; texts that their family's tokenizer cannot count, and
    families without one, are counted by bytes and say so.
    """
    t, m = _c(text), _c(model)
    family = model_family(m)
    counted = df.withColumn("_exact", tokenizer_udf(load)(t, family))
    own, empty = F.col("_exact").isNotNull(), t.isNull() | (t == "")
    method = (F.when(empty | (own & (family == "openai")), F.lit("exact")).when(own, F.lit("near-exact"))
              .otherwise(F.lit("heuristic")))
    warning = F.when(empty, F.lit(None)).when(own & claude_47_plus(m), F.lit(CLAUDE_47_WARNING)).when(
        family == "glm", F.lit(GLM_WARNING))
    return (counted.withColumns({"token_count": F.coalesce("_exact", estimate_tokens(t, m)), "token_method": method,
                                 "token_warning": warning}).drop("_exact"))
