"""Retrieval relevance scoring.

Scores are computed on the (finished message, completed call) row produced by
an equi-join on message_id; the containment tests inside the pair are
higher-order array functions over that row, so no pairs are ever formed
beyond the calls a message really made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import tokens as tk

RELEVANCE_COLUMNS = ["session_id", "message_id", "tool_call_id", "tool", "fetched_tokens",
                     "fetched_lines", "referenced_tokens", "referenced_lines", "relevance_ratio",
                     "scoring_method", "timestamp"]


#: From so many needles times characters of the text on, the text's 4-grams are indexed before needles are looked for.
INDEX_FROM = 20_000_000
GRAM = 4


def contained(needles: Column, text: Column, index_from: int = INDEX_FROM) -> Column:
    """The elements of ``needles`` that ``text`` contains (J7, F10), in their order.

    A search costs the length of the text, so many needles in a long text are first looked up by
    their first four characters among the text's distinct 4-grams, which are made once; only those found are searched
    for. Needles that are shorter, or whose first four are not all ASCII, are always searched for. The
    result is the same on both ways; ``index_from`` only says which is taken.
    """
    def first(needle: Column) -> Column:
        return F.substring(needle, 1, GRAM)

    chars = F.split(text, "")
    grams = F.transform(F.arrays_zip(*[F.slice(chars, k + 1, F.greatest(F.size(chars) - k, F.lit(0))).alias(f"c{k}")
                                       for k in range(GRAM)]), lambda g: F.concat(*[g[f"c{k}"] for k in range(GRAM)]))
    # a struct in an array of one: what is bound in it is worked out once, not for each needle
    bound = F.array(F.struct(needles.alias("needles"), text.alias("text"),
                             F.array_intersect(F.transform(needles, first), grams).alias("present")))

    def searched(x: Column) -> Column:
        def found(needle: Column) -> Column:
            unsure = (F.length(needle) < GRAM) | (F.octet_length(first(needle)) > GRAM)
            return (unsure | F.array_contains(x["present"], first(needle))) & F.contains(x["text"], needle)
        return F.filter(x["needles"], found)

    large = F.size(needles) * F.length(text).cast("bigint") >= index_from
    return F.when(large, F.transform(bound, searched)[0]).otherwise(F.filter(needles, lambda n: F.contains(text, n)))


def line_overlap(output: Column, response: Column, model: Column | None = None,
                 ratio: Column | None = None) -> Column:
    """Struct(fetched_lines, referenced_lines, referenced_tokens, relevance_ratio) (A10).

    Output lines (trimmed, non-empty) of at least 4 UTF-16 units count as
    referenced when the response contains them; shorter lines count only as
    fetched. Referenced tokens are the count of the matched lines joined by
    newline; the ratio is against the count of the whole output, capped at 1.
    """
    ratio = tk.token_ratio(model) if ratio is None else ratio
    lines = tx.to_lines(output)
    matched = contained(F.filter(lines, lambda l: tx.utf16_len_at_least(l, 4)), response)
    ref_tokens = F.when(F.size(matched) > 0,
                        tk.tokens_at_ratio(F.array_join(matched, "\n"), ratio)).otherwise(F.lit(0).cast("bigint"))
    fetched = tk.tokens_at_ratio(output, ratio)
    ratio = F.when(fetched > 0, F.least(F.lit(1.0), ref_tokens / fetched)).otherwise(F.lit(0.0))
    return F.struct(F.size(lines).cast("bigint").alias("fetched_lines"),
                    F.size(matched).cast("bigint").alias("referenced_lines"),
                    ref_tokens.alias("referenced_tokens"),
                    ratio.alias("relevance_ratio"))


def substring_match(output: Column, response: Column, model: Column | None = None,
                    ratio: Column | None = None) -> Column:
    """Struct(referenced_tokens, fetched_tokens, relevance_ratio).

    Tokens (quoted strings, paths, identifiers) are extracted from the tool
    output; the share of their UTF-16 length found in the response scales the
    output's token count (rounded half up).
    """
    ratio = tk.token_ratio(model) if ratio is None else ratio
    toks = tx.extract_tokens(output)
    fetched = tk.tokens_at_ratio(output, ratio)
    zero = F.lit(0).cast("bigint")
    total_chars = F.aggregate(toks, zero, lambda acc, t: acc + tx.utf16_len(t))
    matched_chars = F.aggregate(contained(toks, response), zero, lambda acc, t: acc + tx.utf16_len(t))
    match_ratio = F.when(total_chars > 0, matched_chars / total_chars).otherwise(F.lit(0.0))
    empty = (F.size(toks) == 0) | (fetched == 0)
    ref_tokens = F.when(empty, zero).otherwise(tx.js_round(fetched * match_ratio).cast("bigint"))
    ratio = F.when(empty, F.lit(0.0)).otherwise(F.least(F.lit(1.0), match_ratio))
    return F.struct(ref_tokens.alias("referenced_tokens"), fetched.alias("fetched_tokens"),
                    ratio.alias("relevance_ratio"))


def scorable_pairs(finished: DataFrame, calls: DataFrame) -> DataFrame:
    """Finished messages joined to their completed calls with output.

    ``finished``: message_id, session_id, model_id, response_text, ts_ms.
    ``calls``: id, message_id, tool, status, output_text, output_estimated_tokens.
    One row per (finish event, call); repeated finish events repeat rows.
    """
    f = (finished.select("message_id", "session_id", "model_id", "response_text", "ts_ms")
         .where(tx.js_trim("response_text") != ""))
    c = (calls.where((F.col("status") == "completed") & F.col("output_text").isNotNull()
                     & (F.col("output_text") != ""))
         .select(F.col("id").alias("tool_call_id"), "message_id", "tool", "output_text",
                 "output_estimated_tokens"))
    return f.join(c, "message_id")


def score_tool_calls(finished: DataFrame, calls: DataFrame, method: str = "auto") -> DataFrame:
    """``retrieval_relevance`` rows (A12); method by tool name (P16) or forced.

    ``method``: 'auto' (line overlap for file-read tools, else substring
    match), 'line-overlap' or 'substring-match'.
    """
    pairs = scorable_pairs(finished, calls).withColumn("_ratio", tk.token_ratio("model_id"))
    out, resp, ratio = F.col("output_text"), F.col("response_text"), F.col("_ratio")
    fetched_tokens = F.coalesce(F.col("output_estimated_tokens"), tk.tokens_at_ratio(out, ratio))
    head = ["session_id", "message_id", "tool_call_id", "tool", fetched_tokens.alias("fetched_tokens"),
            F.size(tx.to_lines(out)).cast("bigint").alias("fetched_lines")]
    tail = F.col("ts_ms").alias("timestamp")

    nothing = F.lit(None).cast("bigint")
    lo, sm = line_overlap(out, resp, ratio=ratio), substring_match(out, resp, ratio=ratio)
    by_lines = F.struct(lo["referenced_tokens"].alias("referenced_tokens"), lo["referenced_lines"].alias("referenced_lines"),
                        lo["relevance_ratio"].alias("relevance_ratio"), F.lit("line-overlap").alias("scoring_method"))
    by_substrings = F.struct(sm["referenced_tokens"].alias("referenced_tokens"), nothing.alias("referenced_lines"),
                             sm["relevance_ratio"].alias("relevance_ratio"),
                             F.lit("substring-match").alias("scoring_method"))
    scored = {"line-overlap": by_lines, "substring-match": by_substrings}.get(
        method, F.when(tx.is_file_read_tool("tool"), by_lines).otherwise(by_substrings))
    # inline() holds the one scorer that a row needs, evaluated once, apart from the columns read from it
    return pairs.select(*head, tail, F.inline(F.array(scored))).select(*RELEVANCE_COLUMNS)
