"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, decontam, divergence, html_text, lm_score, packing, passages, quality_ftrl, rule_cascade, secrets,
               sharding, simhash, token_count)

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 4-word shingles, 4 bits."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that documents share, four words of five agreeing."""
    found = passages.repeated_passages(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "start", "end", F.col("other_id").alias("other_doc_id"),
                        "other_start", "other_end", "n_equal", "n_steps", "component_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    pieces = packing.pack_documents(_table(spark, sf_dir, "documents"), VOCABULARY)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into shards 0 to 39 by jump consistent hashing of doc_id."""
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), 40)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-likelihood of every document; rows whose id falls in fold 2 of 7 are never learnt from."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    found = lm_score.score_documents(_table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                        "base_score", "score")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document and the verdict of the rule cascade."""
    docs = _table(spark, sf_dir, "documents")
    rules = rule_cascade.order(rule_cascade.RULES, rule_cascade.estimate(docs, rule_cascade.RULES))
    v = docs.select("doc_id", rule_cascade.verdict("text", rules, statistics=True).alias("v"))
    failed = (F.col("v.n_words") < 50) | (100 * F.col("v.n_repeat_words") > 50 * F.col("v.n_words"))
    return v.select("doc_id", *[f"v.{n}" for n in rule_cascade.STATISTICS], failed.alias("base_failed"), "v.kept")


# Symbols and blanks as in the operator; a word of the contract is a run of non-blanks.
_WORD = r"[^\x20\x09-\x0D]+"

OP6_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, doc_id, t, regexp_extract_all(t, '{_WORD}') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM d),
g AS (SELECT k, unnest(range(1, len(ws) - 1)) AS i,
        unnest(list_transform(range(1, len(ws) - 1), lambda i: list_slice(ws, i, i + 2))) AS g FROM w WHERE len(ws) >= 3),
m AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM g) WHERE c > 1),
r AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM m) GROUP BY k),
s AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
        length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, len(ls) AS n_lines,
        len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_stutters
      FROM w LEFT JOIN r USING (k)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_upper > 3 * word_chars OR 2 * word_chars < 5 * n_words
            OR word_chars > 12 * n_words OR 10 * n_dup_lines > 4 * n_lines OR 10 * n_stutters > 3 * n_words) AS kept
FROM f"""


def op7_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by heap-and-linked-list merging."""
    docs = _table(spark, sf_dir, "documents")
    return (docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
                        token_count.token_count("text", VOCABULARY).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > 2048))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; rows whose id falls in fold 2 of 4 are never learnt from."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    weights = quality_ftrl.fit(docs, labels.where(~held_out))
    return (docs.select("doc_id", held_out.alias("held_out"), quality_ftrl.score_column(docs, weights).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.7).cast("int")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    found = decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


_OP9_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP9_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_OP9_WORDS} AS ws FROM documents),
b AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM (SELECT item_id, {_OP9_WORDS} AS ws FROM benchmark)),
iw AS (SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(ws) - n + 2),
        lambda i: array_to_string(list_slice(ws, i, i + n - 1), ' '))) AS w FROM b WHERE n > 0),
dw AS (SELECT k, n, unnest(range(1, len(ws) - n + 2)) AS s, unnest(list_transform(range(1, len(ws) - n + 2),
        lambda i: array_to_string(list_slice(ws, i, i + n - 1), ' '))) AS w
      FROM d, (SELECT DISTINCT n FROM iw) WHERE len(ws) >= n),
h AS (SELECT k, s, n, item_id FROM dw JOIN iw USING (n, w)),
x AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(s, s + n)) AS p FROM h) GROUP BY k),
y AS (SELECT k, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
      FROM (SELECT DISTINCT k, item_id::VARCHAR AS i FROM h WHERE item_id IS NOT NULL) GROUP BY k)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN x USING (k) LEFT JOIN y USING (k)"""


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    docs = _table(spark, sf_dir, "documents")
    found = docs.select("doc_id", secrets.scan(F.col("text")).alias("s"))
    base = F.col("s.base")
    return found.select("doc_id", *[secrets.count_of(base, k).alias(f"n_{k}") for k in secrets.KINDS[:3]],
                        F.sha2(secrets.as_text(base), 256).alias("base_sha256"),
                        secrets.as_text(F.col("s.spans")).alias("spans"))


def _either_case_sql(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# Patterns, window and thresholds as in the operator, written out anew.
_ASSIGN_SQL = ("(" + _either_case_sql("password|passwd|secret|token|api_?key")
               + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")

def _blanked(text: str) -> str:
    """SQL for a text with the allow-list's strings replaced by blanks of their length."""
    for pattern, blanks in (("[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", 36), ("[Ee][Xx][Aa][Mm][Pp][Ll][Ee]", 7),
                            ("[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]", 11), ("[Yy][Oo][Uu][Rr][_-]", 5),
                            ("[Aa][Bb][Cc][Dd][Ee][Ff][Gg][Hh][Ii][Jj]", 10),
                            ("[Kk][Ll][Mm][Nn][Oo][Pp][Qq][Rr][Ss][Tt]", 10), ("0123456789", 10)):
        text = f"regexp_replace({text}, '{pattern}', repeat(' ', {blanks}), 'g')"
    return text


OP10_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t, {_blanked("coalesce(text, '')")} AS bl
      FROM documents),
p AS (SELECT * FROM (VALUES ('assign', 0, '{_ASSIGN_SQL}'), ('access', 1, 'AKIA[A-Z0-9]+'), ('hex', 2, '[0-9a-f]+'),
      ('cand', 3, '[A-Za-z0-9+/_=-]+')) v(kind, rank, re)),
h AS (SELECT k, t, kind, rank, CASE kind WHEN 'assign' THEN regexp_extract_all(t, '{_ASSIGN_SQL}', 0)
        WHEN 'access' THEN regexp_extract_all(t, 'AKIA[A-Z0-9]+') WHEN 'hex' THEN regexp_extract_all(t, '[0-9a-f]+')
        ELSE regexp_extract_all(bl, '[A-Za-z0-9+/_=-]+') END AS hits,
      CASE kind WHEN 'assign' THEN string_split_regex(t, '{_ASSIGN_SQL}')
        WHEN 'access' THEN string_split_regex(t, 'AKIA[A-Z0-9]+') WHEN 'hex' THEN string_split_regex(t, '[0-9a-f]+')
        ELSE string_split_regex(bl, '[A-Za-z0-9+/_=-]+') END AS gaps FROM d, p),
u AS (SELECT k, kind, rank, unnest(range(1, len(hits) + 1)) AS i, unnest(hits) AS hit,
        unnest(gaps[1:len(hits)]) AS gap FROM h),
s AS (SELECT k, kind, rank, i, hit, sum(length(gap) + length(hit)) OVER (PARTITION BY k, kind ORDER BY i) AS e FROM u),
base AS (SELECT k, kind, rank, (e - length(hit))::BIGINT AS b, e::BIGINT AS e FROM s WHERE
        kind = 'assign' AND length(regexp_extract(hit, '^{_ASSIGN_SQL}', 2)) >= 12
        OR kind = 'access' AND length(hit) >= 18 OR kind = 'hex' AND length(hit) >= 16),
sk AS (SELECT k, hit, e, CASE WHEN regexp_matches(hit, '^sha1[-_=]') THEN 45 WHEN regexp_matches(hit, '^sha256[-_=]') THEN 71
        WHEN regexp_matches(hit, '^sha384[-_=]') THEN 103 WHEN regexp_matches(hit, '^sha512[-_=]') THEN 135 ELSE 0 END AS skip
      FROM s WHERE kind = 'cand' AND length(hit) >= 20),
cand AS (SELECT k, substring(hit, skip + 1) AS hit, (e - length(hit) + skip)::BIGINT AS b, e::BIGINT AS e
      FROM sk WHERE length(hit) - skip >= 20),
c AS (SELECT row_number() OVER () AS c, * FROM cand x
      WHERE NOT EXISTS (SELECT 1 FROM base y WHERE y.k = x.k AND y.b <= x.b AND x.e <= y.e)),
o AS (SELECT c, k, b, unnest(range(0, length(hit) - 19)) AS o, hit FROM c),
win AS (SELECT c, k, b, o, substring(hit, o + 1, 20) AS win FROM o),
w AS (SELECT c, k, b, o, win, CASE WHEN regexp_matches(win, '^[0-9=_/+-]+$') THEN NULL
        WHEN regexp_matches(win, '^([a-z=_/+-]+|[A-Z=_/+-]+)$') THEN NULL
        WHEN regexp_matches(win, '^([0-9a-f]+|[0-9A-F]+)$') THEN 2.9
        WHEN regexp_matches(win, '^[A-Za-z=_/+-]+$') THEN 3.9 WHEN regexp_matches(win, '^[A-Za-z0-9]+$') THEN 3.55
        WHEN length(regexp_replace(win, '[^0-9]', '', 'g')) <= 2
          AND NOT (regexp_matches(win, '[a-z]') AND regexp_matches(win, '[A-Z]')) THEN NULL ELSE 3.85 END AS least FROM win),
ch AS (SELECT c, k, b, least, o, unnest(string_split(win, '')) AS x FROM w WHERE least IS NOT NULL),
n AS (SELECT c, k, b, least, o, x, count(*) AS n FROM ch GROUP BY ALL),
ent AS (SELECT c, k, b, least, o, -sum(n / 20 * log2(n / 20)) AS h FROM n GROUP BY ALL),
added AS (SELECT k, 'entropy' AS kind, 3 AS rank, (min(b + o))::BIGINT AS b, (max(b + o + 20))::BIGINT AS e
      FROM ent WHERE h >= least GROUP BY c, k),
t1 AS (SELECT k, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex, string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, rank) AS spans
      FROM base GROUP BY k),
t2 AS (SELECT k, string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, rank) AS spans
      FROM (SELECT * FROM base UNION ALL SELECT * FROM added) GROUP BY k)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(t1.spans, '')) AS base_sha256, coalesce(t2.spans, '') AS spans
FROM d LEFT JOIN t1 USING (k) LEFT JOIN t2 USING (k)"""


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language stand apart, and the terms by which each exceeds its language."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT k, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source, coalesce(v, 0) AS v FROM d LEFT JOIN v USING (lang)),
n AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM c GROUP BY ALL),
cell AS (SELECT g.lang, g.source, kept.term, coalesce(c, 0) AS c,
        1 + (1000000000::HUGEINT * (coalesce(c, 0) + 2)) // (coalesce(n, 0) + 2 * g.v) AS p
      FROM g JOIN kept ON kept.lang = g.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
        LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(c) + 2)) // (sum(sum(c)) OVER (PARTITION BY lang) + 2 * any_value(v)) AS q
      FROM c JOIN v USING (lang) GROUP BY lang, term),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
        SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS f
        FROM cell x JOIN cell y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
      ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
      FROM cell JOIN q USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
      FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10"""


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens under two tokenizers, aligned, and how its links stand in the corpus."""
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align_documents(_table(spark, sf_dir, "documents"), *paths)


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", html_text.main_text("html").alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("bigint"))


LLM_QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_passages": op2_passages,
    "op3_packing": op3_packing,
    "op4_sharding": op4_sharding,
    "op5_lm_score": op5_lm_score,
    "op6_quality_rules": op6_quality_rules,
    "op7_token_count": op7_token_count,
    "op8_quality": op8_quality,
    "op9_decontamination": op9_decontamination,
    "op10_secrets": op10_secrets,
    "op11_divergence": op11_divergence,
    "op12_alignment": op12_alignment,
    "op13_html_text": op13_html_text,
}

LLM_ORACLE_SQL: dict[str, str] = {
    "op6_quality_rules": OP6_SQL,
    "op9_decontamination": OP9_SQL,
    "op10_secrets": OP10_SQL,
    "op11_divergence": OP11_SQL,
}
