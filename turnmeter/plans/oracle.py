"""DuckDB SQL twins of :mod:`turnmeter.plans.catalog` (the correctness oracle).

Each statement reads the pre-registered driver views and computes the same
columns with plain SQL: window functions where the Spark side uses grouped
struct aggregates, list lambdas where it uses higher-order functions, and
RE2 ``\\b`` patterns where the JVM needs explicit ASCII look-arounds.
"""

from __future__ import annotations

from ..functions import text as tx
from ..functions import tokens as tk
from ..sources import bindings as b

D = 9  # rounding digits, as in the catalog

# JavaScript trim set, spelled with chr() so the SQL text stays ASCII.
WS = "||".join(f"chr({ord(c)})" for c in tx.JS_WHITESPACE)
NL = "chr(10)"

# Token patterns in RE2 form: \b is ASCII there, as in JavaScript.
PATH_RE2 = r"\b([\w./-]{4,}\.(?:ts|js|py|go|rs|md|json|yaml|yml|sh))\b"
IDENT_RE2 = r"\b([a-zA-Z][a-zA-Z0-9_]{5,})\b"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def model_for(key: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {q(m)}" for i, m in enumerate(b.MODEL_IDS))
    return f"(CASE (({key}) % {len(b.MODEL_IDS)}) {arms} END)"


def family(m: str) -> str:
    mm = f"coalesce({m}, '')"
    arms = [f"WHEN regexp_matches(lower({mm}), {q(tk.OPENAI_RE)}) THEN 'openai'"]
    arms += [f"WHEN regexp_matches({mm}, {q(p)}) THEN {q(n)}" for n, p in tk.FAMILY_RULES]
    return "(CASE " + " ".join(arms) + " ELSE 'unknown' END)"


def fallback_ratio(m: str) -> str:
    mm = f"coalesce({m}, '')"
    arms = " ".join(f"WHEN regexp_matches({mm}, {q(p)}) THEN {r}::DOUBLE" for p, r in tk.FALLBACK_RATIOS)
    return f"(CASE {arms} ELSE {tk.DEFAULT_RATIO}::DOUBLE END)"


def ratio(m: str) -> str:
    fam = family(m)
    arms = " ".join(f"WHEN {q(n)} THEN {r}::DOUBLE" for n, r in tk.FAMILY_RATIOS.items())
    return f"(CASE {fam} {arms} ELSE {fallback_ratio(m)} END)"


def tokens(t: str, m: str) -> str:
    return f"(CASE WHEN ({t}) IS NULL OR ({t}) = '' THEN 0::BIGINT ELSE CAST(ceil(strlen({t}) / {ratio(m)}) AS BIGINT) END)"


def jstrim(x: str) -> str:
    return f"trim({x}, {WS})"


def u16(x: str) -> str:
    return f"(length({x}) + length(regexp_replace({x}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"


def to_lines(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, {NL}), lambda z: {jstrim('z')}), lambda z: z <> '')"


def ms(c: str) -> str:
    # truncating, like Spark's unix_millis (DuckDB's epoch_ms rounds)
    return f"(epoch_us({c}) // 1000)"


def jround(x: str) -> str:
    return f"floor(({x}) + 0.5)"


def week_msg(user: str, ts: str) -> str:
    return f"(CAST({user} AS VARCHAR) || ':' || CAST(CAST(floor({ms(ts)} / {b.WEEK_MS}) AS BIGINT) AS VARCHAR))"


# ---- building blocks (CTE bodies) -----------------------------------------

LINEITEM_DEDUP = """
SELECT l_orderkey, l_linenumber, ship_ms, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus
FROM (SELECT *, (epoch_us(l_shipdate) // 1000) AS ship_ms,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                ORDER BY (epoch_us(l_shipdate) // 1000) DESC, l_partkey DESC, l_suppkey DESC,
                                         l_quantity DESC, l_extendedprice DESC, l_discount DESC,
                                         l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
      FROM lineitem) WHERE rn = 1
"""

TOOL_CALLS = f"""
WITH s AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS call_id, {ms('o_orderdate')} AS ts, 0::BIGINT AS seq,
         CAST(o_custkey AS VARCHAR) AS session_id, CAST(o_orderkey AS VARCHAR) AS message_id,
         CASE o_orderstatus WHEN 'F' THEN 'read' WHEN 'O' THEN 'grep' ELSE 'bash' END AS tool,
         {model_for('o_custkey')} AS model_id,
         '{{"priority":"' || o_orderpriority || '"}}' AS input_json
  FROM orders),
e AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS call_id, {ms('l_shipdate')} AS ts, CAST(l_linenumber AS BIGINT) AS seq,
         CASE WHEN l_quantity >= 49 THEN 'error' ELSE 'completed' END AS status,
         repeat(l_returnflag || l_linestatus, CAST(l_quantity AS INTEGER)) AS output_text,
         NULL::VARCHAR AS title, l_returnflag = 'R' AS truncated,
         CASE WHEN l_quantity >= 49 THEN 'failed ' || l_returnflag END AS error_text
  FROM lineitem),
e2 AS (
  SELECT e.*, row_number() OVER (PARTITION BY e.call_id ORDER BY e.ts DESC, e.seq DESC, e.status DESC,
                                 strlen(e.output_text) DESC, e.truncated DESC, e.output_text DESC) AS rn
  FROM e JOIN s ON e.call_id = s.call_id
  WHERE e.ts > s.ts OR (e.ts = s.ts AND e.seq > s.seq))
SELECT s.call_id AS id, s.session_id, s.message_id, s.tool, s.ts AS timestamp_start,
       e2.ts AS timestamp_end, e2.ts - s.ts AS duration_ms,
       CASE WHEN e2.ts IS NOT NULL THEN e2.status ELSE 'pending' END AS status,
       s.input_json, CAST(strlen(s.input_json) AS BIGINT) AS input_size_bytes,
       {tokens('s.input_json', 's.model_id')} AS input_estimated_tokens,
       e2.output_text,
       CASE WHEN e2.ts IS NOT NULL THEN strlen(e2.output_text) >= {tk.COMPRESS_THRESHOLD_BYTES} ELSE false END
         AS output_compressed,
       CAST(strlen(e2.output_text) AS BIGINT) AS output_size_bytes,
       CASE WHEN e2.ts IS NOT NULL THEN {tokens('e2.output_text', 's.model_id')} END AS output_estimated_tokens,
       e2.title,
       CASE WHEN e2.ts IS NOT NULL THEN coalesce(e2.truncated, false) ELSE false END AS truncated,
       e2.error_text,
       CASE WHEN e2.ts IS NOT NULL THEN {tokens('e2.output_text', 's.model_id')} END AS next_turn_token_impact
FROM s LEFT JOIN e2 ON s.call_id = e2.call_id AND e2.rn = 1
"""

LATENCY = """
WITH ev AS (
  SELECT CAST(user_id AS VARCHAR) AS call_id,
         CASE event_type WHEN 'click' THEN 'before' ELSE 'after' END AS kind,
         (epoch_us(ts) // 1000) AS ts, event_id AS seq
  FROM events WHERE event_type IN ('click', 'view')),
l AS (
  SELECT *, lag(kind) OVER w AS pk, lag(ts) OVER w AS pts
  FROM ev WINDOW w AS (PARTITION BY call_id ORDER BY ts, seq))
SELECT call_id AS tool_call_id, call_id AS session_id, 'total' AS phase, ts - pts AS duration_ms,
       NULL::VARCHAR AS metadata_json, ts AS timestamp
FROM l WHERE kind = 'after' AND pk = 'before'
"""

TIMING = f"""
WITH ev AS (
  SELECT CAST(user_id AS VARCHAR) AS session_id, {week_msg('user_id', 'ts')} AS message_id,
         event_type, (epoch_us(ts) // 1000) AS ts, event_id AS seq
  FROM events),
parts AS (SELECT * FROM ev WHERE event_type <> 'error'),
seed AS (
  SELECT message_id, session_id, ts AS s_ts, seq AS s_seq FROM (
    SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY ts, seq) AS rn FROM parts) WHERE rn = 1),
ft AS (
  SELECT message_id, ts AS f_ts, seq AS f_seq FROM (
    SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY ts, seq) AS rn
    FROM parts WHERE event_type = 'view') WHERE rn = 1),
tl AS (SELECT message_id, min(ts) AS first_tool FROM parts WHERE event_type = 'click' GROUP BY message_id),
cmp AS (
  SELECT c.message_id, c.ts, c.seq FROM ev c JOIN seed s ON c.message_id = s.message_id
  WHERE c.event_type = 'error' AND (c.ts > s.s_ts OR (c.ts = s.s_ts AND c.seq > s.s_seq))),
done AS (SELECT message_id, min(ts) AS completed FROM cmp GROUP BY message_id),
lastc AS (
  SELECT message_id, ts AS l_ts, seq AS l_seq FROM (
    SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY ts DESC, seq DESC) AS rn FROM cmp) WHERE rn = 1)
SELECT s.message_id, s.session_id, s.s_ts AS request_sent, s.s_ts AS first_part_received,
       ft.f_ts AS first_text_received, tl.first_tool AS first_tool_call, done.completed AS message_completed,
       CASE WHEN done.completed IS NOT NULL AND ft.f_ts IS NOT NULL
                 AND (ft.f_ts < lastc.l_ts OR (ft.f_ts = lastc.l_ts AND ft.f_seq < lastc.l_seq))
            THEN ft.f_ts - s.s_ts END AS time_to_first_token_ms,
       CASE WHEN done.completed IS NOT NULL THEN done.completed - s.s_ts END AS total_streaming_ms
FROM seed s LEFT JOIN ft USING (message_id) LEFT JOIN tl USING (message_id)
     LEFT JOIN done USING (message_id) LEFT JOIN lastc USING (message_id)
"""


def _value_tokens(v: str) -> str:
    return (f"CAST(floor({v} * 100) AS BIGINT) AS tokens_input, CAST(floor({v} * 10) AS BIGINT) AS tokens_output, "
            f"CAST(floor({v}) AS BIGINT) AS tokens_reasoning, CAST(floor({v} * 50) AS BIGINT) AS tokens_cache_read, "
            f"CAST(floor({v} * 5) AS BIGINT) AS tokens_cache_write")


STEPS = f"""
SELECT id, session_id, message_id, timestamp, reason, round(cost, {D}) AS cost, tokens_input, tokens_output,
       tokens_reasoning, tokens_cache_read, tokens_cache_write
FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY timestamp DESC, seq DESC) AS rn FROM (
    SELECT CAST(user_id AS VARCHAR) || ':' || CAST(CAST(floor((epoch_us(ts) // 1000) / {b.DAY_MS}) AS BIGINT) AS VARCHAR) AS id,
           CAST(user_id AS VARCHAR) AS session_id, {week_msg('user_id', 'ts')} AS message_id,
           (epoch_us(ts) // 1000) AS timestamp, event_id AS seq,
           CASE WHEN value >= 50 THEN 'tool-calls' ELSE 'stop' END AS reason, value / 1000 AS cost,
           {_value_tokens('value')}
    FROM events WHERE event_type = 'purchase'))
WHERE rn = 1
"""

CONV_CALLS = f"""
SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS tool_call_id,
       CAST(conv_id AS VARCHAR) || ':' || CAST(turn + 1 AS VARCHAR) AS message_id,
       CAST(conv_id AS VARCHAR) AS session_id,
       CASE WHEN contains(text, {NL}) THEN 'read' ELSE 'grep' END AS tool,
       text AS output_text, {model_for('conv_id')} AS model_id,
       {tokens('text', model_for('conv_id'))} AS output_estimated_tokens
FROM conversations WHERE role <> 'assistant' AND text IS NOT NULL AND text <> ''
"""

CONV_FINISHED = """
SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS message_id, coalesce(text, '') AS response_text
FROM conversations WHERE role = 'assistant'
"""


def _line_overlap_cols(out: str, resp: str, m: str) -> dict[str, str]:
    lines = to_lines(out)
    matched = f"list_filter({lines}, lambda l: {u16('l')} >= 4 AND contains({resp}, l))"
    ref_tok = f"(CASE WHEN len({matched}) > 0 THEN {tokens(f'array_to_string({matched}, {NL})', m)} ELSE 0 END)"
    fetched = tokens(out, m)
    return {
        "referenced_tokens": ref_tok,
        "referenced_lines": f"CAST(len({matched}) AS BIGINT)",
        "relevance_ratio": f"(CASE WHEN {fetched} > 0 THEN least(1.0, {ref_tok} / {fetched}) ELSE 0.0 END)",
    }


def _substring_cols(out: str, resp: str, m: str) -> dict[str, str]:
    toks = (f"list_distinct(list_concat(list_transform(regexp_extract_all({out}, {q(tx.QUOTED_RE)}, 1), "
            f"lambda z: {jstrim('z')}), regexp_extract_all({out}, {q(PATH_RE2)}, 1), "
            f"regexp_extract_all({out}, {q(IDENT_RE2)}, 1)))")
    fetched = tokens(out, m)
    total = f"coalesce(list_sum(list_transform({toks}, lambda t: {u16('t')})), 0)"
    matched = f"coalesce(list_sum(list_transform(list_filter({toks}, lambda t: contains({resp}, t)), lambda t: {u16('t')})), 0)"
    mr = f"(CASE WHEN {total} > 0 THEN {matched} / {total} ELSE 0.0 END)"
    empty = f"(len({toks}) = 0 OR {fetched} = 0)"
    return {
        "referenced_tokens": f"(CASE WHEN {empty} THEN 0 ELSE CAST({jround(f'{fetched} * {mr}')} AS BIGINT) END)",
        "referenced_lines": "NULL::BIGINT",
        "relevance_ratio": f"(CASE WHEN {empty} THEN 0.0 ELSE least(1.0, {mr}) END)",
    }


def relevance_sql(method: str) -> str:
    lo = _line_overlap_cols("c.output_text", "f.response_text", "c.model_id")
    sb = _substring_cols("c.output_text", "f.response_text", "c.model_id")
    file_read = f"regexp_matches(c.tool, {q(tx.FILE_READ_TOOL_RE)})"

    def pick(col: str) -> str:
        if method == "line-overlap":
            return lo[col]
        if method == "substring-match":
            return sb[col]
        return f"(CASE WHEN {file_read} THEN {lo[col]} ELSE {sb[col]} END)"

    if method == "line-overlap":
        meth = "'line-overlap'"
    elif method == "substring-match":
        meth = "'substring-match'"
    else:
        meth = f"(CASE WHEN {file_read} THEN 'line-overlap' ELSE 'substring-match' END)"
    return f"""
WITH c AS ({CONV_CALLS}), f AS ({CONV_FINISHED})
SELECT c.session_id, c.message_id, c.tool_call_id, c.tool,
       coalesce(c.output_estimated_tokens, {tokens('c.output_text', 'c.model_id')}) AS fetched_tokens,
       CAST(len({to_lines('c.output_text')}) AS BIGINT) AS fetched_lines,
       {pick('referenced_tokens')} AS referenced_tokens,
       {pick('referenced_lines')} AS referenced_lines,
       round({pick('relevance_ratio')}, {D}) AS relevance_ratio,
       {meth} AS scoring_method
FROM f JOIN c ON f.message_id = c.message_id
WHERE {jstrim('f.response_text')} <> ''
"""


# ---- raw events: one CTE for all raw_* queries ------------------------------

RAW = f"""e AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS session_id, event_type AS kind, value,
         (epoch_us(ts) // 1000) AS ts, CAST(floor(value) AS BIGINT) AS n, {week_msg('user_id', 'ts')} AS message_id,
         CAST(user_id AS VARCHAR) || '#' || CAST((event_id // 2) % 3 AS VARCHAR) AS call_id,
         CASE WHEN event_type = 'signup' THEN {model_for('CAST(floor(value) AS BIGINT)')} END AS asked
  FROM events),
t AS (SELECT *, coalesce(last_value(asked IGNORE NULLS) OVER (
        PARTITION BY session_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS model FROM e),
s AS (SELECT * FROM (SELECT *, CASE WHEN n % 2 = 0 THEN 'read' ELSE 'grep' END AS tool, '{{"level":"' || n || '"}}' AS input_json,
        row_number() OVER (PARTITION BY call_id ORDER BY ts DESC, seq DESC) AS rn
        FROM t WHERE kind = 'click' AND seq % 2 = 0) WHERE rn = 1),
a AS (SELECT t.*, 'reply ' || repeat('to ', CAST(t.n % 9 AS INTEGER)) || t.seq AS output,
        row_number() OVER (PARTITION BY t.call_id ORDER BY t.ts DESC, t.seq DESC) AS rn
      FROM t JOIN s ON t.call_id = s.call_id AND (t.ts > s.ts OR (t.ts = s.ts AND t.seq > s.seq))
      WHERE t.kind = 'view' AND t.seq % 2 = 0),
calls AS (
  SELECT s.call_id AS id, s.session_id, s.message_id, s.tool, s.ts AS timestamp_start, a.ts AS timestamp_end,
         a.ts - s.ts AS duration_ms,
         CASE WHEN a.ts IS NULL THEN 'pending' WHEN a.n % 11 = 0 THEN 'error' ELSE 'completed' END AS status,
         s.input_json, CAST(strlen(s.input_json) AS BIGINT) AS input_size_bytes,
         {tokens('s.input_json', 's.model')} AS input_estimated_tokens, a.output AS output_text, false AS output_compressed,
         CAST(strlen(a.output) AS BIGINT) AS output_size_bytes,
         CASE WHEN a.ts IS NOT NULL THEN {tokens('a.output', 'a.model')} END AS output_estimated_tokens,
         NULL::VARCHAR AS title, coalesce(a.n % 7 = 0, false) AS truncated,
         CASE WHEN a.n % 11 = 0 THEN 'exit 1' END AS error_text,
         CASE WHEN a.ts IS NOT NULL THEN {tokens('a.output', 'a.model')} END AS next_turn_token_impact
  FROM s LEFT JOIN a ON a.call_id = s.call_id AND a.rn = 1),
done AS (
  SELECT message_id, session_id, ts, seq, n, value, {model_for('n')} AS model_id,
         'reply ' || seq || chr(10) || chr(10) || 'to to' AS response_text
  FROM e WHERE kind = 'error' AND seq % 5 <> 0 AND seq % 3 = 1)"""

RAW_TIMING = (TIMING.replace("WHERE event_type <> 'error'",
                             "WHERE event_type = 'purchase' OR (event_type IN ('click', 'view') AND seq % 2 = 1)")
              .replace("c.event_type = 'error'", "c.event_type = 'error' AND c.seq % 5 <> 0 AND c.seq % 3 = 1"))

RAW_ESTIMATES = f"""
WITH {RAW},
w AS (
  SELECT CAST(seq AS VARCHAR) AS message_id, session_id, 'char-ratio' AS approach, asked AS model_id, 0 AS input_tokens,
         0 AS output_tokens, 0 AS cache_read_tokens, 0 AS cache_write_tokens, 0 AS total_tokens, 0.0 AS estimated_cost,
         ts AS timestamp, seq FROM e WHERE kind = 'signup'
  UNION ALL
  SELECT message_id, session_id, 'opencode', model_id, n * 100, n * 10, n * 50, n * 5, n * 166, round(value / 100, {D}), ts, seq
  FROM done)
SELECT * EXCLUDE (seq, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY message_id, approach ORDER BY timestamp DESC, seq DESC) AS rn FROM w)
WHERE rn = 1"""


def raw_relevance_sql() -> str:
    lo = _line_overlap_cols("c.output_text", "f.response_text", "f.model_id")
    sb = _substring_cols("c.output_text", "f.response_text", "f.model_id")

    def pick(col: str) -> str:
        return f"(CASE WHEN c.tool = 'read' THEN {lo[col]} ELSE {sb[col]} END)"
    return f"""
WITH {RAW}
SELECT f.session_id, f.message_id, c.id AS tool_call_id, c.tool, c.output_estimated_tokens AS fetched_tokens,
       CAST(len({to_lines('c.output_text')}) AS BIGINT) AS fetched_lines, {pick('referenced_tokens')} AS referenced_tokens,
       {pick('referenced_lines')} AS referenced_lines, round({pick('relevance_ratio')}, {D}) AS relevance_ratio,
       CASE WHEN c.tool = 'read' THEN 'line-overlap' ELSE 'substring-match' END AS scoring_method, f.ts AS timestamp
FROM done f JOIN calls c ON c.message_id = f.message_id
WHERE c.status = 'completed' AND c.output_text <> ''"""


# ---- cost shares as of a step: over starts st, ends en and last steps sp -------

COST_ASOF = """pr AS (SELECT DISTINCT st.call_id, st.message_id AS probe_msg, sp.ts, sp.seq, sp.cost
       FROM st JOIN sp ON st.message_id = sp.message_id),
ls AS (
  SELECT call_id, probe_msg, cost, s_msg, s_ts, s_seq FROM (
    SELECT pr.call_id, pr.probe_msg, pr.cost, st.message_id AS s_msg, st.ts AS s_ts, st.seq AS s_seq,
           row_number() OVER (PARTITION BY pr.call_id, pr.probe_msg
                              ORDER BY st.ts DESC, st.seq DESC, st.message_id DESC) AS rn
    FROM pr JOIN st ON st.call_id = pr.call_id AND (st.ts < pr.ts OR (st.ts = pr.ts AND st.seq < pr.seq)))
  WHERE rn = 1),
le AS (
  SELECT call_id, probe_msg, e_ts, e_seq, bytes FROM (
    SELECT pr.call_id, pr.probe_msg, en.ts AS e_ts, en.seq AS e_seq, en.bytes,
           row_number() OVER (PARTITION BY pr.call_id, pr.probe_msg ORDER BY en.ts DESC, en.seq DESC) AS rn
    FROM pr JOIN en ON en.call_id = pr.call_id AND (en.ts < pr.ts OR (en.ts = pr.ts AND en.seq < pr.seq)))
  WHERE rn = 1),
at_t AS (
  SELECT ls.call_id, ls.probe_msg AS message_id, ls.cost, ls.s_ts, ls.s_seq, le.bytes
  FROM ls JOIN le ON ls.call_id = le.call_id AND ls.probe_msg = le.probe_msg
  WHERE ls.s_msg = ls.probe_msg AND (le.e_ts > ls.s_ts OR (le.e_ts = ls.s_ts AND le.e_seq > ls.s_seq))),
tot AS (SELECT message_id, CAST(sum(coalesce(bytes, 0)) AS BIGINT) AS tb, count(*) AS n FROM at_t GROUP BY message_id),
fin AS (
  SELECT call_id, message_id, ts, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY ts DESC, seq DESC, message_id DESC) AS rn FROM st)
  WHERE rn = 1)
SELECT fin.call_id, fin.message_id,
       CASE WHEN tot.tb = 0 THEN a.cost / tot.n ELSE (coalesce(a.bytes, 0) / tot.tb) * a.cost END AS cost_share
FROM fin LEFT JOIN at_t a ON a.call_id = fin.call_id AND a.message_id = fin.message_id
                         AND a.s_ts = fin.ts AND a.s_seq = fin.seq
     LEFT JOIN tot ON tot.message_id = a.message_id"""


# ---- per-query SQL ---------------------------------------------------------

def _sql() -> dict[str, str]:
    s: dict[str, str] = {}
    s["token_count_heuristic"] = f"""
WITH d AS (SELECT doc_id, text, {model_for('doc_id')} AS model_id FROM documents)
SELECT doc_id, model_id, {family('model_id')} AS family, {ratio('model_id')} AS ratio,
       CAST(strlen(text) AS BIGINT) AS n_bytes, {tokens('text', 'model_id')} AS token_count,
       CASE WHEN text IS NULL OR text = '' THEN 'exact' ELSE 'heuristic' END AS method,
       CASE WHEN text IS NULL OR text = '' THEN NULL
            WHEN {family('model_id')} = 'glm' THEN {q(tk.GLM_WARNING)} END AS warning
FROM d"""

    r = b.RATES
    s["cost_estimate"] = f"""
WITH u AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(floor(l_extendedprice) AS BIGINT) AS input_tokens,
         CAST(floor(l_quantity * 40) AS BIGINT) AS output_tokens,
         CAST(l_linenumber * 10 AS BIGINT) AS reasoning_tokens,
         CAST(floor(l_extendedprice * l_discount) AS BIGINT) AS cache_read_tokens,
         CAST(floor(l_extendedprice * l_tax) AS BIGINT) AS cache_write_tokens
  FROM lineitem)
SELECT *, input_tokens + output_tokens + reasoning_tokens + cache_read_tokens + cache_write_tokens AS total_tokens,
       round(input_tokens * {r['input']!r} + output_tokens * {r['output']!r}
             + cache_read_tokens * {r['cache_read']!r} + cache_write_tokens * {r['cache_write']!r}, {D})
         AS estimated_cost
FROM u"""

    s["large_output_flag"] = f"""
SELECT doc_id, CAST(strlen(text) AS BIGINT) AS output_size_bytes,
       strlen(text) >= {tk.COMPRESS_THRESHOLD_BYTES} AS output_compressed,
       {tokens('text', model_for('doc_id'))} AS output_estimated_tokens
FROM documents"""

    s["system_prompt_dedup"] = f"""
WITH ev AS (
  SELECT coalesce(lang, '') AS session_id, coalesce({model_for('doc_id')}, 'unknown') AS model_id,
         doc_id AS timestamp, doc_id AS seq,
         array_to_string(string_split(text, {NL} || {NL}), {NL} || {NL}) AS content
  FROM documents),
r AS (
  SELECT *, sha256(content) AS content_hash,
         row_number() OVER (PARTITION BY session_id, sha256(content) ORDER BY timestamp, seq) AS rn
  FROM ev WHERE content <> '')
SELECT session_id, model_id, timestamp, content_hash, content, {tokens('content', 'model_id')} AS token_count
FROM r WHERE rn = 1"""

    s["tool_calls_upsert"] = LINEITEM_DEDUP
    s["tool_call_pairing"] = TOOL_CALLS
    s["tool_latency_total"] = LATENCY

    s["latest_model_asof"] = f"""
WITH u AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS session_id, event_type, (epoch_us(ts) // 1000) AS ts, event_id AS seq,
         CASE WHEN event_type = 'signup' THEN CAST(event_id AS VARCHAR) END AS p_id,
         CASE WHEN event_type = 'signup' THEN {model_for('CAST(floor(value) AS BIGINT)')} END AS p_model,
         CASE WHEN event_type = 'signup' THEN CAST((floor(value) + 1) * 1000 AS BIGINT) END AS p_limit
  FROM events),
f AS (
  SELECT *, last_value(p_id IGNORE NULLS) OVER w AS params_id,
         last_value(p_model IGNORE NULLS) OVER w AS model_id,
         last_value(p_limit IGNORE NULLS) OVER w AS context_limit
  FROM u WINDOW w AS (PARTITION BY session_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, session_id, event_type, ts AS timestamp, params_id, model_id, context_limit
FROM f WHERE event_type <> 'signup'"""

    s["chat_params_upsert"] = f"""
WITH r AS (
  SELECT CAST(user_id AS VARCHAR) || ':' || CAST(CAST(floor({ms('ts')} / {b.DAY_MS}) AS BIGINT) AS VARCHAR) AS id,
         CAST(user_id AS VARCHAR) AS session_id, {ms('ts')} AS timestamp, event_id AS seq,
         {model_for('CAST(floor(value) AS BIGINT)')} AS model_id,
         coalesce(CASE WHEN floor(value) >= 100 THEN {family(model_for('CAST(floor(value) AS BIGINT)'))} END, '')
           AS provider_id,
         'build' AS agent, round(value / 100, {D}) AS temperature, NULL::DOUBLE AS top_p, NULL::DOUBLE AS top_k,
         CAST(floor(value) * 10 AS BIGINT) AS max_output_tokens,
         CAST((floor(value) + 1) * 1000 AS BIGINT) AS model_context_limit, 4096::BIGINT AS model_output_limit,
         {r['input']!r}::DOUBLE AS cost_input, {r['output']!r}::DOUBLE AS cost_output,
         {r['cache_read']!r}::DOUBLE AS cost_cache_read, {r['cache_write']!r}::DOUBLE AS cost_cache_write,
         CASE WHEN props IS NULL OR CAST(json(props) AS VARCHAR) = '{{}}' THEN NULL
              ELSE CAST(json(props) AS VARCHAR) END AS options_json
  FROM events WHERE event_type = 'signup')
SELECT * EXCLUDE (seq, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY timestamp DESC, seq DESC) AS rn FROM r) WHERE rn = 1"""

    s["cost_share"] = f"""
WITH li AS ({LINEITEM_DEDUP}),
c AS (
  SELECT CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS call_id,
         CAST(l_orderkey AS VARCHAR) AS message_id,
         CASE WHEN l_linestatus = 'F' THEN 'completed' ELSE 'pending' END AS status,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(floor(l_quantity) AS BIGINT) END AS output_size_bytes
  FROM li JOIN orders ON l_orderkey = o_orderkey),
t AS (SELECT message_id, CAST(sum(coalesce(output_size_bytes, 0)) AS BIGINT) AS tb, count(*) AS n
      FROM c WHERE status = 'completed' GROUP BY message_id),
st AS (
  SELECT message_id, cost FROM (
    SELECT CAST(o_orderkey AS VARCHAR) AS message_id, o_totalprice AS cost,
           row_number() OVER (PARTITION BY o_orderkey ORDER BY (epoch_us(o_orderdate) // 1000) DESC, o_totalprice DESC) AS rn
    FROM orders WHERE o_totalprice > 0) WHERE rn = 1)
SELECT c.call_id, c.message_id, c.status, c.output_size_bytes,
       CASE WHEN c.status = 'completed' AND st.cost IS NOT NULL THEN
         CASE WHEN t.tb = 0 THEN st.cost / t.n
              ELSE (coalesce(c.output_size_bytes, 0) / t.tb) * st.cost END END AS cost_share
FROM c LEFT JOIN t USING (message_id) LEFT JOIN st USING (message_id)"""

    s["cost_share_asof"] = f"""
WITH st AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS call_id, CAST(o_custkey AS VARCHAR) AS message_id,
         {ms('o_orderdate')} AS ts, 0::BIGINT AS seq FROM orders),
en AS (
  SELECT call_id, ts, seq, max(bytes) AS bytes FROM (
    SELECT CAST(l_orderkey AS VARCHAR) AS call_id, {ms('l_shipdate')} AS ts, CAST(l_linenumber AS BIGINT) AS seq,
           CAST(floor(l_quantity) * 2 AS BIGINT) AS bytes FROM lineitem) GROUP BY call_id, ts, seq),
sp AS (
  SELECT message_id, ts, seq, cost FROM (
    SELECT CAST(o_custkey AS VARCHAR) AS message_id, {ms('o_orderdate')} AS ts, 100::BIGINT AS seq,
           o_totalprice AS cost,
           row_number() OVER (PARTITION BY o_custkey ORDER BY {ms('o_orderdate')} DESC, o_totalprice DESC) AS rn
    FROM orders WHERE o_totalprice > 0) WHERE rn = 1),
{COST_ASOF}"""

    s["raw_cost_shares"] = f"""
WITH {RAW},
st AS (SELECT call_id, message_id, ts, seq FROM e WHERE kind = 'click' AND seq % 2 = 0),
en AS (SELECT call_id, ts, seq, CAST(strlen('reply ' || repeat('to ', CAST(n % 9 AS INTEGER)) || seq) AS BIGINT) AS bytes
       FROM e WHERE kind = 'view' AND seq % 2 = 0 AND n % 11 <> 0),
sp AS (SELECT message_id, ts, seq, value / 1000 AS cost FROM (
         SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY ts DESC, seq DESC) AS rn
         FROM e WHERE kind = 'purchase' AND value / 1000 > 0) WHERE rn = 1),
{COST_ASOF.replace('AS cost_share', ') AS cost_share', 1).replace('CASE WHEN tot.tb', f'round(CASE WHEN tot.tb', 1).replace(') AS cost_share', f', {D}) AS cost_share', 1)}"""

    s["first_parts"] = f"""
SELECT session_id, item, ts_ms, seq FROM (
  SELECT CAST(user_id AS VARCHAR) AS session_id, {week_msg('user_id', 'ts')} || '/' || event_type AS item, {ms('ts')} AS ts_ms,
         event_id AS seq, row_number() OVER (PARTITION BY user_id, {week_msg('user_id', 'ts')}, event_type
                                             ORDER BY {ms('ts')}, event_id) AS rn
  FROM events WHERE event_type <> 'error' AND NOT (event_type = 'purchase' AND value >= 90)) WHERE rn = 1"""

    s["streaming_milestones"] = TIMING

    s["token_estimates"] = f"""
WITH req AS (
  SELECT CAST(event_id AS VARCHAR) AS message_id, CAST(user_id AS VARCHAR) AS session_id,
         'char-ratio' AS approach, {model_for('CAST(floor(value) AS BIGINT)')} AS model_id,
         0::BIGINT AS input_tokens, 0::BIGINT AS output_tokens, 0::BIGINT AS cache_read_tokens,
         0::BIGINT AS cache_write_tokens, 0::BIGINT AS total_tokens, 0.0::DOUBLE AS estimated_cost,
         (epoch_us(ts) // 1000) AS timestamp, event_id AS seq
  FROM events WHERE event_type = 'signup'),
fin AS (
  SELECT {week_msg('user_id', 'ts')} AS message_id, CAST(user_id AS VARCHAR) AS session_id,
         'opencode' AS approach, {model_for('CAST(floor(value) AS BIGINT)')} AS model_id,
         tokens_input AS input_tokens, tokens_output AS output_tokens, tokens_cache_read AS cache_read_tokens,
         tokens_cache_write AS cache_write_tokens,
         tokens_input + tokens_output + tokens_reasoning + tokens_cache_read + tokens_cache_write AS total_tokens,
         value / 100 AS estimated_cost, (epoch_us(ts) // 1000) AS timestamp, event_id AS seq
  FROM (SELECT *, {_value_tokens('value')} FROM events WHERE event_type = 'error')),
u AS (SELECT * FROM req UNION ALL SELECT * FROM fin)
SELECT message_id, session_id, approach, model_id, input_tokens, output_tokens, cache_read_tokens,
       cache_write_tokens, total_tokens, round(estimated_cost, {D}) AS estimated_cost, timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY message_id, approach ORDER BY timestamp DESC, seq DESC) AS rn FROM u)
WHERE rn = 1"""

    s["step_metrics_upsert"] = STEPS

    s["context_snapshot"] = f"""
WITH c AS (SELECT conv_id, role, text, {model_for('conv_id')} AS model_id FROM conversations),
agg AS (
  SELECT conv_id, count(*) AS message_count, count(*) AS total_parts,
         count(*) FILTER (WHERE role = 'user') AS tool_parts,
         count(*) FILTER (WHERE role = 'assistant') AS text_parts,
         coalesce(sum(CASE WHEN role = 'user' THEN {tokens('text', 'model_id')} END), 0) AS tool_tok,
         coalesce(sum(CASE WHEN role = 'assistant' THEN {tokens('text', 'model_id')} END), 0) AS conv_tok
  FROM c GROUP BY conv_id)
SELECT CAST(conv_id AS VARCHAR) AS id, CAST(conv_id AS VARCHAR) AS session_id,
       CAST(message_count AS BIGINT) AS message_count, CAST(total_parts AS BIGINT) AS total_parts,
       CAST(tool_parts AS BIGINT) AS tool_parts, CAST(text_parts AS BIGINT) AS text_parts,
       CAST(tool_tok + conv_tok AS BIGINT) AS estimated_tokens,
       round(CASE WHEN conv_id + 1000 > 0 THEN (tool_tok + conv_tok) / (conv_id + 1000) END, {D}) AS context_utilization,
       NULL::DOUBLE AS system_token_pct,
       round(tool_tok / CASE WHEN tool_tok + conv_tok = 0 THEN 1 ELSE tool_tok + conv_tok END, {D}) AS tool_output_token_pct,
       round(conv_tok / CASE WHEN tool_tok + conv_tok = 0 THEN 1 ELSE tool_tok + conv_tok END, {D}) AS conversation_token_pct
FROM agg"""

    words = r"len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"
    s["token_count_by_tokenizer"] = f"""
WITH d AS (SELECT doc_id, text, {model_for('doc_id')} AS model_id FROM documents),
f AS (SELECT *, {family('model_id')} AS family FROM d),
x AS (SELECT *, CASE WHEN family IN ('openai', 'claude') OR (family = 'deepseek' AND length(text) <= 1000)
                     THEN {words} END AS own FROM f)
SELECT doc_id, model_id, CAST(coalesce(own, {tokens('text', 'model_id')}) AS BIGINT) AS token_count,
       CASE WHEN coalesce(text, '') = '' OR (own IS NOT NULL AND family = 'openai') THEN 'exact'
            WHEN own IS NOT NULL THEN 'near-exact' ELSE 'heuristic' END AS token_method,
       CASE WHEN coalesce(text, '') = '' THEN NULL
            WHEN own IS NOT NULL AND regexp_matches(model_id, '(?i)claude.*4[.]([7-9]|[1-9][0-9])') THEN {q(tk.CLAUDE_47_WARNING)}
            WHEN family = 'glm' THEN {q(tk.GLM_WARNING)} END AS token_warning
FROM x"""

    s["latency_phases"] = f"""
SELECT * FROM ({LATENCY})
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR), 'lineitem', 'phase-' || l_returnflag, CAST(floor(l_quantity) AS BIGINT),
       CASE WHEN l_quantity >= 10 THEN '{{"state":"' || l_linestatus || '"}}' END, {ms('l_shipdate')}
FROM lineitem"""

    first = "min(struct_pack(ts := u.ts, seq := u.seq)) FILTER (u.event_type = '{}')"
    s["timing_updates"] = f"""
WITH ev AS (
  SELECT CAST(user_id AS VARCHAR) AS session_id, {week_msg('user_id', 'ts')} AS message_id, event_type,
         (epoch_us(ts) // 1000) AS ts, event_id AS seq FROM events),
seed AS (
  SELECT message_id, session_id, ts, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY ts, seq) AS rn FROM ev WHERE event_type = 'signup')
  WHERE rn = 1),
u AS (
  SELECT s.message_id, {first.format('click')} AS p, {first.format('view')} AS x, {first.format('purchase')} AS t,
         {first.format('error')} AS d,
         max(struct_pack(ts := u.ts, seq := u.seq)) FILTER (u.event_type = 'error') AS l
  FROM seed s JOIN ev u ON u.message_id = s.message_id AND u.event_type <> 'signup'
                       AND (u.ts > s.ts OR (u.ts = s.ts AND u.seq >= s.seq)) GROUP BY s.message_id)
SELECT s.message_id, s.session_id, s.ts AS request_sent, u.p.ts AS first_part_received, u.x.ts AS first_text_received,
       u.t.ts AS first_tool_call, u.d.ts AS message_completed,
       CASE WHEN u.x < u.l THEN u.x.ts - s.ts END AS time_to_first_token_ms,
       CASE WHEN u.p < u.l THEN u.d.ts - u.p.ts END AS total_streaming_ms
FROM seed s LEFT JOIN u USING (message_id)"""

    s["raw_chat_params"] = s["chat_params_upsert"]
    s["raw_system_prompts"] = s["system_prompt_dedup"]
    s["raw_tool_cost_shares"] = s["raw_cost_shares"]
    s["raw_step_metrics"] = f"""
WITH {RAW}
SELECT CAST(seq AS VARCHAR) AS id, session_id, message_id, ts AS timestamp, 'stop' AS reason, round(value / 1000, {D}) AS cost,
       n * 100 AS tokens_input, n * 10 AS tokens_output, n AS tokens_reasoning, n * 50 AS tokens_cache_read,
       n * 5 AS tokens_cache_write
FROM e WHERE kind = 'purchase'"""
    s["raw_tool_latency_breakdown"] = f"""
WITH {RAW},
h AS (SELECT *, lag(kind) OVER w AS last_kind, lag(ts) OVER w AS last_ts FROM e WHERE kind IN ('click', 'view') AND seq % 2 = 0
      WINDOW w AS (PARTITION BY call_id ORDER BY ts, seq))
SELECT call_id AS tool_call_id, session_id, 'total' AS phase, ts - last_ts AS duration_ms, NULL::VARCHAR AS metadata_json,
       ts AS timestamp
FROM h WHERE kind = 'view' AND last_kind = 'click'"""
    s["raw_quarantine"] = """
SELECT CASE event_id % 4 WHEN 0 THEN 'damaged' WHEN 1 THEN 'unknown kind' ELSE 'incomplete' END AS reason, count(*) AS n,
       count(DISTINCT event_id) AS n_different
FROM events WHERE event_id % 3 = 0 AND event_id % 4 <> 3 GROUP BY 1"""
    s["raw_tool_calls"] = f"WITH {RAW} SELECT * FROM calls"
    s["raw_streaming_timing"] = RAW_TIMING
    s["raw_token_estimates"] = RAW_ESTIMATES
    s["raw_retrieval_relevance"] = raw_relevance_sql()

    s["context_windows"] = f"""
WITH c AS (SELECT *, CAST(conv_id AS VARCHAR) AS session_id, {model_for('conv_id')} AS model_id FROM conversations),
p AS (SELECT session_id, turn, session_id || ':' || turn AS id, model_id, strlen(text) + 100 AS lim
      FROM c WHERE role = 'system'),
w AS (SELECT c.session_id, c.turn, c.role, c.text, p.id, p.model_id, p.lim,
             row_number() OVER (PARTITION BY c.session_id, c.turn ORDER BY p.turn DESC) AS nearest
      FROM c JOIN p ON p.session_id = c.session_id AND p.turn <= c.turn
      WHERE c.role <> 'system' AND c.turn % 5 <> 0),
l AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY turn DESC) AS rn FROM w WHERE nearest = 1),
t AS (SELECT *, CASE WHEN role = 'user' THEN {tokens("'user'", 'model_id')} ELSE 0 END AS tool_tok,
             {tokens('text', 'model_id')} AS conv_tok FROM l WHERE rn = 1)
SELECT id, session_id, CAST(turn AS BIGINT) AS timestamp, 2::BIGINT AS message_count, 3::BIGINT AS total_parts,
       1::BIGINT AS tool_parts, 1::BIGINT AS text_parts, CAST(tool_tok + conv_tok AS BIGINT) AS estimated_tokens,
       round((tool_tok + conv_tok) / lim, {D}) AS context_utilization, NULL::DOUBLE AS system_token_pct,
       round(tool_tok / CASE WHEN tool_tok + conv_tok = 0 THEN 1 ELSE tool_tok + conv_tok END, {D}) AS tool_output_token_pct,
       round(conv_tok / CASE WHEN tool_tok + conv_tok = 0 THEN 1 ELSE tool_tok + conv_tok END, {D}) AS conversation_token_pct
FROM t"""

    s["line_overlap"] = relevance_sql("line-overlap")
    s["substring_match"] = relevance_sql("substring-match")
    s["relevance_scoring"] = relevance_sql("auto")

    s["session_totals"] = f"""
SELECT session_id, CAST(coalesce(sum(tokens_input), 0) AS BIGINT) AS total_input,
       CAST(coalesce(sum(tokens_output), 0) AS BIGINT) AS total_output,
       round(coalesce(sum(cost), 0.0), {D}) AS total_cost
FROM ({STEPS}) GROUP BY session_id"""

    tool_totals = f"""
SELECT session_id, count(*) AS total_calls,
       CAST(coalesce(sum(output_estimated_tokens), 0) AS BIGINT) AS total_fetched, avg(duration_ms) AS avg_dur
FROM ({TOOL_CALLS}) WHERE status = 'completed' GROUP BY session_id"""
    s["tool_aggregates"] = f"""
SELECT session_id, total_calls, total_fetched, CAST({jround('avg_dur')} AS BIGINT) AS avg_tool_duration_ms
FROM ({tool_totals})"""

    rel_totals = f"""
SELECT session_id, CAST(coalesce(sum(referenced_tokens), 0) AS BIGINT) AS total_referenced,
       avg(relevance_ratio) AS avg_relevance
FROM ({relevance_sql('auto')}) GROUP BY session_id"""
    s["relevance_aggregates"] = f"""
SELECT session_id, total_referenced, round(avg_relevance, {D}) AS avg_relevance FROM ({rel_totals})"""

    s["precision"] = f"""
WITH t AS ({tool_totals}), r AS ({rel_totals})
SELECT t.session_id, t.total_fetched, coalesce(r.total_referenced, 0) AS total_referenced,
       round(CASE WHEN t.total_fetched > 0 THEN least(1.0, coalesce(r.total_referenced, 0) / t.total_fetched) END, {D})
         AS precision_score
FROM t LEFT JOIN r USING (session_id)"""

    timing_totals = f"""
SELECT session_id, avg(time_to_first_token_ms) AS avg_ttft, min(request_sent) AS first_sent,
       max(message_completed) AS last_done
FROM ({TIMING}) GROUP BY session_id"""
    s["ttft_and_wall"] = f"""
SELECT session_id, CAST({jround('avg_ttft')} AS BIGINT) AS avg_ttft_ms, last_done - first_sent AS total_session_ms
FROM ({timing_totals})"""

    lat = f"""
SELECT session_id, count(*) AS n_queries, CAST({jround('avg(duration_ms)')} AS BIGINT) AS avg_query_ms,
       quantile_disc(duration_ms, 0.5) AS p50_query_ms, quantile_disc(duration_ms, 0.95) AS p95_query_ms
FROM ({LATENCY}) WHERE phase = 'total' GROUP BY session_id"""
    s["latency_percentiles"] = lat

    s["benchmark_run_summary"] = f"""
WITH req AS (
  SELECT 'task-' || CAST(c_nationkey AS VARCHAR) AS task_id, CAST(c_custkey AS VARCHAR) AS session_id,
         lower(c_mktsegment) AS strategy FROM customer
  UNION ALL
  SELECT 'task-' || CAST(c_nationkey AS VARCHAR), '-' || CAST(c_custkey AS VARCHAR), 'baseline' FROM customer),
st AS (
  SELECT session_id, CAST(coalesce(sum(tokens_input), 0) AS BIGINT) AS total_input,
         CAST(coalesce(sum(tokens_output), 0) AS BIGINT) AS total_output, coalesce(sum(cost), 0.0) AS total_cost
  FROM ({STEPS}) GROUP BY session_id),
tt AS ({tool_totals}),
rt AS ({rel_totals}),
tm AS ({timing_totals}),
lt AS ({lat})
SELECT req.task_id, req.session_id, req.strategy,
       coalesce(st.total_input, 0) AS total_input_tokens, coalesce(st.total_output, 0) AS total_output_tokens,
       round(coalesce(st.total_cost, 0.0), {D}) AS total_cost,
       CAST(coalesce(tt.total_calls, 0) AS BIGINT) AS total_tool_calls,
       nullif(coalesce(tt.total_fetched, 0), 0) AS total_fetched_tokens,
       nullif(coalesce(rt.total_referenced, 0), 0) AS total_referenced_tokens,
       round(CASE WHEN coalesce(tt.total_fetched, 0) > 0
                  THEN least(1.0, coalesce(rt.total_referenced, 0) / tt.total_fetched) END, {D}) AS precision_score,
       round(rt.avg_relevance, {D}) AS avg_relevance,
       CAST({jround('tm.avg_ttft')} AS BIGINT) AS avg_ttft_ms,
       CAST({jround('tt.avg_dur')} AS BIGINT) AS avg_tool_duration_ms,
       tm.last_done - tm.first_sent AS total_session_ms,
       lt.avg_query_ms, lt.p50_query_ms, lt.p95_query_ms
FROM req LEFT JOIN st USING (session_id) LEFT JOIN tt USING (session_id) LEFT JOIN rt USING (session_id)
     LEFT JOIN tm USING (session_id) LEFT JOIN lt USING (session_id)"""

    s["benchmark_task_upsert"] = """
SELECT id, description, expected_output_hint, created_at FROM (
  SELECT source AS id, text AS description, nullif(lang, 'en') AS expected_output_hint, doc_id AS created_at,
         row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS rn
  FROM documents) WHERE rn = 1"""

    s["schema_evolution_union"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, (epoch_us(o_orderdate) // 1000) AS order_ms,
       CASE WHEN o_orderdate >= TIMESTAMP '1995-01-01' THEN o_orderpriority END AS o_orderpriority
FROM orders"""
    s["schema_evolution_files"] = s["schema_evolution_union"]
    s["raw_context_snapshots"] = s["context_windows"]
    return s


ORACLE_SQL: dict[str, str] = _sql()
