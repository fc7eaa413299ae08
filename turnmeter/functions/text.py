"""Text helpers as native Column expressions.

All of them stay inside whole-stage codegen: string built-ins and higher-order
array functions, no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters JavaScript's String.prototype.trim removes
# (ECMAScript WhiteSpace and LineTerminator code points), in code-point order.
JS_WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# Token extraction patterns. JavaScript's \b is ASCII-only, the
# JVM's is Unicode-aware, so word boundaries are spelled out with ASCII \w
# look-arounds (\w is ASCII on the JVM by default).
QUOTED_RE = r"""["']([^"']{4,}?)["']"""
PATH_RE = (r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"
           r"([\w./-]{4,}\.(?:ts|js|py|go|rs|md|json|yaml|yml|sh))(?!\w)")
IDENT_RE = r"(?<!\w)([a-zA-Z][a-zA-Z0-9_]{5,})(?!\w)"

# Tool names scored by line overlap (everything else: substring match).
# Fixed value: names of tools that read files.
FILE_READ_TOOL_RE = r"(?i)^(read|cat|serena_read_file|view|open)$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def js_trim(col) -> Column:
    """Trim like JavaScript: all Unicode white space and line terminators."""
    return F.btrim(_c(col), F.lit(JS_WHITESPACE))


def utf16_len(col) -> Column:
    """String length in UTF-16 code units (JavaScript ``.length``)."""
    c = _c(col)
    # code points outside the BMP take two units; the byte count of the
    # UTF-16 encoding is exact but only needed when such points exist
    return F.when(F.octet_length(c) == F.length(c), F.length(c)).otherwise(
        (F.octet_length(F.encode(c, "UTF-16BE")) / 2).cast("bigint"))


def utf16_len_at_least(col, n: int) -> Column:
    """``utf16_len(col) >= n`` without encoding when the code-point count decides."""
    c = _c(col)
    return F.when(F.length(c) >= n, F.lit(True)).otherwise(utf16_len(c) >= n)


def to_lines(col) -> Column:
    """Split on newline, trim each line, drop empty ones."""
    return F.filter(F.transform(F.split(_c(col), "\n"), js_trim), lambda x: x != "")


def join_system(col) -> Column:
    """System prompt strings joined by a blank line."""
    return F.array_join(_c(col), "\n\n")


def content_hash(col) -> Column:
    """SHA-256 hex digest of the UTF-8 bytes (P10)."""
    return F.sha2(_c(col), 256)


def extract_tokens(col) -> Column:
    """Distinct quoted strings, file paths and long identifiers."""
    c = _c(col)
    quoted = F.transform(F.regexp_extract_all(c, F.lit(QUOTED_RE), 1), js_trim)
    paths = F.regexp_extract_all(c, F.lit(PATH_RE), 1)
    idents = F.regexp_extract_all(c, F.lit(IDENT_RE), 1)
    return F.array_distinct(F.concat(quoted, paths, idents))


def response_text(parts_col) -> Column:
    """Text parts of a finished message joined by newline."""
    parts = _c(parts_col)
    return F.array_join(
        F.transform(F.filter(parts, lambda p: p["type"] == "text"),
                    lambda p: F.coalesce(p["text"], F.lit(""))),
        "\n")


def is_file_read_tool(col) -> Column:
    """Tool names whose output is scored by line overlap."""
    return _c(col).rlike(FILE_READ_TOOL_RE)


def js_round(col) -> Column:
    """``Math.round``: halves go toward +infinity (P25)."""
    return F.floor(_c(col) + F.lit(0.5))
