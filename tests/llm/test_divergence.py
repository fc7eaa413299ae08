"""Divergence of sources: against plain counting with Python integers."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnmeter.llm import divergence

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]
SCHEMA = "text string, lang string, source string, term string, count string, n string"


def plain(rows, min_docs, top=10):
    """The contract, read off the rows (text, lang, source)."""
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        groups[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in {k for k, _ in groups}:
        kept = [w for w, n in docs[lang].items() if n >= min_docs]
        own = {s: Counter({w: c[w] for w in kept if c[w]}) for (k, s), c in groups.items() if k == lang}
        whole = sum(own.values(), Counter())

        def share(c, w):
            return 1 + (10**9 * (c[w] + 2)) // (sum(c.values()) + 2 * len(kept))

        def far(p, q):
            return (p - q) ** 2 // (p + q)
        for s, c in own.items():
            pairs = [(o, sum(far(share(c, w), share(d, w)) for w in kept)) for o, d in own.items() if o != s]
            terms = [(w, far(share(c, w), share(whole, w))) for w in c if share(c, w) > share(whole, w)]
            for part, items in (("pair", pairs), ("term", terms)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items) if part == "pair" or k < top]
    return sorted(out)


def audited(spark, rows, **options):
    df = spark.createDataFrame([(*r, "own", "own", "own") for r in rows], SCHEMA)
    got = divergence.audit(df, **options)
    assert got.columns == COLUMNS and dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"
    return sorted(tuple(r) for r in got.collect())


@pytest.fixture(scope="module")
def made_up():
    rng = np.random.default_rng(5)
    words = [f"w{chr(97 + i % 26)}{'é' * (i % 3)}{chr(97 + i // 26)}" for i in range(60)]
    rows = []
    for i in range(120):
        lang, source = [None, "en", "d e"][i % 3], [None, "s1", "s2", "S3"][rng.integers(4)]
        rows.append((" ".join(rng.choice(words[: 20 + 10 * (i % 4)], 30)).upper() + "!", lang, source))
    rows += [(None, "en", "s1"), ("", "en", "only empty"), ("alone", "xx", "one"), ("few words", "yy", "a"), ("", "yy", "b")]
    return rows + rows[:10] * 2


@pytest.mark.parametrize("part_terms", [divergence.PART_TERMS, 20])
def test_against_plain_counting(spark, made_up, part_terms):
    assert audited(spark, made_up, min_docs=10, part_terms=part_terms) == plain(made_up, 10)


def test_no_term_is_kept(spark):
    rows = [("one two", "en", "a"), ("three", "en", "b"), (None, None, None)]
    assert audited(spark, rows) == plain(rows, 10) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_ties_are_broken_by_bytes(spark):
    rows = [("a b c z \U0001F600 ￰", "en", s) for s in ("x", "y")] + [("a a b b c c \U0001F600 \U0001F600 ￰ ￰", "en", "w")]
    assert audited(spark, rows, min_docs=1, top_terms=3) == plain(rows, 1, 3)


def test_empty_table(spark, no_docs):
    assert divergence.audit(no_docs).collect() == []


def test_corrections_of_absent_terms():
    p0 = np.array([5, 7, 9], dtype=np.int64)
    at, offsets, p = np.array([0, 1, 2, 1]), np.array([0, 2, 4]), np.array([50, 60, 70, 80], dtype=np.int64)
    want = np.zeros((3, 3), dtype=np.int64)
    for entries in ({0: 50, 1: 60}, {2: 70, 1: 80}):
        share = [entries.get(s, int(p0[s])) for s in range(3)]
        for s in range(3):
            for t in range(3):
                if s in entries or t in entries:
                    want[s, t] += ((share[s] - share[t]) ** 2 // (share[s] + share[t])
                                   - (int(p0[s]) - int(p0[t])) ** 2 // (int(p0[s]) + int(p0[t])))
    assert divergence._corrections(at, offsets, p, p0).tolist() == want.tolist()


def test_only_a_to_z_are_lower_cased(spark):
    points = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(points[k:k + 50]) for k in range(0, len(points), 50)] + ["AbÉ", "ABC", "İI", "ΑΣ ", "Ⅷ Ⓐ ǅ ẞ Ω K Å", "aZ\u0130"]
    df = spark.createDataFrame([(t,) for t in texts + [c for c in points if ord(c) < 0x2F00]], "t string")
    for r in df.select("t", divergence.ascii_lower(F.col("t")).alias("l")).collect():
        assert r.l == "".join(c.lower() if "A" <= c <= "Z" else c for c in r.t)


def test_long_text(spark):
    rows = [("word Word other " * 40_000, "en", "a"), ("x" * 100_000, "en", "b"), ("other", "en", "b")]
    assert audited(spark, rows, min_docs=1) == plain(rows, 1)


@pytest.mark.parametrize("first_terms", [0, 3, 200_000])
def test_second_fit_counts_only_what_the_first_has_not(spark, monkeypatch, made_up, first_terms):
    """Rows whose words the first fit knows in part, wholly or not at all, with the same result."""
    seen, fit = [], divergence._fit

    def noted(docs, *options):
        seen.append((fit(docs, *options), {w for r in docs.collect() for w in r.terms}))
        return seen[-1][0]
    monkeypatch.setattr(divergence, "_fit", noted)
    monkeypatch.setattr(divergence, "FIRST_TERMS", first_terms or 1)
    monkeypatch.setattr(divergence, "SAMPLE", 0.5 if first_terms else 1e-9)
    assert audited(spark, made_up, min_docs=10, part_terms=10**12) == plain(made_up, 10)
    (first, _), (_, counted) = seen
    assert not set(first.vocabulary) & counted and counted
    assert 0 < len(first.vocabulary) <= first_terms if first_terms else not first.vocabulary
