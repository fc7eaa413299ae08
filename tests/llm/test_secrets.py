import math
import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from turnmeter.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def either(word):
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile("(" + "|".join(map(either, ["password", "passwd", "secret", "token", "api_?key"]))
                    + ")" + ASSIGN.pattern.partition(")")[2], re.ASCII)
HARMLESS = ["[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", "(?i)example", "(?i)placeholder", "(?i)your[_-]",
            "(?i)abcdefghij", "(?i)klmnopqrst", "0123456789"]
DIGEST = {"sha1": 40, "sha256": 64, "sha384": 96, "sha512": 128}


def entropy(s):
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def least(w):
    """Threshold of a window, by what characters it has."""
    digits = sum(c.isdigit() for c in w)
    lower, upper = any(c.islower() for c in w), any(c.isupper() for c in w)
    plain = w.isalnum()
    if not (lower or upper) or not digits and not (lower and upper):
        return math.inf
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", w):
        return 2.9
    if not digits:
        return 3.9
    if plain:
        return 3.55
    return math.inf if digits <= 2 and not (lower and upper) else 3.85


def brute(text):
    t = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    more, blank = [], t
    for p in HARMLESS:
        blank = re.sub(p, lambda m: " " * len(m[0]), blank)
    for m in re.finditer("[A-Za-z0-9+/_=-]+", blank):
        start, s = m.start(), m[0]
        if len(s) >= 20 and (d := re.match("(sha1|sha256|sha384|sha512)[-_=]", s)):
            start, s = start + d.end() + DIGEST[d[1]], s[d.end() + DIGEST[d[1]]:]
        if len(s) < 20 or any(b <= start and m.end() <= e for b, _, e in base):
            continue
        hot = [i for i in range(len(s) - 19) if entropy(s[i:i + 20]) >= least(s[i:i + 20])]
        if hot:
            more.append((start + hot[0], 3, start + hot[-1] + 20))
    return sorted(base), sorted(base + more)


def scanned(df):
    out = df.select("*", secrets.scan(F.col("text")).alias("s")).collect()
    return [(r, [tuple(x) for x in r.s.base], [tuple(x) for x in r.s.spans]) for r in out]


def random_texts():
    rng = random.Random(5)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    parts = ["password", "Token = \"", "api_key:", "APIKEY=", "secret: ", "= ", "AKIA", " ", "é", "\n", "sha256-", "example", "your_", "/", "-",
              "123e4567-e89b-12d3-a456-426614174000", "0123456789", "/usr/lib/python3/dist-packages/", "Some-HeaderName"]
    parts += ["token: secret: \"abcdefghijklmnop1"]
    for _ in range(600):
        out = []
        for _ in range(rng.randrange(12)):
            kind = rng.randrange(6)
            n = rng.choice([3, 11, 12, 15, 16, 19, 20, 21, 40, 300])
            alphabet = ("0123456789abcdef", b64, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "0123456789ABCDEF", "aB1",
                        "abcdefghijklmnopqrstuvwxyz0123456789-")[kind % 6]
            out.append(rng.choice(parts) if kind == 5 or rng.random() < 0.3 else "".join(rng.choices(alphabet, k=n)))
            out.append(rng.choice(["", "", " ", "é"]))
        yield "".join(out)


def test_spans_against_brute_force(spark):
    texts = list(random_texts())
    got = scanned(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1))
    kinds = Counter()
    for r, base, spans in got:
        want_base, want = brute(r.text)
        assert base == want_base and spans == want, r.text
        kinds.update(k for _, k, _ in spans)
    assert min(kinds[k] for k in range(4)) > 5


def test_allow_list_and_words(spark):
    fine = ["123e4567-e89b-12d3-a456-426614174000", "onintionlywhentionthereforetion", "sha512-Ab9/xKq81LmNz0PqR+tUvW==",
            "Example9fKq81LmNz0PqRtUv", "z" * 40, "ALLCAPSALLCAPSALLCAPS_AND_MORE",
            "/usr/lib/python3/dist-packages/numpy/core", "2024-01-02/10-11-12_13-14-15",
            "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"]
    for r, base, spans in scanned(spark.createDataFrame([(t,) for t in fine], "text string")):
        assert not spans, r.text


def test_keys_beside_separators_and_harmless_strings(spark):
    keys = ["key-3ax6xnjp29jd6fds4gc373sgvjxteol0", "qT_vKxRzLw/HmYdNsBpGf", "your_key/8fKq81LmNz0PqRtUvWxE",
            "/home/example/x9Zq81LmNz0PqRtUvWxE", "123e4567-e89b-12d3-a456-426614174000/x9Zq81LmNz0PqRtUvWxE"]
    for r, base, spans in scanned(spark.createDataFrame([(t,) for t in keys], "text string")):
        assert [k for _, k, _ in spans] == [3] and spans == brute(r.text)[1], r.text
        assert spans[0][2] == len(r.text)


def test_long_runs_cost_in_proportion_to_their_length(spark):
    rng = random.Random(3)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

    def seconds(text, spans):
        df = spark.createDataFrame([(text,)], "text string").select("text", secrets.scan(F.col("text"))["spans"].alias("s"))
        began = time.perf_counter()
        row = df.select("s", secrets.redact(F.col("text"), F.col("s")).alias("r")).collect()[0]
        took = time.perf_counter() - began
        assert len(row.s) == spans and row.r.count("[SECRET]") == spans
        return took

    def one(n):
        return "".join(rng.choices(b64, k=n))

    def many(n):
        return " ".join("".join(rng.choices("0123456789abcdef", k=20)) for _ in range(n // 21))

    seconds(one(1000), 1)
    runs = [seconds(one(n), 1) for n in (10_000, 100_000, 1_000_000)]
    hits = [seconds(many(n), n // 21) for n in (10_000, 100_000, 1_000_000)]
    print("one run", runs, "many", hits)
    assert runs[2] < 20 * runs[1] + 2 and hits[2] < 20 * hits[1] + 2


def test_odd_rows(spark, odd_docs, no_docs):
    got = scanned(odd_docs)
    assert len(got) == odd_docs.count()
    assert all((base, spans) == brute(r.text) for r, base, spans in got)
    assert no_docs.select(secrets.scan(F.col("text"))).collect() == []


def test_long_text_and_redaction(spark):
    rng = random.Random(2)
    text = "é " * 20_000 + "token = " + "".join(rng.choices("abcdef0123456789", k=5000)) + " end " + "AKIA" + "X" * 16
    df = spark.createDataFrame([(text,), ("clean text",), (None,)], "text string")
    out = df.select("text", secrets.redact(F.col("text"), secrets.scan(F.col("text"))["spans"]).alias("r")).collect()
    assert out[0].r == "é " * 20_000 + "[SECRET] end [SECRET]"
    assert [r.r for r in out[1:]] == ["clean text", None]
