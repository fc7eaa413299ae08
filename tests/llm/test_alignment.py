"""Alignment of two tokenizers: against both libraries on whole texts and plain counting."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from test_queries import rows
from tokenizers import Tokenizer

from turnmeter.llm import alignment

A, B = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    """Both libraries on the whole text, bytes by the rules of the contract, links one by one."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in kept)}
        self.code = {c: b for b, c in letters.items()}

    def bytes_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.IsByte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        ba = [bytes(self.code[c] for c in self.a.id_to_token(i)) for i in a]
        bb = [self.bytes_b(i) for i in b]
        if not b"".join(ba) == b"".join(bb) == (" " + text).encode():
            return []
        ends_a, ends_b = ([sum(map(len, x[:k + 1])) for k in range(len(x))] for x in (ba, bb)) if len(a) < 300 else (
            self.ends(ba), self.ends(bb))
        found, start = [], -1
        for end in sorted(set(ends_a) & set(ends_b)):
            found.append(([x for x, e in zip(a, ends_a) if start < e <= end], [x for x, e in zip(b, ends_b) if start < e <= end])
                         if len(a) < 300 else None)
            start = end
        return found if len(a) < 300 else self.cut(a, ends_a, b, ends_b)

    @staticmethod
    def ends(parts):
        total, out = 0, []
        for p in parts:
            out.append(total := total + len(p))
        return out

    @staticmethod
    def cut(a, ends_a, b, ends_b):
        common, found = set(ends_a) & set(ends_b), []
        for ids, ends, side in ((a, ends_a, 0), (b, ends_b, 1)):
            k, own = 0, []
            for x, e in zip(ids, ends):
                own.append(x)
                if e in common:
                    if side == 0:
                        found.append((own, None))
                    else:
                        found[k] = (found[k][0], own)
                    k, own = k + 1, []
        return found


@pytest.fixture(scope="module")
def plain():
    return Plain()


def measures(plain, texts):
    """The contract's columns for (doc_id, text) rows."""
    grouped = [(i, plain.groups(t)) for i, t in texts]
    links = [[(x, y) for a, b in g for x in a for y in b] for _, g in grouped]
    counts = Counter(pair for own in links for pair in set(own))
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for (i, g), own in zip(grouped, links):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(own),
                    sum(counts[p] == most[p[0]] for p in own), sum(counts[p] for p in own),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


def as_rows(found):
    return sorted((tuple(r[c] for c in COLUMNS) for r in found), key=str)


def test_given_documents(spark, small_dir, plain):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    assert as_rows(rows(spark, "op12_alignment", small_dir)) == sorted(measures(plain, texts), key=str)


ODD = ["", " ", "  ", "a ", " a", "a  b", "a \n b\n\n  c", "\ta  b", "x▁y", "<|endoftext|> <s></s> <unk> <0x41>",
       "a　 b", "café ﬁ \U0001F600\U0001F600 ᬅ́", "x" * 5000, "Ab" * 700 + " 12345678901234567890", "a\r\n b\x1c c\x85 d",
       "it's they'll 'S", "\x00 a\x00b", "é ́", "日本語 テキスト です"]


def test_odd_texts_nulls_repeats_and_clashing_names(spark, plain):
    data = [(i, t) for i, t in enumerate([None, *ODD])] + [(5, "a  b"), (None, "a  b"), (70, None)]
    df = spark.createDataFrame([(i, t, "own", "own") for i, t in data], "doc_id bigint, text string, key string, n_a string")
    want = measures(plain, data)
    for head in (alignment.HEAD_PAIRS, 20, 0):  # all pairs broadcast, some, none
        got = alignment.align_documents(df, A, B, head_pairs=head)
        assert got.columns == COLUMNS
        assert as_rows(got.collect()) == sorted(want, key=str)


def test_empty_table(spark, no_docs):
    assert alignment.align_documents(no_docs, A, B).collect() == []


def test_every_character_in_context(plain):
    """Words cut out of their text give the ids of the whole text, whatever the characters."""
    aligner, library = alignment.load(A, B), plain
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 97):
        text = "".join(f"a{chr(c)} b {chr(c)}1 {chr(c)}{chr(c)}  c\n" for c in points[k:k + 97])
        assert aligner.ids(text)[0] == library.a.encode(" " + text, add_special_tokens=False).ids
        words = [w for w in text.split(" ")]
        if all(w and not w[-1].isspace() for w in words[:-1]):
            assert [i for w in words for i in aligner.ids(w)[1]] == library.b.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" ab\n\t'é  1.x▁日\U0001F600"), max_size=30))
def test_words_against_whole_texts(plain, text):
    if text:
        found, groups = alignment.load(A, B).text(text), plain.groups(text)
        assert (found is None) == (not groups)
        if groups:
            assert found[4] == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
            assert found[:3] == (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups))


def test_cache_limit_changes_nothing():
    aligner = alignment.Aligner(A, B)
    text = " ".join(f"word{i % 7}x{i % 11}" for i in range(200))
    want = alignment.load(A, B).text(text)
    aligner.words.limit = 3
    got = aligner.text(text)
    assert got[:5] == want[:5] and got[5].tolist() == want[5].tolist() and got[6].tolist() == want[6].tolist()
