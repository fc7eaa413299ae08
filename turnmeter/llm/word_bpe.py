"""Words of a lower-casing word-level BPE vocabulary, and their merge ranks.

The vocabulary file (``tokenizers`` JSON) is read in place on each worker; its
path is a parameter. A text is normalised (NFC, lower case, code point by code
point), split at special strings, and cut into words by the file's own pattern;
merges never cross a word, so all per-word work can be cached.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import regex

#: Words remembered per worker before the cache starts anew.
CACHE_WORDS = 400_000


#: Texts of these characters only are in normal form, and each character's kind is plain: lower-cased letters
#: are those of ``_LETTERS``, digits 0-9, blanks those of ASCII. A faster pattern does for them.
_SIMPLE = re.compile("[\x00-\x7f\u00ab\u00bb\u00c0-\u012f\u0131-\u017f\u2010-\u2027\u20ac]*").fullmatch
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u017f"


class Cache(dict):
    """``make(word)``, remembered; forgets everything when it is full, so its memory is bounded."""

    def __init__(self, make, limit: int = CACHE_WORDS):
        super().__init__()
        self._make, self._limit = make, limit

    def __missing__(self, word):
        if len(self) >= self._limit:
            self.clear()
        value = self[word] = self._make(word)
        return value


@functools.cache
def byte_symbols() -> list[str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


def byte_level(word: str) -> str:
    """A word's UTF-8 bytes in the byte-level alphabet."""
    if word.isascii() and word.isprintable():
        return word  # words hold no blanks
    return "".join([byte_symbols()[b] for b in word.encode()])


class WordBpe:
    """What the vocabulary file says: words of a text, merge ranks, special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.ranks = {tuple(pair): i for i, pair in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"]
        self._words = regex.compile(pattern).findall
        for general, simple in (("\\s", " \\t\\n\\r\\x0b\\x0c"), ("\\p{L}", _LETTERS), ("\\p{N}", "0-9")):
            pattern = pattern.replace(general, simple)
        self._simple_words = re.compile(pattern).findall
        self._plain: set[str] = set()
        self._path, self._library = path, None

    def parts(self, text: str) -> list[str]:
        """The text cut at special strings: ordinary text at even places, special strings at odd ones."""
        return self._cut(text) if "<|" in text else [text]

    def words(self, text: str) -> list[str]:
        """Words of ordinary text, normalised."""
        if _SIMPLE(text):
            return self._simple_words(text.lower())
        if not self._usual(text):
            return self._library_words(text)
        text = unicodedata.normalize("NFC", text)
        # str.lower() treats a final capital sigma by its context; the vocabulary's rule does not
        return self._words(text.replace("Σ", "σ").lower())

    def _usual(self, text: str) -> bool:
        """Whether all characters are of the same kind in every version of Unicode at hand."""
        new = set(text) - self._plain
        odd = {c for c in new if regex.match(r"[\p{L}\p{N}]", c) and unicodedata.category(c)[0] not in "LN"}
        self._plain |= new - odd
        return not odd

    def _library_words(self, text: str) -> list[str]:
        """For texts with letters that only one of the Unicode tables knows: as the library cuts them."""
        if self._library is None:
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_file(self._path)
        text = self._library.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self._library.pre_tokenizer.pre_tokenize_str(text)]

    def symbols(self, word: str) -> list[str]:
        """The symbols that merging starts from: bytes, the last one marked as the word's end."""
        out = list(byte_level(word))
        out[-1] += self.suffix
        return out


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)
