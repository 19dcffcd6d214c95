"""Token counts by byte-pair merging, without making any token.

A word's symbols lie in a linked list. A heap holds every adjacent pair that has a merge, lowest rank and then leftmost
first; the lowest is popped, its two symbols become one, and the pairs with the new neighbours are pushed. Entries whose
symbols have changed meanwhile are passed over. The count is the initial symbols less the merges made.

The vocabulary is a tokenizers .json file of kind BPE (read on the driver, sent to the tasks: a file of a few MB). Its
own normalisation and word rules decide the words; they are told apart in plain Python wherever that surely gives the
same words, which holds for characters that kept their kind since Unicode 3.2, and by the file's own rules elsewhere.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Characters that are cut into words at once; cuts are made at spaces and line ends only.
CHUNK = 1 << 16
#: Words whose counts a worker keeps; beyond it the store starts anew. It only saves time.
KEPT_WORDS = 1 << 19
KEPT_LENGTH = 48
_CUT = re.compile(r"[ \n]")
#: White space as the word rules know it, and the numbers that are no decimal digits.
_SPACE = r"\t-\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_NUMBERS = "".join(c for c in map(chr, range(0x10000)) if unicodedata.category(c) in ("Nl", "No"))
_SPACES = re.compile(rf"[{_SPACE}]+")
#: The vocabulary's word rules: letters are the word characters but for numbers and the underscore. Texts without such
#: numbers, nearly all, take the shorter pattern.
_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w ]|_)+")
_WORD_AND_NUMBERS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_{_NUMBERS}]+|[\d{_NUMBERS}]|(?:[^\w ]|_)+")
_PLAIN_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


class Merges:
    """The merges of a BPE vocabulary over numbered symbols."""

    def __init__(self, model: dict) -> None:
        self.suffix = model.get("end_of_word_suffix") or ""
        self.number = model["vocab"]
        self.size = max(self.number.values()) + 1
        #: rank of a pair's merge, and the symbol that each rank makes.
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, (a, b) in enumerate(model["merges"]):
            self.rank[self.number[a] * self.size + self.number[b]] = rank
            self.made.append(self.number[a + b])
        self.inner = [self.number[c] for c in _byte_letters()]
        self.last = [self.number[c + self.suffix] for c in _byte_letters()]

    def count(self, word: bytes) -> int:
        """Symbols that are left of a word when no pair has a merge."""
        n = len(word)
        if n < 2:
            return n
        size, rank, made = self.size, self.rank, self.made
        symbol = [self.inner[b] for b in word]
        symbol[-1] = self.last[word[-1]]
        #: rank of the pair that begins at each place now; a heap entry that says otherwise is out of date.
        now = [rank.get(a * size + b, -1) for a, b in zip(symbol, symbol[1:])]
        now.append(-1)
        width = n.bit_length()
        heap = [r << width | i for i, r in enumerate(now) if r >= 0]
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        left, place = n, (1 << width) - 1
        while heap:
            entry = heapq.heappop(heap)
            i = entry & place
            if now[i] != entry >> width:
                continue
            new, j = made[entry >> width], after[i]
            symbol[i], now[j] = new, -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                now[i] = r = rank.get(new * size + symbol[k], -1)
                if r >= 0:
                    heapq.heappush(heap, r << width | i)
            else:
                now[i] = -1
            h = before[i]
            if h >= 0:
                now[h] = r = rank.get(symbol[h] * size + new, -1)
                if r >= 0:
                    heapq.heappush(heap, r << width | h)
        return left


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable Latin-1, else the next free one from U+0100 on."""
    letters, free = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            letters.append(chr(b))
        else:
            letters.append(chr(free))
            free += 1
    return letters


def _sure(c: str) -> bool:
    """Whether every version of Unicode since 3.2 gives a character the same kind, lower case and composition."""
    old, new = unicodedata.ucd_3_2_0, unicodedata
    if new.category(c) in ("Cn", "Co", "Cs") or old.category(c)[0] != new.category(c)[0] or old.combining(c) != new.combining(c):
        return False
    if old.decomposition(c) != new.decomposition(c) or ord(c) > 0xFFFF and c.isalnum():
        return False
    return c.lower() == c.upper() or ord(c) < 0x530 or 0x1E00 <= ord(c) < 0x2000 or 0xFF00 <= ord(c)


class Kept(dict):
    """Counts of the words met so far; others are counted when they are asked for."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges

    def __missing__(self, word: str) -> int:
        n = self.merges.count(word.encode("utf-8", "surrogateescape"))
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = n
        return n


class Counter:
    """Token counts of texts under one vocabulary."""

    def __init__(self, vocabulary: str) -> None:
        spec = json.loads(vocabulary)
        model = spec["model"]
        if model.get("type", "BPE") != "BPE" or model.get("unk_token") or model.get("continuing_subword_prefix") or model.get("byte_fallback"):
            raise ValueError("a byte-level BPE vocabulary without unknown token is needed")
        self.vocabulary, self.merges = vocabulary, Merges(model)
        special = [t["content"] for t in spec.get("added_tokens", [])]
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens with rules of their own are not known here")
        self.strings = special
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or "(?!)")
        self.kept = Kept(self.merges)
        self.known: dict[str, int] = {}
        self.rules = None

    def _words(self, text: str) -> list[str]:
        if text.isascii():
            return _PLAIN_WORD.findall(text.lower())
        known, kinds = self.known, 0
        for c in set(text):
            kind = known.get(c)
            if kind is None:
                kind = known[c] = 0 if not _sure(c) else 2 if unicodedata.category(c) in ("Nl", "No") else 1
            if not kind:
                return self._words_by_rules(text)
            kinds |= kind
        # a sigma at a word's end stays the common one, as each character is lower-cased by itself
        plain = _SPACES.sub(" ", unicodedata.normalize("NFC", text)).replace("Σ", "σ").lower()
        return (_WORD_AND_NUMBERS if kinds & 2 else _WORD).findall(plain)

    def _words_by_rules(self, text: str) -> list[str]:
        if self.rules is None:
            from tokenizers import Tokenizer
            self.rules = Tokenizer.from_str(self.vocabulary)
            self.letter = {c: b for b, c in enumerate(_byte_letters())}
        found = self.rules.pre_tokenizer.pre_tokenize_str(self.rules.normalizer.normalize_str(text))
        return [bytes(self.letter[c] for c in word).decode("utf-8", "surrogateescape") for word, _ in found]

    def _plain(self, text: str) -> int:
        """Tokens of a text without special strings, cut at spaces so that no piece is long unless a word is."""
        total, at = 0, 0
        while at < len(text):
            end = len(text)
            if at + CHUNK < end and (cut := _CUT.search(text, at + CHUNK)) is not None:
                end = cut.start() + 1
            total += sum(map(self.kept.__getitem__, self._words(text[at:end] if at or end < len(text) else text)))
            at = end
        return total

    def __call__(self, text: str) -> int:
        if not any(s in text for s in self.strings):
            return self._plain(text)
        total, at = 0, 0
        for m in self.special.finditer(text):
            total += self._plain(text[at:m.start()]) + 1
            at = m.end()
        return total + self._plain(text[at:] if at else text)


@lru_cache(maxsize=2)
def _counter(vocabulary: str) -> Counter:
    """One counter a worker, so that the words it knows serve all tasks."""
    return Counter(vocabulary)


def counter_udf(path: str | None = None) -> Callable[[Column], Column]:
    """A function of a text column that gives its tokens (null: 0) under the vocabulary file at `path`."""
    with open(path or default_path(), encoding="utf-8") as f:
        vocabulary = f.read()

    @F.pandas_udf("long")
    def tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = _counter(vocabulary)
        for batch in texts:
            yield pd.Series([0 if t is None else count(t) for t in batch], dtype="int64")
    return tokens


def count_tokens(df: DataFrame, text: str = "text", path: str | None = None, limit: int = LIMIT,
                 into: tuple[str, str, str] = ("n_bytes", "n_tokens", "over_limit")) -> DataFrame:
    """df with the UTF-8 bytes and tokens of each whole text, and whether the tokens are over the limit.

    Null and empty texts have 0 bytes and 0 tokens. Every row is kept and counted by itself: repeated rows and null ids
    are no special case, an empty table stays empty. Columns of df that bear a new column's name are replaced. A text of
    any length is read piece by piece; only a single word is held whole. No rows are shuffled.
    """
    tokens = counter_udf(path)
    clash = {n.lower() for n in into}
    out = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in clash or c == text], F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias(into[0]), tokens(text).alias(into[1]))
    return out.withColumn(into[2], F.col(into[1]) > limit)
