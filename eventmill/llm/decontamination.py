"""Benchmark decontamination: q-gram lemma over diagonal bands, verified by banded alignment.

If a stretch of a text lies within k edits of a passage of m characters, the two share at least m + 1 - q - k * q of the
passage's q-grams, and the places where they share them lie on diagonals (place in the text minus place in the
passage) no further apart than k. Shared q-grams are therefore counted in bands of diagonals that are 2k wide and
start k apart, so that some band holds all of them; bands that reach the count are kept as regions, and each is
aligned with the passage within its band.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Q = 9
#: Edits allowed per character of a passage.
EDIT_RATE = 0.08
#: Passages are taken in blocks of at most so many characters; a block's index is what one broadcast holds.
BLOCK_CHARS = 2_000_000
#: Characters of a text looked up at once.
PIECE = 1 << 20
#: Places of a text that do not lie near this many places with too few known q-grams are set aside before the bands.
WINDOW = 128
_FILTER_BITS = 21
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def folded(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased text with runs of white space as one space, and where each stands in the text."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint32)
    lowered = text.lower()
    code = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint32)
    if len(code) != len(raw):  # a few characters lower-case to two; those texts are folded character by character
        code = np.array([ord(c.lower()[0]) for c in text], dtype=np.uint32)
    space = (code == 32) | ((code >= 9) & (code <= 13)) | (code == 0xA0)
    code = np.where(space, np.uint32(32), code)
    keep = ~(space & np.concatenate(([True], space[:-1]))) if len(code) else np.zeros(0, bool)
    return code[keep], np.flatnonzero(keep)


def qgrams(code: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit number for each run of q characters."""
    n = len(code) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(q):
        out = out * np.uint64(0x100000001B3) + code[i:i + n].astype(np.uint64)
    out *= _FACTOR
    return out ^ (out >> np.uint64(29))


def budget(m: int, rate: float, q: int) -> int:
    """Edits allowed for a passage of m characters; for short ones as many as leave one q-gram whole at least."""
    return max(0, min(int(math.floor(m * rate + 1e-9)), (m - q) // q))


@dataclass
class Index:
    """The q-grams of a block of passages, sorted, with a bit table in front."""

    items: list
    passages: list[np.ndarray]
    q: int
    rate: float

    def __post_init__(self) -> None:
        grams = [qgrams(p, self.q) for p in self.passages]
        all_grams = np.concatenate(grams) if grams else np.zeros(0, dtype=np.uint64)
        owner = np.concatenate([np.full(len(g), i, dtype=np.int32) for i, g in enumerate(grams)]) if grams else np.zeros(0, np.int32)
        place = np.concatenate([np.arange(len(g), dtype=np.int32) for g in grams]) if grams else np.zeros(0, np.int32)
        order = np.argsort(all_grams, kind="stable")
        self.grams, self.owner, self.place = all_grams[order], owner[order], place[order]
        self.known = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.known[(all_grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        length = np.array([len(p) for p in self.passages], dtype=np.int64)
        self.edits = np.array([budget(int(m), self.rate, self.q) for m in length], dtype=np.int64)
        self.needed = np.maximum(1, length + 1 - self.q - self.edits * self.q)
        self.span = int((length + self.edits).max()) if len(length) else 1
        # passages with fewer characters than a q-gram have no edits and are looked for as they stand
        self.short = np.flatnonzero(length < self.q).tolist()
        self.edits[self.short] = 0
        windows = -(-(length + self.edits) // WINDOW)
        self.dense = int((-(-self.needed // np.maximum(1, windows))).min()) if len(length) else 1

    def near(self, known: np.ndarray) -> np.ndarray:
        """Of the places with a known q-gram, those that may belong to a match.

        A match covers at most ceil((m + k) / WINDOW) windows and holds `needed` known places, so some window of it
        holds `dense` of them; the match then lies within its own length of that window.
        """
        total = np.concatenate(([0], np.cumsum(known)))
        n = len(known)
        ends = np.minimum(np.arange(n) + WINDOW, n)
        full = np.flatnonzero(total[ends] - total[:-1] >= self.dense)
        mark = np.zeros(n + 1, dtype=np.int64)
        np.add.at(mark, np.maximum(full - self.span, 0), 1)
        np.add.at(mark, np.minimum(full + WINDOW + self.span, n), -1)
        return np.flatnonzero((np.cumsum(mark[:-1]) > 0) & known)

    def hits(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, place in the text, place in the passage) of the shared q-grams that may belong to a match."""
        known = np.zeros(max(0, len(code) - self.q + 1), dtype=bool)
        for s in range(0, len(known), PIECE):
            grams = qgrams(code[s:s + PIECE + self.q - 1], self.q)
            at = np.flatnonzero(self.known[(grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            left = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
            known[at[self.grams[left] == grams[at]] + s] = True
        at = self.near(known) if known.any() else np.zeros(0, dtype=np.int64)
        if not len(at):
            return at, at, at
        grams = qgrams(code[at[:, None] + np.arange(self.q)].ravel(), self.q)[::self.q] if self.q > 1 else code[at].astype(np.uint64)
        left = np.searchsorted(self.grams, grams, side="left")
        count = np.searchsorted(self.grams, grams, side="right") - left
        which = np.repeat(left - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        return self.owner[which].astype(np.int64), np.repeat(at, count), self.place[which].astype(np.int64)

    def regions(self, code: np.ndarray) -> list[tuple[int, int, int]]:
        """(passage, first diagonal, last diagonal) of the bands with enough shared q-grams."""
        owner, at, place = self.hits(code)
        if not len(owner):
            return []
        step = np.maximum(1, self.edits)
        longest = int(max(len(p) for p in self.passages)) + 1
        shift = longest + 2  # keeps the numbers of the bands positive
        bands = len(code) + 2 * shift
        band = (at - place) // step[owner] + shift
        keys = np.unique(np.concatenate([(owner * bands + band - back) * longest + place for back in (0, 1)]))  # a place of the passage counts once a band
        both, counts = np.unique(keys // longest, return_counts=True)
        which, number = both // bands, both % bands - shift
        good = counts >= self.needed[which]
        return [(int(i), int(b * step[i]), int((b + 2) * step[i] - 1)) for i, b in zip(which[good], number[good])]


def found_whole(passage: np.ndarray, text: np.ndarray) -> int | None:
    """Where the passage stands in the text without an edit."""
    whole, part, at = text.tobytes(), passage.tobytes(), -1
    while True:
        at = whole.find(part, at + 1)
        if at < 0:
            return None
        if at % 4 == 0:
            return at // 4


def banded_distance(passage: np.ndarray, text: np.ndarray, low: int, high: int, most: int, from_start: bool = False) -> tuple[int, int] | None:
    """(edits, end in the text) of the best alignment of the whole passage within diagonals low to high; None above most.

    The alignment may begin anywhere in the text, or only at its start, and end anywhere. Row i of the table holds the cells of passage place i on
    diagonals low - most to high + most; a step along a row is a minimum over the cells to its left.
    """
    first, last = low - most, high + most
    width = last - first + 1
    far = most + 1
    slope = np.arange(width)
    ends = slope + first  # text characters used at row 0
    row = np.where((ends >= 0) & (ends <= len(text)), np.minimum(ends, far) if from_start else 0, far)
    padded = np.concatenate([text.astype(np.int64), [-1]])
    for i in range(1, len(passage) + 1):
        ends = slope + first + i
        inside = (ends >= 1) & (ends <= len(text))
        char = padded[np.where(inside, ends - 1, len(text))]
        across = row + (char != int(passage[i - 1]))
        down = np.append(row[1:], far) + 1
        row = np.where(inside, np.minimum(across, down), np.where(ends == 0, down, far))
        row = np.minimum(np.minimum.accumulate(row - slope) + slope, far)
        row = np.where((ends >= 0) & (ends <= len(text)), row, far)
        if row.min() >= far:
            return None
    best = int(np.argmin(row))
    return (int(row[best]), best + first + len(passage)) if row[best] <= most else None


def text_matches(text: str | None, index: Index) -> list[tuple[int, int, int, int]]:
    """(passage, edits, start, end): the best stretch of the text for each passage within its budget."""
    if not text:
        return []
    code, where = folded(text)
    best: dict[int, tuple[int, int, int]] = {}
    for i in index.short:
        at = found_whole(index.passages[i], code)
        if at is not None:
            best[i] = (0, int(where[at]), int(where[at + len(index.passages[i]) - 1]) + 1)
    for i, low, high in index.regions(code):
        passage, most = index.passages[i], int(index.edits[i])
        if i in best and best[i][0] == 0:
            continue
        begin = max(0, low - most)
        window = code[begin:high + most + len(passage) + 1]
        exact = found_whole(passage, window)
        if exact is not None:
            at = begin + exact
            best[i] = (0, int(where[at]), int(where[at + len(passage) - 1]) + 1)
            continue
        got = banded_distance(passage, window, low - begin, high - begin, most)
        if got and (i not in best or got[0] < best[i][0]):
            back = banded_distance(passage[::-1], window[:got[1]][::-1], 0, 0, got[0], from_start=True)  # the same stretch from its end
            length = back[1] if back else len(passage)
            end = begin + got[1]
            best[i] = (got[0], int(where[max(0, end - length)]), int(where[end - 1]) + 1)
    return [(i, *v) for i, v in sorted(best.items())]


def passage_blocks(benchmark: DataFrame, id_col: str, text_col: str, q: int, rate: float, block_chars: int) -> Iterator[Index]:
    """Indexes of the distinct passages, a block at a time. Passages with too few characters for the lemma
    (none of their q-grams need survive the edits) get as many edits as leave one q-gram, those shorter than q none; empty
    ones are left out, as every text would hold them."""
    items, passages, size = [], [], 0
    rows = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).filter("t is not null").distinct()
    for row in rows.orderBy("i", "t").toLocalIterator():
        code = folded(row["t"].strip())[0]
        if not len(code):
            continue
        items.append(row["i"])
        passages.append(code)
        size += len(code)
        if size >= block_chars:
            yield Index(items, passages, q, rate)
            items, passages, size = [], [], 0
    if items:
        yield Index(items, passages, q, rate)


def contaminations(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
                   q: int = Q, rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, edits, start, end.

    A document holds an item if some stretch of its text, lower-cased and with runs of white space as one space, lies
    within floor(rate * length) edits of the whole item. edits is the least such number; start and end (code points of
    the text as given) bound one stretch with it.

    Nulls: documents with a null text match nothing, a null id is kept, that of an item too; items with a null or blank text
    are left out. An item with fewer than q characters is found as it stands, without edits. Empty texts match nothing; very long texts are read whole, in pieces that overlap
    by q - 1. Repeated documents and items give their rows each (equal (item, text) rows once). Empty tables on either
    side give no rows. Other columns are ignored. The passages are the stated query set: they are read a block at a
    time, each block's index (about 40 bytes a character) goes to every task, and all texts pass by it.
    """
    spark: SparkSession = docs.sparkSession
    schema = "doc_id long, item_id long, edits int, start int, end int"
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = spark.createDataFrame([], schema)
    for index in passage_blocks(benchmark, item_id_col, item_text_col, q, rate, block_chars):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            block = shared.value
            for rows in batches:
                found = [(d, block.items[i], e, s, t) for d, text in zip(rows["doc_id"], rows["text"]) for i, e, s, t in text_matches(text, block)]
                yield pd.DataFrame(found, columns=["doc_id", "item_id", "edits", "start", "end"]).astype({"item_id": "Int64", "edits": "int32", "start": "int32", "end": "int32"})
        out = out.unionByName(texts.mapInPandas(run, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
          q: int = Q, rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """docs without the rows whose text holds a benchmark item, decided row by row: ids may repeat or be null."""
    spark: SparkSession = docs.sparkSession
    out = docs
    for index in passage_blocks(benchmark, item_id_col, item_text_col, q, rate, block_chars):
        shared = spark.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for rows in batches:
                yield rows.filter(pa.array([not text_matches(t, block) for t in rows.column(text_col).to_pylist()], pa.bool_()))
        out = out.mapInArrow(keep, docs.schema)
    return out
