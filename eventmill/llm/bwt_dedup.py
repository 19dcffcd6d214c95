"""Exact substring deduplication by merged Burrows-Wheeler transforms.

Every byte that some 200-byte string covers which also starts elsewhere is removed. Strings are placed by anchors: the
anchor of a 200-byte window is the K bytes within it whose hash is least (the leftmost of equal ones), so equal windows
have equal anchors at equal offsets, and windows that follow each other mostly share one. Stretches of text around an
anchor that occurs once cannot repeat and are set aside; stretches that are equal throughout are one row with a count.

What is left, the distinct stretches around each repeated anchor, is dealt out by anchor. There, shards of them are
transformed one at a time: sorted by what follows the anchor, with the bytes before it as the transform's symbols. The
shards are merged by refining their interleaving a symbol at a time within the blocks that still hold more than one
row, never sorting a shard again; where a block breaks up gives the common prefix of the neighbours. Backward steps
through the transform then split the rows by the bytes before the anchor, and an interval whose rows keep 200 bytes in
common is a repeated string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import cut, written

LENGTH = 200
#: Bytes of an anchor.
K = 40
#: Windows looked at in one piece of a text.
PIECE = 1 << 22
#: Stretches of one shard; stretches that one task merges; stretches from which an anchor is taken window by window.
SHARD, BUCKET, HOT = 4096, 16_384, 16_384
#: Rows of the frames that tasks hand back.
FRAME = 32_768
_PLACE_BITS = 24
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
#: No byte of UTF-8: stands for what lies beyond the ends of a text.
_BEYOND = 0xFF


def text_key(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw) - (1 << 63)


def piece_anchors(raw: bytes, k: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, last window, anchor place) of the windows of a piece, in order."""
    words = np.ndarray(shape=(len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    m, w = len(raw) - k + 1, length - k + 1
    h = words[:m] * _MIX[0]
    for i in range(8, k, 8):
        h = (h ^ (h >> np.uint64(31))) * _MIX[1] + words[i:i + m]
    h = (h ^ (h >> np.uint64(29))) * _MIX[2]
    place = np.uint64((1 << _PLACE_BITS) - 1)
    ranked = ((h ^ (h >> np.uint64(32))) & ~place) | np.arange(m, dtype=np.uint64)
    padded = np.concatenate([ranked, np.full(-m % w, ~np.uint64(0))]).reshape(-1, w)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = m - w + 1
    least = np.minimum(behind[:n], ahead[w - 1:w - 1 + n])
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    last = np.append(first[1:], n) - 1
    return (least[first] >> np.uint64(_PLACE_BITS)).astype(np.int64), first, last, (least[first] & place).astype(np.int64)


def text_anchors(raw: bytes, k: int = K, length: int = LENGTH) -> list[np.ndarray]:
    """Of a whole text: anchor, signature of the stretch, first window, last window, anchor place; one row each."""
    parts = []
    for start in range(0, max(0, len(raw) - length + 1), PIECE):
        piece = raw if start == 0 and len(raw) <= PIECE else raw[start:start + PIECE + length - 1]
        h, first, last, place = piece_anchors(piece, k, length)
        sig = [xxhash.xxh3_64_intdigest(piece[a:b], d) for a, b, d in zip(first.tolist(), (last + length).tolist(), (place - first).tolist())]
        parts.append((h, np.array(sig, dtype=np.uint64).view(np.int64), first + start, last + start, place + start))
    return [np.concatenate(x) for x in zip(*parts)] if parts else []


def shard_order(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Rows of one shard by key and by the bytes from the anchor on."""
    return np.lexsort((*words.T[::-1], keys))


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit length of 64-bit numbers; each half is exact as a float."""
    high = np.frexp((values >> np.uint64(32)).astype(np.float64))[1]
    return np.where(high > 0, 32 + high, np.frexp((values & np.uint64(0xFFFFFFFF)).astype(np.float64))[1])


def merged_order(keys: np.ndarray, words: np.ndarray, shard: int = SHARD) -> tuple[np.ndarray, np.ndarray]:
    """Order of all rows by key and following bytes, and the common bytes of each row with the one before (-1: other key).

    The shards' orders are laid side by side and their interleaving refined one 8-byte symbol a round: rows of a block
    are dealt out by their next symbol, stably, and the block breaks where it changes. Blocks of one row are done.
    """
    shards = [s + shard_order(keys[s:s + shard], words[s:s + shard]) for s in range(0, len(keys), shard)]
    order = np.concatenate(shards)
    order = order[np.argsort(keys[order], kind="stable")]
    same = np.concatenate(([False], keys[order[1:]] == keys[order[:-1]]))
    common = np.where(same, words.shape[1] * 8, -1)
    block = np.cumsum(~same)
    for depth in range(words.shape[1]):
        joined = np.concatenate(([False], block[1:] == block[:-1]))
        open_ = np.flatnonzero(joined | np.append(joined[1:], False))
        if not len(open_):
            break
        rows = order[open_]
        dealt = np.lexsort((words[rows, depth], block[open_]))
        order[open_] = rows = rows[dealt]
        symbol = words[rows, depth]
        changes = 1 + np.flatnonzero((symbol[1:] != symbol[:-1]) & (block[open_][1:] == block[open_][:-1]))
        apart = symbol[changes] ^ symbol[changes - 1]
        common[open_[changes]] = depth * 8 + 8 - (_bits(apart) + 7) // 8
        breaks = np.zeros(len(block), dtype=np.int64)
        breaks[open_[changes]] = 1
        block = block + np.cumsum(breaks)
    return order, common


class Lowest:
    """Least value of any stretch of an array, from a table of powers of two."""

    def __init__(self, values: np.ndarray, longest: int) -> None:
        self.table = [values]
        while (1 << len(self.table)) <= longest:
            half = 1 << (len(self.table) - 1)
            below = self.table[-1]
            self.table.append(np.minimum(below[:-half], below[half:]) if len(below) > half else below)

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), dtype=np.int64)
        for i in np.unique(level):
            at = np.flatnonzero(level == i)
            out[at] = np.minimum(self.table[i][first[at]], self.table[i][last[at] - (1 << int(i)) + 1])
        return out


def repeated_windows(keys: np.ndarray, after: np.ndarray, before: np.ndarray, most: np.ndarray, length: int = LENGTH, shard: int = SHARD) -> tuple[np.ndarray, np.ndarray]:
    """(row, offset): windows that start `offset` bytes before the anchor and are equal to that of another row.

    after: rows x length bytes from the anchor on; before: the bytes before it, nearest first; most: the greatest
    offset of each row's windows. A backward step splits each interval by the byte before; rows alone are done.
    """
    padded = np.full((len(keys), -(-length // 8) * 8), _BEYOND, dtype=np.uint8)
    padded[:, :length] = after
    order, common = merged_order(keys, padded.view(">u8").astype(np.uint64), shard)
    edges = np.flatnonzero(common < 0)
    lowest = Lowest(common, int(np.diff(np.append(edges, len(common))).max()))
    at, interval = np.arange(len(order)), np.cumsum(common < 0)
    rows, offsets = [], []
    for offset in range(int(most.max()) + 1):
        joined = interval[1:] == interval[:-1]
        alone = ~(np.concatenate(([False], joined)) | np.append(joined, False)) | (most[order[at]] < offset)
        at, interval = at[~alone], interval[~alone]
        if not len(at):
            break
        pair = np.flatnonzero(interval[1:] == interval[:-1])
        hit = pair[lowest(at[pair] + 1, at[pair + 1]) >= length - offset]
        found = np.unique(np.concatenate([at[hit], at[hit + 1]]))
        rows.append(order[found])
        offsets.append(np.full(len(found), offset))
        if offset < before.shape[1]:
            symbol = interval * 256 + before[order[at], offset]
            step = np.argsort(symbol, kind="stable")
            at, symbol = at[step], symbol[step]
            interval = np.cumsum(np.concatenate(([0], symbol[1:] != symbol[:-1])))
    return (np.concatenate(rows), np.concatenate(offsets)) if rows else (np.zeros(0, int), np.zeros(0, int))


def spans_of(first: np.ndarray, last: np.ndarray, length: int, n: int) -> np.ndarray:
    """Maximal runs (start, end) of the bytes that windows first..last of each row cover."""
    order = np.argsort(first, kind="stable")
    start, end = first[order], np.minimum(last[order] + length, n)
    reach = np.maximum.accumulate(end)
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    at = np.flatnonzero(new)
    return np.stack([start[at], reach[np.append(at[1:], len(start)) - 1]], axis=1)


def anchor_rows(docs: DataFrame, k: int, length: int) -> DataFrame:
    columns = ["h", "sig", "first", "last", "place"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[list[np.ndarray]] = []
        owners: list[tuple[int, int, int]] = []
        size = 0

        def frame() -> pd.DataFrame:
            k1, did, n = (np.array(x, dtype=np.int64) for x in zip(*owners))
            return pd.DataFrame({c: np.concatenate(x) for c, x in zip(columns, zip(*found))} | {"k1": np.repeat(k1, n), "did": np.repeat(did, n)})[["h", "sig", "k1", "did", "first", "last", "place"]]
        for rows in batches:
            for did, text in zip(rows["did"], rows["text"]):
                raw = text.encode("utf-8", "surrogatepass") if text else b""
                anchors = text_anchors(raw, k, length)
                if anchors:
                    found.append(anchors)
                    owners.append((text_key(raw), did, len(anchors[0])))
                    size += len(anchors[0])
                    if size >= FRAME:
                        yield frame()
                        found, owners, size = [], [], 0
        if owners:
            yield frame()
    return docs.select(F.coalesce("doc_id", F.lit(-1)).alias("did"), "text").mapInPandas(run, "h long, sig long, k1 long, did long, first long, last long, place long")


def packed_texts(docs: DataFrame) -> DataFrame:
    """(k1, did, packed): compressed whole texts under their key."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=1)
        for rows in batches:
            for some in (rows.iloc[s:s + 256] for s in range(0, len(rows), 256)):
                raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in some["text"]]
                yield pd.DataFrame({"doc_id": some["doc_id"].to_numpy(), "k1": [text_key(b) for b in raw], "did": some["did"].to_numpy(), "packed": [press.compress(b) for b in raw]})
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(-1)).alias("did"), "text").mapInPandas(run, "doc_id long, k1 long, did long, packed binary")


def _buckets(rows: DataFrame, n: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(n)))


def repeated_intervals(docs: DataFrame, *, length: int = LENGTH, k: int = K, hot: int = HOT) -> DataFrame:
    """(k1, did, first, last): intervals of window starts of a text whose windows repeat."""
    anchors = anchor_rows(docs, k, length)
    often = anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    chosen = written(anchors.join(often, "h", "left_semi"), "anchors")
    stretches = written(chosen.groupBy("h", "sig").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("did", "k1", "first", "last", "place")).alias("at")), "stretches")
    equal = chosen.join(stretches.filter("n > 1").select("h", "sig"), ["h", "sig"], "left_semi").select("k1", "did", "first", "last")

    kinds = written(stretches.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "kinds")
    several = stretches.join(kinds, "h").select("h", "n", "kinds", "at.*")
    wanted = several.groupBy("k1", "did").agg(F.collect_list(F.struct("h", "n", "kinds", "first", "last", "place")).alias("wanted"))
    reach = length - k

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack, columns = zstandard.ZstdDecompressor(), ["h", "n", "k1", "did", "first", "last", "place", "before", "after", "digest"]
        out: list[tuple] = []
        for rows in batches:
            for k1, did, packed, asked in zip(rows["k1"], rows["did"], rows["packed"], rows["wanted"]):
                raw = unpack.decompress(packed)
                for a in asked:
                    first, last, place = a["first"], a["last"], a["place"]
                    if a["kinds"] <= hot:
                        out.append((a["h"], a["n"], k1, did, first, last, place, raw[max(0, place - reach):place][::-1], raw[place:place + length], None))
                    else:
                        out += [(a["h"], a["n"], k1, did, s, s, place, None, None, hashlib.blake2b(b"%d|" % (place - s) + raw[s:s + length], digest_size=16).digest()) for s in range(first, last + 1)]
                if len(out) >= FRAME // 8:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
        if out:
            yield pd.DataFrame(out, columns=columns)
    row = "h long, n long, k1 long, did long, first long, last long, place long, before binary, after binary, digest binary"
    # a text that has copies under one id is fetched once a copy; such rows only repeat each other
    fetched = written(wanted.join(packed_texts(docs).drop("doc_id"), ["k1", "did"]).mapInPandas(fetch, row), "stretch-texts")

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["h", "k1", "did", "first"]).reset_index(drop=True)
        after = np.full((len(rows), length), _BEYOND, dtype=np.uint8)
        before = np.full((len(rows), reach), _BEYOND, dtype=np.uint8)
        for i, (a, b) in enumerate(zip(rows["after"], rows["before"])):
            after[i, :len(a)] = np.frombuffer(a, dtype=np.uint8)
            before[i, :len(b)] = np.frombuffer(b, dtype=np.uint8)
        first, last, place = (rows[c].to_numpy() for c in ("first", "last", "place"))
        row, offset = repeated_windows(rows["h"].to_numpy(), after, before, place - first, length)
        start = place[row] - offset
        good = (start >= first[row]) & (start <= last[row]) & (rows["n"].to_numpy()[row] == 1)
        row, start = row[good], start[good]
        order = np.lexsort((start, row))
        row, start = row[order], start[order]
        new = np.concatenate(([True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1))) if len(row) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        end = np.append(at[1:], len(row)) - 1 if len(at) else at
        return pd.DataFrame({"k1": rows["k1"].to_numpy()[row[at]], "did": rows["did"].to_numpy()[row[at]], "first": start[at], "last": start[end]})
    buckets = fetched.filter("after is not null").agg(F.count(F.lit(1))).first()[0] // BUCKET + 1
    merged = _buckets(fetched.filter("after is not null"), buckets).groupBy("bucket").applyInPandas(merge, "k1 long, did long, first long, last long")

    # anchors with too many stretches for one task: their windows meet one by one, by offset and digest
    windows = fetched.filter("digest is not null")
    again = windows.groupBy("h", "digest").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    single = windows.filter("n = 1").join(again, ["h", "digest"], "left_semi").select("k1", "did", "first", "last")
    return equal.unionByName(merged).unionByName(single)


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_text: bool = False, **options) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept (binary) if with_text.

    A byte is removed if some `length`-byte string of the text that covers it also starts anywhere else, in the same
    text (overlaps count) or in any other; strings never cross documents and are judged on the input. n_spans counts
    the maximal removed runs; kept_sha256 is the hash of the remaining bytes.

    Nulls: a null text is empty, a null id is kept. Empty and short texts lose nothing; very long texts are read whole,
    in pieces that overlap by length - 1. Repeated rows are documents of their own and so remove each other wholly if
    long enough. Empty tables give no rows. Other columns are ignored.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # rows that repeat a text under one id bring the same intervals each
    found = repeated_intervals(texts, length=length, **options).distinct()
    gathered = found.groupBy("k1", "did").agg(F.collect_list("first").alias("first"), F.collect_list("last").alias("last"))
    kept = ", kept binary" if with_text else ""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor()
        for rows in batches:
            out = []
            for doc_id, packed, first, last in zip(rows["doc_id"], rows["packed"], rows["first"], rows["last"]):
                raw, removed, spans, left = unpack.decompress(packed), 0, 0, None
                if first is not None and len(first):
                    runs = spans_of(np.asarray(first, dtype=np.int64), np.asarray(last, dtype=np.int64), length, len(raw))
                    removed, spans = int((runs[:, 1] - runs[:, 0]).sum()), len(runs)
                    edges = [0, *runs.ravel().tolist(), len(raw)]
                    left = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                left = raw if left is None else left
                out.append((doc_id, len(raw), removed, spans, hashlib.sha256(left).hexdigest(), *([left] if with_text else [])))
            frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else [])])
            yield frame.assign(doc_id=frame["doc_id"].astype("Int64"))
    joined = packed_texts(texts).join(gathered, ["k1", "did"], "left")
    return joined.select("doc_id", "packed", "first", "last").mapInPandas(keep, f"doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string{kept}")
