"""SimHash near-duplicates through anchor points of a covering code.

Two 64-bit fingerprints that differ in at most `max_bits` bits differ in at most one bit in one of max_bits // 2 + 1
equal parts of the word. On the first 2^r - 1 bits of each part the Hamming code is the covering code: its covering
radius is 1, so every fingerprint has exactly one code word, its home anchor, within 1. A fingerprint that differs from
it by one bit lies within 1 + 1 = covering radius plus threshold of that anchor. Each fingerprint is therefore
replicated to every anchor within 2 (16 of them for 31 bits), and per anchor the ones at home are compared with all.
Because that is symmetric, a visitor goes only to anchors below its own home.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import cut, unused
from eventmill.llm.components import components

BITS = 64
SHINGLE = 3
MAX_BITS = 3
#: Hashes whose bits are counted at once.
_BLOCK = 32768


def _hashes(text: str, width: int) -> list[int]:
    """XXH64 (seed 42) of each shingle of the lower-cased words; bytes split just at the six ASCII white-space bytes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) < width:
        return [xxhash.xxh64_intdigest(line, 42)]
    digest = xxhash.xxh64_intdigest
    return [digest(line[s:e], 42) for s, e in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist())]


def _bit_counts(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit set."""
    total = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _BLOCK):
        part = np.array(hashes[at:at + _BLOCK], dtype="<u8")
        total += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return total


def text_fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """A bit is 1 if set in over half of the shingle hashes; no words give 0. Signed 64-bit."""
    hashes = _hashes(text, width) if text else []
    if not hashes:
        return 0
    on = (_bit_counts(hashes) * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(on, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint long) of every whole text; null and empty texts have fingerprint 0."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({"doc_id": rows["doc_id"], "fingerprint": np.array([text_fingerprint(t, width) for t in rows["text"]], dtype=np.int64)})
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(run, "doc_id long, fingerprint long")


def hamming_checks(length: int) -> list[int]:
    """Masks of the parity checks of the Hamming code of that length (2^r - 1): check k covers positions with bit k."""
    return [sum(1 << (p - 1) for p in range(1, length + 1) if p >> k & 1) for k in range(length.bit_length())]


def anchors_of(words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Home anchor of each word, and the other anchors within distance 2 (one row per word; the home repeated if none).

    The syndrome of a word is the position to flip to reach its home. A word at distance 1 from its home has further
    code words at distance 2: those reached by flipping two positions whose exclusive or is the syndrome.
    """
    words = words.astype(np.uint64)
    syndrome = np.zeros(len(words), dtype=np.uint64)
    for k, mask in enumerate(hamming_checks(length)):
        syndrome |= (np.bitwise_count(words & np.uint64(mask)).astype(np.uint64) & np.uint64(1)) << np.uint64(k)
    one = np.uint64(1)
    home = np.where(syndrome > 0, words ^ (one << (np.maximum(syndrome, one) - one)), words)
    others = np.repeat(home[:, None], length // 2, axis=1)
    for s in range(1, length + 1):
        pairs = np.array([(1 << (i - 1)) ^ (1 << ((i ^ s) - 1)) for i in range(1, length + 1) if i < i ^ s], dtype=np.uint64)
        at = syndrome == s
        others[at] = words[at][:, None] ^ pairs[None, :]
    return home, others


def replicated(prints: DataFrame, max_bits: int) -> DataFrame:
    """(part, anchor, at_home, fingerprint): each fingerprint at its home and at the lower anchors within reach."""
    parts = max_bits // 2 + 1
    part_bits = BITS // parts
    length = 2 ** ((part_bits + 1).bit_length() - 1) - 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            word = rows["fingerprint"].to_numpy(dtype=np.int64)
            for part in range(parts):
                piece = word.view(np.uint64) >> np.uint64(part * part_bits) & np.uint64(2**length - 1)
                home, others = anchors_of(piece, length)
                lower = others < home[:, None]
                which, _ = np.nonzero(lower)
                yield pd.DataFrame({"part": np.int32(part), "anchor": np.concatenate([home, others[lower]]).astype(np.int64),
                                    "at_home": np.concatenate([np.ones(len(home), bool), np.zeros(len(which), bool)]),
                                    "fingerprint": np.concatenate([word, word[which]])})
    return prints.select("fingerprint").mapInPandas(run, "part int, anchor long, at_home boolean, fingerprint long")


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): pairs of distinct fingerprints that differ in at most max_bits bits, found per anchor."""
    placed = replicated(prints, max_bits)
    home = placed.filter("at_home").select("part", "anchor", F.col("fingerprint").alias("a"))
    every = placed.select("part", "anchor", "at_home", F.col("fingerprint").alias("b"))
    near = (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits) & (~F.col("at_home") | (F.col("a") < F.col("b")))
    same = (home["part"] == every["part"]) & (home["anchor"] == every["anchor"])
    return home.join(every, same & near).select("a", "b")


def classes(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fingerprint, root, component_id) for each distinct fingerprint of (doc_id, fingerprint): the smallest linked
    fingerprint, and the smallest doc_id among all that links reach (null if none is known)."""
    distinct = cut(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    linked = components(fingerprint_links(distinct, max_bits)).withColumnRenamed("node", "fingerprint")
    rooted = cut(distinct.join(linked, "fingerprint", "left").withColumn("root", F.coalesce("component", "fingerprint")))
    in_links = rooted.filter("component is not null")
    smallest = in_links.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return in_links.join(smallest, "root").select("fingerprint", "root", "component_id").unionByName(
        rooted.filter("component is null").select("fingerprint", "root", F.col("first_id").alias("component_id")))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (long), component_id (the smallest doc_id that links reach).

    Texts are lower-cased in A-Z and split into words; shingles of `width` words count with their repeats; a text with
    fewer words is one shingle; a null, empty or blank text has fingerprint 0 and links like any other. Documents with
    equal fingerprints are one class from the start, so large groups of copies cost one row. Ties and repeated rows
    share a class; a row with a null id gets the class of its fingerprint (null only if no id in the class is known).
    Empty tables give no rows; other columns are ignored.
    """
    prints = cut(fingerprints(docs, id_col=id_col, text_col=text_col, width=width))
    return prints.join(classes(prints, max_bits).drop("root"), "fingerprint").select("doc_id", "fingerprint", "component_id")


def deduplicated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of docs, all columns, that stay: one row of each group of linked documents, decided row by row.

    The row that stays has the group's smallest id and, where rows of unlike texts bear it, the smallest fingerprint among
    those of this group; where no id of a group is known, its smallest fingerprint. Rows that repeat that id and fingerprint
    leave one. Rows that share an id but no group do not touch each other. A row joins its decision by id and fingerprint
    computed anew; texts are shuffled for the rows alone whose id and fingerprint repeat.
    """
    prints = cut(fingerprints(docs, id_col=id_col, text_col=text_col, width=width).groupBy("doc_id", "fingerprint").agg(F.count(F.lit(1)).alias("n")))
    named = cut(classes(prints, max_bits))
    own = prints.join(named, "fingerprint").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = own.groupBy("root").agg(F.min_by(F.struct("doc_id", "fingerprint", "n"), "fingerprint").alias("c")).select("c.*")
    key, print_col, times = unused(docs, "chosen_id"), unused(docs, "fingerprint"), unused(docs, "times")

    @F.pandas_udf("long")
    def printed(text: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(t, width) for t in text], dtype="int64")
    chosen = cut(chosen.select(F.col("doc_id").cast(docs.schema[id_col].dataType).alias(key), F.col("fingerprint").alias(print_col), F.col("n").alias(times)))
    rows = docs.withColumn(print_col, printed(text_col))
    met = rows.join(chosen, F.col(id_col).eqNullSafe(F.col(key)) & (rows[print_col] == chosen[print_col])).drop(chosen[print_col])
    met = met.select(*[F.col(f"`{c}`") for c in docs.columns], print_col, times)
    once = met.filter(F.col(times) == 1)
    repeated = met.filter(F.col(times) > 1).dropDuplicates([id_col, print_col])
    return once.unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])


def hex_print(col: str = "fingerprint"):
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))
