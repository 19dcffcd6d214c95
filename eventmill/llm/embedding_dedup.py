"""Embedding near-duplicates through a forest of random-projection trees with spill.

Each tree splits its nodes, again and again, at the median of a projection drawn for the node; vectors near the cut go to
both sides, so that close vectors stay together. How near follows from the threshold. Splitting goes on until a leaf is
small enough, or until splits leave as many pairs to compare as before: a dense group is compared whole, in pieces.
Vectors are compared as they are, in double precision. A pair is counted in one cell only, the first of those it meets
in, and cells hand back counts and a spanning forest, so that no row is made per pair.

Splits are fitted per node on a bounded sample, a few levels at a time; a round of the loop sends every vector of the
nodes that are still too large through its node's splits, and nodes never meet in one task before they are small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmill.llm.common import cut, written
from eventmill.llm.components import components

THRESHOLD = 0.93
TREES = 8
#: Vectors that a leaf may hold, and the least share of a node's vectors beyond its cut that go to both sides.
LEAF = 1024
SPILL = 0.05
#: Directions a split chooses from, and the share of a node's pairs that its children may be left with together.
TURNS = 4
WORTH = 0.9
#: Vectors of a node that its splits are fitted on.
SAMPLE = 2048
SEED = 11
#: Vectors of one cell compared in one task; larger cells (dense groups) are compared piece against piece.
PIECE = 8192
#: Vectors of a piece compared in one matrix product.
BLOCK = 2048


def packed(vector, kind: str) -> bytes | None:
    """The vector's numbers as bytes; None if null, empty, zero or not finite throughout."""
    v = np.zeros(0) if vector is None else np.asarray(vector, dtype=kind)
    return v.tobytes() if len(v) and np.isfinite(v).all() and v.any() else None


def unit_rows(vectors: pd.Series, kind: str) -> np.ndarray:
    """Packed vectors as rows of length 1, in double precision."""
    rows = np.frombuffer(b"".join(vectors), dtype=kind).reshape(len(vectors), -1).astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def margin_of(threshold: float) -> float:
    """Projection units on either side of a cut that go to both sides.

    On a direction of standard normal numbers the ends of a link at the threshold differ by sqrt(2 - 2 * threshold) in
    standard deviation; half of it on either side parts only those that differ by more.
    """
    return float(np.sqrt(max(0.0, 2 - 2 * threshold)) / 2)


@dataclass
class Splits:
    """A few levels of splits below a node: the cuts of the inner nodes in heap order, directions drawn from the seed."""

    seed: int
    low: np.ndarray
    high: np.ndarray
    turn: np.ndarray

    def direction(self, inner: int, width: int, turn: int) -> np.ndarray:
        return np.random.default_rng([self.seed, inner, turn]).standard_normal(width)

    def route(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, child) pairs: the children, 0 to 2^levels - 1, that each vector goes to. Infinite cuts send all left."""
        row, node = np.arange(len(vectors)), np.zeros(len(vectors), dtype=np.int64)
        for inner in range(len(self.low)):
            here = np.flatnonzero(node == inner)
            if not len(here):
                continue
            if np.isposinf(self.low[inner]):
                node[here] = 2 * inner + 1
                continue
            value = vectors[row[here]] @ self.direction(inner, vectors.shape[1], int(self.turn[inner]))
            left, right = value <= self.high[inner], value > self.low[inner]
            node[here] = np.where(left, 2 * inner + 1, 2 * inner + 2)
            both = here[left & right]
            row, node = np.append(row, row[both]), np.append(node, np.full(len(both), 2 * inner + 2))
        return row, node - len(self.low)


def fit_splits(sample: np.ndarray, size: int, seed: int, leaf: int = LEAF, spill: float = SPILL, margin: float = 0.0) -> Splits | None:
    """Splits for a node of `size` vectors from a sample of them; None if no split of the node saves comparisons.

    Of a few directions each split takes the one that leaves the fewest pairs.
    """
    levels = max(1, min(int(np.ceil(np.log2(max(2.0, size / leaf)))), int(np.log2(max(2, len(sample) / 32)))))
    inner = 2**levels - 1
    splits = Splits(seed, np.full(inner, np.inf), np.full(inner, np.inf), np.zeros(inner, dtype=np.int64))
    parts = {0: np.arange(len(sample))}
    for i in range(inner):
        rows = parts.pop(i, np.zeros(0, dtype=np.int64))
        best = None
        for turn in range(TURNS if len(rows) > 1 else 0):
            value = sample[rows] @ splits.direction(i, sample.shape[1], turn)
            middle = np.median(value)
            low, high = np.quantile(value, [0.5 - spill, 0.5 + spill])
            low, high = min(low, middle - margin), max(high, middle + margin)
            left, right = value <= high, value > low
            pairs = (left.sum() ** 2 + right.sum() ** 2) / len(rows) ** 2
            if best is None or pairs < best[0]:
                best = pairs, low, high, turn, left, right
        if best is None or best[0] > WORTH:
            if i == 0:
                return None
            parts[2 * i + 1] = rows  # all go left; the next round tells with a sample of their own
            continue
        _, splits.low[i], splits.high[i], splits.turn[i], left, right = best
        parts[2 * i + 1], parts[2 * i + 2] = rows[left], rows[right]
    return splits


def linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of a and b have a cosine that reaches the threshold, by the same sum of products wherever a pair is met."""
    product = a @ b.T
    hit = product >= threshold + 1e-9
    i, j = np.nonzero((product >= threshold - 1e-9) & ~hit)
    hit[i, j] = np.einsum("ij,ij->i", a[i], b[j]) >= threshold
    return hit


def disown(hit: np.ndarray, first: list[np.ndarray], second: list[np.ndarray]) -> None:
    """Drops the hits whose ends share one of the cells given for each row of either side."""
    rows, columns = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
    if not len(rows):
        return

    def by_cell(lists: list[np.ndarray], at: np.ndarray) -> dict[int, np.ndarray]:
        cells, row = np.concatenate([lists[r] for r in at]), np.repeat(at, [len(lists[r]) for r in at])
        order = np.argsort(cells, kind="stable")
        found, start = np.unique(cells[order], return_index=True)
        return dict(zip(found.tolist(), np.split(row[order], start[1:])))
    here, there = by_cell(first, rows), by_cell(second, columns)
    for cell in here.keys() & there.keys():
        hit[np.ix_(here[cell], there[cell])] = False


def forest(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) pairs that connect what the hits connect: the hits themselves, or a tree per group if those are fewer."""
    rows, columns = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
    if np.count_nonzero(hit) <= len(rows) + len(columns):
        return np.nonzero(hit)
    a, b, open_rows = [], [], hit.any(axis=1)
    fresh = hit.any(axis=0)
    for root in rows:
        if not open_rows[root]:
            continue
        open_rows[root] = False
        edge = np.array([root])
        while len(edge):
            reached = hit[edge][:, fresh]
            new = np.flatnonzero(fresh)[reached.any(axis=0)]
            a.append(edge[reached.argmax(axis=0)[reached.any(axis=0)]])
            b.append(new)
            fresh[new] = False
            back = hit[:, new][open_rows]
            edge = np.flatnonzero(open_rows)[back.any(axis=1)]
            a.append(edge)
            b.append(new[back.argmax(axis=1)[back.any(axis=1)]] if len(new) else edge)
            open_rows[edge] = False
    return np.concatenate(a), np.concatenate(b)


def leaves(vectors: DataFrame, kind: str, *, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, margin: float = 0.0, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """(tree, node, key) with every vector in the leaves it falls into; vectors: key, label, vec (packed).

    Equal labels alone meet: the label is the root of each tree. node names the path from there.
    """
    placed = "tree int, node string, key long, vec binary"
    at = vectors.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).select(
        F.col("tree").cast("int"), F.col("label").cast("string").alias("node"), "key", "vec")
    done = None
    while True:
        sizes = cut(at.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("size")))
        small = at.join(sizes.filter(F.col("size") <= leaf).select("tree", "node"), ["tree", "node"]).select("tree", "node", "key")
        done = small if done is None else done.unionByName(small)
        large = sizes.filter(F.col("size") > leaf)
        if large.isEmpty():
            return done
        # about `sample` vectors of each large node, chosen by the hash of key and node
        chance = F.pmod(F.xxhash64("key", "node", "tree"), F.lit(1 << 30)) < F.least(F.lit(1.0), F.lit(1.0 * sample) / F.col("size")) * (1 << 30)
        drawn = at.join(large, ["tree", "node"]).filter(chance)

        def fit(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("key")
            tree, node, size = int(rows["tree"].iloc[0]), rows["node"].iloc[0], int(rows["size"].iloc[0])
            number = seed + 7919 * tree + sum((i + 1) * ord(c) for i, c in enumerate(node)) * 104729
            splits = fit_splits(unit_rows(rows["vec"], kind), size, number, leaf, spill, margin)
            low, high, turn = (splits.low, splits.high, splits.turn) if splits else [np.zeros(0)] * 3
            return pd.DataFrame({"tree": [np.int32(tree)], "node": [node], "seed": [number], "low": [low.tolist()], "high": [high.tolist()], "turn": [turn.astype(np.int64).tolist()]})
        fitted = cut(drawn.groupBy("tree", "node").applyInPandas(fit, "tree int, node string, seed long, low array<double>, high array<double>, turn array<long>"))
        dense = fitted.filter(F.size("low") == 0).select("tree", "node")
        done = done.unionByName(at.join(dense, ["tree", "node"]).select("tree", "node", "key"))

        def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                for (tree, node, number), part in rows.groupby(["tree", "node", "seed"], sort=False):
                    splits = Splits(int(number), np.asarray(part["low"].iloc[0]), np.asarray(part["high"].iloc[0]), np.asarray(part["turn"].iloc[0]))
                    row, child = splits.route(unit_rows(part["vec"], kind))
                    yield pd.DataFrame({"tree": np.int32(tree), "node": [f"{node}/{number % 1000}.{c}" for c in child],
                                        "key": part["key"].to_numpy()[row], "vec": part["vec"].to_numpy()[row]})
        at = cut(at.join(fitted.filter(F.size("low") > 0), ["tree", "node"]).mapInPandas(route, placed))


def links(vectors: DataFrame, kind: str, *, threshold: float = THRESHOLD, **options) -> DataFrame:
    """(a, b, others): what is found of the links; vectors: key, label, n, vec.

    Rows with a null b add the n of linked vectors to a; over all rows each link of the forest counts once. Rows with a
    b connect all that links connect. Links are found where two vectors share a cell (a leaf, or a dense node) and
    counted in the least such cell. A large cell is compared piece against piece, each pair of pieces a group of its
    own, so no group holds more than two pieces.
    """
    placed = written(leaves(vectors.drop("n"), kind, margin=margin_of(threshold), **options).select(F.xxhash64("tree", "node").alias("cell"), "key"), "leaves")
    pieces = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("pieces"))
    cells = placed.join(pieces, "cell").groupBy("key").agg(F.sort_array(F.collect_set(F.struct("cell", "pieces"))).alias("cells"))
    spread = cells.join(vectors.drop("label"), "key").select("key", "n", "vec", F.col("cells.cell").alias("all"), F.explode("cells").alias("c")).select(
        "key", "n", "vec", "c.cell", "c.pieces", F.filter("all", lambda x: x < F.col("c.cell")).alias("before"))
    spread = spread.withColumn("piece", F.pmod(F.xxhash64("key"), F.col("pieces")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    grouped = spread.withColumn("other", other).select(
        "cell", F.least("piece", "other").alias("p"), F.greatest("piece", "other").alias("q"), "piece", "key", "n", "vec", "before")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        units, keys, n, piece = unit_rows(rows["vec"], kind), rows["key"].to_numpy(), rows["n"].to_numpy(), rows["piece"].to_numpy()
        before = [np.asarray(x, dtype=np.int64) for x in rows["before"]]
        p, q = rows["p"].iloc[0], rows["q"].iloc[0]
        first, second = (np.flatnonzero(piece == p), np.flatnonzero(piece == q))
        others, a, b = np.zeros(len(keys), dtype=np.int64), [], []
        for i in range(0, len(first), BLOCK):
            for j in range(i if p == q else 0, len(second), BLOCK):
                x, y = first[i:i + BLOCK], second[j:j + BLOCK]
                hit = linked(units[x], units[y], threshold)
                if p == q and i == j:
                    hit = np.triu(hit, 1)
                disown(hit, [before[r] for r in x], [before[r] for r in y])
                others[x] += hit @ n[y]
                others[y] += n[x] @ hit
                u, v = forest(hit)
                a.append(keys[x][u])
                b.append(keys[y][v])
        counted = np.flatnonzero(others)
        edges = pd.DataFrame({"a": np.concatenate([*a, keys[:0]]), "b": np.concatenate([*b, keys[:0]])}).drop_duplicates()
        return pd.concat([
            pd.DataFrame({"a": keys[counted], "b": pd.array([None] * len(counted), dtype="Int64"), "others": others[counted]}),
            pd.DataFrame({"a": edges["a"], "b": edges["b"].astype("Int64"), "others": np.zeros(len(edges), dtype=np.int64)})])
    return grouped.groupBy("cell", "p", "q").applyInPandas(compare, "a long, b long, others long")


def near_duplicates(embeddings: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, **options) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null and their cosine in double precision is at least the threshold.
    Equal vectors of a label are one class from the start; their members link with each other and with all that the
    class links with, so a large group of copies adds counts, not pairs. n_links counts the other vectors linked
    directly, component_id is the smallest vec_id that links reach, kept says whether that is the vector itself.

    Nulls: vectors that are null, empty, zero, or hold null or non-finite components, and those with a null label, link
    with nothing (component_id is their own id); a null id is kept with its row, counts as a linked vector and names no
    component. Repeated rows are vectors of their own. Empty tables give no rows. Other columns are ignored.
    """
    element = embeddings.schema[vector_col].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({"vec_id": rows["vec_id"], "label": rows["label"], "vec": [packed(v, kind) for v in rows["v"]]})
    usable = F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull())
    numbers = F.col(vector_col).cast("array<float>" if kind == "<f4" else "array<double>")
    source = embeddings.select(F.col(id_col).alias("vec_id"), F.col(label_col).cast("string").alias("label"), numbers.alias("v"))
    source = source.withColumn("v", F.when(usable, F.col("v"))).withColumn("label", F.concat_ws("/", F.size("v"), F.col("label")))  # lengths that differ never meet
    rows = written(source.mapInPandas(pack, "vec_id long, label string, vec binary"), "vectors")
    alone, linked = rows.filter("vec is null"), rows.filter("vec is not null")
    copies = written(linked.groupBy("label", "vec").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id")).withColumn(
        "key", F.xxhash64("label", "vec")), "vector-classes")
    near = cut(links(copies.select("key", "label", "n", "vec"), kind, threshold=threshold, **options))
    degree = near.filter("b is null").groupBy(F.col("a").alias("key")).agg(F.sum("others").alias("others"))
    roots = components(near.filter("b is not null")).withColumnRenamed("node", "key")
    named = copies.drop("vec", "label").join(roots, "key", "left").withColumn("root", F.coalesce("component", "key"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    facts = cut(named.join(smallest, "root").join(degree, "key", "left").select(
        "key", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"))
    found = linked.select("vec_id", F.xxhash64("label", "vec").alias("key")).join(facts, "key").select("vec_id", "n_links", "component_id")
    out = found.unionByName(alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
