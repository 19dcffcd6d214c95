"""Audit of how far the sources of a language lie apart in their words, by a cube of group x group x term blocks.

Words are counted per (lang, source) once. Groups of a language are dealt to group blocks and its kept words to term
blocks; a task owns one cell (group block, group block, term block), gets the two slices of counts that meet there, and
sums the divergences of all its pairs of groups over its words. Cells that differ only in the term block are added up
afterwards. Every slice is copied to one cell for each group block, so a cell's size is bounded by the block sizes,
whatever the number of groups and words.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmill.llm.common import written

#: Documents of a language that must hold a word.
MIN_DOCS = 10
TOP = 10
UNIT = 1_000_000_000
#: Groups and words of a block, on average.
GROUP_BLOCK = 16
TERM_BLOCK = 4096
#: Characters read at once, and (group, word) entries that a task holds before it hands them on.
PIECE = 1 << 20
ENTRIES = 400_000
#: What is no part of a word: white space, digits, signs and control characters of ASCII. A-Z become a-z.
_LETTERS = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded piece at a time (a piece ends where a word ends)."""
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        if end < len(text):
            end = text.find(b" ", end)
            end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and group: occurrences and documents of each word, and one row without a word for the group itself."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)

    def out() -> Iterator[pa.RecordBatch]:
        for group, words in counts.items():
            held = docs[group]
            keys = list(words)
            for at in range(0, len(keys), 32768):
                part = keys[at:at + 32768]
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(pa.scalar(group[0], pa.string()), len(part)), pa.repeat(pa.scalar(group[1], pa.string()), len(part)),
                    pa.array(part, pa.binary()).cast(pa.string()), pa.array([words[w] for w in part], pa.int64()),
                    pa.array([held[w] for w in part], pa.int64())], schema=_COUNTS)
        if counts:
            yield pa.RecordBatch.from_pylist([{"lang": g[0], "source": g[1], "term": None, "n": 0, "docs": 0} for g in counts], _COUNTS)
        counts.clear()
        docs.clear()

    unread = 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2)):
            group, seen = (lang, source), set()
            words = counts[group]
            body = (text.as_py() or "").encode("utf-8").translate(_LETTERS)
            for piece in _pieces(body):
                words.update(piece)
                seen.update(piece)
            docs[group].update(seen)
            unread += len(body)
            if unread > PIECE:
                unread = 0
                if sum(map(len, counts.values())) > ENTRIES:
                    yield from out()
    yield from out()


def share(n: Column, total: Column) -> Column:
    """1 + floor(UNIT * n / total) for 0 <= n <= total, in longs: three digits of the quotient a step, so that nothing overflows."""
    whole, rest = F.call_function("div", n, total), n % total
    for _ in range(3):
        step = rest * 1000
        whole, rest = whole * 1000 + F.call_function("div", step, total), step % total
    return whole + 1


def _shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    whole, rest = np.divmod(n, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    return whole + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); p and q are at most UNIT + 1, so the square fits a long."""
    return (p - q) ** 2 // (p + q)


def _cell(rows: pd.DataFrame) -> pd.DataFrame:
    """Divergence of each pair of groups that meet in a cell, over its words.

    Rows without a term stand for the groups themselves (total: N + 2 V, words: kept words of the term block). Words that
    neither slice holds have the same shares for a pair each, so they are counted instead of spelt out.
    """
    groups = rows[rows["term"].isna()].sort_values("source")
    found = rows[rows["term"].notna()]
    names = groups["source"].to_numpy(dtype=object)
    term, terms = pd.factorize(found["term"])
    n = np.zeros((len(names), len(terms)), dtype=np.int64)
    n[pd.Index(names).get_indexer(found["source"]), term] = found["n"].to_numpy()
    words = int(groups["n"].iloc[0])
    left, right = groups["gb"].to_numpy() == groups["low"].to_numpy(), groups["gb"].to_numpy() == groups["high"].to_numpy()
    if words:
        totals = groups["total"].to_numpy()
        p = _shares(n + 2, totals[:, None])
        none = _shares(np.full(len(names), 2, dtype=np.int64), totals)
    a, b, value = [], [], []
    same = bool(groups["low"].iloc[0] == groups["high"].iloc[0])
    for i in np.flatnonzero(left):
        others = np.flatnonzero(right & (np.arange(len(names)) > i)) if same else np.flatnonzero(right)
        if words:
            sums = _apart(p[i][None, :], p[others]).sum(axis=1) + (words - len(terms)) * _apart(none[i], none[others])
        else:
            sums = np.zeros(len(others), dtype=np.int64)
        a += [names[i]] * len(others)
        b += names[others].tolist()
        value.append(sums)
    text = {"lang": [rows["lang"].iloc[0]] * len(a), "a": a, "b": b}
    return pd.DataFrame({k: pd.Series(v, dtype=object) for k, v in text.items()} | {"value": np.concatenate(value) if value else np.zeros(0, np.int64)})


def _empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def word_counts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, groups) of documents: occurrences of each kept word per group, with the language's own; every group.

    kept: lang, term, source, n, lang_n. groups: lang, source, n (over kept words), lang_n, words (V of the language).
    """
    rows = df.select(_empty("lang"), _empty("source"), "text").mapInArrow(_count_words, "lang string, source string, term string, n long, docs long")
    counts = written(rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
    words = (counts.filter(F.col("term").isNotNull()).groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
             .filter(F.col("docs") >= MIN_DOCS).select("lang", "term", "lang_n"))
    kept = written(counts.select("lang", "source", "term", "n").join(words, ["lang", "term"]), "divergence-kept")
    vocabulary = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang").agg(F.count(F.lit(1)).alias("words"), F.sum("lang_n").alias("lang_n"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = (counts.filter(F.col("term").isNull()).select("lang", "source").join(totals, ["lang", "source"], "left").join(vocabulary, "lang", "left")
              .select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n", "lang_n", "words")]))
    return kept, written(groups, "divergence-groups")


def pair_divergences(kept: DataFrame, groups: DataFrame, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """(lang, a, b, value) for each two groups a < b of a language: the divergence summed over all its kept words."""
    sizes = groups.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / group_block).cast("int").alias("gbs"), F.greatest(F.lit(1), F.ceil(F.max("words") / term_block)).cast("int").alias("tbs"))
    gb, tb = F.pmod(F.xxhash64("source"), F.col("gbs")).cast("int"), F.pmod(F.xxhash64("term", F.lit(7)), F.col("tbs")).cast("int")
    slices = kept.join(sizes, "lang").select("lang", "gbs", tb.alias("tb"), gb.alias("gb"), "source", "term", "n", F.lit(0).cast("long").alias("total"))
    blocks = kept.select("lang", "term").distinct().join(sizes, "lang").groupBy("lang", tb.alias("tb")).agg(F.count(F.lit(1)).alias("n"))
    heads = (groups.withColumn("total", F.col("n") + 2 * F.col("words")).drop("n").join(sizes, "lang")
             .withColumn("tb", F.explode(F.sequence(F.lit(0), F.col("tbs") - 1))).join(blocks, ["lang", "tb"], "left")
             .select("lang", "gbs", "tb", gb.alias("gb"), "source", F.lit(None).cast("string").alias("term"), F.coalesce("n", F.lit(0)).alias("n"), "total"))
    cells = (slices.unionByName(heads).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("gbs") - 1)))
             .withColumn("low", F.least("gb", "other")).withColumn("high", F.greatest("gb", "other")))
    partial = cells.groupBy("lang", "low", "high", "tb").applyInPandas(_cell, "lang string, a string, b string, value long")
    return partial.groupBy("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("value").alias("value"))


def audit(df: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank for documents (lang, source, text).

    part `pair`: each other source of the language and its divergence, all ranks (0 where no word is kept). part `term`:
    the words that lift the group furthest above its language, ranks up to `top`. Ranks go by falling value, then by the
    item's bytes. Null lang, source and text count as empty; a group without words is kept; a language with one group has
    no pairs; repeated rows count each time; an empty table gives no rows; other columns are ignored.
    """
    kept, groups = word_counts(df)
    links = written(pair_divergences(kept, groups), "divergence-pairs")
    both = links.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        links.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).cast("int").alias("rank"))
    own = groups.select("lang", "source", (F.col("n") + 2 * F.col("words")).alias("total"), (F.col("lang_n") + 2 * F.col("words")).alias("lang_total"))
    p, q = F.col("p"), F.col("q")
    scored = (kept.filter("n > 0").join(own, ["lang", "source"])
              .select("lang", "source", F.col("term").alias("item"), share(F.col("n") + 2, F.col("total")).alias("p"), share(F.col("lang_n") + 2, F.col("lang_total")).alias("q"))
              .filter(p > q).select("lang", "source", "item", F.call_function("div", (p - q) * (p - q), p + q).alias("value")))
    terms = (scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
             .select("lang", "source", F.lit("term").alias("part"), "item", "value", F.col("rank").cast("int").alias("rank")))
    return pairs.unionByName(terms)


def audit_sql(table: str = "documents", min_docs: int = MIN_DOCS, top: int = TOP) -> str:
    """The same rows as DuckDB SQL over a documents table."""
    return rf"""WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce("text", '') AS body FROM {table}),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
v AS (SELECT lang, term, count(*) AS n FROM w GROUP BY 1, 2 HAVING count(DISTINCT rid) >= {min_docs}),
l AS (SELECT lang, sum(n)::HUGEINT AS n, count(*)::HUGEINT AS v FROM v GROUP BY 1),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN v USING (lang, term) GROUP BY 1, 2, 3),
t AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM c GROUP BY 1, 2),
p AS (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n,
  1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(t.n, 0) + 2 * l.v) AS p,
  1 + (1000000000::HUGEINT * (v.n + 2)) // (l.n + 2 * l.v) AS q
  FROM g JOIN v USING (lang) JOIN l USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT * FROM (SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r) x
WHERE part = 'pair' OR rank <= {top}"""
