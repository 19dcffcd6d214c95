"""Whitening, token counts and the source audit against numpy, the tokenizer's library and SQL."""

import math
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from llm_helpers import SMALL

from eventmill.llm import divergence, queries, tokencount, whitening


def plain_whitening(vectors, components=8):
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for v in vectors], dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    centred = (n * x - s) / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return ((n * x - s) ** 2).sum(axis=1), centred @ u / np.sqrt(e), e / np.trace(centred.T @ centred / n)


def check_whitening(rows, vectors):
    """rows of whiten() in the order of vectors, 8 each."""
    deviation, white, explained = plain_whitening(vectors)
    k = min(8, white.shape[1])
    got = np.array([r["whitened"] for r in rows]).reshape(-1, k)
    assert [r["deviation"] for r in rows[::k]] == deviation.tolist()
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got * signs - white).max() < 1e-8
    assert np.allclose([r["explained"] for r in rows[:k]], explained, rtol=1e-10)
    assert np.abs(np.cov(got.T, bias=True) - np.eye(k)).max() < 1e-9 and rows[0]["identity_error"] < 1e-9


def test_whitening_equals_numpy_on_the_given_vectors(spark):
    rows = queries.op11_embedding_whitening(spark, SMALL).orderBy("vec_id", "component").collect()
    given = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    assert len(rows) == 8 * len(given) and {r["n"] for r in rows} == {len(given)}
    check_whitening(rows, [r["embedding"] for r in given])


def test_whitening_on_odd_rows(spark):
    rnd = np.random.default_rng(3)
    good = [rnd.normal(0, 1, 5).tolist() for _ in range(60)]
    rows = [(i, v) for i, v in enumerate(good)] + [(7, good[7]), (None, good[8])]
    bad = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0]), (103, [1.0, math.nan, 1.0, 1.0, 1.0]), (104, [math.inf] * 5), (105, [1.0, 2.0]), (106, [1e300] * 5)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").selectExpr("*", "1 AS component", "2 AS n", "3 AS whitened", "4 AS x", "5 AS d")
    got = whitening.whiten(df).collect()
    assert len(got) == 62 * 5 and {r["n"] for r in got} == {62} and sum(r["vec_id"] is None for r in got) == 5
    again = sorted((r for r in got if r["vec_id"] not in (7, None)), key=lambda r: (r["vec_id"], r["component"]))
    fit = good + [good[7], good[8]]
    white = plain_whitening(fit)[1]
    mine = np.array([r["whitened"] for r in again]).reshape(-1, 5)
    kept = [i for i in range(60) if i != 7]
    assert np.abs(np.abs(mine) - np.abs(white[kept])).max() < 1e-9
    empty = whitening.whiten(df.limit(0))
    assert empty.count() == 0 and empty.columns == whitening.whiten(df).columns
    assert whitening.whiten(df.filter("vec_id = 7")).count() == 0   # no variance at all
    flat = spark.createDataFrame([(i, [float(i), 2.0, float(-i)]) for i in range(9)], "vec_id int, embedding array<float>")
    assert {r["component"] for r in whitening.whiten(flat).collect()} == {1}   # the other directions have none


def test_whitening_exact_where_longs_are_too_small(spark):
    df = spark.createDataFrame([(0, [1e12, 0.0]), (1, [-1e12, 3.0]), (2, [5.0, 1.0])], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(df).filter("component = 1").collect()}
    x = [[math.floor(1024 * c) + 100000 for c in v] for v in ([1e12, 0.0], [-1e12, 3.0], [5.0, 1.0])]
    want = [sum((3 * a - sum(col)) ** 2 for a, col in zip(v, zip(*x))) for v in x]
    assert got == {i: w if w < 1 << 63 else None for i, w in enumerate(want)}


def test_whitening_filter_on_a_flat_and_a_steep_spectrum(spark):
    rnd = np.random.default_rng(5)
    for scales in (np.ones(48), 2.0 ** -np.arange(48), np.r_[np.full(4, 3.0), np.full(44, 1.0)]):
        v = (rnd.normal(0, 1, (400, 48)) * scales * 8).tolist()
        rows = whitening.whiten(spark.createDataFrame(list(enumerate(v)), "vec_id long, embedding array<double>")).orderBy("vec_id", "component").collect()
        check_whitening(rows, v)
        assert whitening.fit(spark.createDataFrame(list(enumerate(v)), "vec_id long, embedding array<double>")).passes > 10


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    found = Tokenizer.from_file(tokencount.default_path())
    return lambda text: len(found.encode(text, add_special_tokens=False).ids)


def test_token_counts_equal_the_library_on_the_given_texts(spark, library):
    got = queries.op12_token_counts(spark, SMALL).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got} == {
        i: (len(t.encode()), library(t), library(t) > 2048) for i, t in texts.items()}


def test_token_counts_on_odd_rows(spark, docs, empty, library):
    clash = docs.selectExpr("*", "'x' AS n_tokens", "'y' AS N_BYTES", "'z' AS tokens")
    rows = tokencount.count_tokens(clash).collect()
    assert len(rows) == docs.count() and all(r["n_tokens"] == library(r["text"] or "") and r["n_bytes"] == len((r["text"] or "").encode()) for r in rows)
    assert tokencount.count_tokens(empty).count() == 0


def test_token_counts_equal_the_library_on_odd_texts(library, monkeypatch):
    monkeypatch.setattr(tokencount, "CHUNK", 9)
    with open(tokencount.default_path(), encoding="utf-8") as f:
        count = tokencount.Counter(f.read())
    rnd = random.Random(2)
    pool = [chr(c) for c in range(0x180)] + [chr(c) for c in (0x300, 0x301, 0x323, 0x3A3, 0x3C2, 0x130, 0x1E9E, 0xFB01, 0x2160, 0xBD, 0x1F600, 0x200D, 0x4E00, 0x3042, 0xAC00, 0x1100, 0x1161, 0x10A0, 0x13A0, 0x1C89, 0x5D0, 0x64B, 0x915, 0x94D, 0x2028, 0x85, 0x1C, 0x180E, 0xFEFF, 0x10FFFF)]
    pool += ["<|endoftext|>", "<|startoftext|>", "<|end", "'s", "'LL", " ", "ing", "the"] * 8
    for _ in range(3000):
        text = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 40)))
        assert count(text) == library(text), text
    for text in ("a" * 30000, "ab" * 9000, "x y" * 9000, "é" * 9000, "Ꭰ a" * 4000, "9" * 9000, "!?" * 9000, "e" + "́" * 500):
        assert count(text) == library(text)


def plain_merges(word, merges):
    """Symbols left when the best adjacent pair is merged again and again, leftmost first."""
    symbols = [merges.inner[b] for b in word[:-1]] + [merges.last[word[-1]]]
    while True:
        found = [(merges.rank[a * merges.size + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a * merges.size + b in merges.rank]
        if not found:
            return len(symbols)
        rank, i = min(found)
        symbols[i:i + 2] = [merges.made[rank]]


def test_heap_merges_equal_plain_merges():
    import json
    with open(tokencount.default_path(), encoding="utf-8") as f:
        merges = tokencount.Merges(json.load(f)["model"])
    rnd = random.Random(4)
    for _ in range(2000):
        word = "".join(rnd.choice("aaeeiinnsstth'é") for _ in range(rnd.randint(1, 24))).encode()
        assert merges.count(word) == plain_merges(word, merges)


def same_audit(spark_rows, frame):
    with duckdb.connect() as db:
        db.register("documents", frame)
        want = db.sql(divergence.audit_sql()).fetchall()
    assert sorted(map(tuple, spark_rows)) == sorted(want)


def test_audit_equals_sql_on_the_given_documents(spark):
    rows = queries.op13_source_divergence(spark, SMALL).collect()
    same_audit(rows, spark.read.parquet(f"{SMALL}/documents.parquet").toPandas())


def odd_documents():
    rnd = random.Random(6)
    words = ["Ärger", "naïve", "the", "THE", "of", "x", "don't", "日本", "zebra", "Zebra"] + [f"w{chr(97 + i)}" for i in range(26)]
    rows = [(i % 90, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))) + rnd.choice(["", "\t1 2\x00", "\n--", " a_b[c]"]), rnd.choice(["en", "en", "de", None, ""]), rnd.choice(["s1", "s2", "s3", "é", None, "", "only12"]), 1) for i in range(400)]
    rows += [(None, None, "en", "silent", None), (1, "", "xx", "alone", 0), (2, "rare words here", "xx", "b", 0), (3, "the " * 50000, "en", "s1", 9), (3, "the " * 50000, "en", "s1", 9), (4, "q" * 300000, "de", "s1", 1)]
    return pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"])


def test_audit_equals_sql_on_odd_rows_and_small_blocks(spark, empty, monkeypatch):
    frame = odd_documents()
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "doc_id long, text string, lang string, source string, n_chars long")
    clash = df.selectExpr("*", "'a' AS term", "1 AS n", "2 AS gb", "3 AS rank", "'x' AS item", "4 AS words")
    same_audit(divergence.audit(clash).collect(), frame)
    kept, groups = divergence.word_counts(df)
    whole = {tuple(r) for r in divergence.pair_divergences(kept, groups).collect()}
    assert {tuple(r) for r in divergence.pair_divergences(kept, groups, group_block=2, term_block=5).collect()} == whole
    assert divergence.audit(empty).count() == 0


def test_audit_pieces_and_flushes_change_nothing(monkeypatch):
    import pyarrow as pa
    frame = odd_documents().fillna("")
    batch = pa.RecordBatch.from_pandas(frame[["lang", "source", "text"]], preserve_index=False)

    def total():
        rows = pa.Table.from_batches(list(divergence._count_words(iter([batch])))).to_pandas()
        return rows.groupby(["lang", "source", "term"], dropna=False)[["n", "docs"]].sum().reset_index().sort_values(["lang", "source", "term"]).values.tolist()
    want = total()
    monkeypatch.setattr(divergence, "PIECE", 7)
    monkeypatch.setattr(divergence, "ENTRIES", 3)
    assert str(total()) == str(want)


def test_shares_are_exact_for_large_counts(spark):
    rnd = random.Random(8)
    pairs = [(1, 1), (7, 7), (2, 9 * 10**15)] + [(n, rnd.randint(n, 9 * 10**15)) for n in (rnd.randint(1, 9 * 10**15) for _ in range(50))]
    want = [1 + 10**9 * n // t for n, t in pairs]
    assert divergence._shares(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])).tolist() == want
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, n long, t long")
    from pyspark.sql import functions as F
    assert [r[0] for r in df.orderBy("i").select(divergence.share(F.col("n"), F.col("t"))).collect()] == want
