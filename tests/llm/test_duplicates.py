"""Near and exact duplicates against brute force: SimHash, substrings, embeddings, components."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from eventmill.llm import bwt_dedup, embedding_dedup, simhash
from eventmill.llm.components import components


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_odd_rows(spark):
    r = random.Random(3)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(500, 540)] + [(r.randint(1000, 1100), r.randint(1000, 1100)) for _ in range(80)]
    df = spark.createDataFrame([*pairs, (5, 5), (None, 3), pairs[0]], "a long, b long")
    linked = {x for p in pairs for x in p if p[0] != p[1]}
    want = roots([p for p in pairs if p[0] != p[1]], linked)
    assert {r["node"]: r["component"] for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0


def plain_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprints_equal_a_plain_loop_and_the_engine_hash(spark, docs):
    texts = ["", " ", None, "a", "A b\tC\nd\x0be\x0cf", "é à " * 40, "one two three four"] + [f"w{i % 9} x{i % 4} y{i}" for i in range(50)]
    assert [simhash.text_fingerprint(t) % 2**64 for t in texts] == [plain_print(t) for t in texts]
    assert spark.sql("SELECT xxhash64('one two three')").first()[0] % 2**64 == xxhash.xxh64_intdigest(b"one two three", 42)


@pytest.mark.parametrize("max_bits", [1, 3, 5])
def test_links_equal_all_pairs(spark, max_bits):
    r = random.Random(max_bits)
    prints = {r.getrandbits(64) - 2**63 for _ in range(150)}
    for p in list(prints)[:60]:
        for _ in range(3):
            x = p % 2**64
            for b in r.sample(range(64), r.randint(1, max_bits + 1)):
                x ^= 1 << b
            prints.add(x - 2**64 if x >= 2**63 else x)
    prints = sorted(prints)
    df = spark.createDataFrame([(p, i) for i, p in enumerate(prints)], "fingerprint long, first_id long")
    got = {tuple(sorted((x["a"], x["b"]))) for x in simhash.fingerprint_links(df, max_bits).collect()}
    assert got == {(a, b) for i, a in enumerate(prints) for b in prints[i + 1:] if bin((a ^ b) % 2**64).count("1") <= max_bits}


def test_near_duplicates_and_deduplicated_on_odd_rows(spark, docs, empty):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    prints = [(r["doc_id"], plain_print(r["text"])) for r in docs.collect()]
    nodes = sorted({p for _, p in prints})
    group = roots([(a, b) for a in nodes for b in nodes if a < b and bin(a ^ b).count("1") <= 3], nodes)
    ids = {}
    for d, p in prints:
        if d is not None:
            ids[group[p]] = min(d, ids.get(group[p], d))
    want = sorted(((d, ids.get(group[p])) for d, p in prints), key=str)
    assert sorted(((r["doc_id"], r["component_id"]) for r in rows), key=str) == want
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([d for d in ids.values()] + [None] * (len(set(group.values())) - len(ids)), key=str)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.deduplicated(empty).count() == 0


def test_deduplicated_decides_row_by_row(spark):
    a, b, c = "one two three four five six seven eight", "nothing like the other text at all here", "third text of its own kind entirely new"
    schema = "doc_id long, text string, times int, fingerprint string, chosen_id long"
    kept = lambda rows: sorted(((r["doc_id"], r["text"]) for r in simhash.deduplicated(spark.createDataFrame([(*r, 1, "f", 2) for r in rows], schema)).collect()), key=str)
    assert kept([(1, a), (1, b)]) == sorted([(1, b), (1, a)], key=str)                     # one id, two unlike texts
    assert kept([(1, a), (2, a), (2, b)]) == [(1, a), (2, b)]                # a copy goes though its id keeps another row
    assert kept([(2, b), (2, b), (None, c), (None, c), (None, b)]) == sorted([(2, b), (None, c)], key=str)
    assert kept([(1, a)] * 400 + [(2, a.upper())] * 3) == [(1, a)]


def test_many_repeated_rows_and_null_ids_do_not_square(spark):
    text = "".join(random.Random(1).choice("abcdefgh ") for _ in range(900))
    rows = [(None, text, 1)] * 600 + [(7, text, 1)] * 600 + [(8, "x" + text[:400], 1)]
    got = bwt_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string, first int")).groupBy("doc_id", "n_removed", "n_spans").count().collect()
    assert {(r["doc_id"], r["n_removed"], r["n_spans"], r["count"]) for r in got} == {(None, 900, 1, 600), (7, 900, 1, 600), (8, 400, 1, 1)}


def brute_removed(texts, length):
    seen = {}
    for i, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            seen.setdefault(t[s:s + length], []).append((i, s))
    cover = [bytearray(len(t)) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                cover[i][s:s + length] = b"\1" * length
    out = []
    for t, c in zip(texts, cover):
        spans = sum(1 for i, x in enumerate(c) if x and (i == 0 or not c[i - 1]))
        out.append((len(t), sum(c), spans, hashlib.sha256(bytes(b for b, x in zip(t, c) if not x)).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [bwt_dedup.HOT, 1])
def test_repeated_substrings_equal_brute_force(spark, empty, hot):
    r = random.Random(9)
    make = lambda n: "".join(r.choice("abcdé ") for _ in range(n))
    passage, texts = make(260), [None, "", "x" * 199, "x" * 200, "x" * 201, "é" * 300, "ab" * 400]
    for i in range(40):
        t = make(r.randint(0, 500))
        if i % 3 == 0:
            cut = r.randint(0, 60)
            t = t[:100] + passage[cut:r.randint(cut + 150, 260)] + t[100:]
        texts.append(t)
    texts += [texts[10], texts[10][:250], make(50) + texts[12][20:] + make(20), None]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, passage, 2)], "doc_id long, text string, first int")
    want = brute_removed([(t or "").encode() for t in [*texts, passage]], 200)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in bwt_dedup.deduplicate(df, hot=hot).collect()}
    assert [got[i] for i in [*range(len(texts)), None]] == want
    assert bwt_dedup.deduplicate(empty).count() == 0


def test_pieces_of_long_texts_and_shards_agree(monkeypatch):
    r = random.Random(2)
    raw = bytes(r.choice(b"abc") for _ in range(3000)) * 2
    rows = lambda: {(int(h), int(a), int(b), int(p)) for h, _, a, b, p in zip(*bwt_dedup.text_anchors(raw))}
    whole = rows()
    windows = lambda rows: {(s, h, p) for h, a, b, p in rows for s in range(a, b + 1)}
    monkeypatch.setattr(bwt_dedup, "PIECE", 700)
    assert windows(rows()) == windows(whole)
    keys = np.array([r.randint(0, 3) for _ in range(300)])
    words = np.array([[r.choice([0, 1, 2**56 - 1, 2**56, 2**63, 2**64 - 1]) if r.random() < 0.2 else 7 for _ in range(25)] for _ in range(300)], dtype=np.uint64)
    order, common = bwt_dedup.merged_order(keys, words, shard=37)
    rows = [(keys[i], *words[i]) for i in order]
    assert rows == sorted(rows)
    for i in range(1, 300):
        a, b = (np.array(x[1:], dtype=">u8").tobytes() for x in rows[i - 1:i + 1])
        same = next((k for k in range(200) if a[k] != b[k]), 200)
        assert common[i] == (-1 if rows[i][0] != rows[i - 1][0] else same)


def test_embeddings_equal_brute_force_on_odd_rows(spark):
    r = np.random.default_rng(5)
    base = r.standard_normal((60, 16)).astype(np.float32)
    vectors = [*base, *(base[:30] + 0.05 * r.standard_normal((30, 16)).astype(np.float32)), *base[:5]]
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(vectors)]
    rows += [(900, None, 0), (901, [], 0), (902, [0.0] * 16, 0), (903, [float("nan")] * 16, 0), (904, [float("inf")] * 16, 0), (905, rows[0][1], None),
             (906, [None] + [1.0] * 15, 0), (907, [1.0, 2.0], 0), (908, [2.0, 4.0], 0), (None, rows[2][1], 0), (0, rows[0][1], 0)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), leaf=20, sample=64, trees=16, spill=0.15).collect()

    def unit(v):
        v = np.array([np.nan if x is None else x for x in v or []], dtype=np.float64)
        return v / np.linalg.norm(v) if len(v) and np.isfinite(v).all() and v.any() else None
    units = [unit(v) for _, v, _ in rows]
    link = [[i != j and units[i] is not None and units[j] is not None and rows[i][2] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j])
             and units[i] @ units[j] >= 0.93 for j in range(len(rows))] for i in range(len(rows))]
    assert sorted((r["vec_id"], r["n_links"]) for r in got if r["vec_id"] is not None) == sorted((rows[i][0], sum(link[i])) for i in range(len(rows)) if rows[i][0] is not None)
    group = roots([(i, j) for i in range(len(rows)) for j in range(len(rows)) if link[i][j]], range(len(rows)))
    least = {}
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            least[group[i]] = min(v, least.get(group[i], v))
    assert sorted((r["vec_id"], r["component_id"]) for r in got if r["vec_id"] is not None) == sorted((v, least[group[i]]) for i, (v, _, _) in enumerate(rows) if v is not None)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_embedding_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/check_s/embeddings.parquet") if __import__("os").path.isdir("/root/testdata/check_s") else spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    some = df.where("label < 3")
    rows = some.collect()
    units = np.array([r["embedding"] for r in rows], dtype=np.float64)
    units /= np.linalg.norm(units, axis=1)[:, None]
    labels = np.array([r["label"] for r in rows])
    near = (units @ units.T >= 0.93) & (labels[:, None] == labels[None, :])
    true = near.sum() - len(rows)
    found = embedding_dedup.near_duplicates(some).agg({"n_links": "sum"}).first()[0]
    assert found <= true and (true == 0 or found / true >= 0.97)


def test_embedding_links_of_a_dense_group_larger_than_a_leaf(spark):
    r = np.random.default_rng(8)
    dense = r.standard_normal(64) + 0.17 * r.standard_normal((5000, 64))  # pairwise cosine about 0.97
    vectors = np.vstack([dense, r.standard_normal((3000, 64))]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int")
    units = vectors.astype(np.float64)
    units /= np.linalg.norm(units, axis=1)[:, None]
    want = (units @ units.T >= 0.93).sum(axis=1) - 1
    got = {x["vec_id"]: x for x in embedding_dedup.near_duplicates(df).collect()}
    found = np.array([got[i]["n_links"] for i in range(len(vectors))])
    assert (found <= want).all() and found.sum() >= 0.999 * want.sum()
    assert {got[i]["component_id"] for i in range(5000) if want[i]} == {0}


def test_embedding_links_are_counted_once_and_connected():
    r = np.random.default_rng(2)
    hit = r.random((60, 80)) < 0.02
    hit[:10, :30] = True
    a, b = embedding_dedup.forest(hit)
    assert hit[a, b].all() and len(a) < hit.sum()
    assert roots(((i, 100 + j) for i, j in zip(a, b)), range(200)) == roots(((i, 100 + j) for i, j in zip(*np.nonzero(hit))), range(200))
    first, second = [r.integers(0, 9, 2) for _ in range(60)], [r.integers(0, 9, 2) for _ in range(80)]
    want = hit & ~np.array([[bool(set(x) & set(y)) for y in second] for x in first])
    embedding_dedup.disown(hit, first, second)
    assert (hit == want).all()
