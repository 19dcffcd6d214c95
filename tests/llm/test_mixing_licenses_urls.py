"""Mixing against its DuckDB SQL and its promises; licence scan against its SQL; URL rules and model."""

import math
import re
import zlib
from collections import Counter

import duckdb
import pandas as pd
from llm_helpers import SMALL

from eventmill.llm import licenses, mixing, queries, urlfilter


def same(spark_rows, duck_rows):
    norm = lambda r: tuple("nan" if x is None or isinstance(x, float) and math.isnan(x) else round(x, 9) if isinstance(x, float) else x for x in r)
    return sorted(map(norm, spark_rows), key=str) == sorted(map(norm, duck_rows), key=str)


def test_mix_equals_sql_on_odd_rows_and_keeps_its_promises(spark, docs):
    got = mixing.mix(docs).collect()
    frame = pd.DataFrame([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()], columns=["doc_id", "text", "source"])
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    con = duckdb.connect()
    con.register("documents", frame)
    want = con.execute(f"SELECT source, size, source_size, target, sum(taken), count(*) FROM ({mixing.mix_sql()}) GROUP BY ALL").fetchall()
    mine = {}
    for r in got:
        key = (r["source"], r["size"], r["source_size"], r["target"])
        t, n = mine.get(key, (0, 0))
        mine[key] = (t + r["taken"], n + 1)
    assert same([(*k, *v) for k, v in mine.items()], want)
    assert len(got) == docs.count() and all(0 <= r["copies"] <= 2 and r["taken"] <= 2 * r["size"] for r in got)
    assert sorted(map(tuple, mixing.mix(docs).select("doc_id", "taken").collect()), key=str) == sorted([(r["doc_id"], r["taken"]) for r in got], key=str)
    total = sum(r["size"] for r in got)
    by = {r["source"]: (r["target"], r["source_size"]) for r in got}
    assert abs(sum(t for t, _ in by.values()) - 1.5 * total) < 1e-6 and all(t <= 2 * s + 1e-9 for t, s in by.values())


def test_mix_hot_source_comes_near_its_target(spark):
    df = spark.range(30_000).selectExpr("id AS doc_id", "repeat('w ', cast(1 + id % 7 as int)) AS text", "if(id % 3 = 0, 'hot', concat('s', id % 5)) AS source")
    rows = mixing.mix(df).groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect()
    assert all(abs(r["sum(taken)"] - r["max(target)"]) <= 2 * r["max(size)"] for r in rows)


def test_licenses_equal_sql(spark, docs):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    assert same([tuple(r) for r in queries.op5_license_scan(spark, SMALL).collect()], con.execute(licenses.scan_sql()).fetchall())
    assert licenses.scan(docs).count() == 0


def test_license_paragraph_in_a_long_text_and_near_wording(spark):
    mit = licenses.TEMPLATES[5][1]
    texts = [(1, "prose " * 500 + "\n\n" + mit.replace("free of charge", "for free") + "\n\nmore prose"), (2, "Licensed under the Apache License, Version 2.0."), (3, "license")]
    rows = {(r["doc_id"], r["license"]): r["dice"] for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert set(rows) == {(1, "MIT"), (2, "Apache-2.0")} and 0.9 < rows[1, "MIT"] < 1 and rows[2, "Apache-2.0"] == 1


def test_license_in_comment_blocks_sentences_and_close_wordings(spark):
    named = {}
    for name, text in licenses.TEMPLATES:
        named.setdefault(name, text)

    def wrapped(text, mark):
        words = text.split()
        return "\n".join(mark + " ".join(words[i:i + 9]) for i in range(0, len(words), 9))
    mit = [t for n, t in licenses.TEMPLATES if n == "MIT"]
    texts = [
        (1, "/*\n * Copyright 2020 Some One\n *\n" + wrapped(mit[2], " * ") + "\n *\n" + wrapped(mit[3], " * ") + "\n */\nint main() { return 0; }"),
        (2, "# A tool\n#\n" + wrapped(named["AGPL-3.0"], "# ") + "\n#\nimport os\n"),
        (3, "// " + named["MPL-2.0"] + "\n"),
        (4, "See the manual for more. Licensed under the MIT License. Copyright 2021 the authors of this work and others."),
        (5, wrapped(named["GPL-3.0"], "") + "\n----\n" + wrapped(named["Zlib"], "-- ")),
        (6, "We are licensed to sell permission slips under the sea.\n***\nNothing here is granted."),
    ]
    frame = pd.DataFrame(texts, columns=["doc_id", "text"])
    con = duckdb.connect()
    con.register("documents", frame)
    got = [tuple(r) for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()]
    assert same(got, con.execute(licenses.scan_sql()).fetchall())
    assert {(r[0], r[1]) for r in got} == {(1, "MIT"), (2, "AGPL-3.0"), (3, "MPL-2.0"), (4, "MIT"), (5, "GPL-3.0"), (5, "Zlib")}
    assert {r[0]: r[4] for r in got if r[0] == 1} == {1: 3}  # two paragraphs, and the whole text is near enough to the first


def test_every_license_template_is_found_as_itself(spark):
    texts = [(i, text) for i, (_, text) in enumerate(licenses.TEMPLATES)]
    got = {r["doc_id"]: r["license"] for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect() if r["dice"] == 1}
    assert got == {i: name for i, (name, _) in enumerate(licenses.TEMPLATES)}


def test_no_unit_without_a_telling_word_reaches_the_threshold():
    telling = set(licenses.telling_words(licenses.TEMPLATES, licenses.THRESHOLD))
    for _, wording in licenses.TEMPLATES:
        words = [w for w in re.split(licenses.SEPARATORS, wording.lower()) if w]
        pairs = list(zip(words, words[1:]))
        left = sum(1 for a, b in pairs if a not in telling and b not in telling)
        assert 2 * left / (left + len(pairs)) < licenses.THRESHOLD  # the best unit without such a word holds just these
    assert "the" not in telling and len(telling) < 120


def test_mix_long_runs_of_one_id_equal_sql(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE", 64)
    rows = [(7, "a b c", "hot")] * 1000 + [(None, "a b c", "hot")] * 130 + [(None, None, None)] * 65 + [(i, "w " * (i % 5), f"s{i % 2}") for i in range(200)]
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "source"])
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    con = duckdb.connect()
    con.register("documents", frame)
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).select("doc_id", "source", "size", "copies", "taken").collect()
    assert len(got) == len(rows)
    assert same([tuple(r) for r in got], con.execute(f"SELECT doc_id, source, size, copies, taken FROM ({mixing.mix_sql()})").fetchall())


URLS = [None, "", "no scheme", "http://", "HTTPS://Example.NET/en/x?q#f", "http://a.b.example.net/en", "http://example.com/de/1", "http://notexample.com/de/1",
        "https://x.org/fr/a", "https://x.org/FR/a", "ftp://org/fr/", "http://net/", "https://x.example.com?u=http://y.org/fr/", "http://h#/a"]


def rule_of(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        tail = rest[end:]
        stop = min([i for i in (tail.find(c) for c in "?#") if i >= 0], default=len(tail))
        path = tail[:stop]
    best = None
    for verdict, rule in queries.URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path, best


def test_url_rules_and_model_on_odd_urls(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS * 2)] + [(None, URLS[4], None)]
    got = urlfilter.judge(spark.createDataFrame(rows, "page_id long, url string, score string"), queries.URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, best = rule_of(URLS[r["page_id"] % len(URLS)] if r["page_id"] is not None else URLS[4])
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[1])
        assert r["verdict"] == (best[0] if best else "allow" if r["score"] >= r["threshold"] else "block")
    nothing = spark.createDataFrame([], "page_id long, url string")
    assert urlfilter.judge(nothing, queries.URL_RULES).count() == 0


def test_url_scores_equal_plain_witten_bell(spark):
    """Scores and threshold against plain loops over the same labelled shapes."""
    hosts = ["a.net", "shop.net", "x.org/fr/news", "y.org/fr/story", "z.com/abc", "q.com/de/offer"]
    rows = [(i, f"http://{hosts[i % 6]}/{'buy' if i % 3 else 'read'}-{chr(97 + i % 23)}{chr(97 + i % 19)}") for i in range(240)]
    got = urlfilter.judge(spark.createDataFrame(rows, "page_id long, url string"), queries.URL_RULES).collect()
    order, sides = urlfilter.ORDER, ("allow", "block")
    shapes = {}
    for r in got:
        shape = re.sub("[0-9]", "0", r["host"] + r["path"])
        shapes.setdefault(shape, []).append(r)
    verdicts = {s: Counter(v for r in rs for v, t in queries.URL_RULES if r["rule"] == t) for s, rs in shapes.items()}
    held = {s: zlib.crc32(s.encode()) % urlfilter.FOLDS == 0 for s in shapes}
    spelled = lambda s: [(p[max(0, i - order):i], p[i]) for p in [urlfilter.START + s + urlfilter.END] for i in range(1, len(p))]
    seen = {v: Counter() for v in sides}
    letters = set()
    for s in shapes:
        for context, c in spelled(s):
            letters.add(c)
            for k in range(len(context) + 1):
                for v in sides:
                    seen[v][context[len(context) - k:], c] += 0 if held[s] else verdicts[s][v]
    totals = {v: Counter() for v in sides}
    kinds = {v: Counter() for v in sides}
    for v in sides:
        for (context, _), n in seen[v].items():
            totals[v][context] += n
            kinds[v][context] += n > 0

    def prob(v, context, c):
        p = 1 / (len(letters) + 1)
        for k in range(len(context) + 1):
            x = context[len(context) - k:]
            if totals[v][x]:
                p = (seen[v][x, c] + kinds[v][x] * p) / (totals[v][x] + kinds[v][x])
        return p
    for s, rs in shapes.items():
        chars = spelled(s)
        want = sum(math.log(prob("allow", *g)) - math.log(prob("block", *g)) for g in chars) / len(chars)
        assert all(abs(r["score"] - want) < 1e-9 for r in rs)
    scores = [(rs[0]["score"], verdicts[s]) for s, rs in shapes.items() if held[s]]
    edges = sorted({math.floor(x / urlfilter.BIN) for x, _ in scores})
    n = {v: sum(c[v] for _, c in scores) for v in sides}
    loss = {e: sum(c["allow"] for x, c in scores if math.floor(x / urlfilter.BIN) < e) / n["allow"]
            + sum(c["block"] for x, c in scores if math.floor(x / urlfilter.BIN) >= e) / n["block"] for e in edges}
    got_edge = round(got[0]["threshold"] / urlfilter.BIN)
    assert abs(loss[got_edge] - min(loss.values())) < 1e-12


def test_url_model_follows_the_labelled_urls(spark):
    rows = [(i, f"http://s{i}.net/{'de' if i % 2 else 'fr'}/buy-cheap-{i}") for i in range(200)] + [(1000 + i, f"http://s{i}.org/fr/story/{i}") for i in range(200)]
    rows += [(2000, "http://new.com/de/buy-cheap-9"), (2001, "http://new.com/fr/story/9")]
    got = {r["page_id"]: r["verdict"] for r in urlfilter.judge(spark.createDataFrame(rows, "page_id long, url string"), [("block", "net/"), ("allow", "org/fr/")]).collect()}
    assert (got[2000], got[2001]) == ("block", "allow")
