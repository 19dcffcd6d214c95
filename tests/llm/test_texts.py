"""Toxicity, surrogates, decontamination, HTML extraction: held-out accuracy and brute force on small fixtures."""

import random
import re

import numpy as np
import pytest
from llm_helpers import SMALL

from eventmill.llm import decontamination, html_extraction, pii, toxicity


def test_toxicity_on_held_out_labels(spark, docs, empty):
    sf = SMALL.replace("sf0.001", "sf0.1")
    some = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 6000")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity.classify(some, labels).join(labels, "doc_id").where("held_out").collect()
    hit = sum(r["predicted"] == r["toxic"] == 1 for r in rows)
    assert hit / sum(r["toxic"] for r in rows) > 0.85 and sum(r["predicted"] > r["toxic"] for r in rows) <= 0.01 * len(rows)
    odd = toxicity.classify(docs, labels).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in odd)
    assert toxicity.classify(empty, labels.limit(0)).count() == 0


def test_label_model_finds_accuracies_and_correlations():
    r = np.random.default_rng(1)
    y = r.random(4000) < 0.2
    rates = np.array([(0.6, 0.02), (0.5, 0.05), (0.4, 0.01), (0.3, 0.3)])
    votes = (r.random((4000, 4)) < np.where(y[:, None], rates[:, 0], rates[:, 1])).astype(float)
    votes = np.hstack([votes, votes[:, :1]])  # a voter that copies the first
    model = toxicity.fit_label_model(votes, 0.2, np.full(5, 0.3), np.full(5, 0.05))
    assert model.correlation[0, 4] > 0.8 and model.correlation[1, 2] < 0.3
    assert abs(np.log(model.toxic[3] / model.clean[3])) < 0.7 < np.log(model.toxic[0] / model.clean[0])


TEXT = "Mr John Smith (john.smith@corp.example.com, +1 (386) 555-3733) and Mrs Anna Smith; 4337166598464399, 25.86.162.211, 192.168.1.7, DE89 3704 0044 0532 0130 00, 078-05-1120, token = \"1dbdfc8c8e65b434\", fe80:1:2:3::9"


def test_surrogates_keep_type_format_identity(spark, docs, empty):
    rows = [(1, TEXT, 9), (2, TEXT + " again john.smith@corp.example.com 386-555-3733", 9), (2, TEXT, 9), (3, None, 9), (4, "", 9), (None, "plain words, chapter 3", 9)]
    got = {(r["doc_id"], len(r["text"] or "")): r for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string, edits int")).collect()}
    one = next(r for (d, _), r in got.items() if d == 1)
    old, new = pii.mentions(TEXT), pii.mentions(one["text"])
    assert [m.kind for m in old] == [m.kind for m in new] and one["n_entities"] == len(old) >= 11
    assert all(a.canonical != b.canonical for a, b in zip(old, new) if a.kind != "person" or True)
    card = next(m.canonical for m in new if m.kind == "card")
    assert pii.luhn_ok(card) and card[0] == "4" and re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", one["text"]) and "192.168." in one["text"]
    names = [m.canonical for m in new if m.kind == "person"]
    assert names[0][2:].split()[0] in pii.GIVEN["latin", "m"] and names[1][2:].split()[0] in pii.GIVEN["latin", "f"] and names[0].split()[-1] == names[1].split()[-1]
    again = next(r for (d, _), r in got.items() if d == 2 and "again" in r["text"])
    assert again["text"].count(next(m.canonical for m in new if m.kind == "email")) == 2
    phone = next(m.canonical for m in new if m.kind == "phone")
    assert f"{phone[:3]}-{phone[3:6]}-{phone[6:]}" in again["text"]
    assert got[(None, 22)]["n_entities"] == 0 and got[(3, 0)]["text"] is None
    assert pii.pseudonymise(empty).count() == 0
    same = pii.pseudonymise(docs)
    assert same.columns == [*docs.columns, "n_entities", "kinds"] and sorted(map(str, same.select(docs.columns).collect())) == sorted(map(str, docs.collect()))


def test_surrogates_stay_distinct_in_a_crowded_format(spark):
    texts = [(i, f"mail {c}@a.example") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    got = [r["text"] for r in pii.pseudonymise(spark.createDataFrame(texts, "doc_id long, text string")).collect()]
    assert len(set(got)) == 26 and not set(got) & {t for _, t in texts}


def edit_end(p, t):
    prev = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        cur = [i]
        for j, e in enumerate(t, 1):
            cur.append(min(prev[j - 1] + (c != e), prev[j] + 1, cur[j - 1] + 1))
        prev = cur
    return min(prev)


def test_decontamination_equals_full_alignment(spark, docs, empty):
    r = random.Random(4)
    words = "the of and nation there reaing stion heon erly ther andor ing ble".split()
    make = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [(i, make(r.randint(6, 40)) + ".") for i in range(25)] + [(90, None), (91, ""), (92, "tiny"), (None, make(20))]
    rows = []
    for d in range(80):
        p = list(r.choice(items[:25])[1])
        for _ in range(r.randint(0, int(len(p) * 0.12))):
            at = r.randrange(len(p))
            p[at:at + r.randint(0, 1)] = r.choice(["", "x", "Q "])
        rows.append((d, make(30) + "  " + "".join(p).upper() + "\n" + make(30) if d % 4 else make(70), 1))
    rows += [(500, None, 1), (501, "", 1), (None, items[0][1], 1)]
    got = {(x["doc_id"], x["item_id"]): (x["edits"], x["start"], x["end"]) for x in decontamination.contaminations(
        spark.createDataFrame(rows, "doc_id long, text string, edits int"), spark.createDataFrame(items, "item_id long, text string"), block_chars=900).collect()}
    texts = {d: t for d, t, _ in rows}
    for d, t, _ in rows:
        for i, p in items[:25]:
            passage, text = (decontamination.folded(x or "")[0].tolist() for x in (p, t))
            edits = edit_end(passage, text)
            held = edits <= decontamination.budget(len(passage), decontamination.EDIT_RATE, decontamination.Q)
            assert ((d, i) in got) == held, (d, i, edits)
            if held:
                assert got[d, i][0] == edits
                found = decontamination.folded(texts[d][got[d, i][1]:got[d, i][2]])[0].tolist()
                assert edit_end(passage, found) <= edits + 1  # a space at the edge of the stretch folds away
    assert decontamination.contaminations(empty, spark.createDataFrame(items, "item_id long, text string")).count() == 0
    bench = spark.createDataFrame([(1, docs.where("doc_id = 1").first()["text"])], "item_id long, text string")
    kept = decontamination.clean(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {None, 4, 5, 6, 7, 8}


def test_marginals_equal_enumeration():
    page = html_extraction.parse("<body><div class=post><p>a b c</p><a href=x>d</a></div><nav>e</nav></body>")
    html_extraction.add_text_features(page)
    model = html_extraction.fit(html_extraction.training_pages(30, 1), rounds=20)
    forest = html_extraction.plant([page], model.feature, model.edge)
    got, _, log_z = html_extraction.marginals(forest, model)
    n = len(page.name)
    unary = [sum(model.weight[model.feature[f]] for f in fs if f in model.feature) for fs in page.features]
    weights = {}
    for state in range(2**n):
        x = [state >> i & 1 for i in range(n)]
        weights[state] = np.exp(sum(u * v for u, v in zip(unary, x)) + sum(model.pair[forest.kind[i]][x[p]][x[i]] for i, p in enumerate(page.parent) if p >= 0))
    z = sum(weights.values())
    assert np.allclose(got, [sum(w for s, w in weights.items() if s >> i & 1) / z for i in range(n)]) and abs(np.log(z) - log_z) < 1e-9


def test_html_model_on_held_out_templates_and_odd_pages(spark):
    model = html_extraction.fit(html_extraction.training_pages(html_extraction.TRAINING_PAGES, html_extraction.SEED))
    test = html_extraction.training_pages(80, 99)
    content, _, _ = html_extraction.marginals(html_extraction.plant(test, model.feature, model.edge), model)
    truth = np.array([m == "c" for p in test for m in p.marks])
    assert ((content > 0.5) == truth).mean() > 0.98
    page = """<!DOCTYPE html><html><head><title>T</title><script>if (a < b) "<p>no</p>"</script></head><body><header><h1>Site</h1></header>
    <nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><div class="cookie-banner">We use cookies here.</div>
    <article><h1>Title &amp; more</h1><p>First&nbsp;line with <b>bold</b>text,<br>and so on. It has some words, quite a few.
    <p>Second paragraph &lt;here&gt;, which also goes on for a while.<ul><li>one item, long<li>two</ul></article>
    <section class="comments"><div class="comment"><p>I disagree, strongly, with this.</p></div></section><form><label>Mail</label></form>
    <aside class="sidebar"><p>Read this too.</p></aside><footer>&copy; 2024 Site.</footer></body></html>"""
    rows = [(1, "u", page, "x"), (2, None, None, "x"), (3, "u", "", "x"), (None, "u", "<p>open <b>never closed", "x"), (4, "u", "<" * 50 + "a" * 99, "x"), (1, "u", page, "x")]
    got = html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == 6 and all(r["n_chars"] == len(r["text"]) for r in got)
    want = "Title & more First line with boldtext, and so on. It has some words, quite a few. Second paragraph <here>, which also goes on for a while. one item, long two"
    assert [r["text"] for r in got if r["page_id"] == 1] == [want, want] and [r["text"] for r in got if r["page_id"] in (2, 3)] == ["", ""]
    assert html_extraction.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages_with_stray_quotes_and_deep_nesting_keep_their_text(spark):
    import time
    body = "<p>Hello there, this is a full sentence. It goes on, and on.</p>"
    pages = [f"<div data-a=it's>{body}", f"<div title=\"a > b\" x='c>d'>{body}", f'<div class="x"">{body}', f"<div '>{body}", f"<div a = 'q'>{body}<p class=\"open>", f"<a href=x?a=b\"c></a>{body}"]
    said = "Hello there, this is a full sentence. It goes on, and on."
    assert all("".join(piece for _, piece in html_extraction.parse(p).texts).strip() == said for p in pages)
    got = html_extraction.extract(spark.createDataFrame([(i, "u", p) for i, p in enumerate(pages[:4])], "page_id long, url string, html string")).collect()
    assert {r["text"] for r in got} == {said}

    def seconds(depth):
        began = time.perf_counter()
        for unit in ("<div>", "<span>", "<li><b>", "<body><p>"):
            html_extraction.parse(unit * depth + "x" + "</div></i>" * depth)
        return time.perf_counter() - began
    seconds(500)
    assert seconds(16000) < 16 * max(0.02, seconds(2000))      # 8 times the depth; the square would be 64 times


def test_benchmark_items_shorter_than_a_gram_are_found_without_edits(spark):
    bench = spark.createDataFrame([(1, "Zyx 9"), (2, "  "), (3, None), (4, "kumquat jelly pots")], "item_id long, text string")
    rows = [(1, "the zyx  9 answer"), (2, "zyx 8"), (3, ""), (4, None), (5, "Zyx"), (6, "some KUMQUAT jelly pots, zyx 9")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["edits"], r["start"], r["end"]) for r in decontamination.contaminations(df, bench).collect()}
    assert got == {(1, 1, 0, 4, 10), (6, 4, 0, 5, 23), (6, 1, 0, 25, 30)}
    assert sorted(r["doc_id"] for r in decontamination.clean(df, bench).collect()) == [2, 3, 4, 5]


def test_pipeline_stages_follow_each_other(spark):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "mixing"]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(columns).cache()
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL).cache()
        assert after.columns == columns
        sizes.append(after.count())
        if name == "decontamination":
            items = [r["text"].strip() for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            assert not [1 for r in after.collect() if any(i in (r["text"] or "") for i in items)]
        docs = after
    assert sizes == sorted(sizes, reverse=True) and sizes[3] == sizes[4]
    assert stage is corpus_pipeline.personal_data and corpus_pipeline.mix_sources(spark, docs, SMALL).count() == sizes[-1]


def test_compressed_addresses_and_all_card_ranges_are_found():
    found = {"ipv6": ["2001:db8::1", "2001:db8::8a2e:370:7334", "fe80::1ff:fe23:4567:890a", "::1", "fe80::", "1:2:3:4:5:6:7:8", "2001:db8:85a3::8a2e:370:7334"],
             "card": ["3782 822463 10005", "3782-822463-10005", "2223003122003222", "2223 0031 2200 3222", "4111 1111 1111 1111"]}
    for kind, values in found.items():
        for value in values:
            text = f"see {value}, now"
            got = pii.mentions(text)
            assert [(m.kind, text[m.start:m.end]) for m in got] == [(kind, value)] and re.search(pii.MAY_HAVE, text), value
            new = [pii.rendered(kind, value, pii.surrogate(kind, got[0].canonical, "k", attempt)) for attempt in (0, 60)]
            assert all([m.kind for m in pii.mentions(f"see {x}, now")] == [kind] and x != value for x in new), (value, new)
    for decoy in ("3782 822463 10006", "2223003122003223", "2100 0000 0000 0005", "at 12:30:45", "std::vector", "a :: b"):
        assert not pii.mentions(decoy), decoy
    assert [m.kind for m in pii.mentions("::ffff:192.168.1.7")] == ["ipv4"]


def test_private_addresses_move_to_a_wider_range_and_rounds_are_bounded(spark):
    for value in ("192.168.3.4", "172.20.3.4"):
        assert pii.surrogate("ipv4", value, "k", 11).split(".")[:2] == value.split(".")[:2]
        assert len({pii.surrogate("ipv4", value, "k", attempt) for attempt in range(12, 60)}) == 48
        assert all(pii.surrogate("ipv4", value, "k", attempt).startswith("10.") for attempt in range(12, 60))
    crowded = spark.createDataFrame([("email", f"{c}@a.example") for c in "abcdefghijklmnopqrstuvwxyz"], "kind string, canonical string")
    with pytest.raises(ValueError, match="email"):
        pii.resolve(crowded, "k", rounds=2)


def test_training_takes_one_text_per_id(spark):
    rows = [(1, "a hot text")] * 40 + [(1, "another"), (2, "x"), (2, "x"), (3, None), (None, "y"), (4, "no label")]
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = toxicity.one_text_each(texts, spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, label int")).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 2, 3] and {r["doc_id"]: r["label"] for r in got} == {1: 1, 2: 0, 3: 0}
    assert {r["text"] for r in got if r["doc_id"] != 1} == {"x", None}


def test_decontamination_decides_row_by_row_and_searches_items_without_an_id(spark):
    item, other = "the quick brown fox jumps over the lazy dog near the river bank", "seven wise owls sat on a crooked branch and sang until the dawn came"
    rows = [(None, f"x {item} y"), (None, "clean"), (1, f"x {item} y"), (1, "clean too"), (2, f"so {other} it"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (None, other)], "item_id long, text string")
    assert sorted(map(str, decontamination.clean(docs, bench, block_chars=10).collect())) == sorted(map(str, docs.filter("text is null or text like 'clean%'").collect()))
    found = decontamination.contaminations(docs, bench).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"] or 0) for r in found) == [(0, 7), (1, 7), (2, 0)]


NAMES = {
    "Mr McDonald": "McDonald", "Mr John Q. Smith": "John Q. Smith", "Frau Schmidt-Meyer": "Schmidt-Meyer", "Mr SMITH": "SMITH", "Mr O'Brien": "O'Brien",
    "Señora María José García López": "María José García López", "Dr Petra Novak": "Petra Novak", "Herr Ludwig van der Berg": "Ludwig van der Berg",
    "Mr J. R. Miller": "J. R. Miller", "Mr J Smith": "J Smith", "Prof. Anna-Lena Weiss": "Anna-Lena Weiss", "Mrs Smith's": "Smith",
    "Господин Иван Петров": "Иван Петров", "Κυρία Μαρία Παπαδοπούλου": "Μαρία Παπαδοπούλου", "Mrs de la Cruz": "de la Cruz",
    "Monsieur Étienne d'Arc": "Étienne", "Mr John Smith": "John Smith",
}


def test_names_are_found_whole_and_replaced_whole():
    for text, name in NAMES.items():
        text = f"so {text}, as said"
        got = pii.mentions(text)
        assert [(m.kind, text[m.start:m.end]) for m in got] == [("person", name)] and re.search(pii.MAY_HAVE, text), text
        for attempt in (0, 5):
            new = pii.rendered("person", name, pii.surrogate("person", got[0].canonical, "k", attempt))
            again = pii.mentions(text.replace(name, new))
            assert [m.kind for m in again] == ["person"] and again[0].canonical[2:] != got[0].canonical[2:] and len(new.split()) == len(name.split()), (name, new)
            old_words = {w for w in re.split(r"[ '-]", name) if len(w) > 2 and w not in pii.PARTICLES}
            assert not old_words & set(re.split(r"[ '-]", new)), (name, new)
            assert (name.isupper(), "-" in name and "Anna" not in name) == (new.isupper(), "-" in new), (name, new)
    gender = lambda text: pii.mentions(text)[0].canonical[0]
    assert [gender(t) for t in ("Dr Petra Novak", "Dr Anna Novak", "Dr Novak", "Prof Victor Hugo Braun", "Mrs Victor")] == ["n", "f", "n", "m", "f"]
    assert pii.surrogate("person", "n Petra Novak", "k", 0).split()[0] in pii.NEUTRAL["latin"]
    for clean in ("Dr. says", "Miss the bus", "Mr 5", "the Mr"):
        assert not pii.mentions(clean), clean


def test_national_phones_and_spaced_numbers():
    for text, kind in {"0171-1234567": "phone", "030 12345678": "phone", "020 7946 0958": "phone", "078 05 1120": "ssn"}.items():
        got = pii.mentions(f"call {text} now")
        assert [(m.kind, m.canonical) for m in got] == [(kind, re.sub(r"\D", "", text))], text
        new = pii.rendered(kind, text, pii.surrogate(kind, got[0].canonical, "k", 0))
        assert re.sub(r"\d", "9", new) == re.sub(r"\d", "9", text) and new != text
    for decoy in ("000 12 3456", "1 078 05 1120", "078 05 1120 3", "10 2000 3000"):
        assert not pii.mentions(decoy), decoy
