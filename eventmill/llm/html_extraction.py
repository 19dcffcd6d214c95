"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element is a variable, content or boilerplate: content if it is part of the article or holds it. Its own tag,
names and text give a unary potential, each edge from parent to child a 2 x 2 potential by the kind of the child.
Messages are passed from the leaves to the root and back down (sum-product), which on a tree gives the exact marginal
of every element. The parameters are fitted by gradient ascent on the likelihood of labelled pages, with the same
message passing. Text directly within elements that are content by their marginal is the text of the page.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages for training are put together from templates, so many of them.
TRAINING_PAGES = 300
SEED = 5

# Element names of HTML, by what they mean for the flow of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER = frozenset("head script style noscript template textarea title iframe svg math select option button object canvas audio video xmp noembed noframes datalist".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul caption head title".split())
ENDS_P = frozenset("address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
BOXES = frozenset("article main section div td aside nav header footer form body dialog ul ol center".split())
#: An opening tag (key) ends open elements of these names, but not beyond an element of the names after.
IMPLIED = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "tbody": ("tbody thead tfoot tr td th", "table"), "thead": ("tbody thead tfoot", "table"), "tfoot": ("tbody thead tfoot tr td th", "table"), "option": ("option", "select datalist"),
}
IMPLIED = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in IMPLIED.items()}
KINDS = {
    "article": "article", "main": "article", "section": "section", "div": "div", "p": "p", "h1": "h1", "h2": "heading", "h3": "heading", "h4": "heading", "h5": "heading", "h6": "heading",
    "ul": "list", "ol": "list", "menu": "list", "dl": "list", "li": "item", "dt": "item", "dd": "item", "table": "table", "tr": "table", "td": "table", "th": "table", "tbody": "table",
    "blockquote": "p", "pre": "p", "figure": "figure", "figcaption": "figure", "nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "dialog": "aside", "form": "form",
    "fieldset": "form", "label": "form", "legend": "form", "a": "a", "body": "body", "html": "html", "ins": "inline", "address": "div", "details": "div", "summary": "div", "center": "div",
}
#: Parts of class, id and role names and what they hint at.
HINTS = {
    "good": "article post entry story content body text main prose hentry articlebody page-content single markdown",
    "nav": "nav menu navigation navbar breadcrumb breadcrumbs crumbs pagination pager toc tabs toolbar skip",
    "head": "header masthead topbar banner branding logo hero site-title",
    "foot": "footer foot copyright legal colophon bottom credits imprint",
    "side": "sidebar side aside rail widget widgets complementary secondary related recommended recommendations trending popular more-stories",
    "ad": "ad ads advert advertisement adverts sponsor sponsored promo promotion promoted adsbygoogle dfp commercial banner-ad affiliate",
    "note": "cookie cookies consent notice alert gdpr popup modal overlay toast warning message paywall announcement disclaimer",
    "talk": "comment comments commentlist reply replies respond disqus discussion reader-comments reviews feedback thread",
    "share": "share sharing social follow subscribe newsletter signup login search form contact tags meta byline author-box",
}
_HINT = {word: kind for kind, words in HINTS.items() for word in words.split()}

#: A comment, declaration or tag. Quotes belong to a tag only right after an equals sign; a stray one is a character.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')|=)*)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_PART = re.compile(r"[a-z]+")
_WORDS = re.compile(r"\S+")


@dataclass
class Page:
    """Elements in page order: parent, name, feature names, kind of edge to the parent; and the texts between tags."""

    parent: list[int] = field(default_factory=list)
    name: list[str] = field(default_factory=list)
    features: list[list[str]] = field(default_factory=list)
    edge: list[str] = field(default_factory=list)
    texts: list[tuple[int, str]] = field(default_factory=list)  # (element, text); (-1, "") ends a block
    marks: list[str | None] = field(default_factory=list)


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in _ATTRIBUTE.finditer(raw)}


def _describe(name: str, raw: str) -> tuple[list[str], str, str | None]:
    """Features of an element by its tag alone, the kind of its edge, and its training mark if it has one."""
    kind = KINDS.get(name, "inline")
    features, mark, hinted = [f"tag:{kind}"], None, ""
    if raw.strip():
        values = _attributes(raw)
        mark = values.get("data-mark")
        if "hidden" in values or values.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", values.get("style", "")):
            features.append("hidden")
            hinted = "bad"
        if values.get("role") in ("navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "form", "menu"):
            features.append("role:bad")
            hinted = "bad"
        names = " ".join((values.get("class", ""), values.get("id", ""), values.get("itemprop", ""), "main" if values.get("role") in ("main", "article") else "")).lower()
        whole = re.split(r"\s+", names.strip())
        parts = set(whole) | set(_PART.findall(names)) if names.strip() else set()
        kinds = {_HINT[p] for p in parts if p in _HINT}
        features += [f"hint:{k}" for k in sorted(kinds)]
        if kinds - {"good"}:
            features.append("hint:bad")
            hinted = "bad"
        elif kinds:
            hinted = "good"
    features.append(f"tag:{kind}, {hinted or 'unnamed'}")
    group = {"p": "text", "h1": "text", "heading": "text", "list": "list", "item": "item", "table": "item", "a": "inline", "inline": "inline", "figure": "text"}.get(kind, "box")
    return features, hinted or (kind if kind in ("nav", "header", "footer", "aside", "form", "article") else group), mark


def parse(source: str | None, memo: dict | None = None) -> Page:
    """Elements and texts of a page, read forgivingly: missing end tags are implied, stray ones ignored."""
    page, stack, memo = Page(), [], {} if memo is None else memo
    text = source or ""
    opened: Counter[str] = Counter()  # open elements by name, so that no tag looks through the stack in vain

    def push(name: str, raw: str) -> None:
        known = memo.get((name, raw))
        if known is None:
            known = _describe(name, raw)
            if len(memo) < 50_000:
                memo[name, raw] = known
        page.parent.append(stack[-1] if stack else -1)
        page.name.append(name)
        kind, holder = KINDS.get(name, "inline"), KINDS.get(page.name[stack[-1]], "inline") if stack else "none"
        page.features.append([*known[0], f"{kind} in {holder}"])
        page.edge.append(known[1])
        page.marks.append(known[2])
        stack.append(len(page.name) - 1)
        opened[name] += 1

    def drop() -> None:
        opened[page.name[stack.pop()]] -= 1

    def pop(name: str) -> None:
        while stack and page.name[stack[-1]] != name:
            drop()
        if stack:
            drop()

    def say(piece: str) -> None:
        if stack:
            page.texts.append((stack[-1], piece))
        elif piece.strip():
            push("body", "")
            seen.add("body")
            page.texts.append((stack[-1], piece))

    at, end, seen = 0, len(text), set()
    while at < end:
        m = _TOKEN.search(text, at)
        if m is None:
            say(text[at:])
            break
        if m.start() > at:
            say(text[at:m.start()])
        at = m.end()
        name = m[2] and m[2].lower()
        if not name:
            continue
        if name in BLOCK or name == "br":
            page.texts.append((-1, "") if name != "br" else (stack[-1] if stack else -1, " "))
        if m[1]:
            if opened[name]:
                pop(name)
            continue
        if name in ENDS_P and opened["p"]:
            # a paragraph ends here unless it lies outside a cell, list item or box opened since
            for i in reversed(stack):
                if page.name[i] == "p":
                    pop("p")
                    break
                if page.name[i] in ("td", "th", "li", "div", "article", "section", "main", "body", "table", "blockquote", "form", "aside"):
                    break
        if name in IMPLIED:
            closing, limit = IMPLIED[name]
            while any(opened[c] for c in closing):
                inner = next((i for i in reversed(stack) if page.name[i] in closing or page.name[i] in limit), None)
                if inner is None or page.name[inner] in limit:
                    break
                pop(page.name[inner])
        if name in ("html", "body"):
            if name in seen:
                continue
            seen.add(name)
        if name == "body":
            while stack and page.name[stack[-1]] != "html":
                drop()
        if name in VOID:
            continue
        push(name, m[3])
        if m[3].endswith("/") and name not in BLOCK:
            drop()
        elif name in RAW:
            close = re.compile(rf"</{name}\s*[^>]*>", re.IGNORECASE).search(text, at)
            page.texts.append((stack[-1], ""))
            drop()
            at = close.end() if close else end
    return page


def add_text_features(page: Page) -> None:
    """Features of the text in and below each element: how many words, how many of them in links, how it is punctuated."""
    n = len(page.name)
    own, marks, links = [0] * n, [0] * n, [0] * n
    in_link, never = [False] * n, [False] * n
    for i in range(n):
        p = page.parent[i]
        in_link[i] = page.name[i] == "a" or (p >= 0 and in_link[p])
        never[i] = page.name[i] in NEVER or (p >= 0 and never[p])
    for i, piece in page.texts:
        if i >= 0 and not never[i] and not piece.isspace():
            words = len(piece.split())
            own[i] += words
            marks[i] += piece.count(".") + piece.count(",") + piece.count("!") + piece.count("?")
            if in_link[i]:
                links[i] += words
    total, total_links, total_marks = own[:], links[:], marks[:]
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        if p >= 0:
            total[p] += total[i]
            total_links[p] += total_links[i]
            total_marks[p] += total_marks[i]
    for i in range(n):
        f, t = page.features[i], total[i]
        f.append("words:0" if t == 0 else "words:1" if t < 5 else "words:5" if t < 15 else "words:15" if t < 40 else "words:40" if t < 120 else "words:120")
        share = total_links[i] / t if t else 0
        f.append("links:0" if share == 0 else "links:some" if share < 0.4 else "links:many")
        f.append("marks:0" if total_marks[i] == 0 else "marks:few" if total_marks[i] * 25 < t else "marks:many")
        held = t / max(1, total[0])
        if page.name[i] in BOXES:
            share_of_page = "all" if held > 0.9 else "most" if held > 0.5 else "part" if held > 0.1 else "little"
            f += [f"held:{share_of_page}", f"held:{share_of_page} by {KINDS.get(page.name[i], 'box')}"]
        if never[i]:
            f.append("never")
        if in_link[i]:
            f.append("in link")


@dataclass
class Model:
    """Weights of the features (for content), and the log potential of each kind of edge: [parent][child]."""

    feature: dict[str, int]
    weight: np.ndarray
    edge: dict[str, int]
    pair: np.ndarray


@dataclass
class Forest:
    """Pages laid side by side: parents by number, elements by depth, features flattened."""

    parent: np.ndarray
    levels: list[np.ndarray]
    row: np.ndarray
    col: np.ndarray
    kind: np.ndarray
    size: int


def plant(pages: list[Page], feature: dict[str, int], edge: dict[str, int]) -> Forest:
    parent, depth, row, col, kind, base = [], [], [], [], [], 0
    for page in pages:
        for i, p in enumerate(page.parent):
            parent.append(base + p if p >= 0 else -1)
            depth.append(depth[base + p] + 1 if p >= 0 else 0)
            kind.append(edge.get(page.edge[i], 0))
            for f in page.features[i]:
                c = feature.get(f)
                if c is not None:
                    row.append(base + i)
                    col.append(c)
        base += len(page.parent)
    depth_at = np.array(depth, dtype=np.int64)
    levels = [np.flatnonzero(depth_at == d) for d in range(int(depth_at.max()) + 1)] if base else []
    return Forest(np.array(parent, dtype=np.int64), levels, np.array(row, dtype=np.int64), np.array(col, dtype=np.int64), np.array(kind, dtype=np.int64), base)


def _log_sum(a: np.ndarray) -> np.ndarray:
    top = a.max(axis=-1, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=-1, keepdims=True)))[..., 0]


def marginals(forest: Forest, model: Model) -> tuple[np.ndarray, np.ndarray, float]:
    """P(content) of each element, joint distribution of each element's parent and itself, log partition function."""
    n = forest.size
    unary = np.zeros((n, 2))
    unary[:, 1] = np.bincount(forest.row, weights=model.weight[forest.col], minlength=n) if n else 0
    up, to_parent = unary.copy(), np.zeros((n, 2))
    for level in reversed(forest.levels[1:]):  # from the leaves: what each element tells its parent
        to_parent[level] = _log_sum(model.pair[forest.kind[level]] + up[level][:, None, :])
        np.add.at(up, forest.parent[level], to_parent[level])
    down, joint = np.zeros((n, 2)), np.zeros((n, 2, 2))
    for level in forest.levels[1:]:  # back from the roots: what the rest of the page tells each element
        above = up[forest.parent[level]] + down[forest.parent[level]] - to_parent[level]
        both = above[:, :, None] + model.pair[forest.kind[level]]
        down[level] = _log_sum(np.swapaxes(both, 1, 2))
        both = both + up[level][:, None, :]
        both -= both.max(axis=(1, 2), keepdims=True)
        both = np.exp(both)
        joint[level] = both / both.sum(axis=(1, 2), keepdims=True)
    belief = up + down
    content = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -60, 60)))
    root = forest.levels[0] if forest.levels else np.zeros(0, dtype=np.int64)
    return content, joint, float(_log_sum(up[root]).sum()) if len(root) else 0.0


def fit(pages: list[Page], rounds: int = 300, penalty: float = 0.005) -> Model:
    """Maximum likelihood with a quadratic penalty: the gradient is what the labels show less what the model expects."""
    feature = {f: i for i, f in enumerate(sorted({f for p in pages for fs in p.features for f in fs}))}
    edge = {e: i + 1 for i, e in enumerate(sorted({e for p in pages for e in p.edge}))}
    forest = plant(pages, feature, edge)
    truth = np.array([float(m == "c") for p in pages for m in p.marks])
    model = Model(feature, np.zeros(len(feature)), edge, np.zeros((len(edge) + 1, 2, 2)))
    child = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros_like(model.pair)
    np.add.at(seen, (forest.kind[child], truth[forest.parent[child]].astype(int), truth[child].astype(int)), 1)
    squares = [np.full_like(model.weight, 1e-6), np.full_like(model.pair, 1e-6)]
    for _ in range(rounds):
        content, joint, _ = marginals(forest, model)
        expected = np.zeros_like(model.pair)
        np.add.at(expected, forest.kind[child], joint[child])
        slopes = (np.bincount(forest.col, weights=(truth - content)[forest.row], minlength=len(feature)) / len(pages) - penalty * model.weight,
                  (seen - expected) / len(pages) - penalty * model.pair)
        for value, slope, square in zip((model.weight, model.pair), slopes, squares):
            square += slope * slope
            value += 0.8 * slope / np.sqrt(square)
    return model


def text_of(page: Page, content: np.ndarray) -> str:
    """Texts of the content elements: blocks in page order, white space inside a block as one space."""
    never = [False] * len(page.name)
    for i, p in enumerate(page.parent):
        never[i] = page.name[i] in NEVER or (p >= 0 and never[p])
    blocks, block = [], []
    for i, piece in [*page.texts, (-1, "")]:
        if i < 0:
            joined = " ".join("".join(block).split())
            if joined:
                blocks.append(joined)
            block = []
        elif not never[i] and (content[i] > 0.5 or piece.isspace()):
            block.append(html.unescape(piece) if "&" in piece else piece)
    return " ".join(blocks)


def extract_texts(sources: list[str | None], model: Model, memo: dict) -> list[str]:
    pages = [parse(s, memo) for s in sources]
    for page in pages:
        add_text_features(page)
    forest = plant(pages, model.feature, model.edge)
    content, _, _ = marginals(forest, model)
    out, base = [], 0
    for page in pages:
        out.append(text_of(page, content[base:base + len(page.name)]))
        base += len(page.name)
    return out


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", training: int = TRAINING_PAGES, seed: int = SEED) -> DataFrame:
    """One row per page: page_id, url, text (main text, empty if none), n_chars (its code points).

    The model is fitted on `training` labelled pages put together from templates, a bounded sample that does not depend
    on the table. Nulls: a null or empty html has an empty text; null ids and urls are kept. Very long pages are read
    whole. Repeated rows get equal texts. Empty tables give no rows. Other columns are ignored. Pages are independent
    of each other, so there is no shuffle; a task holds the elements of a few pages at a time.
    """
    model = fit(training_pages(training, seed))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict = {}
        for rows in batches:
            for start in range(0, len(rows), 64):
                some = rows.iloc[start:start + 64]
                texts = extract_texts(list(some["html"]), model, memo)
                yield pd.DataFrame({"page_id": some["page_id"].to_numpy(), "url": some["url"].to_numpy(), "text": texts, "n_chars": [len(t) for t in texts]})
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return source.mapInPandas(run, "page_id long, url string, text string, n_chars long")


def training_pages(n: int, seed: int) -> list[Page]:
    """Labelled pages: templates of articles among what surrounds them, filled with made-up words.

    Elements that are or hold the article carry data-mark="c" in the source, all others are boilerplate.
    """
    pages = []
    for i in range(n):
        page = parse(training_source(random.Random(seed * 100_003 + i)))
        add_text_features(page)
        pages.append(page)
    return pages


def training_source(r: random.Random) -> str:
    """One labelled page. Each part stands in several common spellings, some of them without telling names."""
    syllables = "an be co da er fi go ha in jo ka le mi no or pa que ra se ti un ve wo xa yo zu".split()

    def words(low: int, high: int, stops: bool = True) -> str:
        out = ["".join(r.choice(syllables) for _ in range(r.randint(1, 3))) for _ in range(r.randint(low, high))]
        if stops:
            for at in range(r.randint(3, 9), len(out), 9):
                out[at] += r.choice(".,,.!?")
            out[-1] += "."
        return " ".join(out).capitalize()

    def link() -> str:
        return f'<a href="/{r.randint(1, 999)}">{words(1, 3, False)}</a>'

    def link_list() -> str:
        tag = r.choice(["ul", "ol", "div"])
        inner = "".join(f"<li>{link()}</li>" if tag != "div" else link() + " " for _ in range(r.randint(2, 8)))
        return f"<{tag}>{inner}</{tag}>"

    def box(names: list[str], inner: str, plain: float = 0.0) -> str:
        tag, _, name = r.choice(names).partition(".")
        attr = "" if not name or r.random() < plain else f' {r.choice(["class", "id"])}="{name}"'
        return f"<{tag}{attr}>{inner}</{tag}>"

    def menu() -> str:
        return box(["nav", "nav.main-nav", "div.menu", "div.navbar", "ul.nav", "div.breadcrumbs", "nav.pagination", "div.skip-link"], link_list())

    def advert() -> str:
        return box(["div.ad", "div.ads", "div.advert", "aside.promo", "div.sponsored", "ins.adsbygoogle", "section.advertisement", "div.ad-slot", "p.ad"], r.choice([words(3, 14), f"<p>{words(5, 25)}</p>", link()]))

    def notice() -> str:
        return box(["div.cookie-banner", "div.notice", "div.consent", "section.alert", "div.popup", "dialog", "div.gdpr", "p.notice"], r.choice([f"<p>{words(6, 30)}</p>", words(6, 30)]) + r.choice(["", "<button>OK</button>", link()]))

    def form() -> str:
        return f'<form{r.choice(["", " class=search", " id=newsletter", " action=/login"])}>' + r.choice([f"<label>{words(1, 4, False)}</label><input><button>Go</button>", f"<p>{words(4, 16)}</p><input type=email>", f"<fieldset><legend>{words(1, 3, False)}</legend><label>{words(2, 5, False)}</label></fieldset>"]) + "</form>"

    def comments() -> str:
        def one() -> str:
            inner = r.choice([f"<p>{words(5, 50)}</p>", f"<b>{words(1, 2, False)}</b> {words(5, 40)}", f"<cite>{words(1, 2, False)}</cite><p>{words(8, 40)}</p><p>{words(8, 30)}</p>"])
            return box(["div.comment", "article.comment", "li.comment", "li", "div", "div.reply", "blockquote"], inner)
        some = "".join(one() for _ in range(r.randint(1, 4)))
        head = r.choice(["", f"<h2>{words(1, 3, False)}</h2>", f"<h3>{words(1, 3, False)}</h3>"])
        return box(["section.comments", "div.comments", "ol.commentlist", "div.reader-comments", "ul.comments", "section.discussion", "div.disqus_thread", "aside.comments"], head + some)

    def side() -> str:
        inner = r.choice([f"<h3>{words(1, 4, False)}</h3>{link_list()}", f"<h3>{words(1, 3, False)}</h3><p>{words(5, 40)}</p>", f"<p>{words(8, 40)}</p>", words(4, 30)])
        return box(["aside", "aside.sidebar", "div.sidebar", "div.widget", "section.related", "div.recommended", "div.side"], inner)

    def share() -> str:
        return box(["div.share", "ul.social", "div.tags", "p.follow", "div.author-box"], r.choice([link_list(), link(), words(3, 20)]))

    def masthead() -> str:
        return box(["header", "header.site-header", "div.header", "div.masthead", "div.topbar"], r.choice([words(1, 6, False), f"<h1>{words(1, 4, False)}</h1>", f"<h1>{words(1, 2, False)}</h1>", f"<p>{words(3, 9)}</p>", link()]) + r.choice(["", menu()]))

    def footing() -> str:
        return box(["footer", "footer.site-footer", "div.footer", "div.copyright", "div.legal"], r.choice([f"&copy; {words(3, 20)}", f"<p>{words(3, 30)}</p>", link_list(), f"&copy; x.example &middot; {words(5, 25)}"]))

    def inline(text: str) -> str:
        parts = text.split(" ")
        if len(parts) > 6 and r.random() < 0.5:
            at = r.randrange(len(parts) - 3)
            tag = r.choice(["b", "i", "em", "strong", "a", "span", "code"])
            parts[at] = f'<{tag}{" href=/x" if tag == "a" else ""} data-mark="c">{parts[at]}'
            if r.random() < 0.8:
                parts[at + 2] += f"</{tag}>"
        return " ".join(parts)

    def paragraph(longest: int) -> str:
        kind = r.random()
        if kind < 0.72:
            return f'<p data-mark="c">{inline(words(1, longest))}{r.choice(["</p>", "</p>", "</p>", "<br>", ""])}'
        if kind < 0.8:
            return f'<h{r.choice("23")} data-mark="c">{words(1, 8, False)}</h{r.choice("23")}>'
        if kind < 0.88:
            items = "".join(f'<li data-mark="c">{inline(words(2, 25))}</li>' for _ in range(r.randint(1, 5)))
            return f'<ul data-mark="c">{items}</ul>'
        if kind < 0.92:
            return f'<blockquote data-mark="c">{r.choice([words(5, 40), "<p data-mark=c>" + words(5, 40) + "</p>"])}</blockquote>'
        if kind < 0.95:
            return f'<table data-mark="c"><tr data-mark="c"><td data-mark="c">{words(1, 8, False)}</td><td data-mark="c">{words(1, 8, False)}</td></tr></table>'
        if kind < 0.97:
            return f'<pre data-mark="c">{words(3, 30)}</pre>'
        return f'<div data-mark="c">{inline(words(5, 60))}</div>'

    def article() -> str:
        title = f'<h1 data-mark="c">{words(2, 14, False)}</h1>'
        if r.random() < 0.2:
            title = f'<header data-mark="c">{title}</header>'
        inner = "" if r.random() < 0.15 else title
        body = []
        longest = r.choice([8, 16, 24, 40, 90])
        for _ in range(r.choice([1, 2, 3, 3, 5, 5, 8, 8, 13, 13, 25, 25, 50, 150, 150, 300])):
            body.append(paragraph(longest))
            if r.random() < 0.08:
                body.append(r.choice([advert, share, side, form, notice, menu])())
        inner += "".join(body)
        if r.random() < 0.12:
            inner += comments()
        tag, _, name = r.choice(["article", "article", "article.post", "main", "div.content", "div.post-content", "div.entry-content", "section.story", "div.article-body", "div", "div.x1", "section", "td"]).partition(".")
        attr = f' class="{name}"' if name else ""
        out = f'<{tag}{attr} data-mark="c">{inner}</{tag}>'
        return f'<table data-mark="c"><tr data-mark="c">{out}</tr></table>' if tag == "td" else out

    before = [f() for f in (masthead, menu, advert, notice, form, side, masthead) if r.random() < 0.4]
    after = [f() for f in (comments, side, share, advert, form, menu, notice) if r.random() < 0.35] + [footing() for _ in range(r.random() < 0.7)]
    r.shuffle(before)
    middle = article()
    for _ in range(r.choice([0, 0, 1, 1, 2])):
        name = r.choice(["", ' class="wrapper"', ' id="main"', ' class="container"', ' id="page"', ' class="row"'])
        inside = r.random() < 0.5
        middle = f'<div{name} data-mark="c">' + ("".join(before) + middle + "".join(after) if inside else middle) + "</div>"
        if inside:
            before, after = [], []
    head = f"<head><title>{words(2, 9, False)}</title><style>p{{}}</style><script>var x='<p>';</script></head>" if r.random() < 0.8 else ""
    return f'<html data-mark="c">{head}<body data-mark="c">{"".join(before)}{middle}{"".join(after)}</body></html>'
