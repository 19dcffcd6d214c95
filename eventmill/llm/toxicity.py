"""Toxicity by weak supervision: voters, a generative label model, a linear classifier on its posterior labels.

1. Features (words, word beginnings, writing patterns) are counted by label over labelled training texts, FIT_ROWS of
   them at most.
2. The features that speak most for toxic texts become voters, beside a small fixed lexicon and pattern voters. A voter
   fires on a text or abstains.
3. A generative model of the voters - how often each fires in either class, and how strongly two of them fire together
   beyond what the class explains - is fitted by expectation maximisation; correlated voters share their evidence.
4. A logistic model over all chosen features is trained on the posterior labels and scores every whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import cut

#: One training fold in so many is held out.
FOLDS = 5
#: Bound on the labelled rows that the voters, the label model and the classifier are fitted on.
FIT_ROWS = 30_000
#: Features of the classifier for each class, and voters mined from them.
FEATURES, VOTERS = 1024, 128
#: A mined voter must be right in so many of its training texts.
PRECISION = 0.75
#: A feature must occur in so many texts of its class.
LEAST_TEXTS = 3
#: Lengths of word beginnings that count as features: stems of inflected words.
STEMS = (4, 5, 6, 7)
#: A rate feature is percent of words, smoothed by so many words; as a voter it fires from RATE on.
SMOOTH, RATE = 60, 0.8

#: A lexicon of general insults, voters whatever the labels say.
LEXICON = ("idiot", "idiots", "moron", "morons", "stupid", "loser", "losers", "pathetic", "scum", "trash", "worthless", "disgusting", "clown", "dumb", "hate", "kill")

_WORD = re.compile(r"[^\W\d_]+")
_SPELT = str.maketrans("013457@$", "oieastas")
_DISGUISED = re.compile(r"(?=\w*[^\W\d_])(?=\w*[0-9@$])[\w@$]{4,}")

#: Pattern voters: name -> pattern in the text as written.
PATTERNS = {
    "!shout": re.compile(r"\b[^\W\d_a-z]{4,}\b(?:\W+[^\W\d_a-z]{4,}\b){3}"),
    "!marks": re.compile(r"[!?]{3,}"),
    "!symbols": re.compile(r"[#$%&*@]{3,}"),
    "!you": re.compile(r"(?i)\byou(?:'re| are) (?:an? |such )?\w+"),
}


def stems_of(word: str) -> list[str]:
    """The word itself (marked by a closing $) and its beginnings."""
    return [word + "$", *(word[:k] for k in STEMS if len(word) > k)]


def text_words(text: str) -> tuple[Counter, int]:
    """Words with their counts, and the number of words. Disguised words (1d10t) also count as what they spell."""
    lowered = text.lower()
    words = Counter(_WORD.findall(lowered))
    n = sum(words.values())
    if any(c in lowered for c in "013457@$"):
        words.update(w.translate(_SPELT) for w in _DISGUISED.findall(lowered))
    return words, n


def text_features(text: str | None) -> dict[str, float]:
    """Features of a text with their values: 1 for each word, beginning and pattern there, and its rate (name + '+')."""
    if not text:
        return {}
    words, n = text_words(text)
    counts: Counter = Counter()
    for word, times in words.items():
        for f in stems_of(word):
            counts[f] += times
    found: dict[str, float] = dict.fromkeys(counts, 1.0)
    found.update((f + "+", 100.0 * times / (n + SMOOTH)) for f, times in counts.items())
    found.update((name, 1.0) for name, p in PATTERNS.items() if p.search(text))
    return found


def fires(feature: str, value: float) -> bool:
    return value >= RATE if feature.endswith("+") else value > 0


def held_out(doc_id: Column) -> Column:
    """Whether a document's id falls in the held-out fold; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def feature_counts(train: DataFrame) -> DataFrame:
    """(feature, toxic, clean): in how many training texts of each label a feature occurs; '' counts the texts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            both = (Counter(), Counter())
            for text, label in zip(rows["text"], rows["label"]):
                both[int(label)].update(f for f, value in text_features(text).items() if fires(f, value))
                both[int(label)][""] += 1
            names = list(both[0].keys() | both[1].keys())
            yield pd.DataFrame({"feature": names, "toxic": [both[1][n] for n in names], "clean": [both[0][n] for n in names]})
    return train.select("text", "label").mapInPandas(run, "feature string, toxic long, clean long").groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_features(counts: DataFrame, per_class: int) -> pd.DataFrame:
    """The `per_class` features that most raise the odds of either class, by log odds times root of support."""
    total = counts.filter("feature = ''").first()
    n_toxic, n_clean = (total["toxic"], total["clean"]) if total else (0, 0)
    odds = F.log((F.col("toxic") + 0.5) / F.lit(n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(n_clean + 1.0))
    ranked = counts.filter("feature != ''").withColumn("odds", odds)
    best = []
    for sign, name in ((1, "toxic"), (-1, "clean")):
        side = ranked.filter((F.col("odds") * sign > 0.5) & (F.col(name) >= LEAST_TEXTS)).withColumn("weight", F.col("odds") * F.sqrt(name) * sign)
        best.append(side.orderBy(F.desc("weight"), "feature").limit(per_class).toPandas())
    return pd.concat(best, ignore_index=True).assign(n_toxic=n_toxic, n_clean=n_clean)


def vote_matrix(feature_lists: list[np.ndarray], width: int) -> np.ndarray:
    votes = np.zeros((len(feature_lists), width), dtype=np.float64)
    for row, hit in enumerate(feature_lists):
        votes[row, hit] = 1
    return votes


@dataclass
class LabelModel:
    """Prior of the toxic class, firing rates of each voter by class, correlations of voters within a class."""

    prior: float
    toxic: np.ndarray
    clean: np.ndarray
    correlation: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(toxic | votes). A voter that abstains says nothing; the evidence of a firing one, the log ratio of its
        rates, is divided among those that fire along with it, by their correlation."""
        company = 1 + votes @ self.correlation
        evidence = (votes * (np.log(self.toxic) - np.log(self.clean)) / company).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(np.log(self.prior) - np.log1p(-self.prior) + evidence, -60, 60)))


def fit_label_model(votes: np.ndarray, prior: float, toxic: np.ndarray, clean: np.ndarray, rounds: int = 25) -> LabelModel:
    """Expectation maximisation from the given start; correlations are re-estimated within the classes each round.

    The class balance stays as given: voters that may abstain do not tell it.
    """
    n, k = votes.shape
    model = LabelModel(float(np.clip(prior, 1e-3, 0.5)), np.clip(toxic, 1e-4, 0.9), np.clip(clean, 1e-4, 0.9), np.zeros((k, k)))
    for _ in range(rounds):
        p = model.posterior(votes)
        rates, together = [], np.zeros((k, k))
        for weight in (p, 1 - p):
            mass = weight.sum() + 1
            rate = np.clip((weight @ votes + 0.02) / mass, 1e-4, 0.95)
            centred = (votes - rate) * np.sqrt(weight)[:, None]
            covariance = centred.T @ centred / mass
            spread = np.sqrt(np.maximum(np.diag(covariance), 1e-4))
            together += covariance / np.outer(spread, spread) * mass / (n + 2)
            rates.append(rate)
        together[together < 0.1] = 0
        np.fill_diagonal(together, 0)
        change = np.abs(model.toxic - rates[0]).max()
        model = LabelModel(model.prior, rates[0], rates[1], np.minimum(together, 1))
        if change < 1e-4:
            break
    return model


def fit_linear(rows: list[np.ndarray], values: list[np.ndarray], target: np.ndarray, width: int, rounds: int = 200, penalty: float = 2e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by full-batch gradient steps with per-weight scaling. rows: feature numbers."""
    at = np.concatenate([np.full(len(r), i) for i, r in enumerate(rows)]) if rows else np.zeros(0, int)
    col = np.concatenate(rows) if rows else np.zeros(0, int)
    at, col = at.astype(np.int64), col.astype(np.int64)
    val = np.concatenate(values) if rows else np.zeros(0)
    w, b, n = np.zeros(width), 0.0, max(1, len(rows))
    square, square_b = np.full(width, 1e-8), 1e-8
    for _ in range(rounds):
        z = b + np.bincount(at, weights=w[col] * val, minlength=len(rows))
        slope = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target) / n
        g = np.bincount(col, weights=slope[at] * val, minlength=width) + penalty * w
        square += g * g
        square_b += slope.sum() ** 2
        w -= 0.5 * g / np.sqrt(square)
        b -= 0.5 * slope.sum() / np.sqrt(square_b)
    return w, b


@dataclass
class Scorer:
    """The linear classifier: weight by feature, and the level that separates the classes at score 0.5."""

    weights: dict[str, float]
    bias: float

    def score(self, texts: Iterator[str | None]) -> np.ndarray:
        weights, memo = self.weights, {}

        def known(word: str) -> list[str]:
            bases = memo.get(word)
            if bases is None:
                bases = [f for f in stems_of(word) if f in weights or f + "+" in weights]
                if len(memo) < 200_000:
                    memo[word] = bases
            return bases

        out = []
        for text in texts:
            z = self.bias
            if text:
                words, n = text_words(text)
                counts: Counter = Counter()
                for word, times in words.items():
                    for f in known(word):
                        counts[f] += times
                z += sum(weights.get(f, 0.0) + weights.get(f + "+", 0.0) * 100.0 * counts[f] / (n + SMOOTH) for f in sorted(counts))
                z += sum(weights[name] for name, p in PATTERNS.items() if name in weights and p.search(text))
            out.append(z)
        return 1 / (1 + np.exp(-np.clip(np.array(out, dtype=np.float64), -40, 40)))


def one_text_each(texts: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, label, text): for each id of the sample, the text with the least hash among its rows.

    Hashes alone are grouped over all rows; of equal texts each task hands on one per id, so a repeated id shuffles little.
    """
    least = cut(texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min(F.xxhash64("text")).alias("h")))

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set = set()
        for rows in batches:
            rows = rows[~rows["doc_id"].isin(seen)].drop_duplicates("doc_id")
            seen.update(rows["doc_id"])
            yield rows
    chosen = texts.withColumn("h", F.xxhash64("text")).join(F.broadcast(least), ["doc_id", "h"]).select("doc_id", "label", "text")
    return chosen.mapInPandas(first, chosen.schema).groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> Scorer:
    """Fit voters, label model and classifier on the labelled documents outside the held-out fold.

    At most `fit_rows` of them are used, those with the smallest hash of their id, so what is sent to every task (ids and
    labels of these rows) is bounded. Of rows that share an id one text is used. Without labels, or with one class only, the voters are the fixed lexicon and patterns alone.
    """
    marks = labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col(label_id_col).alias("doc_id")).agg(F.max(label_col).alias("label"))
    marks = marks.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sample = cut(marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
    training = cut(one_text_each(texts, sample).select("text", F.col("label").cast("int").alias("label")))
    chosen = choose_features(cut(feature_counts(training)), FEATURES)
    fixed = [w + "$" for w in LEXICON] + list(PATTERNS)
    names = list(dict.fromkeys([*chosen["feature"], *fixed]))
    place = {name: i for i, name in enumerate(names)}

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = [sorted((place[f], value) for f, value in text_features(t).items() if f in place) for t in rows["text"]]
            yield pd.DataFrame({"label": rows["label"], "hits": [np.array([i for i, _ in x], dtype=np.int32) for x in found], "values": [np.array([v for _, v in x], dtype=np.float64) for x in found]})

    fitted = training.mapInPandas(hits, "label int, hits array<int>, values array<double>").toPandas()
    rows = [np.asarray(h, dtype=np.int64) for h in fitted["hits"]]
    values = [np.asarray(v, dtype=np.float64) for v in fitted["values"]]
    label = fitted["label"].to_numpy(dtype=np.float64)
    toxic_side = chosen[(chosen["odds"] > 0) & (chosen["toxic"] > PRECISION * (chosen["toxic"] + chosen["clean"]))] if len(chosen) else chosen
    voters = list(dict.fromkeys([*toxic_side["feature"][:VOTERS], *fixed]))
    slot = np.full(len(names), -1)
    slot[[place[v] for v in voters]] = np.arange(len(voters))
    least = np.array([RATE if name.endswith("+") else 1e-9 for name in names])
    votes = vote_matrix([slot[r][(slot[r] >= 0) & (v >= least[r])] for r, v in zip(rows, values)], len(voters))
    n_toxic, n_clean = float(chosen["n_toxic"].max() if len(chosen) else 0), float(chosen["n_clean"].max() if len(chosen) else 0)
    seen = chosen.set_index("feature") if len(chosen) else None
    known = {v: ((seen.at[v, "toxic"] + 0.5) / (n_toxic + 1), (seen.at[v, "clean"] + 0.5) / (n_clean + 1)) for v in voters if seen is not None and v in seen.index}
    start = np.array([known.get(v, (0.02, 0.02) if v in PATTERNS else (0.2, 0.002)) for v in voters], dtype=np.float64).reshape(-1, 2)
    prior = (n_toxic + 0.5) / (n_toxic + n_clean + 1) if n_toxic else 0.05
    if len(rows):
        target = fit_label_model(votes, prior, start[:, 0], start[:, 1]).posterior(votes)
    else:
        target = np.zeros(0)
    if not n_toxic or not n_clean or not len(rows):
        return Scorer({v: 5.0 for v in fixed if v not in PATTERNS}, -2.5)
    w, b = fit_linear(rows, values, target, len(names))
    z = b + np.array([(w[r] * v).sum() for r, v in zip(rows, values)])
    return Scorer({n: float(x) for n, x in zip(names, w) if abs(x) > 1e-9}, float(b - separating(z, label)))


def separating(z: np.ndarray, label: np.ndarray) -> float:
    """The level that gives the best F1 of the toxic class on the labelled rows; in the middle of its gap."""
    order = np.argsort(-z, kind="stable")
    ranked, right = z[order], label[order]
    hit = np.cumsum(right)
    f1 = 2 * hit / (np.arange(1, len(z) + 1) + right.sum())
    last = np.append(ranked[1:] < ranked[:-1], True)
    best = int(np.argmax(np.where(last, f1, -1)))
    below = ranked[best + 1] if best + 1 < len(z) else ranked[best] - 1
    return float((ranked[best] + below) / 2)


def scored(docs: DataFrame, scorer: Scorer, *, text_col: str = "text", into: str = "score") -> DataFrame:
    """All rows and columns of docs with the score (0 to 1) of the whole text in `into`."""
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(scorer.score(text))
    return docs.withColumn(into, score(text_col))


def classify(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5).

    Labels, languages, sources and ids are no inputs of the score. Null and empty texts are scored as texts without
    features; a null id is never held out. Very long texts are read whole; every feature counts once a text, so length
    does not dilute it. Repeated rows are scored alike. Empty tables give no rows. Labels other than 0 and 1 are
    ignored, and of contradicting labels of a document the toxic one holds. Other columns are ignored.
    """
    scorer = train(docs, labels, id_col=id_col, text_col=text_col, label_id_col=label_id_col, label_col=label_col)
    texts = scored(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), scorer)
    return texts.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
