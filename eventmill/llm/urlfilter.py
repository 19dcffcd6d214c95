"""URL filter: allow and block rules, and a character language-model ratio for the URLs no rule decides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmill.llm.common import cut

#: Longest context, in characters, of the Markov models.
ORDER = 5
#: One labelled URL shape in so many is kept from the models to calibrate the threshold.
FOLDS = 5
#: Score bins of the calibration, in nats per character.
BIN = 0.01
#: A gram borne by more than one of so many characters is common; there can be no more common grams than this.
COMMON = 1000
START, END = "\x02", "\x03"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lower-cased; path: then up to ? # or the end.

    Both are empty for null or without ://.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, upper.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def apply_rules(urls: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Adds rule and rule_verdict to rows with host and path; rules are (verdict, host/path prefix).

    A rule fits its host and all subdomains if the path starts with the rule's path; the longest rule wins, and of
    equally long ones that with the longer host. The rule list is a parameter, so its table is as long as the call.
    """
    fits = []
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        ok = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        fits.append(F.when(ok, F.struct(F.lit(len(rule)).alias("n"), F.lit(len(host)).alias("h"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    best = F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<n:int,h:int,rule:string,verdict:string>")
    return urls.withColumn("best", best).select(*urls.columns, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict"))


def grams(shapes: DataFrame, order: int) -> DataFrame:
    """One row per character of each shape: the character with up to `order` before it."""
    padded = F.concat(F.lit(START), "shape", F.lit(END))
    at = F.explode(F.sequence(F.lit(2), F.length(padded)))
    return shapes.withColumns({"padded": padded}).withColumn("i", at).withColumn(
        "gram", F.col("padded").substr(F.greatest(F.lit(1), F.col("i") - order), F.least(F.col("i"), F.lit(order + 1)))).drop("padded", "i")


def log_ratios(counted: DataFrame, order: int) -> DataFrame:
    """(gram, ratio): log P(char | context) for accepted minus that for rejected URLs.

    counted: gram, accepted, rejected (occurrences; 0 for grams seen in unlabelled URLs alone). The probabilities are
    Witten-Bell mixtures of all context lengths from `order` down to none and then the uniform one:
    P_k = (n(context, char) + kinds(context) * P_k-1) / (n(context) + kinds(context)), so the order varies by what the
    contexts have been seen with.
    """
    tail = F.explode(F.sequence(F.lit(1), F.length("gram")))
    ends = counted.withColumn("size", tail).withColumn("end", F.right("gram", "size")).drop("size")
    seen = ends.groupBy("end").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    seen = seen.withColumn("context", F.left("end", F.length("end") - 1))
    contexts = seen.groupBy("context").agg(
        F.sum("accepted").alias("n_accepted"), F.sum("rejected").alias("n_rejected"),
        F.sum((F.col("accepted") > 0).cast("long")).alias("k_accepted"), F.sum((F.col("rejected") > 0).cast("long")).alias("k_rejected"))
    facts = seen.join(contexts, "context").select("end", F.struct(
        F.length("end").alias("size"), "accepted", "rejected", "n_accepted", "n_rejected", "k_accepted", "k_rejected").alias("fact"))
    kinds = seen.filter(F.length("end") == 1).agg((F.count(F.lit(1)) + 1).cast("double").alias("letters"))
    chains = ends.select("gram", "end").join(facts, "end").groupBy("gram").agg(F.sort_array(F.collect_list("fact")).alias("facts"))

    def mixed(side: str) -> Column:
        def step(p: Column, f: Column) -> Column:
            n, k = f[f"n_{side}"], f[f"k_{side}"]
            return F.when(n > 0, (f[side] + k * p) / (n + k)).otherwise(p)
        return F.aggregate("facts", 1.0 / F.col("letters"), step)

    return chains.join(F.broadcast(kinds)).select("gram", (F.log(mixed("accepted")) - F.log(mixed("rejected"))).alias("ratio"))


def with_ratios(spelled: DataFrame, ratios: DataFrame, counted: DataFrame) -> DataFrame:
    """Each character with its gram's ratio.

    The grams that more than a thousandth of all characters bear are at most COMMON by count: they are sent to every
    task. The other grams are joined by a shuffle in which none is hot.
    """
    total = counted.agg(F.sum("uses")).first()[0] or 0
    common = counted.filter(F.col("uses") * COMMON > total).select("gram")
    rare = spelled.join(F.broadcast(common), "gram", "left_anti").join(ratios, "gram")
    return spelled.join(F.broadcast(ratios.join(F.broadcast(common), "gram", "left_semi")), "gram").unionByName(rare)


def best_threshold(scores: DataFrame) -> DataFrame:
    """One row, threshold: the score bin edge with the least sum of false-accept and false-reject rates on held-out labels.

    Binned first, so the window holds as many rows as there are bins between the lowest and the highest score. Of
    equally good edges the one nearest to 0 wins; without held-out URLs of both classes it is 0.
    """
    bins = scores.groupBy(F.floor(F.col("score") / BIN).alias("bin")).agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rates = bins.select(
        (F.col("bin") * BIN).alias("edge"),
        (F.coalesce(F.sum("accepted").over(below), F.lit(0)) / F.sum("accepted").over(everything)
         + 1 - F.coalesce(F.sum("rejected").over(below), F.lit(0)) / F.sum("rejected").over(everything)).alias("loss"))
    best = rates.filter(F.col("loss").isNotNull()).agg(F.min(F.struct("loss", F.abs("edge").alias("far"), "edge")).alias("best"))
    return best.select(F.coalesce(F.col("best.edge"), F.lit(0.0)).alias("threshold"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], *, id_col: str = "page_id", url_col: str = "url", order: int = ORDER) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score, threshold.

    URLs that a rule decides are the labelled ones: models of accepted and rejected URLs are counted over all of them
    but a fifth, which calibrates the threshold. The models read host and path with digits as 0 (the shape); each
    distinct shape is scored once. score is the log-likelihood difference per character, for every URL; without a rule
    the verdict is allow if score >= threshold.

    Nulls: a null url, or one without ://, has empty host and path, fits no rule and scores only its end mark; null ids
    are kept. Very long urls are scored whole. Repeated rows get equal verdicts. Empty tables give no rows; without any
    labelled URL of a class its model is uniform. Other columns are ignored.
    """
    host, path = host_and_path(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    ruled = apply_rules(parsed, rules).withColumn("shape", F.regexp_replace(F.concat("host", "path"), "[0-9]", "0"))
    shapes = cut(ruled.groupBy("shape").agg(
        F.sum((F.col("rule_verdict") == "allow").cast("long")).alias("accepted"),
        F.sum((F.col("rule_verdict") == "block").cast("long")).alias("rejected")).select(
        "shape", F.coalesce("accepted", F.lit(0)).alias("accepted"), F.coalesce("rejected", F.lit(0)).alias("rejected"),
        (F.crc32("shape") % FOLDS == 0).alias("held_out")))
    spelled = grams(shapes, order)
    learnt = ~F.col("held_out")
    counted = cut(spelled.groupBy("gram").agg(
        F.count(F.lit(1)).alias("uses"),
        F.sum(F.when(learnt, F.col("accepted")).otherwise(0)).alias("accepted"),
        F.sum(F.when(learnt, F.col("rejected")).otherwise(0)).alias("rejected")))
    ratios = cut(log_ratios(counted, order))
    scored = cut(with_ratios(spelled, ratios, counted).groupBy("shape").agg(
        F.avg("ratio").alias("score"), F.first("accepted").alias("accepted"), F.first("rejected").alias("rejected"), F.first("held_out").alias("held_out")))
    threshold = best_threshold(scored.filter("held_out"))
    judged = ruled.join(scored.select("shape", "score"), "shape").join(F.broadcast(threshold))
    verdict = F.coalesce("rule_verdict", F.when(F.col("score") >= F.col("threshold"), "allow").otherwise("block"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score", "threshold")
