"""Soft-membership mixing of documents to target weights (operator 5), in DataFrame operations only.

The domains come from the labelled table: ``toxic`` (toxic = 1), else ``low`` (quality = 0), else ``clean``. A naive
Bayes classifier over binned statistics and the presence of the most telling words, fitted with aggregations on a
bounded sample of labelled rows (at most ``sample_rows``, the smallest hashes of their ids), gives every document a
posterior over domains. Non-negative rates r then solve

    min  1/2 sum_k (S_k - T_k)**2 / M_k,   S_k = sum_d r_d tokens_d p_dk,   M_k = sum_d tokens_d p_dk

by projected gradient steps r <- max(0, r - sum_k p_k (S_k - T_k) / M_k) from r = 1 (the gradient in the metric of the
documents' tokens, whose step length 1 is safe). A step needs only the sums S_k, one aggregation over the documents;
rates stay column expressions, so no document or rate ever leaves the cluster and nothing is shuffled but sums.

Targets: T_k = weight_k * total; the total is given, or chosen so that the domain with the largest weight keeps its
own tokens. A document is taken floor(r) times, and once more if a hash of its id falls under the rest.

Defined results: null and empty texts have 0 tokens, the prior's posterior for texts without words, and a rate like
any other; a label row with neither mark is none; without labelled rows the posteriors are equal; a domain without labelled rows has only smoothing mass;
repeated rows get equal rates; a null id counts in the sums like any other; other columns are ignored by
:func:`rates` and kept by :func:`mix`; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

DOMAINS = ("clean", "low", "toxic")
WEIGHTS = {"clean": 0.90, "low": 0.06, "toxic": 0.04}
SAMPLE_ROWS = 12_000
#: Upper ends of the bins of each statistic; the last bin is open.
BINS = {
    "symbols": (0.0, 0.02, 0.1, 0.3, 0.6, 1.0, 2.0),
    "shouts": (0.0, 0.02, 0.1, 0.3, 0.6, 1.0),
    "distinct": (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.99),
    "size": (0.0, 7.0, 31.0, 63.0, 127.0, 255.0, 511.0, 1023.0, 4095.0),
}
_SYMBOLS = "#*$%&|<>"


def _gone(text: Column, marks: str) -> Column:
    left = text
    for c in marks:
        left = F.replace(left, F.lit(c), F.lit(""))
    return F.octet_length(text) - F.octet_length(left)


def _binned(value: Column, ends: tuple[float, ...]) -> Column:
    out = F.lit(len(ends))
    for i in range(len(ends) - 1, -1, -1):
        out = F.when(value <= ends[i], F.lit(i)).otherwise(out)
    return out


def described(docs: DataFrame, *keep: str) -> DataFrame:
    """keep, then columns __tokens, __words (distinct words) and __bins (one bin for each statistic) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*keep, F.lower(text).alias("__low"))
    rows = rows.select(*keep, "__low", F.filter(F.split("__low", r"[^\p{L}\p{N}]+"), lambda x: x != "").alias("__all"))
    rows = rows.select(*keep, "__low", F.size("__all").cast("long").alias("__tokens"), F.array_distinct("__all").alias("__words"))
    words = F.greatest(F.col("__tokens"), F.lit(1))
    values = {"symbols": _gone(F.col("__low"), _SYMBOLS) / words, "shouts": _gone(F.col("__low"), "!") / words, "distinct": F.size("__words") / words, "size": F.col("__tokens").cast("double")}
    return rows.select(*keep, "__tokens", "__words", F.array(*(_binned(values[n], BINS[n]) for n in BINS)).alias("__bins"))


@dataclass
class Classifier:
    prior: list[float]  # log, by domain; the absence of every word included
    bins: dict[tuple[int, int], list[float]]  # statistic, bin: log likelihoods by domain
    words: dict[str, list[float]]  # word: log odds of its presence by domain

    def logs(self) -> Column:
        """An array with the unnormalised log posterior of each domain over the columns of described()."""
        out = F.array(*(F.lit(x) for x in self.prior))
        for s, name in enumerate(BINS):
            table = F.array(*(F.array(*(F.lit(x) for x in self.bins[s, b])) for b in range(len(BINS[name]) + 1)))
            out = F.zip_with(out, F.element_at(table, F.element_at("__bins", s + 1) + 1), lambda x, y: x + y)
        if self.words:
            weights = F.create_map(*(x for w, v in self.words.items() for x in (F.lit(w), F.array(*(F.lit(y) for y in v)))))
            hits = F.array_intersect("__words", F.array(*(F.lit(w) for w in self.words)))
            out = F.aggregate(hits, out, lambda s, w: F.zip_with(s, F.element_at(weights, w), lambda x, y: x + y))
        return out


def domain(labels: DataFrame) -> Column:
    """NULL where a row marks nothing: it is no label."""
    return F.when(F.col("toxic") == 1, F.lit(2)).when(F.col("quality") == 0, F.lit(1)).when(F.coalesce("quality", "toxic").isNotNull(), F.lit(0))


def fit(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS, words: int = 24, support: int = 8, ratio: float = 3.0) -> Classifier:
    """words: the most telling words kept for each domain, each in at least support sampled documents and ratio times as common there as elsewhere."""
    sample = labels.select(F.col("doc_id").cast("long").alias("__id"), domain(labels).alias("__domain")).dropna().orderBy(F.xxhash64("__id"), "__id", "__domain").limit(sample_rows)
    ids = docs.select(F.col("doc_id").cast("long").alias("__id"), "text").join(F.broadcast(sample), "__id")
    rows = cut(described(ids, "__domain"))
    n = [0] * len(DOMAINS)
    for r in rows.groupBy("__domain").count().collect():
        n[r["__domain"]] = r["count"]
    bins = {(s, b): [1.0] * len(DOMAINS) for s, name in enumerate(BINS) for b in range(len(BINS[name]) + 1)}
    for r in rows.select("__domain", F.posexplode("__bins").alias("s", "b")).groupBy("__domain", "s", "b").count().collect():
        bins[r["s"], r["b"]][r["__domain"]] += r["count"]
    bins = {(s, b): [math.log(v[k] / (n[k] + len(BINS[list(BINS)[s]]) + 1)) for k in range(len(DOMAINS))] for (s, b), v in bins.items()}
    found: dict[str, list[float]] = {}
    by_word = rows.select("__domain", F.explode("__words").alias("w")).groupBy("w").agg(*(F.count_if(F.col("__domain") == k).alias(f"c{k}") for k in range(len(DOMAINS))))
    by_word = cut(by_word.filter(sum(F.col(f"c{k}") for k in range(len(DOMAINS))) >= support))
    whole = sum(n)
    for k in range(len(DOMAINS)):
        own = (F.col(f"c{k}") + 0.5) / (n[k] + 1.0)
        rest = (sum(F.col(f"c{j}") for j in range(len(DOMAINS)) if j != k) + 0.5) / (whole - n[k] + 1.0)
        for r in by_word.filter(own > ratio * rest).orderBy(F.desc(own * F.log(own / rest)), "w").limit(words).collect():
            found[r["w"]] = [(r[f"c{j}"] + 0.5) / (n[j] + 1.0) for j in range(len(DOMAINS))]
    prior = [math.log((c + 1) / (whole + len(DOMAINS))) + sum(math.log(1 - v[k]) for v in found.values()) for k, c in enumerate(n)]
    return Classifier(prior, bins, {w: [math.log(x / (1 - x)) for x in v] for w, v in found.items()})


def _with_posteriors(docs: DataFrame, model: Classifier, *keep: str) -> DataFrame:
    """keep, __tokens, __p0 ... and __number of every row."""
    rows = described(docs, *keep).select(*keep, "__tokens", model.logs().alias("__logs"))
    rows = rows.select(*keep, "__tokens", "__logs", F.array_max("__logs").alias("__max"))
    rows = rows.select(*keep, "__tokens", F.transform("__logs", lambda x: F.exp(x - F.col("__max"))).alias("__e"))
    rows = rows.select(*keep, "__tokens", "__e", F.aggregate("__e", F.lit(0.0), lambda s, x: s + x).alias("__sum"))
    # the row number is not deterministic for the optimiser: later filters stay above and do not repeat all this
    return rows.select(*keep, "__tokens", *((F.element_at("__e", k + 1) / F.col("__sum")).alias(f"__p{k}") for k in range(len(DOMAINS))), F.monotonically_increasing_id().alias("__number"))


@dataclass
class Steps:
    """Solution of the least-squares problem: the gradient sums of each step, from which any document's rate follows."""

    gradients: list[list[float]]
    totals: list[float]  # expected tokens of each domain at the end
    targets: list[float]

    def rate(self) -> Column:
        out = F.lit(1.0)
        for g in self.gradients:
            out = F.greatest(F.lit(0.0), out - sum(F.col(f"__p{k}") * F.lit(x) for k, x in enumerate(g)))
        return out


def solve(rows: DataFrame, weights: Mapping[str, float], *, total_tokens: float | None = None, max_steps: int = 30, tolerance: float = 1e-4) -> Steps:
    """rows: __tokens and __p0 ...; one aggregation for each step."""
    share = [float(weights.get(name, 0.0)) for name in DOMAINS]
    share = [x / (sum(share) or 1.0) for x in share]
    steps = Steps([], [], [])

    def sums() -> list[float]:
        r = rows.agg(*(F.sum(steps.rate() * F.col("__tokens") * F.col(f"__p{k}")).alias(f"s{k}") for k in range(len(DOMAINS)))).first()
        return [float(x or 0.0) for x in r]

    mass = steps.totals = sums()
    main = max(range(len(share)), key=lambda k: share[k])
    total = total_tokens if total_tokens is not None else mass[main] / share[main] if share[main] else 0.0
    steps.targets = [x * total for x in share]
    apart = lambda a, b: max(abs(x - y) for x, y in zip(a, b, strict=True))
    before: list[float] = []
    while len(steps.gradients) < max_steps and apart(steps.totals, steps.targets) > tolerance * max(total, 1.0):
        if before and apart(before, steps.totals) < 0.1 * tolerance * max(total, 1.0):
            break  # the targets cannot be met more closely
        before = steps.totals
        steps.gradients.append([(s - t) / m if m > 0 else 0.0 for s, t, m in zip(steps.totals, steps.targets, mass, strict=True)])
        steps.totals = sums()
    return steps


def _copies(rate: Column, seed: int) -> Column:
    chance = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(2**20)) / F.lit(float(2**20))
    return F.floor(rate + chance).cast("int")


def rates(docs: DataFrame, labels: DataFrame, *, weights: Mapping[str, float] = WEIGHTS, total_tokens: float | None = None, seed: int = 5, **options) -> DataFrame:
    """doc_id, tokens, p_<domain> ..., rate and copies of every row of docs."""
    model = fit(docs, labels, **options)
    rows = cut(_with_posteriors(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, "doc_id"))
    steps = solve(rows, weights, total_tokens=total_tokens)
    rated = rows.withColumn("rate", steps.rate())
    return rated.select("doc_id", F.col("__tokens").alias("tokens"), *(F.col(f"__p{k}").alias(f"p_{name}") for k, name in enumerate(DOMAINS)), "rate", _copies(F.col("rate"), seed).alias("copies"))


def mix(docs: DataFrame, labels: DataFrame, *, weights: Mapping[str, float] = WEIGHTS, total_tokens: float | None = None, seed: int = 5, **options) -> DataFrame:
    """docs with every row as many times as its rate says; all columns of docs and no others.

    Rows are written with their posteriors, so that texts are taken apart once.
    """
    model = fit(docs, labels, **options)
    own = F.struct(*(F.col(c) for c in docs.columns)).alias("__row")
    rows = cut(_with_posteriors(docs.select(own, F.col("doc_id").cast("long").alias("doc_id"), "text"), model, "__row", "doc_id"))
    steps = solve(rows, weights, total_tokens=total_tokens)
    taken = rows.withColumn("__n", _copies(steps.rate(), seed)).filter("__n > 0")
    return taken.select("__row", F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("__k")).select("__row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return rates(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
