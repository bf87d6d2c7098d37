"""Mixing to target weights by soft domain membership (operator 3).

DataFrame and SQL functions only.

1. A multinomial naive Bayes classifier over hashed word endings is counted on a
   bounded sample of a labelled table (document, domain).
2. Every document gets domain posteriors from its whole text, row by row; the
   summed evidence is divided by the square root of its number of words, so
   membership stays soft.
3. Nonnegative rates, one for each document, are fitted by projected gradient
   least squares: the expected tokens of a domain, the sum of rate * tokens *
   posterior, shall equal its target.  A step moves each rate by the mean
   relative excess of its domains and cuts it at zero.  The state between steps
   is one number for each domain and step, so a pass is one aggregate over a
   narrow table and a rate is a fold over these numbers.
4. A document occurs floor(rate) times, and once more with the probability of
   the remainder, by a hash of its id and text.
"""

from __future__ import annotations

import json
import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navforge.llm.common import Scratch

BUCKETS = 4096
ENDING = 3
#: Bound of the labelled sample, in the order of a hash of the id.
SAMPLE = 20_000
STEPS = 40
TOLERANCE = 1e-4


def _words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), "\\s+"),
                    lambda w: w != "")


def _features(words: Column) -> Column:
    return F.transform(words, lambda w: F.pmod(
        F.xxhash64(F.right(w, F.lit(ENDING))), F.lit(BUCKETS).cast("long")).cast("int"))


def _constant(values: list[float]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "array<double>")


def _total(buckets: str, weights: Column) -> Column:
    return F.aggregate(buckets, F.lit(0.0), lambda s, b: s + weights[b])


def fit_domains(docs: DataFrame, labelled: DataFrame, domains: list[str]
                ) -> tuple[list[float], list[list[float]]]:
    """(log priors, log weights by domain and bucket) from ``labelled`` (doc_id,
    domain); labels outside ``domains`` and nulls are ignored."""
    known = labelled.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("domain").cast("string").alias("domain")) \
        .filter(F.col("domain").isin(domains) & F.col("doc_id").isNotNull())
    sample = known.orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id", "domain").limit(SAMPLE)
    # The sample's size is bounded above, so broadcasting it is safe.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").alias("text")).join(F.broadcast(sample), "doc_id")
    rows = (texts.select("domain", F.explode_outer(_features(_words(F.col("text")))).alias("b"))
            .groupBy("domain", "b").count().collect())  # at most domains * BUCKETS rows
    docs_of = {r["domain"]: r["n"] for r in texts.groupBy("domain").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    prior = [math.log((docs_of.get(d, 0) + 1) / (sum(docs_of.values()) + len(domains)))
             for d in domains]
    counts = {d: [0.5] * BUCKETS for d in domains}
    for r in rows:
        if r["b"] is not None:
            counts[r["domain"]][r["b"]] += r["count"]
    return prior, [[math.log(c / sum(counts[d])) for c in counts[d]] for d in domains]


def posteriors(docs: DataFrame, prior: list[float], weights: list[list[float]]) -> DataFrame:
    """``docs`` with ``__tokens`` (words) and ``__p`` (posterior of each domain; an
    empty or null text has the priors)."""
    df = docs.withColumn("__b", _features(_words(F.col("text"))))
    df = df.withColumn("__tokens", F.size("__b").cast("long"))
    evidence = [F.lit(prior[0])]
    for k in range(1, len(prior)):
        odds = _constant([a - b for a, b in zip(weights[k], weights[0])])
        evidence.append(F.lit(prior[k]) + _total("__b", odds)
                        / F.sqrt(F.greatest(F.col("__tokens"), F.lit(1))))
    df = df.withColumn("__z", F.array(*evidence)).drop("__b")
    df = df.withColumn("__e", F.transform("__z", lambda z: F.exp(z - F.array_max("__z"))))
    total = F.aggregate("__e", F.lit(0.0), lambda s, e: s + e)
    return df.withColumn("__p", F.transform("__e", lambda e: e / total)).drop("__z", "__e")


def _rate(history: list[list[float]], size: int) -> Column:
    """The rate after the steps of ``history`` (one move for each domain a step)."""
    if not history:
        return F.lit(1.0)
    steps = F.from_json(F.lit(json.dumps(history)), "array<array<double>>")
    p = [F.col("__p")[k] for k in range(size)]

    def step(rate: Column, move: Column) -> Column:
        return F.greatest(F.lit(0.0), rate - sum((p[k] * move[k] for k in range(1, size)),
                                                 p[0] * move[0]))
    return F.aggregate(steps, F.lit(1.0), step)


def fit_rates(scored: DataFrame, targets: list[float]) -> list[list[float]]:
    """Steps of the projected gradient; targets are shares of all tokens.  Targets that
    are still missed after STEPS steps, such as those of domains without tokens, give a
    warning with the largest difference."""
    size = len(targets)
    goal = [t / sum(targets) for t in targets]
    history: list[list[float]] = []
    first: list[float] | None = None
    for _ in range(STEPS):
        rate = _rate(history, size)
        row = scored.select("__tokens", "__p", rate.alias("__r")).agg(*[
            F.coalesce(F.sum(F.col("__r") * F.col("__tokens") * F.col("__p")[k]), F.lit(0.0))
            .alias(f"s{k}") for k in range(size)]).first()
        now = [float(row[k]) for k in range(size)]
        first = first or now
        total = sum(first)
        if not total:
            break
        excess = [(now[k] - goal[k] * total) for k in range(size)]
        if max(abs(e) for e in excess) <= TOLERANCE * total:
            break
        # Row sums of the Gram matrix of tokens * posteriors bound its eigenvalues.
        history.append([excess[k] / first[k] if first[k] > 0 else 0.0 for k in range(size)])
    else:
        warnings.warn(f"shares of tokens differ from the targets by up to "
                      f"{max(map(abs, excess)) / total:.2%} after {STEPS} steps", stacklevel=2)
    return history


def mix_to_targets(docs: DataFrame, labelled: DataFrame, targets: dict[str, float]) -> DataFrame:
    """``docs`` with n_tokens, p_<domain>, rate and copies (columns of these names are
    replaced).  Rows with equal id and text get equal copies; ids may be null."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    domains = list(targets)
    new = ["n_tokens", "rate", "copies", *(f"p_{d}" for d in domains)]
    docs = docs.drop(*new)
    prior, weights = fit_domains(docs, labelled, domains)
    scored = scratch.write(posteriors(docs, prior, weights), "scored")
    history = fit_rates(scored, [targets[d] for d in domains])
    unit = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64(F.col("text")), F.lit(5)),
                  F.lit(1 << 52)) / F.lit(float(1 << 52))
    rated = scored.withColumn("rate", _rate(history, len(domains)))
    copies = F.floor("rate") + (unit < F.col("rate") - F.floor("rate")).cast("int")
    return rated.select(
        *docs.columns, F.col("__tokens").alias("n_tokens"), "rate",
        copies.cast("long").alias("copies"),
        *(F.col("__p")[k].alias(f"p_{d}") for k, d in enumerate(domains)))
