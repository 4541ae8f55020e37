"""Mixing to target weights with soft domain membership.

A classifier fitted on a labelled table gives every document a posterior over the domains. Rates r >= 0, the expected
copies of a document, are found by projected-gradient least squares: for each domain the expected tokens
sum(tokens * posterior * rate) shall equal the target's share of the budget. Errors are weighed by the domain's own
tokens and steps are taken in the metric of tokens, so that a step of 1 is safe and a document's rate depends on its
posterior and the past gradients only: a rate is a short arithmetic expression, each iteration is one distributed
sum, and only a number per domain reaches the driver. Starting from 1, rates change as little as they need to.
"""

from __future__ import annotations

import warnings
from functools import reduce
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF, IDFModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlake.llm.shared import stored, sweep, unused, word_array

DOMAINS = ("clean", "low_quality", "toxic")
#: Target share of tokens by domain, and the most copies of a document.
TARGETS = {"clean": 0.92, "low_quality": 0.04, "toxic": 0.04}
#: The classifier is fitted on at most so many labelled documents, those with the least hash of their id.
MAX_LABELLED = 8000
FEATURES = 1 << 15
#: The descent ends when every error is below TOLERANCE of its domain's tokens, when no error moves by more than STILL
#: in a step (targets that rates of at most 1 can't meet are neared ever more slowly: STILL_WHOLE for these), or after
#: ITERATIONS; what is left is in the Fit, and a descent that did not end by itself warns.
ITERATIONS, TOLERANCE, STILL, STILL_WHOLE = 60, 1e-6, 1e-7, 1e-4


class Classifier(NamedTuple):
    idf: IDFModel | None
    model: LogisticRegressionModel | None
    classes: list[int]


class Fit(NamedTuple):
    """rate: over (n_tokens, p_<domain>). By domain: the expected tokens wanted and reached, and the error as a share of
    the domain's tokens (0 for an upper bound that is kept)."""

    rate: Column
    wanted: dict[str, float]
    reached: dict[str, float]
    residual: dict[str, float]
    iterations: int
    converged: bool


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain): the index in DOMAINS by (quality, toxic); of several labels of a document toxic wins, then
    low quality. Labels without a doc_id, or without both values known, are left out."""
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 0)
    return known.select("doc_id", domain.alias("domain")).filter("domain IS NOT NULL")


def _features(docs: DataFrame) -> DataFrame:
    words = docs.withColumn("_words", F.expr(word_array()))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="_words", outputCol="_tf").transform(words)


def _weighted(rows: DataFrame, idf: IDFModel) -> DataFrame:
    return Normalizer(inputCol="_idf", outputCol="features").transform(idf.transform(rows))


def fit_domains(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Classifier:
    """A logistic regression over hashed words. Without labelled documents, or with one class only, no model."""
    sweep(docs.sparkSession)
    chosen = label_domains(labels).orderBy(F.xxhash64(F.lit("domain"), "doc_id"), "doc_id").limit(max_labelled)
    rows = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "labelled")
    classes = sorted(r["domain"] for r in rows.select("domain").distinct().collect())
    if len(classes) < 2:
        return Classifier(None, None, classes)
    tf = _features(rows)
    idf = IDF(inputCol="_tf", outputCol="_idf", minDocFreq=2).fit(tf)
    model = LogisticRegression(labelCol="domain", family="multinomial", regParam=1e-3, maxIter=40).fit(_weighted(tf, idf).select("domain", "features"))
    sweep(docs.sparkSession)  # each step of the fit leaves a broadcast of all weights on the driver
    return Classifier(idf, model, classes)


def posteriors(docs: DataFrame, fitted: Classifier) -> DataFrame:
    """``docs`` with n_tokens (words) and p_<domain>. Without a model: the only class, or even shares without any."""
    k = len(DOMAINS)
    if fitted.model is None:
        only = fitted.classes[0] if fitted.classes else None
        rows = docs.withColumn("n_tokens", F.size(F.expr(word_array())).cast("long"))
        return rows.select("*", *[F.lit(1.0 / k if only is None else float(i == only)).alias(f"p_{d}") for i, d in enumerate(DOMAINS)])
    scored = fitted.model.transform(_weighted(_features(docs), fitted.idf))
    scored = scored.withColumn("_p", vector_to_array("probability")).withColumn("n_tokens", F.size("_words").cast("long"))
    n = fitted.model.numClasses
    share = [F.col("_p")[i] if i < n else F.lit(0.0) for i in range(k)]
    return scored.select(*docs.columns, "n_tokens", *[p.alias(f"p_{d}") for p, d in zip(share, DOMAINS, strict=True)])


def _rate(history: list[list[float]], max_rate: float | None) -> Column:
    rate = F.lit(1.0)
    for g in history:
        rate = F.greatest(F.lit(0.0), rate - reduce(lambda a, b: a + b, [F.col(f"p_{d}") * F.lit(x) for d, x in zip(DOMAINS, g, strict=True)]))
        if max_rate is not None:
            rate = F.least(F.lit(float(max_rate)), rate)
    return rate


def fit_rates(
    rows: DataFrame, targets: dict[str, float] = TARGETS, budget: float | None = None, max_rate: float | None = None, whole: str | None = None
) -> Fit:
    """The rates, and what they reach.

    budget: tokens wanted in all; default as many as there are. Domains without tokens can't be met and are left
    out. whole: a domain whose target is met; those of the others are upper bounds, by which nothing is wanted of
    what is scarce. rows is read once per iteration: pass a stored table.
    """
    names = [f"p_{d}" for d in DOMAINS]

    def totals(history: list[list[float]]) -> list[float]:
        r = _rate(history, max_rate)
        found = rows.agg(*[F.sum(F.col(n) * F.col("n_tokens") * r).alias(n) for n in names]).head()
        return [float(found[n] or 0.0) for n in names]

    have = totals([])
    budget = sum(have) if budget is None else budget
    want = [targets.get(d, 0.0) / (sum(targets.values()) or 1.0) * budget for d in DOMAINS]
    history: list[list[float]] = []
    now, past, ended = have, None, False
    while True:
        error = [(n - w) / h if h > 0 else 0.0 for n, w, h in zip(now, want, have, strict=True)]
        if whole is not None:
            error = [e if d == whole else max(e, 0.0) for d, e in zip(DOMAINS, error, strict=True)]
        moved = max(abs(a - b) for a, b in zip(error, past, strict=True)) if past else float("inf")
        ended = max(map(abs, error)) < TOLERANCE or moved < (STILL if whole is None else STILL_WHOLE)
        if ended or len(history) == ITERATIONS:
            break
        history.append(error)
        now, past = totals(history), error
    wanted, reached, residual = (dict(zip(DOMAINS, x, strict=True)) for x in (want, now, error))
    if not ended:
        warnings.warn(f"mixing rates after {ITERATIONS} iterations: errors by domain {residual}", stacklevel=2)
    return Fit(_rate(history, max_rate), wanted, reached, residual, len(history), ended)


def fitted_mixture(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, repeat: bool = True) -> tuple[DataFrame, Fit | None]:
    """One row per document: (doc_id, row, n_tokens, p_<domain>.., rate, copies); and the fit (None without any tokens
    of the domain that is to stay whole).

    repeat: the budget is the tokens there are, and scarce domains are repeated. Else no document is repeated
    (rates stay at 1 or below): the domain of the largest target is to be kept whole, which gives the budget, and the
    other targets are upper bounds, so that little of a domain takes nothing from the others. copies is the rate rounded up or
    down by a hash of id and text, so its expectation is the rate. Null texts have no tokens; rows that repeat id
    and text get the same values. row is a hash of both.
    """
    scored = posteriors(docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row")), fit_domains(docs, labels)).drop("text")
    rows, fit = stored(scored, "posteriors"), None
    if repeat:
        fit = fit_rates(rows, targets)
    else:
        whole = max(targets, key=lambda d: targets[d])
        have = rows.agg(F.sum(F.col(f"p_{whole}") * F.col("n_tokens"))).head()[0]
        if have:
            fit = fit_rates(rows, targets, have / targets[whole] * sum(targets.values()), 1.0, whole)
    draw = F.pmod(F.xxhash64(F.lit("mix"), "row"), F.lit(1 << 30)) / float(1 << 30)
    rated = rows.withColumn("rate", fit.rate if fit else F.lit(1.0))
    return rated.withColumn("copies", (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("long")).cast("long")), fit


def mixture(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, repeat: bool = True) -> DataFrame:
    """The rows of fitted_mixture."""
    return fitted_mixture(docs, labels, targets, repeat)[0]


def mixed_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, repeat: bool = True) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say, all columns."""
    row, key, times, copy = unused(docs, "row", "key", "times", "copy")
    copies = mixture(docs, labels, targets, repeat).groupBy(F.col("row").alias(key)).agg(F.max("copies").alias(times))
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    found = keyed.join(copies.filter(F.col(times) > 0), F.col(row) == F.col(key))
    if not repeat:
        return found.select(docs.columns)
    return found.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(docs.columns)


def op1_mixing(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return mixture(docs, labels).drop("row")
