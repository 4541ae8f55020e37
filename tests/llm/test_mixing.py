"""Mixing: the rates against a projected gradient in numpy, targets, draws."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomlake.llm import mixing as M


def rows_of(spark, p, tokens):
    data = [(i, f"r{i}", int(t), *map(float, q)) for i, (q, t) in enumerate(zip(p, tokens, strict=True))]
    return spark.createDataFrame(data, "doc_id long, row string, n_tokens long, " + ", ".join(f"p_{d} double" for d in M.DOMAINS))


@pytest.mark.parametrize("cap", [None, 1.0])
def test_rates_meet_targets(spark, cap):
    rng = np.random.default_rng(5)
    p, tokens = rng.dirichlet([0.3, 0.3, 0.3], 400), rng.integers(1, 500, 400)
    targets = {"clean": 0.6, "low_quality": 0.3, "toxic": 0.1}
    have = (p * tokens[:, None]).sum(0)
    budget = None if cap is None else min(have / np.array(list(targets.values()))) * 0.7
    rows = rows_of(spark, p, tokens)
    fit = M.fit_rates(rows, targets, budget, cap)
    rate, now = fit.rate, fit.reached
    want = np.array(list(targets.values())) * (have.sum() if budget is None else budget)
    assert np.allclose(list(now.values()), want, rtol=0.01)
    r = np.array([x["r"] for x in rows.select("doc_id", rate.alias("r")).orderBy("doc_id").collect()])
    assert (r >= 0).all() and (cap is None or (r <= cap + 1e-9).all())
    assert np.allclose((p * (tokens * r)[:, None]).sum(0), want, rtol=0.01)
    mine = np.ones(400)  # the same iteration on arrays
    for _ in range(M.ITERATIONS):
        mine = np.maximum(0, mine - p @ (((p * (tokens * mine)[:, None]).sum(0) - want) / have))
        mine = mine if cap is None else np.minimum(cap, mine)
    assert np.allclose(r, mine, atol=0.02)


def corpus(n=240):
    rng = random.Random(1)
    words = {0: "calm river stone garden letter".split(), 1: "click win cheap buy now".split(), 2: "awful hate vile rage scum".split()}
    docs, labels = [], []
    for i in range(n):
        d = rng.choices((0, 1, 2), (6, 3, 1))[0]
        docs.append((i, " ".join(rng.choice(words[d]) for _ in range(rng.randint(5, 60)))))
        if i % 2:
            labels.append((i, 0 if d == 1 else 1, int(d == 2)))
    return docs, labels


def tables(spark, docs, labels):
    return (spark.createDataFrame([(d, t, 1.0, "x") for d, t in docs], "doc_id long, text string, rate double, domain string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_mixture_of_documents(spark):
    docs, labels = corpus()
    odd = [(1000, None), (1001, ""), (None, "calm river"), (1002, "calm " * 50_000), (5, docs[5][1])]
    d, lab = tables(spark, docs + odd, [*labels, (1, 0, 0), (None, 1, 0), (2000, 1, 0), (9, None, None)])
    got = M.mixture(d, lab).collect()
    assert len(got) == len(docs) + len(odd)
    for r in got:
        assert abs(r["p_clean"] + r["p_low_quality"] + r["p_toxic"] - 1) < 1e-6 and r["rate"] >= 0 and abs(r["copies"] - r["rate"]) < 1
    tokens = {x: sum(r[f"p_{x}"] * r["n_tokens"] * r["rate"] for r in got) for x in M.DOMAINS}
    for x, share in M.TARGETS.items():
        assert abs(tokens[x] / sum(tokens.values()) - share) < 0.01
    once = M.mixed_documents(d, lab, repeat=False)
    assert once.columns == ["doc_id", "text", "rate", "domain"]
    ids = [r["doc_id"] for r in once.collect()]
    assert max(ids.count(i) for i in set(ids)) <= 2  # 5 stands twice in the input
    many = M.mixed_documents(d, lab, {"toxic": 1.0})
    assert many.groupBy("doc_id").count().agg(F.max("count")).head()[0] > 1


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 1, 0), (2, 0, 0), (3, 1, 1)]])
def test_few_labels(spark, labels):
    d, lab = tables(spark, corpus(20)[0], labels)
    got = M.mixture(d, lab).collect()
    assert len(got) == 20 and all(r["rate"] >= 0 for r in got)
    assert M.mixture(d.filter("doc_id < 0"), lab).count() == 0


@pytest.mark.parametrize("share", [0.12, 0.01, 0.001, 0.0])
def test_scarce_domains_take_nothing_from_the_clean(spark, monkeypatch, share):
    """Posteriors that are soft, and sum to so little of toxic: clean documents stay, toxic ones up to their bound."""
    rng = np.random.default_rng(2)
    n, tokens = 4000, rng.integers(50, 150, 4000)
    p = np.full((n, 3), 1e-5)
    p[np.arange(n), rng.choice(3, n, p=[0.9 - share, 0.1, share])] = 1.0
    p /= p.sum(1, keepdims=True)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(n)], "doc_id long, text string")
    given = rows_of(spark, p, tokens).drop("row")
    monkeypatch.setattr(M, "fit_domains", lambda *a: None)
    monkeypatch.setattr(M, "posteriors", lambda d, fitted: d.join(given, "doc_id"))
    rows = M.mixture(docs, None, repeat=False).orderBy("doc_id").collect()
    r = np.array([x["rate"] for x in rows])
    assert (r >= 0).all() and (r <= 1).all()
    kept, have = (p * (tokens * r)[:, None]).sum(0), (p * tokens[:, None]).sum(0)
    assert kept[0] > 0.999 * have[0] and M.mixed_documents(docs, None, repeat=False).count() >= (p[:, 0] > 0.9).sum()
    bound = have[0] / 0.92 * 0.04
    assert kept[1] == pytest.approx(bound, rel=0.01) and kept[2] == pytest.approx(min(bound, have[2]), rel=0.01, abs=1)
