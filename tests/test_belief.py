"""Marginals of relation graphs against summing out all states."""

from __future__ import annotations

import itertools
import random

import pytest

from assay.operators import belief


def plain(priors, relations):
    names = sorted({*priors, *(x for s, t, k, p in relations for x in (s, t) if x is not None and k in belief.FORBIDDEN and s != t and None not in (s, t))})
    total, true = 0.0, dict.fromkeys(names, 0.0)
    for bits in itertools.product((0, 1), repeat=len(names)):
        state = dict(zip(names, bits, strict=True))
        w = 1.0
        for n in names:
            p = priors.get(n) if priors.get(n) is not None else 0.5
            w *= p if state[n] else 1 - p
        for s, t, kind, p in relations:
            if None in (s, t) or s == t or kind not in belief.FORBIDDEN:
                continue
            p = 0.5 if p is None else p
            w *= 1 - p if (state[s], state[t]) in belief.FORBIDDEN[kind] else p
        total += w
        for n in names:
            true[n] += w * state[n]
    return {n: true[n] / total for n in names}


def run(spark, priors, relations, **how):
    v = spark.createDataFrame(list(priors.items()), "variable string, prior double")
    r = spark.createDataFrame(relations, "source string, target string, kind string, p double")
    return {x.variable: x for x in belief.marginals(v, r, **how).collect()}


def graph(rng, n, edges, tag=""):
    names = [f"{tag}v{i}" for i in range(n)]
    priors = {x: round(rng.uniform(0.1, 0.9), 3) for x in names}
    return priors, [(rng.choice(names), rng.choice(names), rng.choice([*belief.FORBIDDEN, "neutral"]), round(rng.uniform(0.2, 0.97), 3)) for _ in range(edges)]


def test_small_components_are_exact(spark):
    rng = random.Random(1)
    priors, relations = {}, []
    for k, (n, m) in enumerate([(12, 30), (5, 4), (2, 6), (7, 7), (1, 1)]):
        p, r = graph(rng, n, m, f"g{k}")
        priors |= p
        relations += r
    priors |= {"alone": 0.3, "unknown": None}
    relations += [("only_here", "alone", "entailment", 0.8), (None, "alone", "entailment", 0.9), ("alone", "g1v0", "contradiction", None)]
    got = run(spark, priors, relations)
    parts = {}
    for k in ("g0", "g2", "g3", "g4"):
        parts |= plain({n: p for n, p in priors.items() if n.startswith(k)}, [r for r in relations if str(r[0]).startswith(k)])
    parts |= plain({n: p for n, p in priors.items() if n.startswith("g1") or n == "alone"}, [r for r in relations if str(r[0]).startswith("g1") or r[0] in ("alone", "only_here", None)])
    parts["unknown"] = 0.5
    assert set(got) == set(parts)
    for n, p in parts.items():
        assert got[n].p_true == pytest.approx(p, abs=1e-9), n


def tree(rng, n):
    priors = {f"v{i}": round(rng.uniform(0.05, 0.95), 3) for i in range(n)}
    relations = [(*rng.sample([f"v{i}", f"v{rng.randrange(i)}"], 2), rng.choice([*belief.FORBIDDEN]), round(rng.uniform(0.2, 0.97), 3)) for i in range(1, n)]
    return priors, relations


def test_messages_are_exact_on_trees(spark):
    priors, relations = tree(random.Random(2), 13)
    got = run(spark, priors, relations, exact=1)
    for n, p in plain(priors, relations).items():
        assert got[n].p_true == pytest.approx(p, abs=1e-7)
        assert got[n].residual <= 1e-8


def test_messages_come_near_on_a_cycle(spark):
    priors, relations = tree(random.Random(3), 9)
    relations.append(("v0", "v8", "entailment", 0.7))
    got = run(spark, priors, relations, exact=1)
    for n, p in plain(priors, relations).items():
        assert got[n].p_true == pytest.approx(p, abs=0.05)


def test_no_relations_and_no_rows(spark):
    got = run(spark, {"a": 0.2, "b": 1.0}, [("a", "a", "entailment", 0.9)])
    assert got["a"].p_true == pytest.approx(0.2) and got["b"].p_true == pytest.approx(1.0)
    v = spark.createDataFrame([], "variable string, prior double")
    assert belief.marginals(v, spark.createDataFrame([], "source string, target string, kind string, p double")).count() == 0
