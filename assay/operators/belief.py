"""Marginal probabilities of statements in a graph of pairwise relations, in place of an external solver.

Variables are true or false, with a prior. A relation between two of them, a source that entails, contradicts or equals a target
with probability p, is a factor over both: what the relation forbids weighs 1 - p, everything else p. The marginal of a variable
is its probability under the normalised product of all priors and factors.

Relations of one pair are multiplied to one factor first. Connected components of at most EXACT variables are summed out exactly,
one group of bounded size each. Larger ones pass messages: a factor tells each of its two variables, as log odds, what the other
one makes of it; a variable adds up what its factors say. One row a factor holds both messages. A round is two joins and one sum
over the factors, its rows are a table in the shared folder, and rounds end when no message moves by more than TOLERANCE. On
trees, among them every atom with contexts of its own, the result is exact; on graphs with cycles it is loopy belief propagation,
damped, and `residual` says how far the last round still moved a variable.

Defined results: a variable without relations keeps its prior, one that only relations name has prior 0.5; a prior or p is kept
EPS away from 0 and 1, null is 0.5; unknown kinds, null ends and relations of a variable with itself say nothing; variables that
are named twice have the greater prior.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialise, release

#: What each kind of relation forbids, as (source, target).
FORBIDDEN = {"entailment": ((1, 0),), "contradiction": ((1, 1),), "equivalence": ((0, 1), (1, 0))}
EXACT = 12
EPS = 1e-9
TOLERANCE, ROUNDS, DAMPING = 1e-9, 200, 0.3
STATES = ("00", "01", "10", "11")


def _certain(p: str) -> Column:
    return F.greatest(F.lit(EPS), F.least(F.lit(1 - EPS), F.coalesce(F.col(p).cast("double"), F.lit(0.5))))


def factors(relations: DataFrame) -> DataFrame:
    """(u, v, l00, l01, l10, l11): the log weight of each state of two variables, u before v, from (source, target, kind, p)."""
    known = relations.where(F.col("kind").isin(*FORBIDDEN) & (F.col("source") != F.col("target"))).withColumn("_p", _certain("p"))
    turned = F.col("source") > F.col("target")

    def weight(u: str, v: str) -> Column:
        against = F.lit(False)
        for kind, states in FORBIDDEN.items():
            for s, t in states:
                against = against | ((F.col("kind") == kind) & F.when(turned, F.lit((s, t) == (int(v), int(u)))).otherwise(F.lit((s, t) == (int(u), int(v)))))
        return F.log(F.when(against, 1 - F.col("_p")).otherwise(F.col("_p")))

    rows = known.select(F.least("source", "target").alias("u"), F.greatest("source", "target").alias("v"), *[weight(s[0], s[1]).alias(f"l{s}") for s in STATES])
    return rows.groupBy("u", "v").agg(*[F.sum(f"l{s}").alias(f"l{s}") for s in STATES])


def components(pairs: DataFrame) -> DataFrame:
    """(variable, component): the least variable reachable. Labels move to neighbours and then to their labels' labels."""
    spark = pairs.sparkSession
    both, p_both = materialise(pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))), "belief-edges")
    labels, path = materialise(both.groupBy(F.col("u").alias("variable")).agg(F.least(F.min("v"), F.first("u")).alias("component")), "belief-labels")
    while True:
        near = both.join(labels.select(F.col("variable").alias("v"), "component"), "v").groupBy(F.col("u").alias("variable")).agg(F.min("component").alias("near"))
        step = labels.join(near, "variable").select("variable", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        jump = step.select(F.col("variable").alias("component"), F.col("component").alias("further"))
        new, p_new = materialise(step.join(jump, "component", "left").select("variable", "was", F.least("component", F.coalesce("further", "component")).alias("component")), "belief-labels")
        release(spark, path)
        labels, path = new.select("variable", "component"), p_new
        if not new.where("was <> component").limit(1).count():
            release(spark, p_both)
            return labels


def _summed_out(group: pd.DataFrame) -> pd.DataFrame:
    """The marginals of one small component, over all of its states."""
    nodes, pairs = group[group["v"].isna()], group[group["v"].notna()]
    names = nodes["u"].tolist()
    place = {x: k for k, x in enumerate(names)}
    bits = (np.arange(1 << len(names))[:, None] >> np.arange(len(names))) & 1
    log = np.zeros(len(bits))
    for k, prior in enumerate(nodes["prior"]):
        log += np.where(bits[:, k], np.log(prior), np.log1p(-prior))
    for _, r in pairs.iterrows():
        table = np.array([r[f"l{s}"] for s in STATES])
        log += table[2 * bits[:, place[r["u"]]] + bits[:, place[r["v"]]]]
    weight = np.exp(log - log.max())
    return pd.DataFrame({"variable": names, "p_true": weight @ bits / weight.sum()})


def _messages(pairs: DataFrame, priors: DataFrame) -> DataFrame:
    """(variable, p_true, residual) by passing messages until they rest."""
    spark = pairs.sparkSession
    zero = F.lit(0.0)
    state, path = materialise(pairs.select("*", zero.alias("to_u"), zero.alias("to_v"), zero.alias("moved")), "belief-messages")
    odds = priors.select("variable", F.log(F.col("prior") / (1 - F.col("prior"))).alias("own"))

    def beliefs(rows: DataFrame) -> DataFrame:
        told = rows.select(F.col("u").alias("variable"), F.col("to_u").alias("said"), "moved").unionByName(rows.select(F.col("v").alias("variable"), F.col("to_v").alias("said"), "moved"))
        return odds.join(told.groupBy("variable").agg(F.sum("said").alias("_s"), F.max("moved").alias("residual")), "variable").select("variable", (F.col("own") + F.col("_s")).alias("odds"), "residual")

    def said(p: Column, f0: str, f1: str, t0: str, t1: str) -> Column:
        """Log odds that a factor gives its one end if the other is true with probability p: (f0, f1) makes it false, (t0, t1) true."""
        return F.log((F.exp(t0) * (1 - p) + F.exp(t1) * p) / (F.exp(f0) * (1 - p) + F.exp(f1) * p))

    sure = lambda x: 1 / (1 + F.exp(-x))
    for _ in range(ROUNDS):
        now = beliefs(state).drop("residual")
        met = state.join(now.select(F.col("variable").alias("u"), F.col("odds").alias("_u")), "u").join(now.select(F.col("variable").alias("v"), F.col("odds").alias("_v")), "v")
        to_v = said(sure(F.col("_u") - F.col("to_u")), "l00", "l10", "l01", "l11")
        to_u = said(sure(F.col("_v") - F.col("to_v")), "l00", "l01", "l10", "l11")
        damp = lambda new, old: new * (1 - DAMPING) + F.col(old) * DAMPING
        step = met.select("u", "v", *[f"l{s}" for s in STATES], "to_u", "to_v", damp(to_u, "to_u").alias("_nu"), damp(to_v, "to_v").alias("_nv"))
        moved = F.greatest(F.abs(F.col("_nu") - F.col("to_u")), F.abs(F.col("_nv") - F.col("to_v")))
        new, p_new = materialise(step.select("u", "v", *[f"l{s}" for s in STATES], F.col("_nu").alias("to_u"), F.col("_nv").alias("to_v"), moved.alias("moved")), "belief-messages")
        release(spark, path)
        state, path = new, p_new
        if (new.agg(F.max("moved")).first()[0] or 0.0) <= TOLERANCE:
            break
    out, _ = materialise(beliefs(state).select("variable", sure(F.col("odds")).alias("p_true"), "residual"), "belief-large")
    release(spark, path)
    return out


def marginals(variables: DataFrame, relations: DataFrame, exact: int = EXACT) -> DataFrame:
    """(variable, p_true, residual) of variables (variable, prior) under relations (source, target, kind, p)."""
    spark = variables.sparkSession
    pairs, _ = materialise(factors(relations), "belief-factors")
    named = pairs.select(F.explode(F.array("u", "v")).alias("variable")).distinct()
    priors, _ = materialise(variables.where("variable IS NOT NULL").select("variable", _certain("prior").alias("prior")).unionByName(named.withColumn("prior", F.lit(None).cast("double"))).groupBy("variable").agg(F.coalesce(F.max("prior"), F.lit(0.5)).alias("prior")), "belief-priors")
    labels = components(pairs)
    sizes = labels.groupBy("component").agg(F.count("*").alias("size"))
    placed, _ = materialise(labels.join(sizes, "component"), "belief-components")
    nodes = priors.join(placed, "variable")
    edges = pairs.join(placed.select(F.col("variable").alias("u"), "component", "size"), "u")

    alone = priors.join(placed.select("variable"), "variable", "left_anti").select("variable", F.col("prior").alias("p_true"), F.lit(0.0).alias("residual"))
    none = lambda kind: F.lit(None).cast(kind)
    kind = dict(priors.dtypes)["variable"]
    rows = nodes.where(F.col("size") <= exact).select("component", F.col("variable").alias("u"), none(kind).alias("v"), "prior", *[none("double").alias(f"l{s}") for s in STATES])
    rows = rows.unionByName(edges.where(F.col("size") <= exact).select("component", "u", "v", none("double").alias("prior"), *[f"l{s}" for s in STATES]))
    small = rows.groupBy("component").applyInPandas(_summed_out, f"variable {kind}, p_true double").withColumn("residual", F.lit(0.0))
    large = edges.where(F.col("size") > exact).drop("component", "size")
    out = alone.unionByName(small)
    if large.limit(1).count():
        out = out.unionByName(_messages(large, priors))
    return out
