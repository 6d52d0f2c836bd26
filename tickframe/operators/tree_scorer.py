"""A trained tree ensemble compiled to one column expression, and to the same expression as SQL text.

Scoring then runs inside the plan, without a model object or vectors: no row leaves the JVM, and any engine that
reads the text gives the same probabilities.  An ensemble is plain data (``to_dict``): per tree a weight and a nested
node, ``{"f": feature, "t": threshold, "l": node, "r": node}`` (left where the feature is at most the threshold) or
``{"v": value}``; the probability of class 1 is 1 / (1 + exp(-2 * sum of weighted values)), as of boosted trees with
logistic loss.

Defined cases: a row with a NULL or NaN feature has no probability (NULL), and ``signals.score`` skips it; an
ensemble without trees gives 0.5; a feature that the rows lack counts as 0, as in ``signals.align_features``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ensemble:
    features: list[str]
    weights: list[float]
    trees: list[dict]

    def to_dict(self) -> dict:
        return {"features": self.features, "weights": self.weights, "trees": self.trees}

    @classmethod
    def from_dict(cls, d: dict) -> Ensemble:
        return cls(list(d["features"]), [float(w) for w in d["weights"]], list(d["trees"]))


def from_model(model, features: list[str]) -> Ensemble:
    """The ensemble of a fitted gradient-boosted classifier, or of a pipeline that ends in one; continuous features."""
    gbt = model.stages[-1] if hasattr(model, "stages") else model
    return Ensemble(list(features), list(gbt.treeWeights), [_node(t._call_java("rootNode"), features) for t in gbt.trees])


def _node(node, features: list[str]) -> dict:
    if node.getClass().getSimpleName() == "LeafNode":
        return {"v": node.prediction()}
    split = node.split()
    return {"f": features[split.featureIndex()], "t": split.threshold(), "l": _node(node.leftChild(), features), "r": _node(node.rightChild(), features)}


def _case(node: dict, name: Callable[[str], str], num: Callable[[float], str]) -> str:
    if "v" in node:
        return num(node["v"])
    return f"CASE WHEN {name(node['f'])} <= {num(node['t'])} THEN {_case(node['l'], name, num)} ELSE {_case(node['r'], name, num)} END"


def probability(ensemble: Ensemble) -> Callable[[DataFrame], Column]:
    """A scorer for ``signals.score``."""
    def scorer(df: DataFrame) -> Column:
        have = set(df.columns)
        name = lambda f: f"`{f}`" if f in have else "0D"
        num = lambda v: f"{float(v)!r}D"
        terms = [f"{num(w)} * {_case(t, name, num)}" for w, t in zip(ensemble.weights, ensemble.trees)]
        margin = f"aggregate(array({', '.join(terms)}), 0D, (a, x) -> a + x)" if terms else "0D"
        given = [F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double")) for f in ensemble.features if f in have]
        known = F.lit(True)
        for g in given:
            known = known & g
        return F.when(known, F.expr(f"1D / (1D + exp(-2D * {margin}))"))
    return scorer


def probability_sql(ensemble: Ensemble) -> str:
    """The same as a standard SQL expression over the feature columns."""
    num = lambda v: f"CAST({float(v)!r} AS DOUBLE)"
    terms = [f"{num(w)} * {_case(t, lambda f: f, num)}" for w, t in zip(ensemble.weights, ensemble.trees)]
    known = " AND ".join(f"{f} IS NOT NULL" for f in ensemble.features)
    return f"CASE WHEN {known} THEN 1.0 / (1.0 + exp(-2.0 * ({' + '.join(terms) or '0.0'}))) END"
