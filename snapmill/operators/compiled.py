"""Fitted models as column expressions: scoring is a projection, without a model in its plan.

A linear model becomes one sum per class, a tree nested conditions, an ensemble the sum over its trees. The
expressions are written as SQL text, which one parse turns into a column, and the same text in another
dialect checks them. Parameters are plain numbers, so a compiled model is stored as JSON.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Dialect:
    """How an engine writes names, doubles and the sum of a list."""

    name: Callable[[str], str]
    double: Callable[[float], str]
    total: Callable[[list[str]], str]


# an array's elements are generated code of their own methods, so a large ensemble stays below the size
# limit of a method
SPARK = Dialect(lambda c: "`" + c.replace("`", "``") + "`", lambda v: f"({float(v)!r}D)",
                lambda parts: f"aggregate(array({', '.join(parts)}), 0.0D, (a, v) -> a + v)" if len(parts) > 1 else parts[0])
DUCKDB = Dialect(lambda c: '"' + c.replace('"', '""') + '"', lambda v: f"cast({float(v)!r} AS DOUBLE)",
                 lambda parts: f"list_sum([{', '.join(parts)}])")

# margins of up to this many trees are plain sums
MAX_SUM = 64

# a node is [feature, threshold, left, right]; a leaf is [value, ...], one value per class or margin
Node = list


@dataclass
class CompiledModel:
    """kind linear: rows of (intercept, weights) per margin. kind trees: weighted trees whose leaves hold
    margins. link: logistic (of the margin), double_logistic (of twice the margin), softmax, or share (leaves
    hold class shares that are averaged)."""

    kind: str
    link: str
    features: list[str]
    rows: list[list[float]] = field(default_factory=list)
    trees: list[Node] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> CompiledModel:
        return cls(**json.loads(text))

    @property
    def n_classes(self) -> int:
        n = len(self.rows) if self.kind == "linear" else len(_first_leaf(self.trees[0]))
        return 2 if self.link in ("logistic", "double_logistic") else n

    def terms(self, dialect: Dialect = SPARK) -> list[list[str]]:
        """SQL texts that add up to each margin (or mean share)."""
        if self.kind == "linear":
            return [[" + ".join([dialect.double(row[0]), *(f"{dialect.double(w)} * {dialect.name(c)}"
                                                           for c, w in zip(self.features, row[1:], strict=True) if w)])]
                    for row in self.rows]
        # a tree that adds nothing to a margin, as one of another class, is left out of it
        return [[f"{dialect.double(w)} * ({self._tree(t, i, dialect)})" for t, w in zip(self.trees, self.weights, strict=True)
                 if _adds(t, i)] or [dialect.double(0.0)] for i in range(len(_first_leaf(self.trees[0])))]

    def margins(self, dialect: Dialect = SPARK) -> list[str]:
        """SQL text of each margin (or mean share)."""
        return [parts[0] if self.kind == "linear" else dialect.total(parts) for parts in self.terms(dialect)]

    def _tree(self, node: Node, i: int, dialect: Dialect) -> str:
        if not _inner(node):
            return dialect.double(node[i])
        feature, threshold, left, right = node
        return (f"CASE WHEN {dialect.name(self.features[feature])} <= {dialect.double(threshold)} "
                f"THEN {self._tree(left, i, dialect)} ELSE {self._tree(right, i, dialect)} END")

    def probabilities(self) -> list[Column]:
        """One column per class over the feature columns, which must be doubles without nulls."""
        m = [F.expr(text) for text in self.margins()]
        if self.link == "share":
            total = sum(m[1:], m[0])
            return [v / total for v in m]
        if self.link == "softmax":
            top = F.greatest(*m)
            e = [F.exp(v - top) for v in m]
            total = sum(e[1:], e[0])
            return [v / total for v in e]
        one = 1.0 / (1.0 + F.exp(-2.0 * m[0] if self.link == "double_logistic" else -m[0]))
        return [1.0 - one, one]

    def score(self, df: DataFrame, keep: Sequence[str], prefix: str = "PROB_CLS") -> DataFrame:
        """keep... and one probability per class. Margins are computed once per row.

        They come from a generator of one row: a filter on scores would otherwise be pushed below the projection
        with a copy of the whole ensemble for every mention of a margin. A generator is interpreted, and so is what
        goes into a higher-order function, so trees are projected below it. The small higher-order function beside
        them leaves that projection out of whole-stage code, whose one method would be too large to be compiled
        to machine code; apart, every tree has methods of its own.
        """
        terms = self.terms()
        names = [f"_M{i}" for i in range(len(terms))]
        # long sums are added from an array, as their method would again be too large
        long = len(terms[0]) > MAX_SUM if self.kind == "trees" else False
        zero = F.expr("transform(array(0.0D), z -> z)").alias("_ZERO")
        sums = [F.array(*[F.expr(t) for t in texts]) if long else F.expr(" + ".join(["0.0D", *texts])) for texts in terms]
        below = df.select(*keep, zero, *[c.alias(n) for n, c in zip(names, sums, strict=True)])
        margins = [F.expr(f"aggregate({n}, _ZERO[0], (a, v) -> a + v)" if long else f"{n} + _ZERO[0]").alias(n) for n in names]
        wide = below.select(*keep, F.inline(F.array(F.struct(*margins))))
        flat = CompiledModel("linear", self.link, names, [[0.0, *(1.0 if i == j else 0.0 for j in range(len(names)))] for i in range(len(names))])
        return wide.select(*keep, *[p.alias(f"{prefix}{i}") for i, p in enumerate(flat.probabilities())])


def _inner(node: Node) -> bool:
    return len(node) == 4 and isinstance(node[2], list)


def _first_leaf(node: Node) -> Node:
    return _first_leaf(node[2]) if _inner(node) else node


def _adds(node: Node, i: int) -> bool:
    return _adds(node[2], i) or _adds(node[3], i) if _inner(node) else node[i] != 0.0


def compile_model(model: Model, features: list[str]) -> CompiledModel:
    """A fitted linear model, forest or boosted ensemble of pyspark.ml; TypeError for another."""
    kind = type(model).__name__
    if kind == "LogisticRegressionModel":
        weights, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
        rows = [[float(b), *map(float, w)] for b, w in zip(intercepts, weights, strict=True)]
        return CompiledModel("linear", "logistic" if len(rows) == 1 else "softmax", features, rows)
    if kind == "LinearSVCModel":
        return CompiledModel("linear", "logistic", features, [[float(model.intercept), *map(float, model.coefficients.toArray())]])
    if kind == "GBTClassificationModel":
        trees = [_walk(t._call_java("rootNode"), lambda leaf: [float(leaf.prediction())]) for t in model.trees]
        return CompiledModel("trees", "double_logistic", features, [], trees, [float(w) for w in model.treeWeights])
    if kind == "RandomForestClassificationModel":
        trees = [_walk(t._call_java("rootNode"), _shares) for t in model.trees]
        return CompiledModel("trees", "share", features, [], trees, [1.0] * len(trees))
    if hasattr(model, "compiled"):
        return model.compiled(features)
    raise TypeError(f"{kind} has no expression")


def _shares(leaf) -> list[float]:
    counts = [float(v) for v in leaf.impurityStats().stats()]
    total = sum(counts)
    return [c / total if total else 0.0 for c in counts]


def _walk(node, leaf: Callable) -> Node:
    if node.subtreeDepth() == 0:
        return leaf(node)
    split = node.split()
    if split.getClass().getSimpleName() != "ContinuousSplit":
        raise TypeError("only splits of numbers have an expression")
    return [int(split.featureIndex()), float(split.threshold()), _walk(node.leftChild(), leaf), _walk(node.rightChild(), leaf)]
