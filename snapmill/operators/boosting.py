"""Gradient boosting for several classes: one tree per class and round, coupled by the softmax.

Columns are binned once by quantiles, a byte each, and written with label, weight and margins in blocks of
rows, so that a task handles a few byte strings a block and no object per row. Every level of a round is one
scan, all classes at once: a task walks its rows down to the smaller child of every split and sums gradients and
curvatures per class, node, column and bin; the sums of the other child are the parent's less these, and the last
level's follow from its parents' splits without a scan. Columns of jointly few bins are counted as one and summed
apart per task. All sums are of integers, so they are exact however rows are dealt. Partial sums meet in one
aggregation whose result has no more rows than classes x nodes x columns x bins. The driver reads the best splits
from it. Margins are written anew every REFRESH rounds; in between tasks add the few trees since. Rows never leave
the tasks.
"""

from __future__ import annotations

import json
import math
from collections import namedtuple
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.operators.compiled import CompiledModel, Node
from snapmill.runtime import collect_bounded, materialize

REFRESH = 2
# rows of a block
BLOCK = 16384
# gradients and curvatures are multiples of 2 ** -UNIT_BITS, or of less where weights are large
UNIT_BITS = 30
# columns are counted together up to this many joint bins
JOINT_BINS = 1024
HESSIAN_FLOOR = 1e-3

_BLOCK_SCHEMA = "N int, B binary, Y binary, W binary, M binary, U binary"
_Block = namedtuple("_Block", "N B Y W M U")


@dataclass(frozen=True)
class SoftmaxBoosting:
    """An estimator over a vector column, with the parameter names of the boosted trees for two classes."""

    n_classes: int
    maxIter: int = 100
    stepSize: float = 0.1
    maxDepth: int = 5
    minInstancesPerNode: int = 20
    minInfoGain: float = 0.0
    subsamplingRate: float = 1.0
    regParam: float = 1.0
    maxBins: int = 32
    seed: int = 0
    features: str = "V"
    label: str = "Y"
    weight: str = "W"

    def getParam(self, name: str) -> str:
        if name not in self.__dataclass_fields__:
            raise AttributeError(name)
        return name

    def copy(self, params: dict | None = None) -> SoftmaxBoosting:
        return replace(self, **(params or {}))

    def fit(self, data: DataFrame) -> SoftmaxBoostingModel:
        """Fit on rows of (vector, label 0 to n_classes - 1, weight)."""
        if self.n_classes < 2 or not 2 <= self.maxBins <= 256:
            raise ValueError("needs at least two classes and 2 to 256 bins")
        x = data.select(vector_to_array(self.features).alias("X"), F.col(self.label).cast("int").alias("Y"), F.col(self.weight).cast("double").alias("W"))
        x = x.where("Y is not null")
        first = x.first()
        if first is None:
            raise ValueError("no rows to fit on")
        width = len(first.X)
        edges = self._edges(x, width)
        prior, heaviest = np.zeros(self.n_classes), 0.0
        for r in collect_bounded(x.groupBy("Y").agg(F.sum("W").alias("W"), F.max("W").alias("TOP")), self.n_classes, "classes"):
            prior[r.Y] = r.W
            heaviest = max(heaviest, r.TOP or 0.0)
        start = np.log(np.maximum(prior, 1e-12) / max(prior.sum(), 1e-12))
        unit = _unit(float(prior.sum()), heaviest)
        table = self._binned(x, edges, start)
        trees: list[list[_Tree]] = []
        fresh = 0
        for n in range(self.maxIter):
            grown = self._round(table, trees[fresh:], edges, n, unit)
            if not any(t.feature[0] >= 0 for t in grown):
                break
            trees.append(grown)
            if len(trees) - fresh == REFRESH and n + 1 < self.maxIter:
                table = self._refreshed(table, trees[fresh:])
                fresh = len(trees)
        gains = np.zeros(width)
        for t in (t for r in trees for t in r):
            for f, g in zip(t.feature, t.gain, strict=True):
                if f >= 0:
                    gains[f] += g
        nodes = [[t.node(0, edges) for t in r] for r in trees]
        return SoftmaxBoostingModel(self.n_classes, start.tolist(), nodes, (gains / gains.sum() if gains.sum() else gains).tolist(), self.features)

    def _edges(self, x: DataFrame, width: int) -> list[np.ndarray]:
        """Upper ends of the bins of each column but the last; few values have a bin each."""
        probs = [i / self.maxBins for i in range(1, self.maxBins)]
        row = x.agg(*[F.percentile_approx(F.col("X")[i], probs, 10_000).alias(f"q{i}") for i in range(width)],
                    *[F.max(F.col("X")[i]).alias(f"m{i}") for i in range(width)]).first()
        return [np.array([v for v in sorted(set(row[f"q{i}"])) if v < row[f"m{i}"]]) for i in range(width)]

    def _binned(self, x: DataFrame, edges: list[np.ndarray], start: np.ndarray) -> DataFrame:
        """Blocks of rows: N rows, bins by column, labels, weights, margins by class and draws as bytes.

        Weights that are all equal are written once, as are the margins of the start.
        """
        share, seed, label = self.subsamplingRate, self.seed, _label_type(self.n_classes)

        def packed(parts: list[tuple]) -> pa.RecordBatch:
            codes, y, w, u = (np.concatenate([p[i] for p in parts], axis=-1) for i in range(4))
            if (w == w[0]).all():
                w = w[:1]
            row = (codes.shape[1], codes.tobytes(), y.tobytes(), w.tobytes(), start.astype(np.float64).tobytes(),
                   u.tobytes() if share < 1.0 else b"")
            return _block_batch(_Block(*row))

        def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n = [], 0
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(at, BLOCK)
                    v = np.asarray(part.column("X").flatten()).reshape(part.num_rows, -1)
                    codes = np.stack([_codes(np.ascontiguousarray(v[:, i]), e) for i, e in enumerate(edges)])
                    if held and n + part.num_rows > BLOCK:
                        yield packed(held)
                        held, n = [], 0
                    held.append((codes, np.asarray(part.column("Y")).astype(label), np.asarray(part.column("W")).astype(np.float64),
                                 np.asarray(part.column("U")).astype(np.int64)))
                    n += part.num_rows
            if held:
                yield packed(held)

        # the row's draw is a hash of its values, so repeated tasks agree
        drawn = x.withColumn("U", F.xxhash64(F.lit(seed), "X", "Y")) if share < 1.0 else x.withColumn("U", F.lit(0).cast("long"))
        return materialize(drawn.select("X", "Y", "W", "U").mapInArrow(bins, _BLOCK_SCHEMA))

    def _state(self, block, since: list[list[_Tree]]) -> tuple[np.ndarray, np.ndarray]:
        """Bins (column, row) and margins (class, row) of a block."""
        b = np.frombuffer(block.B, np.uint8).reshape(-1, block.N)
        m = np.broadcast_to(np.frombuffer(block.M, np.float64).reshape(self.n_classes, -1), (self.n_classes, block.N)).copy()
        for r in since:
            for k, t in enumerate(r):
                m[k] += t.values(b)
        return b, m

    def _refreshed(self, table: DataFrame, since: list[list[_Tree]]) -> DataFrame:
        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches):
                yield _block_batch(block._replace(M=self._state(block, since)[1].tobytes()))

        return materialize(table.mapInArrow(move, _BLOCK_SCHEMA))

    def _round(self, table: DataFrame, since: list[list[_Tree]], edges: list[np.ndarray], n: int, unit: float) -> list[_Tree]:
        """One tree per class on the gradients of the margins so far."""
        trees = [_Tree() for _ in range(self.n_classes)]
        for depth in range(self.maxDepth + 1):
            open_nodes = [(k, i) for k, t in enumerate(trees) for i in t.open]
            if not open_nodes:
                break
            last = depth == self.maxDepth
            if not last or depth == 0:
                self._count(table, since, edges, n, unit, trees)
            for k, i in open_nodes:
                self._split(trees[k], i, unit, last)
        for t in trees:
            t.grids, t.totals = {}, {}
        return trees

    def _count(self, table: DataFrame, since: list[list[_Tree]], edges: list[np.ndarray], n: int, unit: float, trees: list[_Tree]) -> None:
        """Give the open nodes of all trees their sums (gradient, curvature, rows) per column and bin, in one scan."""
        k_all, width, bins = self.n_classes, len(edges), self.maxBins
        threshold, modulus = int(self.subsamplingRate * 1_000_000), 1_000_000
        # nodes too small for a split need no sums, unless a sibling's are taken from theirs
        wanted = [t.to_scan(2 * self.minInstancesPerNode) for t in trees]
        first = np.cumsum([0, *(len(w) for w in wanted)]).tolist()
        if not first[-1]:
            return
        sizes = [len(e) + 1 for e in edges]
        groups = _grouped(sizes, JOINT_BINS)
        joint = [math.prod(sizes[i] for i in g) for g in groups]

        def add(total: list[list[np.ndarray]], block) -> None:
            b, m = self._state(block, since)
            y, w = np.frombuffer(block.Y, _label_type(k_all)), np.frombuffer(block.W, np.float64)
            taken = None
            if threshold < modulus:
                taken = (np.frombuffer(block.U, np.int64) ^ (n * 0x9E3779B1)) % modulus < threshold
            m -= m.max(axis=0)
            p = np.exp(m, out=m)
            p /= p.sum(axis=0)
            codes = []
            for g in groups:
                code = b[g[0]].astype(np.uint32)
                for i in g[1:]:
                    code = code * np.uint32(sizes[i]) + b[i]
                codes.append(code)
            for k, t in enumerate(trees):
                if not wanted[k]:
                    continue
                found = t.reach(b, wanted[k], taken)
                rows = np.concatenate(found) if found[0] is not None else None
                if rows is not None and not len(rows):
                    continue
                pk, yk, wk = (p[k], y, w) if rows is None else (p[k][rows], y[rows], w if len(w) == 1 else w[rows])
                slot = None if len(found) == 1 else np.repeat(np.arange(len(found)), [len(f) for f in found])
                grad = np.rint(wk * (pk - (yk == k)) * unit)
                curve = np.rint(wk * pk * (1 - pk) * (k_all / (k_all - 1)) * unit)
                for size, code, sums in zip(joint, codes, total[k], strict=True):
                    cell = code.astype(np.int64) if rows is None else code[rows].astype(np.int64)
                    if slot is not None:
                        cell += slot * size
                    for s, weight in enumerate((grad, curve, None)):
                        # a block's sums are integers below 2 ** 53
                        sums[s] += np.bincount(cell, weight, sums.shape[1]).astype(np.int64, copy=False)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [[np.zeros((3, len(w) * size), np.int64) for size in joint] for w in wanted]
            for block in _blocks(batches):
                add(total, block)
            grid = np.zeros((3, width, first[-1], bins), np.int64)
            for k, w in enumerate(wanted):
                for g, part in zip(groups, total[k], strict=True):
                    cube = part.reshape(3, len(w), *[sizes[i] for i in g])
                    for axis, i in enumerate(g):
                        others = tuple(2 + a for a in range(len(g)) if a != axis)
                        grid[:, i, first[k]:first[k + 1], :sizes[i]] = cube.sum(axis=others)
            grid = grid.reshape(3, -1)
            at = np.flatnonzero(grid[2])
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *(pa.array(v[at], pa.int64()) for v in grid)], ["C", "G", "H", "N"])

        found = (table.mapInArrow(sums, "C bigint, G bigint, H bigint, N bigint").groupBy("C")
                 .agg(F.sum("G").alias("G"), F.sum("H").alias("H"), F.sum("N").alias("N")))
        grid = np.zeros((3, width * first[-1] * bins), np.int64)
        for r in collect_bounded(found, grid.shape[1], "histogram cells"):
            grid[:, r.C] = r.G, r.H, r.N
        grid = grid.reshape(3, width, first[-1], bins)
        for k, t in enumerate(trees):
            for s, i in enumerate(wanted[k]):
                t.give(i, grid[:, :, first[k] + s])

    def _split(self, tree: _Tree, node: int, unit: float, last: bool) -> None:
        grid = tree.grids.pop(node, None)
        total = tree.totals[node] if grid is None else grid[:, 0].sum(axis=1)
        scale = np.array([unit, unit, 1.0])
        g, h, n = total / scale
        tree.close(node, -self.stepSize * g / (h + self.regParam) if h > 0 else 0.0)
        if last or grid is None:
            return
        below = np.cumsum(grid, axis=2)[:, :, :-1]
        left, right = below / scale[:, None, None], (total[:, None, None] - below) / scale[:, None, None]
        fits = ((left[2] >= self.minInstancesPerNode) & (right[2] >= self.minInstancesPerNode)
                & (left[1] >= HESSIAN_FLOOR) & (right[1] >= HESSIAN_FLOOR))
        gain = left[0] ** 2 / (left[1] + self.regParam) + right[0] ** 2 / (right[1] + self.regParam) - g * g / (h + self.regParam)
        gain = np.where(fits, gain, -np.inf)
        best = int(np.argmax(gain))
        if gain.flat[best] > max(self.minInfoGain, 1e-12):
            column, end = best // gain.shape[1], best % gain.shape[1]
            tree.split(node, column, end, float(gain.flat[best]))
            child = tree.left[node]
            tree.grids[node] = grid
            tree.totals[child], tree.totals[child + 1] = below[:, column, end], total - below[:, column, end]


def _unit(total: float, heaviest: float) -> float:
    """A power of two whose multiples hold all sums in 63 bits and a block's in 53."""
    bits = UNIT_BITS
    for weight, room in ((total, 61), (min(total, BLOCK * heaviest), 51)):
        if weight > 0:
            bits = min(bits, room - math.ceil(math.log2(weight)))
    return 2.0 ** bits


def _codes(v: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The bin of each value, as np.searchsorted from the left has it; one comparison an edge is faster for so few."""
    code = np.full(len(v), len(edges), np.uint8)
    for e in edges:
        code -= v <= e
    return code


def _label_type(n_classes: int):
    return np.uint8 if n_classes <= 256 else np.int32


def _grouped(sizes: list[int], limit: int) -> list[list[int]]:
    """Columns in groups of at most limit joint bins, a column of more alone."""
    groups: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        for g in groups:
            if math.prod(sizes[j] for j in g) * sizes[i] <= limit:
                g.append(i)
                break
        else:
            groups.append([i])
    return groups


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    """The rows of blocks, their bytes not copied."""
    for batch in batches:
        columns = [batch.column(c) for c in _Block._fields]
        for i in range(batch.num_rows):
            yield _Block(columns[0][i].as_py(), *(c[i].as_buffer() for c in columns[1:]))


def _block_batch(block: _Block) -> pa.RecordBatch:
    values = [v.to_pybytes() if isinstance(v, pa.Buffer) else v for v in block]
    return pa.RecordBatch.from_arrays([pa.array([values[0]], pa.int32()), *(pa.array([v], pa.binary()) for v in values[1:])], list(_Block._fields))


class _Tree:
    """A growing tree over bins: a node holds its column (-1: none), last left bin, left child and value.

    While it grows, grids holds sums per column and bin of open nodes and of parents of open nodes, totals the sums
    of a split's children.
    """

    def __init__(self) -> None:
        self.feature, self.bin, self.left, self.value, self.gain, self.open = [-1], [0], [0], [0.0], [0.0], [0]
        self.grids: dict[int, np.ndarray] = {}
        self.totals: dict[int, np.ndarray] = {}

    def __getstate__(self) -> dict:
        # tasks walk a tree and need no sums
        return {**self.__dict__, "grids": {}, "totals": {}}

    def close(self, node: int, value: float) -> None:
        self.open = [i for i in self.open if i != node]
        self.value[node] = value

    def split(self, node: int, feature: int, last_bin: int, gain: float) -> None:
        self.feature[node], self.bin[node], self.left[node], self.gain[node] = feature, last_bin, len(self.feature), gain
        for _ in range(2):
            self.open.append(len(self.feature))
            for column, v in ((self.feature, -1), (self.bin, 0), (self.left, 0), (self.value, 0.0), (self.gain, 0.0)):
                column.append(v)

    def parents(self) -> dict[int, int]:
        return {child: i for i, f in enumerate(self.feature) if f >= 0 for child in (self.left[i], self.left[i] + 1)}

    def to_scan(self, least: int) -> list[int]:
        """Open nodes whose rows are read: the root, or of a split with a child of least rows the smaller child."""
        if self.open == [0]:
            return [0]
        found = []
        for i in sorted({p for c, p in self.parents().items() if c in self.open}):
            sides = self.left[i], self.left[i] + 1
            if max(self.totals[s][2] for s in sides) >= least:
                found.append(min(sides, key=lambda s: (self.totals[s][2], s)))
        return found

    def give(self, node: int, grid: np.ndarray) -> None:
        """The sums of a scanned node; its sibling has the rest of the parent's."""
        self.grids[node] = grid
        if node:
            i = self.parents()[node]
            self.grids[2 * self.left[i] + 1 - node] = self.grids.pop(i) - grid

    def reach(self, b: np.ndarray, nodes: list[int], taken: np.ndarray | None = None) -> list[np.ndarray | None]:
        """The rows of the bins (column, row) that rest in each of the nodes; None for all rows."""
        up, path = self.parents(), set()
        for i in nodes:
            while i not in path:
                path.add(i)
                i = up.get(i, 0)
        rest = dict.fromkeys(nodes)
        todo = [(0, None if taken is None else np.flatnonzero(taken))]
        while todo:
            i, rows = todo.pop()
            if i in rest:
                rest[i] = rows
                continue
            column = b[self.feature[i]]
            right = (column if rows is None else column[rows]) > self.bin[i]
            for child, side in ((self.left[i], False), (self.left[i] + 1, True)):
                if child in path:
                    chosen = right if side else ~right
                    todo.append((child, np.flatnonzero(chosen) if rows is None else rows[chosen]))
        return [rest[i] for i in nodes]

    def place(self, b: np.ndarray) -> np.ndarray:
        """The node that every row of the bins (column, row) rests in."""
        at = np.zeros(b.shape[1], np.int64)
        todo = [(0, None)]
        while todo:
            i, rows = todo.pop()
            if self.feature[i] < 0:
                at[slice(None) if rows is None else rows] = i
                continue
            column = b[self.feature[i]]
            right = (column if rows is None else column[rows]) > self.bin[i]
            for child, side in ((self.left[i], ~right), (self.left[i] + 1, right)):
                chosen = np.flatnonzero(side) if rows is None else rows[side]
                if len(chosen):
                    todo.append((child, chosen))
        return at

    def values(self, b: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.place(b)]

    def node(self, i: int, edges: list[np.ndarray]) -> Node:
        if self.feature[i] < 0:
            return [float(self.value[i])]
        f, last = self.feature[i], self.bin[i]
        # a split behind a column's last edge sends all rows left
        threshold = float(edges[f][last]) if last < len(edges[f]) else float("1.7976931348623157e308")
        return [f, threshold, self.node(self.left[i], edges), self.node(self.left[i] + 1, edges)]


@dataclass
class SoftmaxBoostingModel:
    """Start margins and, per round, one tree per class; probabilities are the softmax of the margins."""

    numClasses: int
    start: list[float]
    rounds: list[list[Node]]
    importances: list[float] = field(default_factory=list)
    column: str = "V"

    @property
    def featureImportances(self):
        from pyspark.ml.linalg import DenseVector

        return DenseVector(self.importances)

    def compiled(self, features: list[str]) -> CompiledModel:
        def spread(node: Node, k: int) -> Node:
            if len(node) == 1:
                return [node[0] if i == k else 0.0 for i in range(self.numClasses)]
            return [node[0], node[1], spread(node[2], k), spread(node[3], k)]

        trees = [[float(v) for v in self.start], *(spread(t, k) for r in self.rounds for k, t in enumerate(r))]
        return CompiledModel("trees", "softmax", features, [], trees, [1.0] * len(trees))

    def probabilities(self, df: DataFrame, prefix: str) -> DataFrame:
        """df with one probability column per class."""
        names = [f"_F{i}" for i in range(len(self.importances))]
        # the vector is unpacked once, in a projection of its own
        unpacked = df.select("*", vector_to_array(self.column).alias("_X"))
        wide = unpacked.select(*df.columns, *[F.col("_X")[i].alias(n) for i, n in enumerate(names)])
        return self.compiled(names).score(wide, df.columns, prefix)

    def transform(self, df: DataFrame) -> DataFrame:
        """df with a probability vector and the class of the largest probability."""
        scored = self.probabilities(df, "_P")
        p = F.array(*[f"_P{i}" for i in range(self.numClasses)])
        return scored.select(*df.columns, array_to_vector(p).alias("probability"),
                             (F.array_position(p, F.array_max(p)) - 1).cast("double").alias("prediction"))

    def to_json(self) -> str:
        return json.dumps(self.__dict__)

    @classmethod
    def from_json(cls, text: str) -> SoftmaxBoostingModel:
        return cls(**json.loads(text))
