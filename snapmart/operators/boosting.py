"""Gradient-boosted trees for many settings and folds at once, grown level by level from histograms.

All fits grow together: one pass over the rows per tree level gives, for every (fit, node, feature, bin), the sums of the
gradients and hessians, and the best split of every node is found from them. So a search costs as many passes as its
deepest fit has levels, whatever the number of fits. Tasks add up what they read in arrays, and only non-empty cells are
shuffled; the driver receives one row per fit and node. Predictions of all fits are carried beside the rows, in tables
of the work folder that are renewed every few rounds.

Gradients are added as whole multiples of 2^-30: sums do not depend on the order of rows, partitions or retries, so the same
seed gives the same trees, and ties between splits go to the first feature and bin.

A split's gain is score(left) + score(right) - score(node), with score = T(G)^2 / (H + l2), T(G) = G drawn towards 0 by l1;
a leaf's weight is -T(G) / (H + l2) times the step size. A node is split only if the gain exceeds ``minGain`` and both
sides have ``minHessian``. Each tree sees a share of the rows and a share of the features.
"""

import hashlib
import json
import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window, functions as F

from snapmart.operators.ranges import by_range, earlier_parts, within_part
from snapmart.session import materialize

DEFAULTS = {
    "maxIter": 50, "maxDepth": 3, "stepSize": 0.1, "subsamplingRate": 1.0, "columnShare": 1.0, "minGain": 0.0,
    "minHessian": 1.0, "l1": 0.0, "l2": 1.0,
}
#: Bins of a feature; cuts are quantiles of all rows.
BINS = 64
#: Cells (fit, node, feature, bin) that a task adds up at a time, 16 bytes each; more fits go in several passes.
CELLS = 1 << 24
#: Rounds after which the predictions are written anew.
RENEWED = 10
UNIT = float(1 << 30)
_PRIME = (1 << 31) - 1
#: Rows that are worth a task, and that one looks at together; fits whose splits one task finds.
_ROWS, _FITS = 2048, 64


def row_draw(keys: Sequence[str]) -> Column:
    """A number below 2^31 - 1 for each row, from its key."""
    text = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    return F.pmod(F.conv(F.substring(text, 1, 8), 16, 10).cast("long"), F.lit(_PRIME))


def row_factors(seed: int, tree: int) -> tuple[int, int]:
    """(a, b): a row is in the tree's sample if (draw * a + b) mod 2^31 - 1 is below the share of 2^31 - 1."""
    numbers = random.Random(f"{seed}|{tree}")
    return numbers.randrange(1, _PRIME), numbers.randrange(_PRIME)


def tree_features(seed: int, tree: int, share: float, features: int) -> list[int]:
    """The features that a tree may split on: the first ones in the order of a hash."""
    ranked = sorted(range(features), key=lambda j: hashlib.md5(f"{seed}|{tree}|{j}".encode()).hexdigest())
    return sorted(ranked[: max(1, math.floor(share * features + 1e-9))])


@dataclass(frozen=True)
class Fit:
    """One model to grow: its setting, and the fold that it must not see (-1: it sees all rows)."""

    setting: dict
    fold: int = -1

    def __getattr__(self, name: str):
        if name in DEFAULTS:
            return self.setting.get(name, DEFAULTS[name])
        raise AttributeError(name)


class Forest:
    """The trees of all fits, as arrays: in ``trees[t]``, fit i's node j has children 2j + 1 and 2j + 2.

    ``feature`` is -1 at a leaf; rows whose bin is at most ``bin`` go left.
    """

    def __init__(self, base: np.ndarray, depth: int):
        self.base, self.nodes, self.trees = base, (1 << (depth + 1)) - 1, []

    def new_tree(self) -> dict[str, np.ndarray]:
        shape = len(self.base), self.nodes
        self.trees.append(
            {"feature": np.full(shape, -1, np.int32), "bin": np.zeros(shape, np.int32), "weight": np.zeros(shape)}
        )
        return self.trees[-1]


def _leaves(tree: dict[str, np.ndarray], bins: np.ndarray, levels: int) -> np.ndarray:
    """[row, fit]: the node that each row comes to, after so many levels at most."""
    fits = np.arange(len(tree["feature"]))
    node = np.zeros((len(bins), len(fits)), np.int32)
    rows = np.arange(len(bins))[:, None]
    for _ in range(levels):
        feature = tree["feature"][fits, node]
        right = bins[rows, np.maximum(feature, 0)] > tree["bin"][fits, node]
        node = np.where(feature >= 0, 2 * node + 1 + right, node)
    return node


def _margins(base: np.ndarray, trees: list[dict], bins: np.ndarray, levels: int) -> np.ndarray:
    margins = np.array(base, np.float64) if base.ndim == 2 else np.tile(base, (len(bins), 1))
    fits = np.arange(margins.shape[1])
    for tree in trees:
        margins += tree["weight"][fits, _leaves(tree, bins, levels)]
    return margins


def _bytes(column: pa.Array, kind, width: int) -> np.ndarray:
    """The fixed-length values of a binary column as rows of numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _split(g: np.ndarray, h: np.ndarray, edges: np.ndarray, allowed: np.ndarray, fit: Fit) -> list[tuple]:
    """Per node: (feature, bin, G and H of the left side, G and H of the node); feature -1 if it stays whole.

    ``g`` and ``h`` are [node, cell] sums, ``edges`` the first cell of each feature and the end.
    """

    def pull(x: np.ndarray) -> np.ndarray:
        return np.sign(x) * np.maximum(np.abs(x) - fit.l1, 0.0)

    def score(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pulled = pull(a / UNIT)
        return pulled * pulled / (b / UNIT + fit.l2)

    first = allowed[0]
    total_g, total_h = (x[:, edges[first] : edges[first + 1]].sum(axis=1) for x in (g, h))
    left_g, left_h = np.cumsum(g, axis=1), np.cumsum(h, axis=1)
    starts = np.repeat(edges[:-1], np.diff(edges))
    for sums, cells in ((left_g, g), (left_h, h)):
        sums -= np.where(starts > 0, sums[:, np.maximum(starts - 1, 0)], 0)
    right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
    usable = np.zeros(g.shape[1], bool)
    for j in allowed:
        usable[edges[j] : edges[j + 1] - 1] = True
    least = fit.minHessian * UNIT
    fine = usable & (left_h >= least) & (right_h >= least) & (left_h > 0) & (right_h > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = score(left_g, left_h) + score(right_g, right_h) - score(total_g, total_h)[:, None]
    gain = np.where(fine, gain, -np.inf)
    out = []
    for node, cell in enumerate(gain.argmax(axis=1)):
        feature = int(np.searchsorted(edges, cell, "right")) - 1 if gain[node, cell] > fit.minGain else -1
        out.append(
            (feature, int(cell - edges[feature]) if feature >= 0 else 0, int(left_g[node, cell]), int(left_h[node, cell]),
             int(total_g[node]), int(total_h[node]))
        )
    return out


@dataclass(frozen=True)
class Binned:
    """Rows with binned features, and the cuts between the bins; see ``binned``."""

    rows: DataFrame  # bins binary, label double, fold int, draw long, and what was asked for
    cuts: list[list[float]]

    @property
    def edges(self) -> np.ndarray:
        return np.cumsum([0, *[len(c) + 1 for c in self.cuts]])


def quantile_cuts(rows: DataFrame, inputs: str, features: int, bins: int = BINS) -> list[list[float]]:
    """Per feature, the different values at rank ceil(i / bins * n) of all rows, for i from 1 to bins - 1.

    Values are counted, and the counts ordered over many tasks; a value is a cut if one of these ranks is among its own.
    """
    values = rows.select(F.posexplode(vector_to_array(inputs)).alias("j", "x"))
    counts = values.groupBy("j", "x").agg(F.count("*").alias("copies"))
    ranged = materialize(by_range(counts, ["j"], "x"), "boost-values")
    parts = ranged.groupBy("j", "part").agg(F.sum("copies").alias("inside"))
    earlier = F.coalesce(F.sum("inside").over(earlier_parts(["j"])), F.lit(0))
    parts = parts.select("j", "part", earlier.alias("before"), F.sum("inside").over(Window.partitionBy("j")).alias("n"))
    placed = ranged.withColumn("inside", F.sum("copies").over(within_part(["j"], "x"))).join(F.broadcast(parts), ["j", "part"])
    upto = F.col("before") + F.col("inside")

    def ranks(r: Column) -> Column:
        """How many of the wanted ranks are at most ``r``."""
        return F.least(F.lit(bins - 1), F.floor(r * bins / F.col("n")))

    found = placed.where(ranks(upto) > ranks(upto - F.col("copies"))).select("j", "x").collect()  # features x bins at most
    cuts: list[list[float]] = [[] for _ in range(features)]
    for j, x in sorted(map(tuple, found)):
        cuts[j].append(x)
    return cuts


def binned(rows: DataFrame, features: int, keep: Sequence[str] = (), inputs: str = "inputs", bins: int = BINS) -> Binned:
    """``rows`` with ``label`` and ``draw``, their inputs as bin numbers; a table of the work folder."""
    stored = materialize(rows.select(inputs, "label", "draw", *keep), "boost-inputs")
    cuts = quantile_cuts(stored, inputs, features, bins)
    edges = [np.array(c) for c in cuts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array(batch.column(0).to_pylist(), np.float64).reshape(batch.num_rows, features)
            numbers = np.empty(values.shape, np.uint8)
            for j, cut in enumerate(edges):
                numbers[:, j] = np.searchsorted(cut, values[:, j], "left")
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in numbers], pa.binary()), *batch.columns[1:]], names=["bins", *batch.schema.names[1:]]
            )

    others = ["label", "draw", *keep]
    kinds = ", ".join(["bins binary", *[f"{c} {stored.schema[c].dataType.simpleString()}" for c in others]])
    made = stored.select(vector_to_array(inputs).alias("bins"), *others).mapInArrow(run, kinds)
    # As many files as tasks could run, so that later passes use them all; few rows are not worth many tasks.
    parts = min(rows.sparkSession.sparkContext.defaultParallelism, -(-stored.count() // _ROWS))
    return Binned(materialize(made.repartition(max(1, parts)), "boost-rows"), cuts)


def _base_margins(data: Binned, fits: Sequence[Fit], fold: str | None) -> np.ndarray:
    """The log-odds of the label among the rows that each fit sees."""
    where = F.col(fold) if fold else F.lit(-2)
    counts = data.rows.groupBy(where.alias("fold")).agg(F.count("*").alias("n"), F.sum("label").alias("pos")).collect()
    base = []
    for fit in fits:
        seen = [r for r in counts if r["fold"] != fit.fold]
        share = sum(r["pos"] for r in seen) / max(1, sum(r["n"] for r in seen))
        share = min(max(share, 1e-6), 1 - 1e-6)
        base.append(math.log(share / (1 - share)))
    return np.array(base)


def with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    """``batch`` with a last column; one of the same name is left out."""
    kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n != name]
    return pa.RecordBatch.from_arrays([*[c for _, c in kept], column], names=[*[n for n, _ in kept], name])


class Grower:
    """Grows the trees of ``fits`` over the rows of ``data``."""

    def __init__(self, data: Binned, fits: Sequence[Fit], seed: int, fold: str | None = None):
        self.data, self.fits, self.seed, self.fold = data, list(fits), seed, fold
        self.features = len(data.cuts)
        self.depth = max(f.maxDepth for f in fits)
        self.forest = Forest(_base_margins(data, fits, fold), self.depth)
        # Predictions are in the rows up to tree ``known``.
        self.rows, self.known, self.carried = data.rows, 0, False

    def grow(self) -> Forest:
        for t in range(max(f.maxIter for f in self.fits)):
            if t - self.known >= RENEWED:
                self.renew()
            self._grow_tree(t)
        return self.forest

    def renew(self) -> None:
        """Writes the rows with the predictions of all trees so far."""
        margins = self._margin_reader()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for low in range(0, batch.num_rows, _ROWS):
                    part = batch.slice(low, _ROWS)
                    _, found = margins(part)
                    column = pa.array([r.tobytes() for r in found], pa.binary())
                    yield with_column(part, "margins", column)

        kept = [f for f in self.rows.schema.fields if f.name != "margins"]
        kinds = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in kept], "margins binary"])
        self.rows = materialize(self.rows.mapInArrow(run, kinds), "boost-margins")
        self.known, self.carried = len(self.forest.trees), True

    def _margin_reader(self):
        """A function from a batch to (bins, margins) of its rows, margins being [row, fit]."""
        features, width, levels, carried = self.features, len(self.fits), self.depth, self.carried
        base, trees = self.forest.base, self.forest.trees[self.known :]

        def read(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            bins = _bytes(part.column("bins"), np.uint8, features)
            start = _bytes(part.column("margins"), np.float64, width) if carried else base
            return bins, _margins(start, trees, bins, levels)

        return read

    def _grow_tree(self, t: int) -> None:
        active = [i for i, f in enumerate(self.fits) if t < f.maxIter]
        open_nodes = {i: [0] for i in active}
        margins = self._margin_reader()
        tree = self.forest.new_tree()
        sums: dict[tuple[int, int], tuple[int, int]] = {}
        for level in range(self.depth):
            wanted = {i: nodes for i, nodes in open_nodes.items() if nodes and self.fits[i].maxDepth > level}
            open_nodes = {}
            cells = int(self.data.edges[-1]) * (1 << level)
            some = max(1, CELLS // cells)
            for low in range(0, len(wanted), some):
                group = dict(list(wanted.items())[low : low + some])
                for i, node, feature, cut, lg, lh, g, h in self._pass(t, level, group, margins, tree):
                    sums[i, node] = g, h
                    if feature < 0:
                        continue
                    tree["feature"][i, node], tree["bin"][i, node] = feature, cut
                    sums[i, 2 * node + 1], sums[i, 2 * node + 2] = (lg, lh), (g - lg, h - lh)
                    open_nodes.setdefault(i, []).extend((2 * node + 1, 2 * node + 2))
        for (i, node), (g, h) in sums.items():
            if tree["feature"][i, node] < 0:
                tree["weight"][i, node] = leaf_weight(g, h, self.fits[i])

    def _pass(self, t: int, level: int, group: dict[int, list[int]], margins, tree) -> list[tuple]:
        """Best splits of the nodes of one level: one pass over the rows."""
        fits, fold, features, edges = self.fits, self.fold, self.features, self.data.edges
        cells, first_node = int(edges[-1]), (1 << level) - 1
        a, b = row_factors(self.seed, t)
        allowed = {i: np.array(tree_features(self.seed, t, fits[i].columnShare, features)) for i in group}
        settings = {i: (fits[i].fold, fits[i].subsamplingRate * _PRIME) for i in group}
        grown = {k: v[list(group)] for k, v in tree.items()}
        wanted = {i: np.isin(np.arange(first_node, 2 * first_node + 1), nodes) for i, nodes in group.items()}
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = {i: np.zeros((2, (first_node + 1) * cells)) for i in group}
            columns = list(group)
            for batch in batches:
                for low in range(0, batch.num_rows, _ROWS):
                    part = batch.slice(low, _ROWS)
                    bins, found = margins(part)
                    chance = 1 / (1 + np.exp(-found[:, columns]))
                    label = part.column("label").to_numpy(zero_copy_only=False)[:, None]
                    g, h = np.rint((chance - label) * UNIT), np.rint(chance * (1 - chance) * UNIT)
                    node = _leaves(grown, bins, level) - first_node
                    drawn = (part.column("draw").to_numpy(zero_copy_only=False) * a + b) % _PRIME
                    folds = part.column(fold).to_numpy(zero_copy_only=False) if fold else None
                    cell = edges[:-1] + bins
                    for k, i in enumerate(columns):
                        apart, share = settings[i]
                        use = (node[:, k] >= 0) & (drawn < share)
                        if folds is not None:
                            use &= folds != apart
                        use = np.flatnonzero(use)
                        use = use[wanted[i][node[use, k]]]
                        place = cell[np.ix_(use, allowed[i])] + (node[use, k] * cells)[:, None]
                        for s, weights in enumerate((g, h)):
                            each = np.repeat(weights[use, k], len(allowed[i]))
                            sums[i][s] += np.bincount(place.ravel(), each, sums[i].shape[1])
            for i, both in sums.items():
                at = np.flatnonzero(both[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([at.astype(np.int32).tobytes()], pa.binary()),
                     pa.array([both[:, at].astype(np.int64).tobytes()], pa.binary())],
                    names=["fit", "at", "sums"],
                )

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, whole = None, None
            for batch in batches:
                for i, at, both in zip(*[c.to_pylist() for c in batch.columns]):
                    if i != last:
                        if last is not None:
                            yield made(last, whole)
                        last, whole = i, np.zeros((2, (first_node + 1) * cells), np.int64)
                    at = np.frombuffer(at, np.int32)
                    whole[:, at] += np.frombuffer(both, np.int64).reshape(2, len(at))
            if last is not None:
                yield made(last, whole)

        def made(i: int, whole: np.ndarray) -> pa.RecordBatch:
            g, h = whole.reshape(2, first_node + 1, cells)
            found = _split(g, h, edges, allowed[i], fits[i])
            rows = [(i, first_node + n, *found[n]) for n in np.flatnonzero(wanted[i]).tolist()]
            names = ["fit", "node", "feature", "bin", "left_g", "left_h", "g", "h"]
            kinds = [pa.int32()] * 4 + [pa.int64()] * 4
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)], names=names)

        taken = ["bins", "label", "draw", *([fold] if fold else []), *(["margins"] if self.carried else [])]
        sums = self.rows.select(*taken).mapInArrow(add, "fit int, at binary, sums binary")
        spark = self.rows.sparkSession
        parts = min(-(-len(group) // _FITS), int(spark.conf.get("spark.sql.shuffle.partitions")))
        splits = sums.repartition(parts, "fit").sortWithinPartitions("fit").mapInArrow(
            best, "fit int, node int, feature int, bin int, left_g long, left_h long, g long, h long"
        )
        return [tuple(r) for r in splits.collect()]  # one row per fit and node


def leaf_weight(g: int, h: int, fit: Fit) -> float:
    """``g`` and ``h`` in multiples of 2^-30."""
    pulled = math.copysign(max(abs(g / UNIT) - fit.l1, 0.0), g)
    below = h / UNIT + fit.l2
    return -pulled / below * fit.stepSize if below > 0 else 0.0


def margins_of(grower: Grower, names: Sequence[str]) -> DataFrame:
    """The rows' columns ``names`` with ``margins``: an array of the final predictions of all fits, as log-odds."""
    grower.renew()
    width = len(grower.fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = _bytes(batch.column(len(names)), np.float64, width).ravel()
            offsets = pa.array(np.arange(0, len(flat) + 1, width, dtype=np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], lists], names=[*names, "margins"])

    kinds = ", ".join([*[f"{c} {grower.rows.schema[c].dataType.simpleString()}" for c in names], "margins array<double>"])
    return grower.rows.select(*names, "margins").mapInArrow(run, kinds)


def tree_list(forest: Forest, i: int, cuts: list[list[float]]) -> list:
    """Fit i's trees as nested lists: a leaf is its weight, a split [feature, cut, left, right]."""

    def node(tree: dict[str, np.ndarray], j: int):
        feature = int(tree["feature"][i, j])
        if feature < 0:
            return float(tree["weight"][i, j])
        return [feature, cuts[feature][int(tree["bin"][i, j])], node(tree, 2 * j + 1), node(tree, 2 * j + 2)]

    return [node(tree, 0) for tree in forest.trees]


class BoostedTrees(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted model: ``probability`` of the positive class from the vector of inputs, as column expressions."""

    inputsCol = Param(Params._dummy(), "inputsCol", "vector of inputs", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "probability", TypeConverters.toString)
    base = Param(Params._dummy(), "base", "log-odds before the first tree", TypeConverters.toFloat)
    trees = Param(Params._dummy(), "trees", "trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputsCol: str = "inputs", outputCol: str = "probability", base: float = 0.0, trees: str = "[]"):
        super().__init__()
        self._setDefault(inputsCol="inputs", outputCol="probability", base=0.0, trees="[]")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        def said(node) -> str:
            if not isinstance(node, list):
                return f"({node!r}D)"
            feature, cut, left, right = node
            return f"CASE WHEN _x[{feature}] <= ({cut!r}D) THEN {said(left)} ELSE {said(right)} END"

        margin = F.lit(self.getOrDefault(self.base))
        for tree in json.loads(self.getOrDefault(self.trees)):
            margin = margin + F.expr(said(tree))
        names = [c for c in dataset.columns if c != self.getOrDefault(self.outputCol)]
        opened = dataset.select(*names, vector_to_array(self.getOrDefault(self.inputsCol)).alias("_x"))
        chance = 1 / (1 + F.exp(-margin))
        return opened.withColumn(self.getOrDefault(self.outputCol), chance).drop("_x")


def grown_model(grower: Grower, i: int = 0) -> BoostedTrees:
    trees = tree_list(grower.forest, i, grower.data.cuts)[: grower.fits[i].maxIter]
    return BoostedTrees(base=float(grower.forest.base[i]), trees=json.dumps(trees))
