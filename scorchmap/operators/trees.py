"""Scoring by an explicit tree ensemble, and training and scoring with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quality import good_look, product_code
from .features import FEATURES

#: Ensembles with more nodes are scored by a vectorised function instead of one column expression.
MAX_EXPRESSION_NODES = 400


@dataclass(frozen=True)
class Ensemble:
    """nodes: (class, tree, node, feature, threshold, left, right, value); feature is null in leaves, node 0 is a tree's root."""

    nodes: list[tuple]
    base: float
    shrinkage: float
    feature_names: tuple[str, ...] = FEATURES

    @property
    def classes(self) -> int:
        return 1 + max(n[0] for n in self.nodes)

    def trees(self) -> dict[tuple[int, int], dict[int, tuple]]:
        out: dict[tuple[int, int], dict[int, tuple]] = {}
        for k, t, node, *rest in self.nodes:
            out.setdefault((k, t), {})[node] = tuple(rest)
        return out


def _expression(tree: dict[int, tuple], names: tuple[str, ...], node: int = 0) -> Column:
    feature, threshold, left, right, value = tree[node]
    if feature is None:
        return F.lit(float(value))
    return F.when(F.col(names[feature]) <= threshold, _expression(tree, names, left)).otherwise(_expression(tree, names, right))


def _walk(tree: dict[int, tuple], x: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), np.int64)
    size = 1 + max(tree)
    feature, threshold, left, right, value = (np.zeros(size, t) for t in (np.int64, float, np.int64, np.int64, float))
    leaf = np.ones(size, bool)
    for k, (f, c, a, b, v) in tree.items():
        leaf[k] = f is None
        if f is None:
            value[k] = v
        else:
            feature[k], threshold[k], left[k], right[k] = f, c, a, b
    while not leaf[at].all():
        go = np.flatnonzero(~leaf[at])
        n = at[go]
        at[go] = np.where(x[go, feature[n]] <= threshold[n], left[n], right[n])
    return value[at]


def tree_probability(ensemble: Ensemble, wanted: int = 1) -> Column:
    """The probability of a class: a softmax over the classes' sums (with one class: its sum; an unknown class: 0)."""
    if wanted >= max(2, ensemble.classes):
        return F.lit(0.0)
    trees = ensemble.trees()
    if len(ensemble.nodes) <= MAX_EXPRESSION_NODES:
        sums = []
        for k in range(ensemble.classes):
            total = F.lit(ensemble.base)
            for (c, _), tree in sorted(trees.items()):
                if c == k:
                    total = total + ensemble.shrinkage * _expression(tree, ensemble.feature_names)
            sums.append(total)
        if len(sums) == 1:
            return sums[0]
        most = F.greatest(*sums)  # subtracted, so that no sum is too great for exp
        total = F.exp(sums[0] - most)
        for s in sums[1:]:
            total = total + F.exp(s - most)
        return F.exp(sums[wanted] - most) / total

    @F.pandas_udf("double")
    def score(x: pd.DataFrame) -> pd.Series:
        data = x.to_numpy(float)
        sums = np.full((ensemble.classes, len(data)), ensemble.base)
        for (k, _), tree in sorted(trees.items()):
            sums[k] += ensemble.shrinkage * _walk(tree, data)
        if len(sums) == 1:
            return pd.Series(sums[0])
        e = np.exp(sums - sums.max(axis=0))
        return pd.Series(e[wanted] / e.sum(axis=0))

    return score(F.struct(*ensemble.feature_names))


#: Nodes (40 bytes each) of a forest that is sent to all tasks; more are scored in several passes, each with the models that fit.
MAX_NODES = 1 << 21
#: Rows times trees that are walked at once, or looked up at once.
_WALKED, _LOOKED_UP = 1 << 20, 1 << 16
#: Bytes of the table by which some trees are looked up together, and of all tables of a forest in a worker; leaves of such a tree.
_TABLE, _TABLES, _LEAVES = 1 << 22, 1 << 27, 64


@dataclass
class Masks:
    """Some trees of at most 64 leaves, as bit masks of the leaves that a row can still reach.

    A test that fails leaves those outside its left branch. Which tests on a feature fail follows from how many of their different
    thresholds are below the row's value, so all of them together are one row of a table: reach[feature][number]. What is left after all
    features, its first leaf, is where a walk from the root ends. value: by tree and leaf.
    """

    trees: np.ndarray
    cuts: dict[int, np.ndarray]
    reach: dict[int, np.ndarray]
    value: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The value of the leaf of each row (first axis) in each tree."""
        some = np.full((len(x), len(self.trees)), ~np.uint64(0)).astype(self.dtype) if not self.reach else None
        part = None
        for f, cuts in self.cuts.items():
            below = np.searchsorted(cuts, x[:, f])  # NaN is above all thresholds, as no test on it holds
            if some is None:
                some = np.take(self.reach[f], below, axis=0)
            else:
                part = np.take(self.reach[f], below, axis=0, out=part, mode="clip")
                np.bitwise_and(some, part, out=some)
        first = np.bitwise_count(~some & (some - some.dtype.type(1))).astype(np.intp)
        first += np.arange(len(self.trees)) * self.value.shape[1]
        return self.value.ravel()[first]

    @property
    def dtype(self) -> np.dtype:
        return np.dtype(f"u{max(1, self.value.shape[1] // 8)}")


@dataclass
class Forest:
    """The trees of several models, in flat arrays. roots, classes and settings (base, shrinkage) are by model; feature is -1 in leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: dict[str, np.ndarray]
    classes: dict[str, np.ndarray]
    settings: dict[str, tuple[float, float]]
    _plans: dict[str, tuple[list[Masks], np.ndarray]] = field(default_factory=dict, repr=False, compare=False)
    _work: tuple[np.ndarray, np.ndarray, np.ndarray] | None = field(default=None, repr=False, compare=False)

    def probability(self, model: str, x: np.ndarray, wanted: int) -> np.ndarray:
        """Of rows of features; a model that is not there gives NaN, an unknown class 0."""
        if model not in self.roots:
            return np.full(len(x), np.nan)
        roots, of, (base, shrinkage) = self.roots[model], self.classes[model], self.settings[model]
        k = int(of.max()) + 1
        if wanted >= max(2, k):
            return np.zeros(len(x))
        member = (of[:, None] == np.arange(k)).astype(float)
        if model not in self._plans:
            self._plans[model] = self._masks(roots)
        masks, walked = self._plans[model]
        total = np.zeros((len(x), k))
        for m in masks:
            step = max(1, _LOOKED_UP // len(m.trees))
            for a in range(0, len(x), step):
                total[a : a + step] += m.leaves(x[a : a + step]) @ member[m.trees]
        step = max(1, _WALKED // max(1, len(walked)))
        for a in range(0, len(x) if len(walked) else 0, step):
            total[a : a + step] += self._leaves(roots[walked], x[a : a + step]) @ member[walked]
        sums = base + shrinkage * total
        if k == 1:
            return sums[:, 0]
        e = np.exp(sums - sums.max(axis=1, keepdims=True))
        return e[:, wanted] / e.sum(axis=1)

    def _masks(self, roots: np.ndarray) -> tuple[list[Masks], np.ndarray]:
        """Tables for groups of some trees, and the places of those that are walked: with too many leaves, a threshold that is no number, a
        node with two parents, or beyond the model's share of _TABLES."""
        levels, nodes, of = [], roots, np.arange(len(roots))
        if self._work is None:
            self._work = np.zeros(len(self.feature), bool), np.zeros(len(self.feature), np.int64), np.zeros(len(self.feature), np.int64)
        (seen, count, start), walk = self._work, np.zeros(len(roots), bool)  # no two models have a node in common
        while len(nodes):
            order = np.argsort(nodes, kind="stable")
            again = seen[nodes]
            again[order[1:]] |= nodes[order[1:]] == nodes[order[:-1]]
            walk[of[again]] = True
            keep = ~walk[of]
            nodes, of = nodes[keep], of[keep]
            seen[nodes] = True
            inner = self.feature[nodes] >= 0
            walk[of[inner & np.isnan(self.threshold[nodes])]] = True
            levels.append((nodes, of))
            nodes, of = np.concatenate([self.left[nodes[inner]], self.right[nodes[inner]]]), np.tile(of[inner], 2)
        for nodes, _ in reversed(levels):
            inner = self.feature[nodes] >= 0
            count[nodes[~inner]] = 1
            count[nodes[inner]] = count[self.left[nodes[inner]]] + count[self.right[nodes[inner]]]
        walk |= count[roots] > _LEAVES
        for nodes, _ in levels:
            n = nodes[self.feature[nodes] >= 0]
            start[self.left[n]], start[self.right[n]] = start[n], start[n] + count[self.left[n]]
        nodes, of = (np.concatenate([v[k] for v in levels]) for k in (0, 1))
        nodes, of = nodes[~walk[of]], of[~walk[of]]
        order = np.argsort(of, kind="stable")
        nodes, of, out = nodes[order], of[order], []
        room = _TABLES * len(nodes) / len(self.feature)
        usual = np.flatnonzero(~walk)
        bits = np.maximum(8, 1 << np.ceil(np.log2(count[roots[usual]])).astype(np.int64))  # 8, 16, 32 or 64
        inner = np.bincount(of[self.feature[nodes] >= 0], minlength=len(roots))
        for size in np.unique(bits):
            own = usual[bits == size]
            step = max(1, int((_TABLE / (max(1.0, inner[own].mean()) * size / 8)) ** 0.5))
            for a in range(0, len(own), step):
                trees = own[a : a + step]
                room -= len(trees) * int(inner[trees].sum() + 1) * int(size) // 8
                if room < 0:
                    walk[own[a:]] = True
                    break
                low, high = np.searchsorted(of, trees), np.searchsorted(of, trees, "right")
                at = np.concatenate([np.arange(p, q) for p, q in zip(low, high, strict=True)])
                out.append(self._table(trees, nodes[at], np.searchsorted(trees, of[at]), count, start, int(size)))
        return out, np.flatnonzero(walk)

    def _table(self, trees: np.ndarray, nodes: np.ndarray, of: np.ndarray, count: np.ndarray, start: np.ndarray, bits: int) -> Masks:
        kind, inner = np.dtype(f"u{bits // 8}"), self.feature[nodes] >= 0
        value = np.zeros((len(trees), bits))
        value[of[~inner], start[nodes[~inner]]] = self.value[nodes[~inner]]
        nodes, of = nodes[inner], of[inner]
        n = count[self.left[nodes]].astype(np.uint64)  # leaves of the left branch, 63 at most
        fails = ~(((np.uint64(1) << n) - np.uint64(1)) << start[nodes].astype(np.uint64))
        cuts, reach = {}, {}
        for f in np.unique(self.feature[nodes]).tolist():
            own = np.flatnonzero(self.feature[nodes] == f)
            cuts[f], place = np.unique(self.threshold[nodes[own]], return_inverse=True)
            table = np.full((len(cuts[f]) + 1, len(trees)), np.iinfo(kind).max, kind)
            np.bitwise_and.at(table, (place + 1, of[own]), fails[own].astype(kind))
            reach[f] = np.bitwise_and.accumulate(table, axis=0)
        return Masks(trees, cuts, reach, value)

    def _leaves(self, roots: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The value of the leaf of each row (first axis) in each tree; all trees go down a level at a time."""
        at = np.tile(roots, (len(x), 1)).ravel()
        row = np.repeat(np.arange(len(x)), len(roots))
        going = np.flatnonzero(self.feature[at] >= 0)
        while len(going):
            n = at[going]
            at[going] = np.where(x[row[going], self.feature[n]] <= self.threshold[n], self.left[n], self.right[n])
            going = going[self.feature[at[going]] >= 0]
        return self.value[at].reshape(len(x), len(roots))


def load_forest(nodes: DataFrame, settings: DataFrame) -> Forest:
    """nodes: model, class, tree, node (0: the root), feature (its place in the vector, null in leaves), threshold, left, right, value.
    settings: model, base, shrinkage. Both are read whole: give those of few enough models, see forest_passes().
    """
    columns = ["model", "class", "tree", "node", "feature", "threshold", "left", "right", "value"]
    t = nodes.select(*columns).orderBy("model", "class", "tree", "node").toArrow()
    model, kind, tree, node, left, right = (t.column(c).to_numpy() for c in ("model", "class", "tree", "node", "left", "right"))
    first = np.ones(len(node), bool)
    first[1:] = (model[1:] != model[:-1]) | (kind[1:] != kind[:-1]) | (tree[1:] != tree[:-1])
    first = np.flatnonzero(first)
    size = np.diff(np.append(first, len(node)))
    root = np.repeat(first, size)
    if (node != np.arange(len(node)) - root).any():
        raise ValueError("the nodes of each tree must be 0, 1, ..")
    feature = t.column("feature").fill_null(-1).to_numpy().astype(np.int64)
    inner = feature >= 0
    if ((left < 0) | (right < 0) | (np.maximum(left, right) >= np.repeat(size, size)))[inner].any():
        raise ValueError("a node has a child that is not in its tree")
    given = {r.model: (r.base, r.shrinkage) for r in settings.collect()}
    roots, classes = {}, {}
    for m in dict.fromkeys(model[first].tolist()):
        own = first[model[first] == m]
        roots[m], classes[m] = own, kind[own].astype(np.int64)
    if roots.keys() - given.keys():
        raise ValueError(f"no base and shrinkage for {sorted(roots.keys() - given.keys())}")
    fill = lambda c: t.column(c).fill_null(0.0).to_numpy().astype(float)
    return Forest(feature, fill("threshold"), root + left.astype(np.int64), root + right.astype(np.int64), fill("value"), roots, classes, given)


def forest_passes(nodes: DataFrame) -> list[list[str]]:
    """Models in groups of at most MAX_NODES nodes each (a model of more is a group of its own)."""
    sizes = sorted((r["model"], r["count"]) for r in nodes.groupBy("model").count().collect())  # a row for each model
    out: list[list[str]] = []
    room = 0
    for model, n in sizes:
        if n > room or not out:
            out.append([])
            room = MAX_NODES
        out[-1].append(model)
        room -= n
    return out


def _scorer(sent: Broadcast, wanted: int):
    @F.pandas_udf("double")
    def score(model: pd.Series, x: pd.DataFrame) -> pd.Series:
        data, value = x.to_numpy(float), np.full(len(model), np.nan)
        for m, place in model.groupby(model).indices.items():
            value[place] = sent.value.probability(m, data[place], wanted)
        return pd.Series(value)

    return score


def score_forest(rows: DataFrame, nodes: DataFrame, settings: DataFrame, feature_names: tuple[str, ...] = FEATURES, wanted: int = 1, name: str = "probability") -> DataFrame:
    """Adds the probability of a class by the model that each row names in a column model; without such a model it is null.

    All models whose nodes fit into a broadcast are scored in one pass over the rows.
    """
    passes = forest_passes(nodes)
    out = None
    for models in passes:
        some = F.col("model").isin(*models)
        forest = load_forest(nodes.where(some), settings.where(some))
        score = _scorer(rows.sparkSession.sparkContext.broadcast(forest), wanted)
        # the last pass takes rows without any of the models too
        part = rows if len(passes) == 1 else rows.where(F.coalesce(some, F.lit(False)) if models is not passes[-1] else ~F.coalesce(F.col("model").isin(*(m for p in passes[:-1] for m in p)), F.lit(False)))
        scored = part.withColumn(name, F.nanvl(score("model", F.struct(*feature_names)), F.lit(None).cast("double")))
        out = scored if out is None else out.unionByName(scored)
    return rows.withColumn(name, F.lit(None).cast("double")) if out is None else out


def ensemble_rows(model: str, ensemble: Ensemble) -> list[tuple]:
    """An ensemble as rows of a table of nodes, see load_forest()."""
    return [(model, *n) for n in ensemble.nodes]


NODES = "model string, class int, tree int, node int, feature int, threshold double, left int, right int, value double"


@dataclass(frozen=True)
class TrainingOptions:
    tree_count: int
    shrinkage: float
    max_depth: int
    subsample: float
    train_fraction: float = 0.7
    seed: int = 0


def train(data: DataFrame, options: TrainingOptions, label: str = "fire") -> tuple[GBTClassificationModel, DataFrame]:
    """A gradient-boosted tree classifier with logistic loss, and a one-row report with both misclassification rates in percent."""
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(data.withColumn("label", F.col(label).cast("double"))).select("features", "label")
    train_rows, test_rows = rows.randomSplit([options.train_fraction, 1 - options.train_fraction], options.seed)
    booster = GBTClassifier(maxIter=options.tree_count, stepSize=options.shrinkage, maxDepth=options.max_depth, subsamplingRate=options.subsample, lossType="logistic", seed=options.seed)
    model = booster.fit(train_rows)
    errors = [misclassified(model.transform(part)) for part in (train_rows, test_rows)]
    settings = [F.lit(options.tree_count).alias("tree_count"), F.lit(options.shrinkage).alias("shrinkage"), F.lit(options.max_depth).alias("max_depth"), F.lit(options.subsample).alias("subsample")]
    report = errors[0].select(F.col("error").alias("train_error")).join(errors[1].select(F.col("error").alias("test_error"))).select(*settings, "train_error", "test_error")
    return model, report


def misclassified(scored: DataFrame, *by: str) -> DataFrame:
    """n_looks: rows; error: the share of rows whose prediction differs from their label, in percent. One row, or one for each group."""
    return scored.groupBy(*by).agg(F.count("*").alias("n_looks"), (F.avg((F.col("prediction") != F.col("label")).cast("double")) * 100).alias("error"))


def score_looks(featured: DataFrame, model: GBTClassificationModel) -> DataFrame:
    """Adds burn_prob; only clear looks go through the model, the others get their sentinels."""
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    clear = model.transform(assembler.transform(featured.where(good_look())).withColumnRenamed("_features", model.getFeaturesCol()))
    clear = clear.select(*featured.columns, product_code(vector_to_array("probability")[1]).alias("burn_prob"))
    return clear.unionByName(featured.where(~good_look()).withColumn("burn_prob", product_code(F.lit(0.0))))


def train_or_load(data: DataFrame | None, options: TrainingOptions | None, path: str | None) -> GBTClassificationModel:
    """Either trains or loads: exactly one of the two must be asked for."""
    if (data is None) == (path is None):
        raise ValueError("give training data or a saved model, not both")
    if path is not None:
        return GBTClassificationModel.load(path)
    if options is None:
        raise ValueError("training needs its options")
    return train(data, options)[0]
