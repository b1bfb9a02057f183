"""Boosted trees with one ensemble for each class (softmax over the classes' sums), trained on histograms of binned features.

Rows of equal bins and label become one row with a weight, so a row that is repeated often is no hot spot. Each level of the trees of all
classes is one pass: tasks add up the gradients of their rows by (class, node, feature, bin) in numpy, Spark adds up the tasks' sums, and
the driver, which gets only these sums, chooses the splits. Their number follows from the options, not from the rows. Gradients are whole
multiples of 2^-30, so sums do not depend on the order of rows, and the same rows, options and seed give the same ensemble.

A null or NaN feature goes right at each split, as it does when an Ensemble is scored. Rows with a null label are left out; a table
without rows is an error. Labels are 0, 1, ..
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialize, release
from .features import FEATURES
from .trees import Ensemble, TrainingOptions, misclassified, tree_probability

#: Rows (about) whose values give the cuts between bins; all rows give gradients.
CUT_ROWS = 1 << 16
#: Bins of a feature.
BINS = 64
#: Rounds after which the sums of all rows are written; until then tasks walk the trees since.
KEPT_ROUNDS = 16
_ONE = 1 << 30

Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # feature (-1 in leaves), last bin on the left, left, right, value


def cut_points(rows: DataFrame, features: tuple[str, ...], bins: int = BINS, seed: int = 0) -> list[np.ndarray]:
    """For each feature the values between bins, ascending: quantiles of different rows, about CUT_ROWS of them picked by hash."""
    wanted = rows.select(*(F.col(f).cast("double").alias(f) for f in features))
    share = min(1.0, CUT_ROWS / max(1, rows.count()))
    if share < 1:
        wanted = wanted.where(F.pmod(F.xxhash64(*features, F.lit(seed)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    table, out = wanted.distinct().toArrow(), []
    for f in features:
        x = np.sort(table.column(f).fill_null(np.nan).to_numpy())
        x = x[~np.isnan(x)]
        values = np.unique(x)
        if len(values) > bins:
            values = np.unique(x[np.arange(bins) * len(x) // bins])
        # halfway; the lower one where that is not below the upper one
        half = values[:-1] / 2 + values[1:] / 2
        out.append(np.where(half < values[1:], half, values[:-1]) if len(values) > 1 else np.empty(0))
    return out


def _binned(rows: DataFrame, features: tuple[str, ...], label: str, cuts: list[np.ndarray]) -> DataFrame:
    """bins (a byte for each feature), label, weight."""

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.empty((b.num_rows, len(cuts)), np.uint8)
            for k, c in enumerate(cuts):
                x[:, k] = np.searchsorted(c, b.column(k).fill_null(np.nan).to_numpy(zero_copy_only=False))
            data = pa.py_buffer(x.tobytes())
            at = pa.py_buffer(np.arange(b.num_rows + 1, dtype=np.int32) * len(cuts))
            yield pa.record_batch([pa.Array.from_buffers(pa.binary(), b.num_rows, [None, at, data]), b.column(len(cuts))], ["bins", "label"])

    plain = rows.where(F.col(label).isNotNull()).select(*(F.col(f).cast("double").alias(f"f{k}") for k, f in enumerate(features)), F.col(label).cast("int").alias("label"))
    return plain.mapInArrow(to_bins, "bins binary, label int").groupBy("bins", "label").agg(F.count("*").alias("weight"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of bins as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _reached(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The node in which each row ends."""
    feature, cut, left, right, _ = tree
    at = np.zeros(len(x), np.int64)
    going = np.flatnonzero(feature[at] >= 0)
    while len(going):
        n = at[going]
        at[going] = np.where(x[going, feature[n]] <= cut[n], left[n], right[n])
        going = going[feature[at[going]] >= 0]
    return at


def _sums(batch: pa.RecordBatch, x: np.ndarray, since: list[list[Tree]], classes: int, shrinkage: float) -> np.ndarray:
    """Each row's sum for each class: those written, and the trees since."""
    out = batch.column(batch.schema.get_field_index("sums")).flatten().to_numpy().reshape(batch.num_rows, classes).copy()
    for trees in since:
        for k, tree in enumerate(trees):
            out[:, k] += shrinkage * tree[4][_reached(tree, x)]
    return out


def _histogram(kept: DataFrame, since: list[list[Tree]], growing: list[Tree], open_nodes: list[list[int]], width: int, bins: int, shrinkage: float) -> np.ndarray:
    """Sums of gradient, curvature and weight by (open node of any class, feature, bin); the last axis is these three."""
    classes = len(growing)
    place, most = [], 0
    for k in range(classes):
        p = np.full(len(growing[k][0]), -1, np.int64)
        p[open_nodes[k]] = most + np.arange(len(open_nodes[k]))
        most += len(open_nodes[k])
        place.append(p)
    cells = most * width * bins

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, cells), np.int64)
        for b in batches:
            for start in range(0, b.num_rows, 4096):  # what is added up as floats stays below 2^53
                part = b.slice(start, 4096)
                x = _matrix(part.column("bins"), width)
                y, w = part.column("label").to_numpy(), part.column("drawn").to_numpy()
                s = _sums(part, x, since, classes, shrinkage)
                e = np.exp(s - s.max(axis=1, keepdims=True))
                p = e / e.sum(axis=1, keepdims=True)
                for k in range(classes):
                    node = place[k][_reached(growing[k], x)]
                    go = np.flatnonzero(node >= 0)
                    if not len(go):
                        continue
                    at = ((node[go][:, None] * width + np.arange(width)) * bins + x[go]).ravel()
                    g = np.rint(((y[go] == k) - p[go, k]) * _ONE).astype(np.int64) * w[go]
                    h = np.rint(p[go, k] * (1 - p[go, k]) * _ONE).astype(np.int64) * w[go]
                    for row, value in zip(total, (g, h, w[go])):
                        np.add.at(row, at, np.repeat(value, width))
        some = np.flatnonzero(total[2])
        yield pa.record_batch([pa.array(some), *(pa.array(t[some]) for t in total)], ["cell", "g", "h", "n"])

    sums = kept.where("drawn > 0").mapInArrow(add_up, "cell long, g long, h long, n long").groupBy("cell").agg(*(F.sum(c).alias(c) for c in ("g", "h", "n"))).toArrow()
    out = np.zeros((cells, 3), np.int64)
    at = sums.column("cell").to_numpy()
    for k, c in enumerate(("g", "h", "n")):
        out[at, k] = sums.column(c).to_numpy()
    return out.reshape(most, width, bins, 3)


def _leaf(g: int, h: int, classes: int) -> float:
    """A Newton step for softmax; 0 where the curvature is 0."""
    return 0.0 if h <= 0 else (classes - 1) / classes * (int(g) / int(h))


def _best_split(cells: np.ndarray, cuts: list[np.ndarray], least: int) -> tuple[int, int] | None:
    """The feature and the last bin on the left that lower the squared error of the gradients most; ties: the first of both."""
    left = cells.cumsum(axis=1)
    whole = left[0, -1]
    right = whole - left
    ok = (left[:, :, 2] >= least) & (right[:, :, 2] >= least)
    for f, c in enumerate(cuts):
        ok[f, len(c) :] = False
    square = lambda t: t[..., 0].astype(float) ** 2 / np.maximum(t[..., 2], 1)
    gain = np.where(ok, square(left) + square(right) - square(whole), -1.0)
    best = int(gain.argmax())
    # a gain that is rounding only is none
    return None if gain.flat[best] <= 1e-12 * max(1.0, float(square(whole))) else divmod(best, gain.shape[1])


def _grow(kept: DataFrame, since: list[list[Tree]], classes: int, cuts: list[np.ndarray], options: TrainingOptions, bins: int, least: int) -> list[Tree]:
    """A tree for each class, a level of all of them at a time."""
    nodes = [[[-1, 0, -1, -1, 0.0]] for _ in range(classes)]
    open_nodes = [[0] for _ in range(classes)]
    for _ in range(options.max_depth):
        growing = [_arrays(t) for t in nodes]
        cells = _histogram(kept, since, growing, open_nodes, len(cuts), bins, options.shrinkage)
        place, following = 0, []
        for k in range(classes):
            children = []
            for node in open_nodes[k]:
                mine, place = cells[place], place + 1
                whole = mine[0].sum(axis=0)
                nodes[k][node][4] = _leaf(whole[0], whole[1], classes)
                found = _best_split(mine, cuts, least)
                if found is None:
                    continue
                f, b = found
                left = mine[f, : b + 1].sum(axis=0)
                first = len(nodes[k])
                nodes[k][node] = [f, b, first, first + 1, 0.0]
                for part in (left, whole - left):
                    nodes[k].append([-1, 0, -1, -1, _leaf(part[0], part[1], classes)])
                children += [first, first + 1]
            following.append(children)
        open_nodes = following
        if not any(open_nodes):
            break
    return [_arrays(t) for t in nodes]


def _arrays(nodes: list[list]) -> Tree:
    feature, cut, left, right = (np.array([n[k] for n in nodes], np.int64) for k in range(4))
    return feature, cut, left, right, np.array([n[4] for n in nodes], float)


def _write_sums(kept: DataFrame, since: list[list[Tree]], width: int, classes: int, shrinkage: float) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = _sums(b, _matrix(b.column("bins"), width), since, classes, shrinkage)
            sums = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * classes), pa.array(s.ravel()))
            yield pa.record_batch([b.column("bins"), b.column("label"), b.column("weight"), sums], ["bins", "label", "weight", "sums"])

    return materialize(kept.select("bins", "label", "weight", "sums").mapInArrow(add, "bins binary, label int, weight long, sums array<double>"), "sums")


def boost(data: DataFrame, options: TrainingOptions, label: str = "fire", features: tuple[str, ...] = FEATURES, classes: int | None = None, bins: int = BINS, least: int = 1) -> Ensemble:
    """An ensemble of options.tree_count trees for each class, trained on all rows; leaves hold at least ``least`` rows.

    subsample is the share of rows that a round draws (by hash; of a row that is repeated, that share of its copies).
    """
    if not 2 <= bins <= 256:
        raise ValueError("2 to 256 bins")
    labelled = data.where(F.col(label).isNotNull())
    seen = labelled.agg(F.min(label).alias("least"), F.max(label).alias("most")).first()
    if seen.most is None:
        raise ValueError("no labelled rows")
    classes = max(2, int(seen.most) + 1) if classes is None else classes
    if seen.least < 0 or seen.most >= classes:
        raise ValueError(f"labels must be 0 to {classes - 1}")
    cuts = cut_points(labelled, features, bins, options.seed)
    rows = materialize(_binned(labelled, features, label, cuts).withColumn("sums", F.array_repeat(F.lit(0.0), classes)), "binned")
    since: list[list[Tree]] = []
    grown: list[list[Tree]] = []
    for turn in range(options.tree_count):
        draw = (F.xxhash64("bins", "label", F.lit(options.seed), F.lit(turn)).bitwiseAND((1 << 30) - 1)) / float(1 << 30)
        drawn = F.col("weight") if options.subsample >= 1 else F.floor(F.col("weight") * options.subsample + draw)
        trees = _grow(rows.withColumn("drawn", drawn), since, classes, cuts, options, bins, least)
        since.append(trees)
        grown.append(trees)
        if len(since) == KEPT_ROUNDS and turn + 1 < options.tree_count:
            before, rows = rows, _write_sums(rows, since, len(cuts), classes, options.shrinkage)
            release(before)
            since = []
    release(rows)
    nodes = []
    for turn, trees in enumerate(grown):
        for k, (feature, cut, left, right, value) in enumerate(trees):
            for n in range(len(feature)):
                f = int(feature[n])
                nodes.append((k, turn, n, None if f < 0 else f, 0.0 if f < 0 else float(cuts[f][cut[n]]), int(left[n]), int(right[n]), float(value[n])))
    return Ensemble(nodes, 0.0, options.shrinkage, tuple(features))


def predicted_class(ensemble: Ensemble) -> Column:
    """The likeliest class; ties: the least."""
    p = F.array(*(tree_probability(ensemble, k) for k in range(max(2, ensemble.classes))))
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def train_classes(data: DataFrame, options: TrainingOptions, label: str = "fire", features: tuple[str, ...] = FEATURES, **how: int) -> tuple[Ensemble, DataFrame]:
    """boost() on a random part of the labelled rows, and a one-row report with both misclassification rates in percent."""
    rows = materialize(data.where(F.col(label).isNotNull()).select(*features, F.col(label).cast("int").alias("label")), "training")
    parts = rows.randomSplit([options.train_fraction, 1 - options.train_fraction], options.seed)
    ensemble = boost(parts[0], options, "label", features, **how)
    errors = [misclassified(p.withColumn("prediction", predicted_class(ensemble))).first()["error"] for p in parts]
    release(rows)
    names = "tree_count int, shrinkage double, max_depth int, subsample double, classes int, train_error double, test_error double"
    return ensemble, data.sparkSession.createDataFrame([(options.tree_count, options.shrinkage, options.max_depth, options.subsample, ensemble.classes, *errors)], names)
