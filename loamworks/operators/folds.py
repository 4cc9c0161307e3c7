"""Cross validation of forests on shared histograms: the models of all folds, labels and trees grow from one scan a level.

A model is one tree of one forest: (label, fold that it does not see, number). A last "fold" sees all rows. A level of all
models together is one aggregate, weights and sums of labels by (model, node, feature, bin); the best cut of each node is
found by a window over its bins, so the driver gets one row per open node, models x 2^level at most, whatever the table.
A task sums its rows up in arrays of numbers, so a level costs a row some dozens of array steps a model, and the exchange has models x
features x bins x open nodes rows a task, of which there are ``MOST`` at most. Trees grow level by level, so a tree cut off at a smaller depth is the tree of that depth, and the first trees of a forest
are the smaller forest: one run gives the scores of all smaller settings too, the same as separate fits would.

A tree's row weights (Poisson, mean 1) and the folds come from hashes of the key, so lost tasks give the same again. Bin edges are
quantiles of the features over all rows, to a ten-thousandth of the rows; labels of held-out rows are never used. Rows with a null feature take no
part, a null or non-finite label counts for no model of that label; an empty table gives models without nodes and no scores.
"""

from __future__ import annotations

import functools
import random
from math import ceil
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamworks.session import discard, ship, staged

#: Cumulative chances of 0, 1, ... in a Poisson distribution of mean 1.
POISSON = (0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582)

#: Rows of a task, as long as there are at most so many tasks; numbers that a task holds of the histograms at once.
DEALT, MOST, HELD = 32_768, 256, 4_000_000


class Forests(NamedTuple):
    """The models of a run: ``splits[model]`` maps a node to (feature, bin, gain), ``means[model]`` every node to its mean label; node n has the children 2n (bins up to the cut's) and 2n + 1."""

    features: list[str]
    labels: list[str]
    folds: int
    trees: int
    depth: int
    edges: list[list[float]]
    splits: list[dict[int, tuple[int, int, float]]]
    means: list[dict[int, float]]

    def first(self, label: int, fold: int) -> int:
        """The first tree of the forest of a label that does not see ``fold`` (``folds``: sees all)."""
        return (label * (self.folds + 1) + fold) * self.trees

    def importances(self, label: int, fold: int | None = None) -> list[float]:
        """Each feature's share of the gains of a forest's cuts; zeros without any."""
        at = self.first(label, self.folds if fold is None else fold)
        gains = [0.0] * len(self.features)
        for cuts in self.splits[at : at + self.trees]:
            for feature, _, gain in cuts.values():
                gains[feature] += gain
        return [g / (sum(gains) or 1.0) for g in gains]

    def cuts(self) -> tuple[np.ndarray, np.ndarray]:
        """Feature (-1: none) and bin of every model's cuts by node."""
        feature, at = np.full((len(self.splits), 2 ** (self.depth + 1)), -1, np.int32), np.zeros((len(self.splits), 2 ** (self.depth + 1)), np.int32)
        for m, splits in enumerate(self.splits):
            for node, (f, b, _) in splits.items():
                feature[m, node], at[m, node] = f, b
        return feature, at

    def means_at(self, depth: int) -> np.ndarray:
        """The means of all models' nodes, models x 2^(depth of the run + 1) numbers, as if trees ended at ``depth``; nan without any."""
        out = np.full((len(self.means), 2 ** (self.depth + 1)), np.nan)
        for m, mean in enumerate(self.means):
            for node in range(2 ** (self.depth + 1)):
                up = node
                while up >= 2 ** (depth + 1):
                    up //= 2
                out[m, node] = mean.get(up, np.nan)
        return out


def feature_edges(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """The values that cut each feature into ``bins`` bins of about equal numbers of rows, equal ones once: one aggregate of mergeable summaries, no exchange of values."""
    shares = [k / bins for k in range(1, bins)]
    got = df.agg(*(F.percentile_approx(F.col(f).cast("double"), shares, 10_000).alias(f"e{i}") for i, f in enumerate(features))).first()
    return [sorted(set(got[f"e{i}"] or [])) for i in range(len(features))]


def _ints(values: list[int]) -> Column:
    return F.expr(f"array({','.join(map(str, values))})")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of arrays of ``width`` numbers as a matrix; nulls are nan."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _walk(bins: np.ndarray, feature: np.ndarray, at: np.ndarray, steps: int) -> np.ndarray:
    """The node of each row of bins after so many steps down one model's cuts."""
    node, first = np.ones(len(bins), np.int32), np.arange(len(bins)) * bins.shape[1]
    flat = bins.ravel()
    for _ in range(steps):
        f = feature[node]
        node = np.where(f >= 0, 2 * node + (flat[first + np.maximum(f, 0)] > at[node]), node)
    return node


def _histograms(state: DataFrame, forests: Forests, level: int) -> DataFrame:
    """(model, node, feature, bin, n, s): weight and label sum of the rows in each open node of the level, by bin; of the last level by node alone.

    A task sums its rows up in arrays, for ``HELD`` numbers' worth of models at once, and gives what is not empty.
    """
    folds, trees, n_features, n_labels = forests.folds, forests.trees, len(forests.features), len(forests.labels)
    wide = level < forests.depth
    n_kinds, n_bins = (n_features, max(map(len, forests.edges)) + 1) if wide else (1, 1)
    cuts, size = forests.cuts(), 2**level * n_kinds * n_bins
    models, step = len(forests.splits), max(1, HELD // size)

    def summed(low: int, high: int):
        def work(batches):
            total = np.zeros((2, high - low, size))
            for batch in batches:
                bins, w, ys = (_matrix(batch.column(c), width) for c, width in (("_bins", n_features), ("_w", trees), ("_ys", n_labels)))
                fold = batch.column("_fold").to_numpy()
                for m in range(low, high):
                    y, weight = ys[:, m // (trees * (folds + 1))], w[:, m % trees]
                    node = _walk(bins, cuts[0][m], cuts[1][m], level)
                    rows = np.flatnonzero((fold != m // trees % (folds + 1)) & (weight > 0) & (node >= 2**level) & ~np.isnan(y))
                    node, weight, y = node[rows] - 2**level, weight[rows].astype(float), y[rows]
                    for k in range(n_kinds):
                        place = (node * n_kinds + k) * n_bins + (bins[rows, k] if wide else 0)
                        total[0, m - low] += np.bincount(place, weight, size)
                        total[1, m - low] += np.bincount(place, weight * y, size)
            model, place = np.nonzero(total[0])
            found = [model + low, place // (n_kinds * n_bins) + 2**level, place // n_bins % n_kinds, place % n_bins, total[0][model, place].astype(np.int64), total[1][model, place]]
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(t)) for x, t in zip(found, ("i4", "i4", "i4", "i4", "i8", "f8"), strict=True)], ["model", "node", "feature", "bin", "n", "s"])

        return work

    rows = state.select("_bins", "_w", "_ys", "_fold")
    parts = [rows.mapInArrow(summed(low, min(low + step, models)), "model int, node int, feature int, bin int, n long, s double") for low in range(0, models, step)]
    return functools.reduce(DataFrame.unionAll, parts).groupBy("model", "node", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


def _cuts(hist: DataFrame, level: int, trees: int, n_features: int, share: float, least: int, seed: int) -> DataFrame:
    """(model, node, n, s, cut): weight and label sum of each open node of the level, and its best cut (feature, bin, gain) or null."""
    whole = Window.partitionBy("model", "node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = hist.select("model", "node", "feature", "bin", *(F.sum(c).over(w).alias(c + t) for c in "ns" for w, t in ((upto, "l"), (whole, ""))))
    # each tree and level looks at its own choice of features
    seen = []
    for t in range(trees):
        chosen = random.Random(f"{seed}/{t}/{level}").sample(range(n_features), ceil(share * n_features))
        seen += [int(f in chosen) for f in range(n_features)]
    right, rest = F.col("n") - F.col("nl"), F.col("s") - F.col("sl")
    allowed = (F.col("nl") >= least) & (right >= least) & (F.get(_ints(seen), F.col("model") % trees * n_features + F.col("feature")) == 1)
    gain = F.when(allowed, F.col("sl") * F.col("sl") / F.col("nl") + rest * rest / right - F.col("s") * F.col("s") / F.col("n"))
    cut = F.when(gain > 1e-9, F.struct(gain.alias("gain"), (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin")))
    return sums.select("model", "node", "n", "s", cut.alias("cut")).groupBy("model", "node").agg(F.max("n").alias("n"), F.max("s").alias("s"), F.max("cut").alias("cut"))


def fold_forests(
    df: DataFrame, features: list[str], labels: list[str], key: str, folds: int = 5, trees: int = 8, depth: int = 4, bins: int = 32, share: float = 0.7, least: int = 2, seed: int = 42,
    edges: list[list[float]] | None = None,
) -> tuple[DataFrame, Forests]:
    """The forests of all labels and folds, and the rows with ``_fold``, ``_ys`` (labels), ``_bins``, ``_w`` and ``_nodes`` (their node in every model, worked out when it is read).

    ``share`` of the features are tried in a tree's level, ``least`` is a child's least weight. The rows are written twice, and read once a level.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(key).alias("_key"), *(F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)), F.array(*(F.when(F.abs(F.col(y).cast("double")) < float("inf"), F.col(y).cast("double")) for y in labels)).alias("_ys"))
    rows = staged(rows.dropna(subset=[f"_f{i}" for i in range(len(features))]), "rows")
    edges = feature_edges(rows, [f"_f{i}" for i in range(len(features))], bins) if edges is None else edges
    models = len(labels) * (folds + 1) * trees
    chance = lambda *salt: F.pmod(F.xxhash64("_key", *(F.lit(x) for x in (seed, *salt))), F.lit(1_000_003)) / 1_000_003
    above = lambda x, limits: sum(((x > e).cast("int") for e in limits), F.lit(0))
    parts = min(max(1, -(-rows.count() // DEALT)), MOST)
    state = staged(
        rows.repartition(parts).select(
            "_key", "_ys", F.floor(chance() * folds).cast("int").alias("_fold"),
            F.array(*(above(F.col(f"_f{i}"), e) for i, e in enumerate(edges))).alias("_bins"),
            F.array(*(above(chance(t), POISSON) for t in range(trees))).alias("_w"),
        ),
        "nodes",
    )
    discard(rows)
    out = Forests(features, labels, folds, trees, depth, edges, [{} for _ in range(models)], [{} for _ in range(models)])
    for level in range(depth + 1):
        found = _cuts(_histograms(state, out, level), level, trees, len(features), share, least, seed).collect()
        for m, node, n, s, cut in found:
            out.means[m][node] = s / n
            if cut is not None and level < depth:
                out.splits[m][node] = -cut["feature"], -cut["bin"], cut["gain"]
        if not any(node >= 2**level for splits in out.splits for node in splits):
            break
    cuts = out.cuts()

    @F.pandas_udf("array<int>")
    def nodes(bins: pd.Series) -> pd.Series:
        table = np.array(bins.tolist(), np.int32).reshape(len(bins), len(features))
        return pd.Series(list(np.column_stack([_walk(table, cuts[0][m], cuts[1][m], depth) for m in range(models)])))

    return state.withColumn("_nodes", nodes("_bins")).withColumnRenamed("_key", key), out


def fold_scores(state: DataFrame, forests: Forests, trees: list[int] | None = None, depths: list[int] | None = None) -> DataFrame:
    """(label, trees, depth, fold, n, rmse, r2) of the held-out rows of every fold, for the numbers of trees and depths asked for (at most those of the run).

    A task gives one row of sums for each of them; labels are summed as differences from the label's mean at a root, so nothing cancels out.
    """
    ship(state.sparkSession)
    trees, depths = trees or [forests.trees], depths or [forests.depth]
    cuts, means = forests.cuts(), [forests.means_at(d) for d in depths]
    shift = [forests.means[forests.first(i, forests.folds)].get(1, 0.0) for i in range(len(forests.labels))]

    def work(batches):
        keys, sums = [], []
        for batch in batches:
            bins, ys = _matrix(batch.column("_bins"), len(forests.features)), _matrix(batch.column("_ys"), len(forests.labels))
            fold = batch.column("_fold").to_numpy()
            for f in np.unique(fold):
                mine = np.flatnonzero(fold == f)
                for i in range(len(forests.labels)):
                    y, first = ys[mine, i], forests.first(i, int(f))
                    total = np.zeros((len(depths), len(mine)))
                    for t in range(max(trees)):
                        node = _walk(bins[mine], cuts[0][first + t], cuts[1][first + t], forests.depth)
                        total += [mean[first + t][node] for mean in means]
                        for k, d in enumerate(depths if t + 1 in trees else []):
                            p = total[k] / (t + 1)
                            known = ~np.isnan(y) & ~np.isnan(p)
                            if known.any():
                                gap, off = (y - p)[known], y[known] - shift[i]
                                keys.append((i, t + 1, d, int(f), int(known.sum())))
                                sums.append(((gap * gap).sum(), off.sum(), (off * off).sum(), off.min(), off.max()))
        columns = [pa.array([k[j] for k in keys], pa.int64() if j == 4 else pa.int32()) for j in range(5)] + [pa.array([x[j] for x in sums], pa.float64()) for j in range(5)]
        yield pa.RecordBatch.from_arrays(columns, ["label", "trees", "depth", "fold", "n", "error", "off", "off2", "low", "high"])

    rows = state.select("_fold", "_ys", "_bins").mapInArrow(work, "label int, trees int, depth int, fold int, n long, error double, off double, off2 double, low double, high double")
    n, error, off = F.sum("n"), F.sum("error"), F.sum("off")
    spread = F.when(F.max("high") > F.min("low"), F.sum("off2") - off * off / n)
    found = rows.groupBy("label", "trees", "depth", "fold").agg(n.alias("n"), F.sqrt(error / n).alias("rmse"), (1 - F.try_divide(error, spread)).alias("r2"))
    return found.withColumn("label", F.get(F.array(*map(F.lit, forests.labels)), F.col("label")))


def search_folds(df: DataFrame, features: list[str], label: str, key: str, trees: tuple[int, ...] = (2, 4, 8), depths: tuple[int, ...] = (2, 3, 4, 5), folds: int = 5, **how) -> DataFrame:
    """(trees, depth, rmse, spread, r2, chosen): mean and deviation of the folds' held-out errors for every setting, from one run; the least mean is chosen (ties: fewer trees, then less depth)."""
    state, forests = fold_forests(df, features, [label], key, folds, max(trees), max(depths), **how)
    each = fold_scores(state, forests, sorted(trees), sorted(depths))
    found = each.groupBy("trees", "depth").agg(F.avg("rmse").alias("rmse"), F.stddev_pop("rmse").alias("spread"), F.avg("r2").alias("r2"))
    best = found.agg(F.min(F.struct("rmse", "trees", "depth")).alias("_best"))
    return found.crossJoin(F.broadcast(best)).withColumn("chosen", (F.col("trees") == F.col("_best.trees")) & (F.col("depth") == F.col("_best.depth"))).drop("_best")


def eliminate_by_folds(df: DataFrame, features: list[str], label: str, key: str, least: int = 1, folds: int = 5, **how) -> list[tuple[int, float, list[str], bool]]:
    """(number, mean held-out RMSE over the folds, features, chosen) while the least important feature is dropped again and again.

    Importances are those of the forest that sees all rows, of the same run (ties: the first name). The step with the least error is chosen.
    """
    steps = []
    while len(features) >= max(least, 1):
        state, forests = fold_forests(df, features, [label], key, folds, **how)
        error = fold_scores(state, forests).agg(F.avg("rmse")).first()[0]
        discard(state)
        steps.append((len(features), error, list(features)))
        drop = min(zip(forests.importances(0), features, strict=True))[1]
        features = [f for f in features if f != drop]
    best = min((e for _, e, _ in steps if e is not None), default=None)
    chosen = next((n for n, e, _ in reversed(steps) if e is not None and e == best), None)
    return [(n, e, f, n == chosen) for n, e, f in steps]


def scores_per_label(df: DataFrame, features: list[str], labels: list[str], key: str, folds: int = 3, **how) -> DataFrame:
    """(label, n, rmse, r2) over the held-out rows of all folds, every label's forests from the same scans; rmse and r2 are means over folds."""
    state, forests = fold_forests(df, features, labels, key, folds, **how)
    return fold_scores(state, forests).groupBy("label").agg(F.sum("n").alias("n"), F.avg("rmse").alias("rmse"), F.avg("r2").alias("r2"))
