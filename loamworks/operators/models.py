"""Feature preparation, model training and inference with MLlib."""

from __future__ import annotations

import itertools
import random
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamworks.operators.aggregates import regression_report
from loamworks.operators.joins import near_pairs, nearest
from loamworks.operators.quantiles import quantiles
from loamworks.operators.sampling import hash_split
from loamworks.session import discard, ship, staged


def assembled(df: DataFrame, features: list[str]) -> DataFrame:
    """``features`` as a vector column; rows with a null are left out."""
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip").transform(df)


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns minus mean over population deviation; constant ones become 0."""
    stats = df.agg(*(f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))))
    out = {c: F.when(F.col(c).isNotNull(), F.coalesce(F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")), F.lit(0.0))) for c in columns}
    return df.crossJoin(F.broadcast(stats)).withColumns(out).drop(*(f"_{n}_{c}" for c in columns for n in "ms"))


def robust_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns minus median over the quartile range."""
    stats = quantiles(df, {f"_{n}_{c}": (c, q) for c in columns for n, q in (("a", 0.25), ("m", 0.5), ("b", 0.75))})
    out = {c: F.when(F.col(c).isNotNull(), F.coalesce(F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_b_{c}") - F.col(f"_a_{c}")), F.lit(0.0))) for c in columns}
    return df.crossJoin(F.broadcast(stats)).withColumns(out).drop(*(f"_{n}_{c}" for c in columns for n in "amb"))


def encode_labels(df: DataFrame, column: str, into: str = "label") -> tuple[DataFrame, DataFrame]:
    """Alphabetical codes from 0, and the mapping as a table."""
    fitted = StringIndexer(inputCol=column, outputCol=into, stringOrderType="alphabetAsc", handleInvalid="keep").fit(df)
    mapping = df.sparkSession.createDataFrame([(i, v) for i, v in enumerate(fitted.labels)], f"{into} int, {column} string")
    return fitted.transform(df).withColumn(into, F.col(into).cast("int")), mapping


def one_hot(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """A 0/1 column per value."""
    return df.withColumns({f"{column}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in values})


def one_hot_vector(df: DataFrame, column: str) -> DataFrame:
    stages = [StringIndexer(inputCol=column, outputCol="_i", stringOrderType="alphabetAsc"), OneHotEncoder(inputCols=["_i"], outputCols=[f"{column}_vector"], dropLast=False)]
    return Pipeline(stages=stages).fit(df).transform(df).drop("_i")


def covariances(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, value) population covariances, one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*(F.covar_pop(a, b).alias(f"{a}|{b}") for a, b in pairs))
    return wide.select(F.inline(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("value")) for a, b in pairs))))


def correlations(df: DataFrame, columns: list[str], label: str | None = None) -> DataFrame:
    """(a, b, value) correlations of all pairs, or of all columns with the label."""
    pairs = [(c, label) for c in columns] if label else list(itertools.combinations(columns, 2))
    wide = df.agg(*(F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs))
    return wide.select(F.inline(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("value")) for a, b in pairs))))


def principal_axes(df: DataFrame, columns: list[str], n: int, into: str = "pc") -> DataFrame:
    """Scores on the first n principal axes of the centred columns."""
    means = df.agg(*(F.avg(c).alias(f"_{c}") for c in columns))
    centred = df.crossJoin(F.broadcast(means)).withColumns({f"_{c}": F.col(c) - F.col(f"_{c}") for c in columns})
    flat = VectorAssembler(inputCols=[f"_{c}" for c in columns], outputCol="_f", handleInvalid="skip").transform(centred)
    out = PCA(k=n, inputCol="_f", outputCol="_p").fit(flat).transform(flat).withColumn(into, vector_to_array("_p"))
    return out.drop("_f", "_p", *(f"_{c}" for c in columns))


def mutual_information(df: DataFrame, feature: str, label: str, bins: int) -> DataFrame:
    """Mutual information of a feature cut into equal bins and a label, from counts."""
    span = df.agg(F.min(feature).alias("_lo"), F.max(feature).alias("_hi"))
    x = F.least(F.floor(F.coalesce(F.try_divide(F.col(feature) - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0)) * bins), F.lit(bins - 1))
    n = df.crossJoin(F.broadcast(span)).select(x.alias("x"), F.col(label).alias("y")).groupBy("x", "y").agg(F.count("*").alias("n"))
    everything = Window.partitionBy()  # bins x classes rows
    p = n.select("x", "y", (F.col("n") / F.sum("n").over(everything)).alias("p"))
    p = p.withColumns({"px": F.sum("p").over(Window.partitionBy("x")), "py": F.sum("p").over(Window.partitionBy("y"))})
    return p.agg(F.lit(feature).alias("feature"), F.sum(F.col("p") * F.log(F.col("p") / (F.col("px") * F.col("py")))).alias("score"))


def mutual_information_ranking(df: DataFrame, features: list[str], label: str, bins: int, digits: int = 12) -> DataFrame:
    """(feature, score, rank): the mutual information of every feature with the label, the highest first (ties by name); one pass over the rows for all.

    Scores that are equal at ``digits`` are ties: who shows fewer asks for them here, so that ranks go with what is shown. A row with a null feature or label counts for nothing there. What is left after counting has bins x classes rows a feature.
    """
    span = df.agg(*(f(x).cast("double").alias(f"_{n}_{x}") for x in features for n, f in (("lo", F.min), ("hi", F.max))))
    spread = F.array(*(F.struct(F.lit(x).alias("feature"), F.col(x).cast("double").alias("v"), F.col(f"_lo_{x}").alias("lo"), F.col(f"_hi_{x}").alias("hi")) for x in features))
    long = df.crossJoin(F.broadcast(span)).select(F.col(label).alias("y"), F.explode(spread).alias("f")).select("y", "f.*").filter("v is not null and y is not null")
    x = F.least(F.floor(F.coalesce(F.try_divide(F.col("v") - F.col("lo"), F.col("hi") - F.col("lo")), F.lit(0.0)) * bins), F.lit(bins - 1))
    n = long.select("feature", x.alias("x"), "y").groupBy("feature", "x", "y").agg(F.count("*").alias("n"))
    of = lambda *keys: F.sum("n").over(Window.partitionBy("feature", *keys))
    part = n.withColumns({"_t": of(), "_x": of("x"), "_y": of("y")})
    scores = part.groupBy("feature").agg(F.sum(F.col("n") / F.col("_t") * F.log(F.col("n") * F.col("_t") / (F.col("_x") * F.col("_y")))).alias("score"))
    return scores.withColumn("rank", F.row_number().over(Window.orderBy(F.round("score", digits).desc(), "feature")))


def forest(df: DataFrame, features: list[str], label: str, trees: int = 20, depth: int = 5, seed: int = 42, classify: bool = False):
    make = RandomForestClassifier if classify else RandomForestRegressor
    return make(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed).fit(assembled(df, features))


def predict(model, df: DataFrame, features: list[str], into: str = "prediction") -> DataFrame:
    """Rows with all features, and the model's prediction."""
    return model.transform(assembled(df, features)).withColumnRenamed("prediction", into).drop("features", "rawPrediction", "probability")


def search(df: DataFrame, features: list[str], label: str, key: str, tries: int = 4, seed: int = 42) -> tuple[dict, float]:
    """Random then fine grid search of forest parameters by hold-out RMSE: (best parameters, its error)."""
    split = hash_split(df, key, 0.25, seed)
    train, test = split.filter("part = 'train'"), split.filter("part = 'test'")
    rng = random.Random(seed)
    coarse = rng.sample([{"trees": t, "depth": d} for t in (5, 10, 20) for d in (3, 5, 7)], tries)

    def error(p: dict) -> float:
        found = predict(forest(train, features, label, seed=seed, **p), test, features)
        return RegressionEvaluator(labelCol=label, metricName="rmse").evaluate(found)

    scored = {tuple(p.items()): error(p) for p in coarse}
    best = dict(min(scored, key=scored.get))
    for p in ({"trees": best["trees"], "depth": best["depth"] + step} for step in (-1, 1)):
        scored[tuple(p.items())] = error(p)
    best = min(scored, key=scored.get)
    return dict(best), scored[best]


def eliminate_features(df: DataFrame, features: list[str], label: str, key: str, least: int, seed: int = 42) -> list[tuple[int, float, list[str]]]:
    """(number, hold-out RMSE, features) while the least important feature is dropped again and again."""
    split = hash_split(df, key, 0.25, seed)
    train, test = split.filter("part = 'train'"), split.filter("part = 'test'")
    steps = []
    while len(features) >= least:
        model = forest(train, features, label, trees=8, depth=4, seed=seed)
        error = RegressionEvaluator(labelCol=label, metricName="rmse").evaluate(predict(model, test, features))
        steps.append((len(features), float(error), list(features)))
        drop = min(zip(model.featureImportances.toArray(), features, strict=True))[1]
        features = [f for f in features if f != drop]
    return steps


def importances(model, features: list[str], df: DataFrame) -> DataFrame:
    """(feature, importance), one row each."""
    return df.sparkSession.createDataFrame([(f, float(v)) for f, v in zip(features, model.featureImportances.toArray(), strict=True)], "feature string, importance double")


def per_label(df: DataFrame, features: list[str], labels: list[str], key: str) -> DataFrame:
    """One model per label; (label, r2, mae, mse, rmse) on the held-out part."""
    split = hash_split(df, key, 0.25)
    rows = None
    for label in labels:
        model = forest(split.filter("part = 'train'"), features, label, trees=8, depth=4)
        report = regression_report(predict(model, split.filter("part = 'test'"), features), label, "prediction").withColumn("label", F.lit(label))
        rows = report if rows is None else rows.unionByName(report)
    return rows


def segmented(df: DataFrame, segment: str, features: list[str], label: str) -> DataFrame:
    """A classifier per segment, each applied to its own segment; predictions united.

    Rows are written once, in a folder for each segment, so a fit reads its own rows only. There is one fit and one
    branch of the union for each segment: meant for tens of segments. Rows without segment have no prediction.
    """
    out = None
    rows = staged(df.filter(F.col(segment).isNotNull()).withColumn("_segment", F.col(segment)), "segments", partition="_segment")
    for (name,) in sorted(df.select(segment).filter(F.col(segment).isNotNull()).distinct().collect()):
        part = rows.filter(F.col("_segment") == name).drop("_segment")
        found = predict(forest(part, features, label, trees=6, depth=4, classify=True), part, features)
        out = found if out is None else out.unionByName(found)
    return out


def tree_spread(model, df: DataFrame, features: list[str]) -> DataFrame:
    """Mean, population deviation and 5th and 95th percentile of the single trees' predictions."""
    flat = assembled(df, features)
    n = len(model.trees)
    for i, tree in enumerate(model.trees):
        flat = tree.transform(flat).withColumnRenamed("prediction", f"_t{i}").drop("rawPrediction", "probability")
    all_ = F.array_sort(F.array(*(F.col(f"_t{i}") for i in range(n))))
    mean = F.aggregate(all_, F.lit(0.0), lambda s, x: s + x) / n
    return flat.withColumns(
        {
            "mean": mean,
            "std": F.sqrt(F.aggregate(all_, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean)) / n),
            "low": F.get(all_, F.lit(int(0.05 * (n - 1)))),
            "high": F.get(all_, F.lit(round(0.95 * (n - 1)))),
        }
    ).drop("features", *(f"_t{i}" for i in range(n)))


def variogram(points: DataFrame, key: str, value: str, reach: float, bins: int) -> DataFrame:
    """(bin, n, distance, gamma): half the mean squared difference of pairs by distance."""
    pairs = near_pairs(points, points, reach).filter(F.col(key) < F.col(f"n_{key}"))
    d = F.sqrt("dist2")
    half = (F.col(value) - F.col(f"n_{value}")) * (F.col(value) - F.col(f"n_{value}")) / 2
    at = F.least(F.floor(d / (reach / bins)), F.lit(bins - 1)).cast("int")
    return pairs.select(at.alias("bin"), d.alias("d"), half.alias("g")).groupBy("bin").agg(F.count("*").alias("n"), F.avg("d").alias("distance"), F.avg("g").alias("gamma"))


def inverse_distance(targets: DataFrame, sites: DataFrame, key: str, site: str, value: str, radius: float | None = None, k: int = 8, other: bool = False) -> DataFrame:
    """``idw``: inverse squared distance mean of the k nearest sites, sought from ``radius`` on; a site at the spot gives its own value.

    With ``other`` a target is left out of its own sites; null without any.
    """
    near = nearest(targets, sites, key, radius, site, k=k, other=other)
    w = 1 / F.greatest(F.col("dist2"), F.lit(1e-12))
    return targets.join(near.groupBy(key).agg((F.sum(w * F.col(f"n_{value}")) / F.sum(w)).alias("idw")), key, "left")


class Variogram(NamedTuple):
    """A variogram model: ``exponential`` (1 - exp(-h / scale)) or ``spherical`` (flat from ``scale`` on), times the sill, plus the nugget beyond 0."""

    model: str
    nugget: float
    sill: float
    scale: float

    def shape(self, h: np.ndarray) -> np.ndarray:
        t = h / self.scale
        return 1 - np.exp(-t) if self.model == "exponential" else np.where(t < 1, 1.5 * t - 0.5 * t**3, 1.0)

    def gamma(self, h: np.ndarray) -> np.ndarray:
        return np.where(h > 0, self.nugget + self.sill * self.shape(h), 0.0)


def _line(f: np.ndarray, g: np.ndarray, w: np.ndarray) -> tuple[float, float, float]:
    """(error, nugget, sill) of the weighted least squares fit g = nugget + sill f with neither below 0."""
    total, ff, gg = w.sum(), (w * f).sum(), (w * g).sum()
    spread = (w * f * f).sum() - ff * ff / total
    sill = ((w * f * g).sum() - ff * gg / total) / spread if spread > 1e-12 else 0.0
    nugget = (gg - sill * ff) / total
    if sill < 0:
        nugget, sill = gg / total, 0.0
    if nugget < 0:
        nugget, sill = 0.0, max(0.0, (w * f * g).sum() / max((w * f * f).sum(), 1e-300))
    return float((w * (g - nugget - sill * f) ** 2).sum()), float(nugget), float(sill)


def fit_variogram(bins: DataFrame, models: tuple[str, ...] = ("spherical", "exponential")) -> Variogram:
    """The model with the least weighted squared error (weight: a bin's pairs by its distance) to the rows of ``variogram``.

    The driver gets one row per bin. For each model the scale is sought on a grid that is refined around its best place; nugget and
    sill follow from each scale by least squares.
    """
    rows = bins.filter("n > 0 and distance > 0").select("distance", "gamma", "n").orderBy("distance").collect()
    if not rows:
        return Variogram(models[0], 0.0, 0.0, 1.0)
    h, g, n = (np.array([r[c] for r in rows], float) for c in ("distance", "gamma", "n"))
    w, best = n / h, None
    for model in models:
        low, high = h.min() / 5, h.max() * 3
        for _ in range(6):
            scales = np.geomspace(low, high, 41)
            fits = [(*_line(Variogram(model, 0.0, 1.0, x).shape(h), g, w), x) for x in scales]
            at = min(range(len(fits)), key=lambda k: fits[k][0])
            low, high = scales[max(at - 1, 0)], scales[min(at + 1, 40)]
            if best is None or fits[at][0] < best[0]:
                best = (fits[at][0], Variogram(model, fits[at][1], fits[at][2], float(fits[at][3])))
    return best[1]


def kriging(
    targets: DataFrame, sites: DataFrame, key: str, site: str, value: str, radius: float | None, sill: float, scale: float, nugget: float = 0.0, k: int = 8, other: bool = False,
    model: str = "exponential", variance: str | None = None,
) -> DataFrame:
    """``kriged``: ordinary kriging from the k nearest sites, sought from ``radius`` on; a column of the name ``variance`` holds the kriging variance.

    One small linear system per target; those of a batch with equally many sites are solved at once, sites on one spot by least
    squares. With ``other`` a target is left out of its own sites. Null without any site.
    """
    ship(targets.sparkSession)
    near = nearest(targets, sites.filter(F.col(value).isNotNull()), key, radius, site, k=k, other=other)
    grouped = near.groupBy(key, "x", "y").agg(F.sort_array(F.collect_list(F.struct("rank", "n_x", "n_y", F.col(f"n_{value}").cast("double").alias("v")))).alias("s"))
    law = Variogram(model, nugget, sill, scale)

    @F.pandas_udf("kriged double, variance double")
    def solve(x: pd.Series, y: pd.Series, s: pd.Series) -> pd.DataFrame:
        out = np.full((len(x), 2), np.nan)
        sizes = s.map(len).to_numpy()
        place = np.column_stack((x, y)).astype(float)
        for n in np.unique(sizes):
            rows = np.flatnonzero(sizes == n)
            p = np.array([[(r["n_x"], r["n_y"], r["v"]) for r in s.iloc[i]] for i in rows], float)
            a = np.ones((len(rows), n + 1, n + 1))
            a[:, n, n] = 0
            gap = p[:, :, None, :2] - p[:, None, :, :2]
            a[:, :n, :n] = law.gamma(np.hypot(gap[..., 0], gap[..., 1]))
            away = p[:, :, :2] - place[rows][:, None, :]
            b = np.concatenate((law.gamma(np.hypot(away[..., 0], away[..., 1])), np.ones((len(rows), 1))), axis=1)
            weights = np.einsum("nij,nj->ni", np.linalg.pinv(a), b)
            out[rows, 0], out[rows, 1] = (weights[:, :n] * p[:, :, 2]).sum(1), np.maximum((weights * b).sum(1), 0)
        return pd.DataFrame(out, columns=["kriged", "variance"])

    solved = grouped.select(key, solve("x", "y", "s").alias("_k")).select(key, F.col("_k.kriged").alias("kriged"), *([F.col("_k.variance").alias(variance)] if variance else []))
    return targets.join(solved, key, "left")


def _residuals_kriged(train: DataFrame, test: DataFrame, features: list[str], label: str, key: str, reach: float, bins: int) -> tuple[DataFrame, DataFrame, Variogram]:
    """Predictions of a forest for ``test``, the same with its kriged residuals, and the variogram that was fitted to these."""
    model = forest(train, features, label, trees=8, depth=4)
    residual = staged(predict(model, train, features).select(F.col(key).alias("site"), "x", "y", (F.col(label) - F.col("prediction")).alias("residual")), "residuals")
    law = fit_variogram(variogram(residual, "site", "residual", reach, bins))
    plain = staged(predict(model, test, features), "plain")
    both = kriging(plain, residual, key, "site", "residual", None, law.sill, law.scale, law.nugget, model=law.model, variance="variance")
    return plain, both.withColumn("prediction", F.col("prediction") + F.coalesce("kriged", F.lit(0.0))).drop("kriged"), law


def regression_kriging(df: DataFrame, features: list[str], label: str, key: str, reach: float, bins: int = 10) -> DataFrame:
    """(model, r2, ..., chosen, variogram, nugget, sill, scale) on held-out sites: the forest alone, and with its residuals kriged; the better one is ``chosen``."""
    split = hash_split(df, key, 0.25)
    plain, both, law = _residuals_kriged(split.filter("part = 'train'"), split.filter("part = 'test'"), features, label, key, reach, bins)
    report = regression_report(plain, label, "prediction").withColumn("model", F.lit("forest")).unionByName(regression_report(both, label, "prediction").withColumn("model", F.lit("forest + kriged residuals")))
    best = report.agg(F.max_by("model", F.struct("r2", F.length("model"))).alias("_best"))
    fitted = {"variogram": F.lit(law.model), "nugget": F.lit(law.nugget), "sill": F.lit(law.sill), "scale": F.lit(law.scale)}
    return report.crossJoin(F.broadcast(best)).withColumn("chosen", F.col("model") == F.col("_best")).drop("_best").withColumns(fitted)


def best_predictions(df: DataFrame, targets: DataFrame, features: list[str], label: str, key: str, reach: float, bins: int = 10) -> DataFrame:
    """(key, prediction, variance, model) of targets that have the features and x, y: by the forest, with kriged residuals if these did better on held-out sites."""
    chosen = regression_kriging(df, features, label, key, reach, bins).filter("chosen").first()["model"]
    plain, both, _ = _residuals_kriged(df, targets, features, label, key, reach, bins)
    found = plain.withColumn("variance", F.lit(None).cast("double")) if chosen == "forest" else both
    return found.select(key, "prediction", "variance", F.lit(chosen).alias("model"))


def boosted(df: DataFrame, features: list[str], label: str, rounds: int = 10, depth: int = 3, seed: int = 42):
    return GBTRegressor(featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=depth, seed=seed).fit(assembled(df, features))


class QuantileTrees(NamedTuple):
    """Boosted trees for one quantile: a start value, the rate, and per tree its splits {node: (feature, edge)} and leaves {node: value}; node n has the children 2n and 2n + 1."""

    features: list[str]
    start: float
    rate: float
    trees: list[tuple[dict[int, tuple[int, float]], dict[int, float]]]

    def node(self, splits: dict[int, tuple[int, float]]) -> Column:
        """The leaf of a row, by comparisons alone."""

        def below(n: int) -> Column:
            if n not in splits:
                return F.lit(n)
            feature, edge = splits[n]
            return F.when(F.col(self.features[feature]) <= edge, below(2 * n)).otherwise(below(2 * n + 1))

        return below(1)

    def value(self) -> Column:
        out = F.lit(self.start)
        for splits, leaves in self.trees:
            table = F.create_map(*(F.lit(x) for leaf in leaves.items() for x in leaf))
            out = out + self.rate * F.coalesce(F.element_at(table, self.node(splits)), F.lit(0.0))
        return out


def _best_split(g: np.ndarray, n: np.ndarray, least: int) -> tuple[float, int]:
    """(gain, bin) of the cut behind a bin that raises the sum of squared gradient means most; gain 0 without any."""
    left_g, left_n = np.cumsum(g)[:-1], np.cumsum(n)[:-1]
    right_g, right_n = g.sum() - left_g, n.sum() - left_n
    ok = (left_n >= least) & (right_n >= least)
    if not ok.any():
        return 0.0, 0
    gain = np.where(ok, left_g**2 / np.maximum(left_n, 1) + right_g**2 / np.maximum(right_n, 1) - g.sum() ** 2 / max(n.sum(), 1), 0)
    at = int(gain.argmax())
    return float(gain[at]), at


def boosted_quantile(df: DataFrame, features: list[str], label: str, share: float, rounds: int = 12, depth: int = 3, rate: float = 0.3, bins: int = 32, least: int = 20) -> QuantileTrees:
    """Gradient boosting on the pinball loss of a quantile ``share``.

    A level of a tree is one aggregate: gradient sums by (node, feature, bin); the driver gets 2^depth x features x bins numbers and
    takes the best cuts. A leaf's value is the exact quantile of its rows' residuals. Bin edges are exact quantiles of the features.
    Rows with a null feature or label take no part.
    """
    rows = staged(df.select(*(F.col(f).cast("double").alias(f) for f in features), F.col(label).cast("double").alias("_y")).dropna(), "rows")
    asked = {f"e{i}_{k}": (f, k / bins) for i, f in enumerate(features) for k in range(1, bins)}
    got = quantiles(rows, asked | {"start": ("_y", share)}).first()
    if got is None or got["start"] is None:
        return QuantileTrees(features, 0.0, rate, [])
    edges = [sorted({got[f"e{i}_{k}"] for k in range(1, bins)}) for i in range(len(features))]
    place = lambda i: F.aggregate(F.array(*(F.lit(e) for e in edges[i])), F.lit(0), lambda n, e: n + (F.col(features[i]) > e).cast("int"))
    model = QuantileTrees(features, float(got["start"]), rate, [])
    state = staged(rows.select(*features, "_y", F.array(*(place(i) for i in range(len(features)))).alias("_bins"), F.lit(model.start).alias("_f")), "boosting")
    for _ in range(rounds):
        splits: dict[int, tuple[int, float]] = {}
        for level in range(depth):
            node = model.node(splits)
            slope = F.when(F.col("_y") > F.col("_f"), share).otherwise(share - 1)
            sums = state.select(node.alias("node"), slope.alias("g"), F.posexplode("_bins").alias("feature", "bin")).filter(F.col("node") >= 2**level)
            table = sums.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.count("*").alias("n")).collect()
            held: dict[int, dict[int, np.ndarray]] = {}
            for r in table:
                held.setdefault(r["node"], {}).setdefault(r["feature"], np.zeros((2, bins)))[:, r["bin"]] = r["g"], r["n"]
            for n, by_feature in held.items():
                gain, at, feature = max(((*_best_split(*x, least), -i) for i, x in by_feature.items()), key=lambda t: (t[0], t[2]))
                feature = -feature
                if gain > 1e-9 and at < len(edges[feature]):
                    splits[n] = feature, edges[feature][at]
        leaf = state.select(model.node(splits).alias("leaf"), (F.col("_y") - F.col("_f")).alias("d"))
        leaves = {r["leaf"]: float(r["v"]) for r in quantiles(leaf, {"v": ("d", share)}, ["leaf"]).collect()}
        model.trees.append((splits, leaves))
        step = F.element_at(F.create_map(*(F.lit(x) for one in leaves.items() for x in one)), model.node(splits))
        before, state = state, staged(state.withColumn("_f", F.col("_f") + rate * step), "boosting")
        discard(before)
    discard(state)
    return model


def quantile_band(df: DataFrame, targets: DataFrame, features: list[str], label: str, low: float = 0.05, high: float = 0.95, **how) -> DataFrame:
    """``targets`` with ``low`` and ``high``: bounds between which a row's label lies with a chance of ``high`` - ``low``; crossed bounds are exchanged."""
    one, two = (boosted_quantile(df, features, label, q, **how).value() for q in (low, high))
    return targets.withColumns({"_a": one, "_b": two}).withColumns({"low": F.least("_a", "_b"), "high": F.greatest("_a", "_b")}).drop("_a", "_b")


def tree_rules(df: DataFrame, features: list[str], label: str, depth: int = 3) -> str:
    """A decision tree's rules as text."""
    return DecisionTreeClassifier(featuresCol="features", labelCol=label, maxDepth=depth, seed=42).fit(assembled(df, features)).toDebugString


def two_models(first, second, cells: DataFrame, features: list[str], masked, unknown: float = -1.0) -> DataFrame:
    """Predictions of two models; masked cells get the unknown label; ``merged`` takes the first; ``agree`` says whether they agree."""
    out = predict(second, predict(first, cells, features, "one"), features, "two")
    out = out.withColumns({c: F.when(masked, unknown).otherwise(F.col(c)) for c in ("one", "two")})
    return out.withColumns({"merged": F.col("one"), "agree": (F.col("one") == F.col("two")).cast("int")})


def retrain(old: DataFrame, new: DataFrame, features: list[str], label: str):
    """A model from old and new samples; from the new alone where their columns differ."""
    same = set(features) <= set(old.columns)
    data = old.select(*features, label).unionByName(new.select(*features, label)) if same else new
    return forest(data, features, label, trees=8, depth=4), data


def silhouette(found: DataFrame, features: list[str], weight: str) -> float:
    """Mean silhouette by squared distance over rows that stand for ``weight`` rows each; rows without company in their cluster have 0, and so have all if there is one cluster.

    A copy of a row is one of its company: MLlib's own weights leave all copies of a row out of it. The driver gets a row per cluster.
    """
    w = F.col(weight)
    sums = found.groupBy("prediction").agg(F.sum(w).alias("n"), F.array(*(F.sum(w * F.col(f)) / F.sum(w) for f in features)).alias("m"), F.sum(w * sum((F.col(f) * F.col(f) for f in features), F.lit(0.0))).alias("q"))
    own, other = [], [F.lit(None).cast("double")] * 2
    for c, n, m, q in sums.collect():
        away = sum((F.col(f) * F.col(f) - 2 * F.col(f) * x for f, x in zip(features, m, strict=True)), F.lit(q / n))
        own.append(F.when(F.col("prediction") == c, away * n / (n - 1) if n > 1 else None))
        other.append(F.when(F.col("prediction") != c, away))
    a, b = F.coalesce(*own, F.lit(None).cast("double")), F.least(*other)
    each = F.coalesce(F.when(a < b, 1 - F.try_divide(a, b)).when(a > b, F.try_divide(b, a) - 1), F.lit(0.0))
    return float(found.agg(F.sum(w * each) / F.sum(w)).first()[0])


#: Different points of a partition that k-means goes through, about.
POINTS = 50_000


def clusters(df: DataFrame, features: list[str], ks: list[int], seed: int = 42) -> list[tuple[int, float, float]]:
    """(k, cost, silhouette) of k-means on standardised features.

    Equal points are one that weighs as many: costs, centres and silhouettes are those of all rows, and a pass over them costs what
    the different points do. Points are dealt by their values and sorted, so a run gives the same again.
    """
    points = assembled(standardise(df.select(*features), features), features).groupBy(*features).agg(F.count("*").cast("double").alias("_n"))
    points = staged(points, "points")
    parts = max(1, -(-points.count() // POINTS))
    flat = assembled(points.repartition(parts, *features).sortWithinPartitions(*features), features).persist()
    out = []
    for k in ks:
        model = KMeans(k=k, seed=seed, weightCol="_n").fit(flat)
        out.append((k, float(model.summary.trainingCost), silhouette(model.transform(flat), features, "_n")))
    flat.unpersist()
    discard(points)
    return out


def elbow(costs: list[tuple[int, float]]) -> int:
    """The k whose cost lies farthest from the chord between the first and last."""
    (x0, y0), (x1, y1) = costs[0], costs[-1]
    far = [abs((y1 - y0) * x - (x1 - x0) * y + x1 * y0 - y1 * x0) for x, y in costs]
    return costs[far.index(max(far))][0]


def representatives(df: DataFrame, key: str, by: str, features: list[str], k: int, seed: int = 42, rounds: int = 200, settled: str | None = None) -> DataFrame:
    """(key, class, cluster): the row nearest to each cluster centre of each class: k-means of all classes at once, one aggregate a round.

    Rounds go on until no centre moves; a column of the name ``settled`` tells whether that was before ``rounds`` of them. Centres
    stay tables and are joined by class. A class of fewer rows has fewer clusters; rows with a null feature are in none.
    """
    rows = staged(df.select(key, by, *(F.col(f).cast("double").alias(f) for f in features)).dropna(), "points")
    w = Window.partitionBy(by).orderBy(F.xxhash64(F.lit(seed), key), key)
    at = F.array(*features)
    first = rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k)
    centres = staged(first.select(by, (F.col("_n") - 1).alias("cluster"), at.alias("at")), "centres")

    def assigned(centres: DataFrame) -> DataFrame:
        table = centres.groupBy(by).agg(F.collect_list(F.struct("cluster", "at")).alias("_centres"))
        d = lambda x: sum(((F.col(f) - F.get(x["at"], F.lit(i))) ** 2 for i, f in enumerate(features)), F.lit(0.0))
        least = F.array_min(F.transform("_centres", lambda x: F.struct(d(x).alias("d"), x["cluster"].alias("cluster"))))
        return rows.join(table, by).withColumn("_least", least).select(key, by, *features, F.col("_least.d").alias("_d"), F.col("_least.cluster").alias("cluster"))

    still = False
    for _ in range(rounds):
        moved = staged(assigned(centres).groupBy(by, "cluster").agg(F.array(*(F.round(F.avg(f), 12) for f in features)).alias("at")), "centres")
        still = moved.join(centres, [by, "cluster", "at"], "left_anti").isEmpty()
        discard(centres)
        centres = moved
        if still:
            break
    best = assigned(centres).groupBy(by, "cluster").agg(F.min(F.struct("_d", key)).alias("_m"))
    return best.select(F.col(f"_m.{key}").alias(key), by, "cluster", *([F.lit(still).alias(settled)] if settled else []))


def lagged_regression(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """(term, coefficient) of an ordinary least squares fit."""
    model = LinearRegression(featuresCol="features", labelCol=label).fit(assembled(df, features))
    rows = [*zip(features, map(float, model.coefficients), strict=True), ("intercept", float(model.intercept))]
    return df.sparkSession.createDataFrame(rows, "term string, coefficient double")
