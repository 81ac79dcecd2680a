"""Classifier pool on MLlib (M1-M9, M11) and feature assembly.

Preparation statistics are fitted once per training part and reused by every
candidate (the reference refits them per candidate).  Candidates without an
MLlib counterpart are re-aimed and named for what they are:
``full_sample_forest`` (random forest without bootstrap, for extra trees),
``rff_svm`` (random Fourier features + calibrated linear SVM, for RBF SVC),
``knn_vote`` (exact k nearest neighbours over blocks of the training rows).

Fixed settings where the re-aim has no counterpart to copy: ``RFF_COMPONENTS``
random features, ``SVC_MAX_ITER`` optimiser iterations, ``CALIBRATION_FOLDS``
folds for held-out margins.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelens.functions.blocked import block_pairs
from tablelens.operators import prep as E
from tablelens.operators.metrics import sigmoid
from tablelens.session import checkpoint_dir

MLLIB_MAX_DEPTH = 30  # MLlib grows no deeper tree; the rule's "no limit" becomes this
RFF_COMPONENTS = 100
SVC_MAX_ITER = 200
CALIBRATION_FOLDS = 3
MAX_CLASSES = 10_000  # more distinct targets are no classification problem (they would reach the driver)
UNKNOWN = "__unknown__"  # never fitted, so the encoder gives it zeros


# ------------------------------------------------------------------ settings as column rules
def settings_columns(rows: Column, prefer_simple: Column) -> list[Column]:
    """Per-profile model sizes (forest/boosting sizes, depths, leaf size, neighbours, C)."""
    return [
        F.when(rows >= 10000, 250).otherwise(350).alias("forest_trees"),
        F.when(prefer_simple, 8).cast("double").alias("forest_max_depth"),
        F.when(rows < 1000, 2).otherwise(1).alias("forest_min_leaf"),
        F.when(rows >= 5000, 300).otherwise(400).alias("full_sample_trees"),
        F.when(prefer_simple, 10).cast("double").alias("full_sample_max_depth"),
        F.when(prefer_simple, 0.05).otherwise(0.1).alias("gbt_step"),
        F.when(rows >= 10000, 100).otherwise(150).alias("gbt_rounds"),
        F.when(prefer_simple, 2).otherwise(3).alias("gbt_depth"),
        F.when(prefer_simple, 0.5).otherwise(1.0).alias("svc_c"),
        F.when(rows > 1000, 7).otherwise(5).alias("knn_k"),
    ]


# ------------------------------------------------------------------ preparation (fit once, reuse)
class Prepared:
    """Fitted preparation: fills, scaling, category mapping and the MLlib encoder pipeline."""

    def __init__(self, numeric, categorical, fills, scaler, modes, rare, encoder):
        self.numeric, self.categorical = numeric, categorical
        self.fills, self.scaler, self.modes, self.rare, self.encoder = fills, scaler, modes, rare, encoder

    def encode(self, df: DataFrame) -> DataFrame:
        """Fill, scale, and map categories; a level that was not seen in fitting stays apart from the rare ones."""
        out = E.apply_scaler(E.apply_fill(df, self.fills), self.scaler) if self.numeric else df
        for c in self.categorical:
            out = out.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit(self.modes.get(c))))
        if self.rare is not None:
            for c in self.categorical:
                m = self.rare.filter(F.col("column_name") == c).select(F.col("category").alias(c), F.col("encoded").alias("_enc"))
                out = out.join(m, on=c, how="left").withColumn(c, F.coalesce(F.col("_enc"), F.lit(UNKNOWN))).drop("_enc")
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        return self.encoder.transform(self.encode(df))


def fit_preparation(train: DataFrame, numeric: list[str], categorical: list[str], max_missing_pct: float,
                    group_rare: bool, profile_rows: int) -> Prepared:
    """Impute (mean/median by profile), scale, mode-fill, rare-group/cap, one-hot, assemble.

    A numeric column without any present value is dropped.
    """
    fills = E.fit_imputer(train, numeric, max_missing_pct) if numeric else {}
    numeric = [c for c in numeric if fills[c] is not None]
    fills = {c: fills[c] for c in numeric}
    filled = E.apply_fill(train, fills)
    scaler = E.fit_scaler(filled, numeric) if numeric else {}
    modes = {r["column_name"]: r["mode"] for r in E.fit_modes(train, categorical).collect()} if categorical else {}
    rare = None
    if group_rare and categorical:
        cat_filled = filled
        for c in categorical:
            cat_filled = cat_filled.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit(modes.get(c))))
        rare = E.rare_category_table(cat_filled, categorical, profile_rows=profile_rows)
        checkpoint_dir(train.sparkSession)
        rare = rare.checkpoint()
    stages = []
    idx = [f"{c}__idx" for c in categorical]
    ohe = [f"{c}__ohe" for c in categorical]
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=idx, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True))
    stages.append(VectorAssembler(inputCols=numeric + ohe, outputCol="features", handleInvalid="keep"))
    prepared = Prepared(numeric, categorical, fills, scaler, modes, rare, None)
    prepared.encoder = Pipeline(stages=stages).fit(prepared.encode(train))
    return prepared


# ------------------------------------------------------------------ candidates
def predict_majority(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """M1: most frequent training class (ties to the smallest) for every row."""
    counts = train.filter(F.col(label).isNotNull()).groupBy(label).count()
    mode = counts.agg(F.min_by(label, F.struct((-F.col("count")).alias("n"), F.col(label))).alias("_m")).first()["_m"]
    # one scalar reaches the driver and returns as a literal
    return test.withColumn("prediction", F.lit(mode).cast(train.schema[label].dataType))


ROWS_PER_PARTITION = 100_000


def spread(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt into partitions of about ROWS_PER_PARTITION; as it is if one would do."""
    target = math.ceil(rows / ROWS_PER_PARTITION)
    return df.repartition(target) if target > 1 else df


def _sized(train: DataFrame) -> DataFrame:
    """Partitions of about ROWS_PER_PARTITION rows, merged or dealt out, before an iterative fit.

    Every optimiser iteration is one Spark job over all partitions; a few
    hundred rows spread over many partitions pay scheduling per task on every
    iteration, and a table that comes in few partitions would be read whole by
    few tasks.  The partition count grows with the rows, without a limit.
    """
    target = max(1, math.ceil(train.count() / ROWS_PER_PARTITION))
    parts = train.rdd.getNumPartitions()
    if target == 1 or parts > 2 * target:
        return train.coalesce(target)
    if parts >= target:  # merging a few would double the rows of one
        return train
    checkpoint_dir(train.sparkSession)
    return train.repartition(target).checkpoint()  # dealt out once, read by every iteration


def _weight_sum(df: DataFrame, weight_col: str | None) -> float:
    if weight_col is None:
        return float(df.count())
    return float(df.agg(F.sum(weight_col)).first()[0])


def make_estimator(name: str, settings: dict, n_classes: int, weight_col: str | None, weight_sum: float,
                   seed: int = 42):
    """MLlib estimator for a pool name (label column 'label_idx', features 'features')."""
    common = dict(featuresCol="features", labelCol="label_idx")
    if name == "LogisticRegression":
        # a C=1 L2 penalty over summed losses equals regParam = 1 / sum(weights)
        return LogisticRegression(maxIter=2500, regParam=1.0 / max(weight_sum, 1.0), elasticNetParam=0.0,
                                  standardization=False, weightCol=weight_col or "", **common) if weight_col else \
            LogisticRegression(maxIter=2500, regParam=1.0 / max(weight_sum, 1.0), standardization=False, **common)
    if name == "RandomForest":
        kw = dict(numTrees=settings["forest_trees"], maxDepth=settings["forest_max_depth"] or MLLIB_MAX_DEPTH,
                  minInstancesPerNode=settings["forest_min_leaf"], seed=seed, **common)
        return RandomForestClassifier(weightCol=weight_col, **kw) if weight_col else RandomForestClassifier(**kw)
    if name == "ExtraTrees":
        kw = dict(numTrees=settings["full_sample_trees"], bootstrap=False, featureSubsetStrategy="sqrt",
                  maxDepth=settings["full_sample_max_depth"] or MLLIB_MAX_DEPTH, seed=seed, **common)
        return RandomForestClassifier(weightCol=weight_col, **kw) if weight_col else RandomForestClassifier(**kw)
    if name == "GradientBoosting":
        gbt = GBTClassifier(stepSize=settings["gbt_step"], maxIter=settings["gbt_rounds"],
                            maxDepth=settings["gbt_depth"], seed=seed, **common)
        return gbt if n_classes <= 2 else OneVsRest(classifier=gbt, **common)
    if name in ("LinearSVC", "SVC_RBF", "SVC_LinearProb"):
        c = {"LinearSVC": settings["svc_c"], "SVC_RBF": 1.0, "SVC_LinearProb": 0.8}[name]
        kw = dict(regParam=1.0 / (c * max(weight_sum, 1.0)), maxIter=SVC_MAX_ITER, standardization=False, **common)
        svc = LinearSVC(weightCol=weight_col, **kw) if weight_col else LinearSVC(**kw)
        if n_classes <= 2:
            return svc
        return OneVsRest(classifier=svc, weightCol=weight_col, **common) if weight_col else OneVsRest(classifier=svc, **common)
    raise ValueError(f"no MLlib estimator for {name}")


def rff_features(df: DataFrame, dim: int, n_components: int = RFF_COMPONENTS, gamma: float | None = None, seed: int = 42,
                 var: float = 1.0) -> DataFrame:
    """M8 re-aim: random Fourier features sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma) (Rahimi & Recht, 2007).

    gamma defaults to 1 / (d * var(X)), the 'scale' rule.  The projection is a
    fixed (dim x D) matrix applied as array expressions, no Python per row.
    """
    g = gamma if gamma is not None else 1.0 / (dim * max(var, 1e-12))
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * g), size=(n_components, dim))
    b = rng.uniform(0.0, 2.0 * math.pi, size=n_components)
    x = vector_to_array(F.col("features"))
    comps = []
    for j in range(n_components):
        wj = F.array(*[F.lit(float(v)) for v in w[j]])
        dot = F.aggregate(F.zip_with(x, wj, lambda a, c: a * c), F.lit(0.0), lambda acc, v: acc + v)
        comps.append(F.lit(math.sqrt(2.0 / n_components)) * F.cos(dot + F.lit(float(b[j]))))
    return df.withColumn("features", array_to_vector(F.array(*comps)))


def feature_variance(df: DataFrame, vec: str = "features") -> float:
    """Variance over all entries of a vector column (one aggregate)."""
    x = vector_to_array(F.col(vec))
    total = F.aggregate(x, F.lit(0.0), lambda a, v: a + v)
    square = F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v)
    r = df.agg(F.sum(total).alias("s"), F.sum(square).alias("q"), F.sum(F.size(x)).alias("n")).first()
    return max(r["q"] / r["n"] - (r["s"] / r["n"]) ** 2, 0.0) if r["n"] else 0.0


PAIR_CELLS = 1 << 19  # distances a task holds at once
DENSE = 4  # over one candidate in so many pairs, all distances are computed


def _distances(xq: np.ndarray, xt: np.ndarray) -> np.ndarray:
    """Squared L2 distances of all pairs, summed in the order of the dimensions."""
    d = np.zeros((len(xq), len(xt)))
    for j in range(xq.shape[1]):  # sequential over dimensions, vectorised over pairs
        diff = xq[:, j][:, None] - xt[:, j][None, :]
        d += diff * diff
    return d


def nearest_rows(xq: np.ndarray, xt: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of xq, row of xt, distance) of the k nearest per row of xq, ties to the earlier row of xt: exact.

    A matrix product gives distances up to a bound of its rounding error; only pairs that may be among the k nearest by
    it get their distance summed.  Rows of xq go in chunks, so ``PAIR_CELLS`` pairs are held at once.
    """
    k = min(k, len(xt))
    dim, chunk = xq.shape[1], max(1, PAIR_CELLS // max(1, len(xt)))
    with np.errstate(over="ignore", invalid="ignore"):
        sq, st = (xq * xq).sum(axis=1), (xt * xt).sum(axis=1)
        slack = (4 * dim + 32) * np.finfo(np.float64).eps * (np.sqrt(sq) + np.sqrt(st.max(initial=0.0))) ** 2
    parts = []
    for lo in range(0, len(xq), chunk):
        q, here = xq[lo : lo + chunk], slice(lo, lo + chunk)
        may = None
        if k < len(xt) and dim > 0:
            with np.errstate(over="ignore", invalid="ignore"):
                near = (q @ xt.T) * -2.0
                near += sq[here, None]
                near += st[None, :]
            if np.isfinite(near).all() and np.isfinite(slack[here]).all():
                may = near <= np.partition(near, k - 1, axis=1)[:, k - 1, None] + 2 * slack[here, None]
        if may is None or may.sum() * DENSE > may.size:
            d = _distances(q, xt)
            # stable sort on distance keeps the earlier row first among equal distances
            at = np.argsort(d, axis=1, kind="stable")[:, :k]
            rows = np.repeat(np.arange(len(q)), at.shape[1])
            parts.append((rows + lo, at.reshape(-1), d[rows, at.reshape(-1)]))
            continue
        rows, at = np.nonzero(may)  # in the order of xt in each row
        d = np.zeros(len(rows))
        for j in range(dim):
            diff = q[rows, j] - xt[at, j]
            d += diff * diff
        order = np.lexsort((d, rows))
        rows, at, d = rows[order], at[order], d[order]
        first = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        parts.append((rows[first] + lo, at[first], d[first]))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def knn_vote(train: DataFrame, test: DataFrame, key: str, vec: str, label: str, k: int,
             positive=None, block_rows: int | None = None) -> DataFrame:
    """M7: exact k nearest neighbours (squared L2, ties by key) and majority vote (ties to the smallest label).

    Blocks of test rows meet blocks of training rows, each pair keeps its k
    nearest per test row (``nearest_rows``), and those are ranked per test row: exact at any size.
    With ``positive`` a ``score`` column gives that label's share of the votes.
    """
    names = ["_q", "_k", "_label", "_d"]

    def nearest(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if q.empty or t.empty:
            return pd.DataFrame({n: [] for n in names})
        t = t.sort_values("_k", kind="stable")
        xq = np.array([np.asarray(v, dtype=np.float64) for v in q["_v"]])
        xt = np.array([np.asarray(v, dtype=np.float64) for v in t["_v"]])
        rows, at, d = nearest_rows(xq, xt, k)
        return pd.DataFrame({"_q": q["_q"].to_numpy()[rows], "_k": t["_k"].to_numpy()[at], "_label": t["_label"].to_numpy()[at], "_d": d})

    schema = T.StructType([
        T.StructField("_q", test.schema[key].dataType), T.StructField("_k", train.schema[key].dataType),
        T.StructField("_label", train.schema[label].dataType), T.StructField("_d", T.DoubleType()),
    ])
    rows = {"rows": block_rows} if block_rows else {}
    cand = block_pairs(test.select(F.col(key).alias("_q"), F.col(vec).alias("_v")),
                       train.select(F.col(key).alias("_k"), F.col(vec).alias("_v"), F.col(label).alias("_label")), nearest, schema, **rows)
    w = Window.partitionBy("_q").orderBy("_d", "_k")  # k candidates per block of training rows
    top = cand.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
    votes = top.groupBy("_q", "_label").agg(F.count(F.lit(1)).alias("_c"))
    out = [F.min_by("_label", F.struct((-F.col("_c")).alias("n"), F.col("_label"))).alias("prediction")]
    if positive is not None:
        out.append((F.sum(F.when(F.col("_label") == F.lit(positive), F.col("_c")).otherwise(0)) / F.sum("_c")).alias("score"))
    return votes.groupBy(F.col("_q").alias(key)).agg(*out)


def _margin(df: DataFrame) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.array(vector_to_array("rawPrediction")[1])))


def fit_platt(estimator, train: DataFrame, key: str):
    """Logistic regression on SVM margins of held-out rows: each fold's margins come from a model of the other folds.

    Where the other folds hold one class only, the fold's margins are that class's side (1 or -1), 0 where they are empty.
    """
    fold = F.pmod(F.xxhash64(F.lit("calibrate"), F.col(key)), F.lit(CALIBRATION_FOLDS))
    sides = {r["f"]: r["c"] for r in train.groupBy(fold.alias("f")).agg(F.collect_set("label_idx").alias("c")).collect()}  # two classes
    margins = None
    for f in sides:
        rest, held = train.filter(fold != f), train.filter(fold == f)
        left = {c for g, found in sides.items() if g != f for c in found}
        if len(left) < 2:
            side = {0.0: -1.0, 1.0: 1.0}[left.pop()] if left else 0.0
            got = held.select(array_to_vector(F.array(F.lit(side))).alias("features"), "label_idx")
        else:
            got = _margin(estimator.fit(rest).transform(held)).select("features", "label_idx")
        margins = got if margins is None else margins.unionByName(got)
    return LogisticRegression(featuresCol="features", labelCol="label_idx", maxIter=100).fit(margins)


def couple(r: np.ndarray) -> np.ndarray:
    """Class probabilities (n, k) from pairwise ones r[:, i, j] = P(i given i or j) (Wu, Lin and Weng, 2004).

    They minimise the sum of (r_ji p_i - r_ij p_j)^2 under a total of 1: one linear system a row.
    """
    n, k = r.shape[0], r.shape[1]
    r = np.clip(r, 1e-7, 1 - 1e-7)
    other = np.where(np.eye(k, dtype=bool), 0.0, r)
    system = np.zeros((n, k + 1, k + 1))
    system[:, :k, :k] = -other * other.transpose(0, 2, 1)
    system[:, range(k), range(k)] = (other ** 2).sum(axis=1)
    system[:, :k, k] = system[:, k, :k] = 1.0
    right = np.zeros((n, k + 1, 1))
    right[:, k] = 1.0
    p = np.clip(np.linalg.solve(system, right)[:, :k, 0], 0.0, None)
    return p / p.sum(axis=1, keepdims=True)


def fit_pairwise(name: str, train: DataFrame, tests: list, settings: dict, n_classes: int, key: str, weight_col: str | None, seed: int) -> list:
    """M8/M9 above two classes: one calibrated SVM per pair of classes; votes predict (ties: smallest class), coupling gives ``probability``.

    A class without training rows gets probability 0.
    """
    classes = sorted(r[0] for r in train.select("label_idx").distinct().collect())  # the rule allows five
    pairs = [(i, j) for i in range(len(classes)) for j in range(i + 1, len(classes))]
    weights, shifts, curves = [], [], []
    for i, j in pairs:
        two = train.filter(F.col("label_idx").isin(classes[i], classes[j])).withColumn("label_idx", (F.col("label_idx") == classes[i]).cast("double"))
        est = make_estimator(name, settings, 2, weight_col, _weight_sum(two, weight_col), seed)
        model, platt = est.fit(two), fit_platt(est, two, key)
        weights.append(model.coefficients.toArray())
        shifts.append(float(model.intercept))
        curves.append((float(platt.coefficients[0]), float(platt.intercept)))
    w, b, c = np.array(weights), np.array(shifts), np.array(curves)
    k, places = len(classes), [int(v) for v in classes]

    def score(x: pd.Series) -> pd.DataFrame:
        n = len(x)
        votes, r = np.zeros((n, k)), np.full((n, k, k), 0.5)
        if n and pairs:
            margin = np.stack(x.to_list()).astype(np.float64) @ w.T + b
            p = 1.0 / (1.0 + np.exp(-np.clip(margin * c[:, 0] + c[:, 1], -500, 500)))
            for m, (i, j) in enumerate(pairs):
                votes[:, i] += margin[:, m] > 0
                votes[:, j] += margin[:, m] <= 0
                r[:, i, j], r[:, j, i] = p[:, m], 1.0 - p[:, m]
        whole = np.zeros((n, n_classes))
        whole[:, places] = couple(r) if k > 1 else 1.0
        best = np.array(places, dtype=np.float64)[votes.argmax(axis=1)] if n else np.zeros(0)
        return pd.DataFrame({"prediction": best, "probability": list(whole)})

    scored = F.pandas_udf(score, "prediction double, probability array<double>")
    return [t.withColumn("_s", scored(vector_to_array("features"))).select(
        *t.columns, F.col("_s.prediction").alias("prediction"), array_to_vector("_s.probability").alias("probability"),
        F.lit(None).cast("double").alias("score")) for t in tests]


def fit_predict(name: str, train: DataFrame, test, settings: dict, n_classes: int, key: str,
                weight_col: str | None, seed: int = 42, threshold: float | None = None, probabilities: bool = False):
    """Fit one MLlib candidate once; score ``test`` (a DataFrame or a list of them).

    With ``probabilities`` the calibrated SVMs have class probabilities above two
    classes too, from five fits a pair of classes (``fit_pairwise``).  Binary candidates get a positive-class ``score``; with ``threshold`` the
    prediction is ``score >= threshold`` (K2).
    """
    tests = test if isinstance(test, list) else [test]
    train = _sized(train)
    w_sum = _weight_sum(train, weight_col)
    if name == "SVC_RBF":
        dim, var = len(train.select("features").first()[0]), feature_variance(train)
        checkpoint_dir(train.sparkSession)
        train = rff_features(train, dim, seed=seed, var=var).checkpoint()  # the optimiser reads it every iteration
        tests = [rff_features(t, dim, seed=seed, var=var) for t in tests]
    if probabilities and name in ("SVC_LinearProb", "SVC_RBF") and n_classes > 2:
        outs = fit_pairwise(name, train, tests, settings, n_classes, key, weight_col, seed)
        return outs if isinstance(test, list) else outs[0]
    est = make_estimator(name, settings, n_classes, weight_col, w_sum, seed)
    model = est.fit(train)
    platt = fit_platt(est, train, key) if name in ("SVC_LinearProb", "SVC_RBF") and n_classes <= 2 else None
    outs = []
    for t in tests:
        pred = model.transform(t)
        if platt is not None:
            pred = platt.transform(_margin(pred.drop("prediction", "probability")).drop("rawPrediction"))
        if n_classes <= 2:
            if "probability" in pred.columns:
                score = vector_to_array("probability")[1]
            else:
                score = sigmoid(vector_to_array("rawPrediction")[1])
            pred = pred.withColumn("score", score)
            if threshold is not None:
                pred = pred.withColumn("prediction", (F.col("score") >= F.lit(threshold)).cast("double"))
        else:
            pred = pred.withColumn("score", F.lit(None).cast("double"))
        outs.append(pred)
    return outs if isinstance(test, list) else outs[0]


def label_values(df: DataFrame, label: str) -> list:
    """The target's distinct values in order; index 1 is the positive class for scores and thresholds."""
    found = df.select(label).filter(F.col(label).isNotNull()).distinct().limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"over {MAX_CLASSES} distinct targets: not a classification problem")
    return sorted(r[0] for r in found)


def index_labels(df: DataFrame, label: str, labels: list) -> DataFrame:
    """Q1 fix: ``label_idx`` by one list of values for every part of the data (see ``label_values``)."""
    mapping = F.create_map(*[x for i, v in enumerate(labels) for x in (F.lit(v), F.lit(float(i)))])
    return df.withColumn("label_idx", mapping[F.col(label)])


def label_of(labels: list, idx: Column) -> Column:
    arr = F.array(*[F.lit(v) for v in labels])
    return F.element_at(arr, idx.cast("int") + 1)
