"""Unsupervised and supervised learning (M01–M11, A07, W03) on Spark ML.

Feature columns stay ``DoubleType`` until the ML boundary, where one
``VectorAssembler`` builds the vector.  Estimators are Spark ML's own
(distributed fits); the driver only holds model coefficients and the
small metric tables.
"""

from __future__ import annotations

import math
import random
import time
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import PCA, BucketedRandomProjectionLSH, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.operators import evaluate as ev
from cohortkit.operators import neighbors
from cohortkit.operators.scale import standard_scale
from cohortkit.functions.ordered import row_index
from cohortkit.session import checkpoint_dir
from cohortkit.operators.select import hash_key, hash_uniform, stratified_folds, stratified_split
from cohortkit.operators.stats import class_weights, cluster_stats


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


# --- M01: PCA ------------------------------------------------------------------

def pca_analysis(df: DataFrame, cols: Sequence[str], variance: float = 0.95, key: Sequence[str] = ()):
    """M01 + W03: standardize, full PCA, explained and cumulative variance
    ratios, components needed for ``variance``, and the 2-D projection.

    Returns ``(variance_table, n_components, projection)``.  The covariance
    is a d×d Gramian aggregated across executors; d is the column count.
    """
    cols = list(cols)
    z = standard_scale(df.select(*key, *cols).na.drop(subset=cols), cols)
    v = assemble(z, cols)
    k = len(cols)
    model = PCA(k=k, inputCol="features", outputCol="pcs").fit(v)
    ratios = [float(x) for x in model.explainedVariance.toArray()]
    spark = df.sparkSession
    t = spark.createDataFrame([(i + 1, r) for i, r in enumerate(ratios)], "component int, explained_variance_ratio double")
    w = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumn("cumulative", F.sum("explained_variance_ratio").over(w))  # k rows
    cum, n_comp = 0.0, k
    for i, r in enumerate(ratios):
        cum += r
        if cum >= variance - 1e-12:
            n_comp = i + 1
            break
    two = PCA(k=min(2, k), inputCol="features", outputCol="pcs").fit(v)
    arr = vector_to_array(F.col("pcs"))
    proj = two.transform(v).select(*key, arr[0].alias("pc1"), (arr[1] if k > 1 else F.lit(0.0)).alias("pc2"))
    return t, n_comp, proj


# --- M02: k-means ----------------------------------------------------------------

def kmeans_analysis(df: DataFrame, cols: Sequence[str], k: int = 5, seed: int = 42, key: Sequence[str] = ()):
    """M02 + A07: standardized k-means.  Returns ``(summary, assignments,
    cluster_table)``: summary has inertia and sizes; cluster_table the
    per-cluster mean, std and size of every column."""
    cols = list(cols)
    z = standard_scale(df.select(*key, *cols).na.drop(subset=cols), cols)
    v = assemble(z, cols)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(v)
    s = model.summary
    centers = [[float(c) for c in ctr] for ctr in model.clusterCenters()]
    # Centers in the plane of the first two principal components, projected
    # as PCAModel.transform projects the (standardized) rows.
    two = PCA(k=min(2, len(cols)), inputCol="features", outputCol="pcs").fit(v)
    pcs = two.pc.toArray()
    centers_2d = [[float(sum(ctr[i] * pcs[i][j] for i in range(len(cols)))) for j in range(pcs.shape[1])]
                  for ctr in centers]
    summary = {"inertia": float(s.trainingCost), "sizes": [int(x) for x in s.clusterSizes],
               "centers": centers, "centers_2d": centers_2d}
    assigned = model.transform(v).select(*key, *cols, "cluster")
    return summary, assigned, cluster_stats(assigned, "cluster", cols)


# --- M03/M04/M09: model zoo ---------------------------------------------------------

# Fixed value: rows of a partition that is worth a task of its own in every pass of a fit.
FIT_ROWS = 50_000


def for_fits(df: DataFrame) -> DataFrame:
    """``df`` in no more partitions than its rows need.  A fit passes over its rows in many short jobs, and each starts
    a task per partition: a split comes in as many as the session shuffles by, however few its rows are."""
    spark = df.sparkSession
    wanted = max(2 * spark.sparkContext.defaultParallelism, -(-df.count() // FIT_ROWS))
    return df.coalesce(wanted) if wanted < int(spark.conf.get("spark.sql.shuffle.partitions", "200")) else df


def make_classifier(name: str, features: str = "features", label: str = "label", weight: str | None = None,
                    seed: int = 42, **params):
    """``random_forest``, ``gbt`` (stands in for every boosted
    tree library), ``logistic``, ``mlp``.  ``weight`` sets ``weightCol``
    where the estimator has it (M04)."""
    common = dict(featuresCol=features, labelCol=label)
    if name == "random_forest":
        est = RandomForestClassifier(seed=seed, **common, **params)
    elif name == "gbt":
        est = GBTClassifier(seed=seed, **common, **params)
    elif name == "logistic":
        est = LogisticRegression(**common, **params)
    elif name == "mlp":
        layers = params.pop("layers", None)
        est = MultilayerPerceptronClassifier(seed=seed, layers=layers, **common, **params)
        weight = None
    else:
        raise ValueError(name)
    if weight and est.hasParam("weightCol"):
        est.setWeightCol(weight)
    return est


def with_class_weights(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """Weight each row by n / (k · n_label) (A10); broadcast table of
    one row per label."""
    w = class_weights(df, label).select(F.col("label").alias("_ck_lab"), F.col("weight").alias(name))
    return df.join(F.broadcast(w), F.col(label) == F.col("_ck_lab")).drop("_ck_lab")


def fit_lsh_bounded(df: DataFrame, vec: str, bucket_length: float, num_tables: int, seed: int,
                    max_bucket: int = 5_000, max_halvings: int = 12):
    """Euclidean LSH whose largest bucket holds at most ``max_bucket`` rows.

    A similarity join compares the rows that share a bucket, so bucket
    size bounds the pairs.  The largest bucket is measured (a partial-
    aggregated count per table and bucket) and the bucket length halved
    until it fits.  Identical vectors can never be separated, so callers
    should pass distinct vectors.  Returns ``(model, bucket_length)``.
    """
    b = float(bucket_length)
    for _ in range(max_halvings + 1):
        m = BucketedRandomProjectionLSH(inputCol=vec, outputCol="_ck_h", bucketLength=b,
                                        numHashTables=num_tables, seed=seed).fit(df)
        h = m.transform(df).select(F.posexplode("_ck_h").alias("_ck_t", "_ck_b"))
        biggest = h.groupBy("_ck_t", vector_to_array("_ck_b")[0].alias("_ck_v")).count().agg(F.max("count")).first()[0]
        if biggest is None or biggest <= max_bucket:
            return m, b
        b /= 2.0
    raise ValueError(f"LSH buckets still exceed {max_bucket} rows; are many vectors identical?")


def smote(df: DataFrame, cols: Sequence[str], label: str = "label", key: Sequence[str] = ("id",), k: int = 5,
          seed: int = 42, bucket_length: float = 2.0, num_tables: int = 3, max_distance: float | None = None) -> DataFrame:
    """Synthetic minority rows x + u·(nn − x) toward one of the k
    nearest minority neighbours, until the classes balance (U03 appends).

    Neighbours are searched among distinct minority vectors, each feature
    divided by its standard deviation (``max_distance`` is in these units).
    The search is exact: a metric index whose cells a row visits only while they
    may hold a nearer one (``neighbors``); ``bucket_length`` and ``num_tables``, of the hashed search it replaced, are
    accepted and unused.  With
    deficit = q·n_min + r, every minority row makes q synthetic rows and r
    of them (first in seeded-hash order) one more, so the result is balanced exactly; a
    minority of one distinct vector repeats it.
    """
    cols, key = list(cols), list(key)
    checkpoint_dir(df.sparkSession)
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}  # one row per label
    if len(counts) != 2:
        raise ValueError("SMOTE needs two classes")
    minority = min(counts, key=counts.get)
    deficit = max(counts.values()) - counts[minority]
    if deficit == 0:
        return df
    rows = df.where(F.col(label) == minority)
    spread = rows.agg(*[F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0)).alias(c) for c in cols]).first()
    distinct = row_index(rows.select(*cols).dropDuplicates(), cols, name="_ck_id").checkpoint(eager=True)
    vec = neighbors.vector_of(cols, [spread[c] for c in cols])
    found = neighbors.knn(neighbors.build_index(distinct, vec, ["_ck_id"]), distinct, vec, k).select(
        F.col("_ck_id").alias("_ck_a"), F.col("nn__ck_id").alias("_ck_b"), F.col("distance").alias("dist"))
    if max_distance is not None:
        found = found.where(F.col("dist") <= max_distance)
    alone = distinct.join(found.select(F.col("_ck_a").alias("_ck_id")), "_ck_id", "left_anti").select(
        F.col("_ck_id").alias("_ck_a"), F.col("_ck_id").alias("_ck_b"), F.lit(0.0).alias("dist"))
    pairs = found.unionByName(alone)
    pairs = (pairs.join(distinct.select(F.col("_ck_id").alias("_ck_a"), *cols), "_ck_a")
             .join(distinct.select(F.col("_ck_id").alias("_ck_b"), *[F.col(c).alias(f"nn_{c}") for c in cols]), "_ck_b").drop("_ck_a", "_ck_b"))
    w = Window.partitionBy(*cols).orderBy("dist", *[f"nn_{c}" for c in cols])
    best = pairs.withColumn("_ck_r", F.row_number().over(w)).where(F.col("_ck_r") <= k)
    nn = rows.select(*key, *cols).join(best, cols)
    # deficit = q·n_min + r: every minority row makes q synthetic rows, and
    # the r rows first in seeded-hash order make one more.
    q, r = divmod(deficit, counts[minority])
    first = nn.where(F.col("_ck_r") == 1).select(*key).withColumn("_ck_hk", hash_key(key, seed))
    extra = row_index(first, ["_ck_hk", *key], name="_ck_i").select(*key, (F.col("_ck_i") < r).alias("_ck_extra"))
    nn = nn.join(extra, key)
    n_reps = F.lit(q) + F.col("_ck_extra").cast("int")
    # sequence(0, -1) would count down, so an empty array when n_reps = 0.
    reps = F.when(n_reps > 0, F.sequence(F.lit(0), n_reps - 1)).otherwise(F.array().cast("array<int>"))
    cand = nn.select("*", F.explode(reps).alias("_ck_rep"))
    cand = cand.withColumn("_ck_pick", F.pmod(F.xxhash64(F.lit(seed), F.col("_ck_rep"), *[F.col(c) for c in key]),
                                               F.lit(k)) + 1)
    n_nb = Window.partitionBy(*key)
    cand = cand.withColumn("_ck_k", F.max("_ck_r").over(n_nb))
    cand = cand.where(F.col("_ck_r") == F.least(F.col("_ck_pick"), F.col("_ck_k")))
    u = hash_uniform([*key, "_ck_rep"], seed + 1)
    synth = cand.select(*[(F.col(c) + u * (F.col(f"nn_{c}") - F.col(c))).alias(c) for c in cols],
                        F.lit(minority).alias(label))
    return df.unionByName(synth, allowMissingColumns=True)


class LinearScorer:
    """A logistic model known by its coefficients (fitted elsewhere, or set by hand), scored as a
    column expression.  ``transform`` adds ``probability`` and ``prediction`` as a fitted Spark
    model does, so every explanation of ``interpret`` takes it."""

    def __init__(self, weights: dict[str, float], intercept: float = 0.0):
        self.weights, self.intercept = dict(weights), float(intercept)

    @property
    def coefficients(self):
        from pyspark.ml.linalg import Vectors
        return Vectors.dense(list(self.weights.values()))

    def margin(self):
        return sum((F.lit(w) * F.col(f) for f, w in self.weights.items()), F.lit(self.intercept))

    def transform(self, df: DataFrame) -> DataFrame:
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))
        return df.withColumns({"probability": array_to_vector(F.array(F.lit(1.0) - p, p)), "prediction": (self.margin() > 0).cast("double")})


# --- M06: random search with cross-validation ----------------------------------------------

# Search ranges per model family (low, high, kind).
SEARCH_SPACE = {
    "random_forest": {"numTrees": (20, 200, "int"), "maxDepth": (3, 12, "int"),
                      "minInstancesPerNode": (1, 20, "int")},
    "gbt": {"maxIter": (20, 100, "int"), "maxDepth": (2, 8, "int"), "stepSize": (0.01, 0.3, "log"), "subsamplingRate": (0.6, 1.0, "float")},
    "logistic": {"regParam": (0.0001, 1.0, "log"), "elasticNetParam": (0.0, 1.0, "float")},
}


def random_grid(est, name: str, n_trials: int, seed: int = 42):
    rng = random.Random(seed)
    space = SEARCH_SPACE.get(name, {})
    grid = []
    for _ in range(n_trials):
        pm = {}
        for p, (lo, hi, kind) in space.items():
            if kind == "int":
                v = rng.randint(lo, hi)
            elif kind == "log":
                v = math.exp(rng.uniform(math.log(lo), math.log(hi)))
            else:
                v = rng.uniform(lo, hi)
            pm[est.getParam(p)] = v
        grid.append(pm)
    return grid or ParamGridBuilder().build()


class TrialSampler:
    """Sequential draws of parameters by a density ratio.

    After ``startup`` uniform draws the trials so far are split at the best ``good`` share.  Per parameter, candidates are drawn
    from a mixture of normals around the good trials' values (and one over the whole range), and the one with the largest
    ratio of the good trials' density to the others' is taken.  Everything is a function of the seed and the history.
    """

    def __init__(self, space: dict[str, tuple], seed: int = 42, startup: int = 5, good: float = 0.25, candidates: int = 24):
        self.space, self.seed, self.startup, self.good, self.candidates = dict(space), seed, startup, good, candidates
        self.history: list[tuple[dict[str, float], float]] = []

    def _value(self, name: str, at: float):
        low, high, kind = self.space[name]
        if kind == "log":
            return math.exp(math.log(low) + at * (math.log(high) - math.log(low)))
        return min(high, low + int(at * (high - low + 1))) if kind == "int" else low + at * (high - low)

    @staticmethod
    def _density(at: float, centers: list[float], width: float) -> float:
        return (1.0 + sum(math.exp(-0.5 * ((at - c) / width) ** 2) / (width * math.sqrt(2 * math.pi)) for c in centers)) / (len(centers) + 1)

    def _draw(self, rng: random.Random, good: list[float], rest: list[float]) -> float:
        width = max(0.05, 0.5 / (len(good) + 1))

        def one():
            i = rng.randrange(len(good) + 1)
            x = rng.random() if i == len(good) else rng.gauss(good[i], width)
            return min(1.0 - 1e-9, max(0.0, x))
        options = [one() for _ in range(self.candidates)]
        return max(options, key=lambda x: self._density(x, good, width) / self._density(x, rest, width))

    def ask(self) -> tuple[dict[str, float], dict]:
        """The next trial: its place in the unit cube, and the parameter values there."""
        rng = random.Random(f"{self.seed}|{len(self.history)}")
        if len(self.history) < self.startup:
            places = {name: rng.random() for name in self.space}
        else:
            ranked = sorted(self.history, key=lambda t: -t[1])
            n = max(1, round(self.good * len(ranked)))
            places = {name: self._draw(rng, [t[0][name] for t in ranked[:n]], [t[0][name] for t in ranked[n:]]) for name in self.space}
        return places, {name: self._value(name, at) for name, at in places.items()}

    def tell(self, places: dict[str, float], score: float):
        self.history.append((places, score))


def tune(df: DataFrame, name: str, features: str = "features", label: str = "label", key: Sequence[str] = ("id",),
         n_trials: int = 5, folds: int = 3, seed: int = 42, weight: str | None = None, parallelism: int = 2, sampler: str = "random"):
    """ROC-AUC over stratified folds (O08).  ``sampler``: ``random`` (all draws at once, trials in parallel) or
    ``sequential`` (``TrialSampler``, each draw learns from the trials before; the folds of a trial run in parallel)."""
    est = make_classifier(name, features, label, weight, seed)
    checkpoint_dir(df.sparkSession)
    data = stratified_folds(df, label, list(key), folds, seed, name="_ck_fold").checkpoint(eager=True)
    ev_ = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC")

    def search(grid):
        return CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=ev_, numFolds=folds, foldCol="_ck_fold", parallelism=parallelism, seed=seed).fit(data)

    if sampler == "random":
        m = search(random_grid(est, name, n_trials, seed))
        return m.bestModel, [float(x) for x in m.avgMetrics]
    if sampler != "sequential":
        raise ValueError(sampler)
    # The folds are filters of one checkpoint; only the best trial is fitted again on all rows.
    trials, best, scores = TrialSampler(SEARCH_SPACE.get(name, {}), seed), {}, []

    def held_out(params, fold):
        return ev_.evaluate(est.fit(data.where(F.col("_ck_fold") != fold), params).transform(data.where(F.col("_ck_fold") == fold)))

    for _ in range(n_trials):
        places, values = trials.ask()
        params = {est.getParam(p): v for p, v in values.items()}
        with ThreadPool(max(1, min(parallelism, folds))) as pool:
            found = pool.map(inheritable_thread_target(data.sparkSession)(lambda fold: held_out(params, fold)), range(folds))
        scores.append(float(np.mean(found)))
        trials.tell(places, scores[-1])
        best = params if scores[-1] == max(scores) and scores.count(scores[-1]) == 1 else best
    return est.fit(data, best), scores


# --- M07 / M10 / M11: training, scoring, evaluation -----------------------------------------

def score(model, df: DataFrame, label: str = "label") -> DataFrame:
    """``prediction`` and the positive-class ``score``."""
    out = model.transform(df)
    return out.withColumn("score", vector_to_array(F.col("probability"))[1]).withColumn(
        "prediction", F.col("prediction").cast("int")).withColumn(label, F.col(label).cast("int"))


def train_test(df: DataFrame, label: str, key: Sequence[str], train_share: float = 0.8, seed: int = 42):
    """O07 as two frames."""
    split = stratified_split(df, label, list(key), train_share, seed)
    return split.where(F.col("split") == "train"), split.where(F.col("split") == "test")


def balanced(train: DataFrame, cols: Sequence[str], label: str, key: Sequence[str], balance: str | None, seed: int = 42):
    """Training rows and the name of their weight column: ``weights`` (M04),
    ``smote`` (M05) or None (as they are); other names are refused."""
    if balance == "weights":
        return with_class_weights(train, label), "weight"
    if balance == "smote":
        return smote(train, cols, label, key, seed=seed), None
    if balance is not None:
        raise ValueError(f"unknown balance {balance!r}")
    return train, None


def train_model(df: DataFrame, cols: Sequence[str], name: str = "random_forest", label: str = "label",
                key: Sequence[str] = ("id",), seed: int = 42, balance: str | None = "weights", train_share: float = 0.8, **params):
    """Split (O07), fit, score, metrics, wall time."""
    train, test = train_test(df, label, key, train_share, seed)
    train, weight = balanced(train, cols, label, key, balance, seed)
    return _fitted(train, test, weight, cols, name, label, seed, **params)


def _fitted(train: DataFrame, test: DataFrame, weight: str | None, cols: Sequence[str], name: str, label: str, seed: int, **params):
    t0 = time.time()
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep"),
                            make_classifier(name, "features", label, weight, seed, **params)])
    model = pipe.fit(for_fits(train))
    fit_s = time.time() - t0
    scored = score(model, test, label)
    metrics = ev.evaluate(scored, label, "prediction", "score").withColumn("train_seconds", F.lit(fit_s))
    return model, scored, metrics


def stacking(df: DataFrame, cols: Sequence[str], bases: Sequence[str] = ("random_forest", "gbt", "logistic"),
             label: str = "label", key: Sequence[str] = ("id",), folds: int = 5, seed: int = 42, parallelism: int = 6):
    """Out-of-fold base scores (each fold scored by models fit on the
    other folds), then a logistic meta-model on those scores.  The models don't depend on each other, so ``parallelism`` of
    them are fit at a time: a fit is a chain of short jobs.  A fold's rows pass through its models one
    after the other, each adding its score: no join by key."""
    checkpoint_dir(df.sparkSession)
    data = for_fits(assemble(stratified_folds(df, label, list(key), folds, seed, name="_ck_fold"), cols).checkpoint(eager=True))
    # The last fits, of fold None, see all rows.  Boosted trees, whose chain is the longest, begin first.
    jobs = sorted([(f, b) for f in [None, *range(folds)] for b in bases], key=lambda j: j[1] != "gbt")

    def fit(job):
        f, b = job
        return make_classifier(b, "features", label, None, seed).fit(data if f is None else data.where(F.col("_ck_fold") != f))

    with ThreadPool(max(1, min(parallelism, len(jobs)))) as pool:
        models = dict(zip(jobs, pool.map(inheritable_thread_target(data.sparkSession)(fit), jobs, chunksize=1)))
    oof = None
    for f in range(folds):
        part = data.where(F.col("_ck_fold") == f)
        for b in bases:
            m = models[f, b]
            for column in ("prediction", "probability", "rawPrediction"):
                m.set(m.getParam(f"{column}Col"), f"_ck_{column}_{b}")
            part = m.transform(part).withColumn(f"s_{b}", vector_to_array(f"_ck_probability_{b}")[1]).drop(*[f"_ck_{c}_{b}" for c in ("prediction", "probability", "rawPrediction")])
        part = part.select(*key, label, *[f"s_{b}" for b in bases])
        oof = part if oof is None else oof.unionByName(part)
    # Scored once, for the meta-model and for the caller.
    oof = oof.checkpoint(eager=True)
    meta_in = assemble(oof, [f"s_{b}" for b in bases], "meta")
    meta = LogisticRegression(featuresCol="meta", labelCol=label).fit(meta_in)
    return [models[None, b] for b in bases], meta, oof


def mlp(input_dim: int, hidden: Sequence[int] = (128, 64, 32), **kw):
    """Feed-forward net d → 128 → 64 → 32 → 2 (sigmoid hidden units)."""
    return make_classifier("mlp", layers=[input_dim, *hidden, 2], **kw)


def train_and_evaluate(df: DataFrame, cols: Sequence[str], label: str = "label", key: Sequence[str] = ("id",),
                       models: Sequence[str] = ("random_forest", "gbt", "logistic"), n_trials: int = 0,
                       seed: int = 42, balance: str | None = "weights", save_dir: str | None = None,
                       train_share: float = 0.8, folds: int = 3):
    """Per candidate: tune (optional, on the training rows alone, with
    class weights if those balance) → balance → fit → score → evaluate;
    best by test accuracy.  Returns ``(metrics, best_name, fitted)``;
    ``metrics`` has one row per model (E08 input)."""
    from cohortkit.sources.sinks import save_model
    rows, fitted = None, {}
    # One split and one balanced training set serve every candidate.
    seen, test = train_test(df, label, key, train_share, seed)
    train, weight = balanced(seen, cols, label, key, balance, seed)
    for name in models:
        params = {}
        if n_trials:
            tuned_on = train if balance == "weights" else seen
            best, _ = tune(assemble(tuned_on, cols), name, "features", label, key, n_trials, folds, seed, weight)
            params = {p.name: v for p, v in best.extractParamMap().items()
                      if p.name in SEARCH_SPACE.get(name, {})}
        model, scored, metrics = _fitted(train, test, weight, cols, name, label, seed, **params)
        fitted[name] = model
        m = metrics.withColumn("model", F.lit(name))
        rows = m if rows is None else rows.unionByName(m)
        if save_dir:
            save_model(model, f"{save_dir}/{name}")
    best = rows.orderBy(F.col("accuracy").desc(), F.col("model")).first()["model"]
    if save_dir:
        save_model(fitted[best], f"{save_dir}/best")
    return rows, best, fitted


def array_features(df: DataFrame, array_col: str, n: int, prefix: str = "x") -> DataFrame:
    """Expand a fixed-length array column into ``n`` double columns."""
    return df.select("*", *[F.col(array_col)[i].cast("double").alias(f"{prefix}{i}") for i in range(n)])


__all__ = ["assemble", "pca_analysis", "kmeans_analysis", "make_classifier", "with_class_weights", "smote",
           "tune", "score", "train_test", "balanced", "train_model", "stacking", "mlp", "train_and_evaluate", "array_features",
           "array_to_vector", "PipelineModel"]
