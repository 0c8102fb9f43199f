"""Model interpretation.

Explanations are long tables ``(…, feature, value)``; every perturbation or
grid is scored as one exploded DataFrame through ``model.transform`` (one
job per method, not one per feature or repeat).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def importance_report(a: DataFrame, b: DataFrame, top: int = 10, common: int = 5,
                      item: str = "feature", score: str = "importance") -> DataFrame:
    """Two importance rankings side by side (full outer join on the
    feature), with ranks and ``in_both_top5``; rows in either top ``top``.
    Rankings hold one row per feature, so the rank windows are tiny."""
    wa = Window.orderBy(F.col(score).desc(), F.col(item))
    ra = a.select(item, F.col(score).alias("importance_a"), F.row_number().over(wa).alias("rank_a"))
    rb = b.select(item, F.col(score).alias("importance_b"), F.row_number().over(wa).alias("rank_b"))
    j = ra.join(rb, item, "full_outer")
    both = F.coalesce((F.col("rank_a") <= common) & (F.col("rank_b") <= common), F.lit(False))
    return j.where((F.col("rank_a") <= top) | (F.col("rank_b") <= top)).select(
        item, "importance_a", "rank_a", "importance_b", "rank_b", both.alias("in_both_top5"))


def _classifier_stage(model):
    from pyspark.ml import PipelineModel
    if isinstance(model, PipelineModel):
        return model.stages[-1]
    return model


def builtin_importances(model, features: Sequence[str], spark) -> DataFrame:
    """The model's own importances (tree impurity gain, or |coef| for
    linear models), sorted descending.  No SHAP value is computed, as in the
    reference."""
    m = _classifier_stage(model)
    if hasattr(m, "featureImportances"):
        vals = m.featureImportances.toArray()
    elif hasattr(m, "coefficients"):
        vals = [abs(x) for x in m.coefficients.toArray()]
    else:
        raise ValueError("model has no importances")
    rows = [(f, float(v)) for f, v in zip(features, vals)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature")


def _accuracy(scored: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*by).agg(F.avg((F.col("prediction").cast("int") == F.col(label).cast("int")).cast("double"))
                                   .alias("accuracy"))


def permutation_importance(model, df: DataFrame, features: Sequence[str], label: str = "label",
                           key: Sequence[str] = ("id",), repeats: int = 5, seed: int = 42) -> DataFrame:
    """Mean and std (population) over ``repeats`` of the drop in
    accuracy when one feature's values are permuted.

    Rows are numbered once along the key, and each repeat is a keyed bijection of these numbers
    (``functions.keyed``): a row's donors are found by arithmetic, a batch at a time, without a sort per permutation.  One join by number brings a row all
    features of its donor, one repeat's permutation serving every feature; each feature is then replaced in turn and scored
    on the same row, without another shuffle or copies of rows.  Of a forest, rows travel as the thresholds they exceed (``tree_scores``).
    """
    import numpy as np
    import pyarrow as pa

    from cohortkit.functions import keyed
    from cohortkit.functions.ordered import row_index
    from cohortkit.operators import tree_scores
    key, feats = list(key), list(features)
    forest = tree_scores.forest_of(model, len(feats), df.sparkSession)
    rows = row_index(df.select(*key, *feats, F.col(label).alias("_ck_label")), key, name="_ck_i").drop(*key).checkpoint(eager=True)
    n = rows.count()
    base_acc = _accuracy(model.transform(rows), "_ck_label").first()["accuracy"]
    if forest is None:
        own = rows
        donors = rows.select(F.col("_ck_i").alias("_ck_from"), *[F.col(f).alias(f"_ck_p{i}") for i, f in enumerate(feats)])
    else:
        own = _placed(rows.select("_ck_i", F.col("_ck_label").cast("int").alias("_ck_label"), *feats), feats, forest)
        donors = own.select(F.col("_ck_i").alias("_ck_from"), F.col("_ck_at").alias("_ck_p"))
    lines, permuted, block = keyed.lines_of(seed, repeats), keyed.permuted_numbers, tree_scores.BLOCK

    def donors_of(batches):
        for b in batches:
            at = np.asarray(b["_ck_i"])
            to = np.column_stack([permuted(at, n, [of[r] for of in lines]) for r in range(repeats)])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, to.size + 1, repeats, dtype=np.int32)), pa.array(to.ravel()))
            yield pa.RecordBatch.from_arrays([*[c for c, f in zip(b.columns, b.schema.names) if f != "_ck_i"], lists], names=[*[f for f in b.schema.names if f != "_ck_i"], "_ck_to"])

    kept = [c for c in own.columns if c != "_ck_i"]
    asked = own.mapInArrow(donors_of, ", ".join(f"`{c}` {t}" for c, t in own.dtypes if c != "_ck_i") + ", _ck_to array<bigint>").select(
        *kept, F.posexplode("_ck_to").alias("_ck_rep", "_ck_from"))
    both = asked.join(donors, "_ck_from")
    if forest is None:
        # The feature's own values step aside while the donor's are scored.
        now = both.select("_ck_rep", "_ck_label", *feats, *[f"_ck_p{i}" for i in range(len(feats))])
        for i, f in enumerate(feats):
            aside = now.withColumnRenamed(f, "_ck_own").withColumn(f, F.col(f"_ck_p{i}"))
            now = model.transform(aside).select(*[F.col("_ck_own").alias(f) if c == f else F.col(c) for c in now.columns if c != f"_ck_p{i}"],
                                                F.col("prediction").cast("int").alias(f"_ck_y{i}"))
        right = now.groupBy("_ck_rep").agg(*[F.avg((F.col(f"_ck_y{i}") == F.col("_ck_label").cast("int")).cast("double")).alias(f) for i, f in enumerate(feats)])
        accuracy = right.unpivot(["_ck_rep"], feats, "_ck_f", "accuracy")
    else:
        shipped = df.sparkSession.sparkContext.broadcast(forest)

        def right_of(batches):
            known, hits, seen = shipped.value, np.zeros((repeats, len(feats)), np.int64), np.zeros(repeats, np.int64)
            for b in batches:
                for at in range(0, b.num_rows, block):
                    part = b.slice(at, block)
                    part = part.filter(part["_ck_label"].is_valid())
                    rep, y = np.asarray(part["_ck_rep"]), np.asarray(part["_ck_label"])
                    mine, other = (_unpacked(part[c], len(feats)) for c in ("_ck_at", "_ck_p"))
                    seen += np.bincount(rep, minlength=repeats)
                    for j, rest in enumerate(known.without_each(mine)):
                        zero, one = known.votes(rest & known.open(j, other[:, j]))
                        hits[:, j] += np.bincount(rep[(one > zero) == y if len(y) else []], minlength=repeats)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(repeats), len(feats)), pa.int32()), pa.array(np.tile(np.arange(len(feats)), repeats), pa.int32()),
                                              pa.array(hits.ravel()), pa.array(np.repeat(seen, len(feats)))], names=["_ck_rep", "_ck_j", "hits", "seen"])

        right = both.select("_ck_rep", "_ck_label", "_ck_at", "_ck_p").mapInArrow(right_of, "_ck_rep int, _ck_j int, hits bigint, seen bigint")
        accuracy = right.groupBy("_ck_rep", "_ck_j").agg(F.try_divide(F.sum("hits"), F.sum("seen")).alias("accuracy")).withColumn(
            "_ck_f", F.element_at(F.lit(feats), F.col("_ck_j") + 1))
    drops = accuracy.select(F.col("_ck_f").alias("feature"), (F.lit(base_acc) - F.col("accuracy")).alias("drop"))
    return drops.groupBy("feature").agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std")).orderBy(
        F.col("importance_mean").desc(), "feature")


def _unpacked(column, width: int):
    import numpy as np
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, width)


def _matrix(batch, feats):
    import numpy as np
    return np.column_stack([np.asarray(batch[f].cast("double").fill_null(float("nan")), np.float64) for f in feats])


def _placed(df: DataFrame, feats: Sequence[str], forest) -> DataFrame:
    """``df`` with its features as one binary: per feature the number of the forest's thresholds exceeded."""
    import numpy as np
    import pyarrow as pa
    shipped, keep = df.sparkSession.sparkContext.broadcast(forest), [c for c in df.columns if c not in feats]

    def place(batches):
        for b in batches:
            if b.num_rows:
                x = _matrix(b, feats)
                raw = np.ascontiguousarray(np.column_stack([shipped.value.places(x[:, j], j) for j in range(len(feats))]))
                packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * len(feats)), len(raw), [None, pa.py_buffer(raw.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*[b[c] for c in keep], packed], names=[*keep, "_ck_at"])

    types = dict(df.dtypes)
    return df.mapInArrow(place, ", ".join(f"`{c}` {types[c]}" for c in keep) + ", _ck_at binary")


def linear_attributions(model, df: DataFrame, features: Sequence[str], key: Sequence[str] = ("id",)) -> DataFrame:
    """X04 (re-aimed): exact additive attributions of a linear model,
    wᵢ·(xᵢ − meanᵢ), as a long table ``(key…, feature, value, attribution)``."""
    m = _classifier_stage(model)
    w = [float(x) for x in m.coefficients.toArray()]
    means = df.agg(*[F.avg(f).alias(f) for f in features]).first()
    long = df.select(*key, F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"),
                 (F.lit(wi) * (F.col(f) - F.lit(means[f]))).alias("attribution"))
        for f, wi in zip(features, w)])).alias("a"))
    return long.select(*key, "a.*")


def attribution_summary(attr: DataFrame, top: int | None = None) -> DataFrame:
    """Mean |attribution| per feature, descending."""
    s = attr.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("mean_abs_attribution"))
    s = s.orderBy(F.col("mean_abs_attribution").desc(), "feature")
    return s.limit(top) if top else s


def explanation_stability(attr: DataFrame, key: Sequence[str] = ("id",), replicates: int = 100,
                          seed: int = 42) -> DataFrame:
    """Bootstrap of the mean |attribution| per feature: mean, std and 2.5/97.5 % percentiles across replicates.

    A row's weights are one array of Poisson(1) numbers, one a replicate, made from its key; all features of a row share them.  Tasks
    add weight arrays and weighted sums elementwise and hand on two arrays per feature, so rows are neither
    exploded nor shuffled.  Rows without an attribution are left out."""
    import numpy as np
    import pyarrow as pa

    from cohortkit.functions import keyed
    from cohortkit.operators.select import poisson1_cdf
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])
    number = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") % keyed.PRIME
    factor, addend = (np.array(v, np.uint64) for v in zip(*[keyed.line(seed, r) for r in range(replicates)]))
    cdf, prime = np.array(poisson1_cdf(16)), np.uint64(keyed.PRIME)

    def add(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            names = b["feature"].dictionary_encode()
            which, size = np.asarray(names.indices), np.abs(np.asarray(b["attribution"]))
            x = np.asarray(b["number"]).astype(np.uint64)
            for begin in range(0, len(x), 4096):
                part = slice(begin, begin + 4096)
                y = (x[part, None] * factor + addend) % prime
                weights = np.searchsorted(cdf, (y * y % prime) / keyed_prime, side="right").astype(np.float64)
                for i in np.unique(which[part]):
                    own = which[part] == i
                    at = sums.setdefault(names.dictionary[int(i)].as_py(), np.zeros((2, replicates)))
                    at += [size[part][own] @ weights[own], weights[own].sum(0)]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v[0].tolist() for v in sums.values()], pa.list_(pa.float64())),
                                          pa.array([v[1].tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["feature", "weighted", "weight"])

    keyed_prime = float(keyed.PRIME)
    rows = attr.where(F.col("attribution").isNotNull()).select(F.col("feature").cast("string").alias("feature"), number.alias("number"), F.col("attribution").cast("double").alias("attribution"))
    sums = rows.mapInArrow(add, "feature string, weighted array<double>, weight array<double>")
    sums = sums.select("feature", F.posexplode(F.arrays_zip("weighted", "weight")).alias("replicate", "s")).groupBy("feature", "replicate").agg(
        F.sum("s.weighted").alias("weighted"), F.sum("s.weight").alias("weight"))
    # Two sums per replicate and feature are left.
    m = F.try_divide(F.col("weighted"), F.col("weight"))
    return sums.groupBy("feature").agg(F.stddev_pop(m).alias("std"), F.avg(m).alias("mean"), F.percentile(m, 0.025).alias("p2_5"), F.percentile(m, 0.975).alias("p97_5"))


def pdp_grids(df: DataFrame, features: Sequence[str], resolution: int = 100, lo: float = 0.05, hi: float = 0.95) -> dict[str, list[float]]:
    """Grids of partial-dependence curves: the distinct values when fewer
    than ``resolution``, else equally spaced between the lo/hi percentiles
    (exact quantiles).  A task hands on at most ``resolution`` values a
    feature: fewer than that in all means that none was left out."""
    from cohortkit.functions.ordered import quantile_values
    feats = list(features)

    def some(batches):
        import pyarrow as pa
        held = [set() for _ in feats]
        for b in batches:
            for f, values in zip(feats, held):
                if len(values) < resolution:
                    values.update(v for v in b[f].drop_null().unique().to_pylist()[:2 * resolution])
        pairs = [(i, v) for i, values in enumerate(held) for v in list(values)[:resolution]]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in pairs], pa.int32()), pa.array([v for _, v in pairs], pa.float64())], names=["i", "v"])

    found = df.select(*[F.col(f).cast("double").alias(f) for f in feats]).mapInArrow(some, "i int, v double").distinct()
    few = found.groupBy("i").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < resolution).select("i")
    grids: dict[str, list[float]] = {f: [] for f in feats}
    for r in found.join(F.broadcast(few), "i").collect():  # below ``resolution`` values a feature
        grids[feats[r["i"]]].append(r["v"])
    many = [feats[r["i"]] for r in found.groupBy("i").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= resolution).collect()]
    if many:
        for f, q in quantile_values(df, many, {"lo": lo, "hi": hi}).items():
            grids[f] = [q["lo"] + (q["hi"] - q["lo"]) * i / (resolution - 1) for i in range(resolution)]
    return {f: grids[f] if f in many else sorted(grids[f]) for f in feats}


def pdp_grid(df: DataFrame, feature: str, resolution: int = 100, lo: float = 0.05, hi: float = 0.95) -> list[float]:
    """The grid of one feature's curve (``pdp_grids``)."""
    return pdp_grids(df, [feature], resolution, lo, hi)[feature]


def partial_dependence(model, df: DataFrame, features: Sequence[str], resolution: int = 20) -> DataFrame:
    """Mean predicted probability over the data with one feature set
    to each grid value (≤ ``resolution`` values).  A forest scores the variants of a row
    in its batch (``tree_scores``), as does a ``LinearScorer``, and a task hands on two sums per grid
    value; other models score a row exploded by the grid, in one ``transform`` per feature."""
    from cohortkit.operators import ml, tree_scores
    features = list(features)
    grids = pdp_grids(df, features, resolution)
    forest = tree_scores.forest_of(model, len(features), df.sparkSession)
    if forest is not None:
        return _forest_dependence(forest, df, features, grids)
    if isinstance(model, ml.LinearScorer):
        return _linear_dependence(model, df, features, grids)
    out = None
    for f in features:
        e = df.select(*[c for c in df.columns if c != f],
                      F.explode(F.array(*[F.lit(g) for g in grids[f]])).alias(f))
        s = model.transform(e).select(f, vector_to_array_col("probability", 1).alias("p"))
        r = s.groupBy(F.col(f).alias("grid_value")).agg(F.avg("p").alias("mean_prediction")).select(
            F.lit(f).alias("feature"), "grid_value", "mean_prediction")
        out = r if out is None else out.unionByName(r)
    return out


def _linear_dependence(model, df: DataFrame, feats: list[str], grids: dict[str, list[float]]) -> DataFrame:
    """As by exploding: a row that lacks another feature of the model has no score, and only counts as one that was seen."""
    import numpy as np
    import pyarrow as pa
    terms, weights, intercept = list(model.weights), np.array(list(model.weights.values()), np.float64), model.intercept
    names, values = zip(*[(f, g) for f in feats for g in grids[f]]) if any(grids.values()) else ((), ())
    asked = [(terms.index(f) if f in terms else None, np.array(grids[f], np.float64)) for f in feats]

    def add(batches):
        sums, counts, seen = np.zeros(len(names)), np.zeros(len(names), np.int64), False
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part, seen = b.slice(at, 256), True
                lacks = np.column_stack([np.asarray(c.is_null()) for c in part.columns]) if terms else np.zeros((part.num_rows, 0), bool)
                each = [np.asarray(c.fill_null(0.0)) * w for c, w in zip(part.columns, weights)]
                begin = 0
                with np.errstate(over="ignore", invalid="ignore"):
                    for own, grid in asked:
                        rest = sum((t for k, t in enumerate(each) if k != own), np.full(part.num_rows, intercept))
                        rest = rest[~lacks[:, [k for k in range(len(terms)) if k != own]].any(1)]
                        p = np.add.outer(-rest, -(grid * weights[own] if own is not None else 0.0 * grid))
                        np.exp(p, out=p)
                        p += 1.0
                        np.reciprocal(p, out=p)
                        sums[begin:begin + len(grid)] += p.sum(0)
                        counts[begin:begin + len(grid)] += len(rest)
                        begin += len(grid)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.float64()), pa.array(sums), pa.array(counts)],
                                             names=["feature", "grid_value", "total", "n"])

    # The scorer may know no feature: a column of zeros then stands for the rows.
    rows = df.select(*[F.col(f).cast("double").alias(f"_ck_t{k}") for k, f in enumerate(terms)]) if terms else df.select(F.lit(0.0).alias("_ck_t"))
    parts = rows.mapInArrow(add, "feature string, grid_value double, total double, n bigint")
    return parts.groupBy("feature", "grid_value").agg(F.try_divide(F.sum("total"), F.sum("n")).alias("mean_prediction"))


def _forest_dependence(forest, df: DataFrame, feats: list[str], grids: dict[str, list[float]]) -> DataFrame:
    import numpy as np
    import pyarrow as pa

    from cohortkit.operators import tree_scores
    shipped, block = df.sparkSession.sparkContext.broadcast(forest), tree_scores.BLOCK
    names, values = zip(*[(f, g) for f in feats for g in dict.fromkeys(grids[f])]) if any(grids.values()) else ((), ())

    def add(batches):
        known, sums, n = shipped.value, np.zeros(len(names)), 0
        grid = [known.places(np.array(list(dict.fromkeys(grids[f])), np.float64), j) for j, f in enumerate(feats)]
        for b in batches:
            for at in range(0, b.num_rows, block):
                x = _matrix(b.slice(at, block), feats)
                begin, n = 0, n + len(x)
                for j, rest in enumerate(known.without_each(np.column_stack([known.places(x[:, i], i) for i in range(len(feats))]))):
                    # Grid values between the same thresholds score alike.
                    kinds, which = np.unique(grid[j], return_inverse=True)
                    total = np.zeros(len(kinds))
                    for i, p in enumerate(kinds):
                        zero, one = known.votes(rest & known.masks[j][:, int(p)][:, None])
                        total[i] = (one / (zero + one)).sum()
                    sums[begin:begin + len(which)] += total[which]
                    begin += len(which)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.float64()), pa.array(sums), pa.array([n] * len(names), pa.int64())],
                                             names=["feature", "grid_value", "total", "n"])

    parts = df.select(*[F.col(f).cast("double").alias(f) for f in feats]).mapInArrow(add, "feature string, grid_value double, total double, n bigint")
    return parts.groupBy("feature", "grid_value").agg((F.sum("total") / F.sum("n")).alias("mean_prediction"))


def vector_to_array_col(col: str, i: int):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(col))[i]


def lime_weights(model, df: DataFrame, instances: DataFrame, features: Sequence[str],
                 key: Sequence[str] = ("id",), samples: int = 200, seed: int = 42, ridge: float = 1.0,
                 kernel_width: float | None = None) -> DataFrame:
    """X06 (re-aimed for many instances): per instance, ``samples`` seeded
    Gaussian perturbations scaled by each feature's std, scored in one
    batch (of a forest by ``tree_scores``); a kernel-weighted ridge fit per instance gives local weights.
    Perturbations are not shuffled: where they are scored, a batch adds up the products that a fit needs, one row of
    sums per run of an instance's perturbations.  Sums are combined by key (rows of one key share a fit), and whole batches of fits are solved.
    Output ``(key…, feature, weight)``."""
    import numpy as np
    import pyarrow as pa

    from cohortkit.operators import tree_scores
    key = list(key)
    feats = list(features)
    n, types = len(feats), dict(instances.dtypes)
    forest = tree_scores.forest_of(model, n, df.sparkSession)
    sd = df.agg(*[F.stddev_pop(f).alias(f) for f in feats]).first()
    # Few instances may lie in one partition, and each becomes ``samples`` rows.
    spread = instances.select(*key, *feats).repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)
    s = spread.select("*", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("_ck_s"))
    normal, moved = [], []
    for j, f in enumerate(feats):
        u1 = (F.pmod(F.xxhash64(F.lit(seed), F.lit(2 * j), F.col("_ck_s"), *[F.col(k) for k in key]), F.lit(1 << 40))
              .cast("double") + 1.0) / float((1 << 40) + 1)
        u2 = (F.pmod(F.xxhash64(F.lit(seed), F.lit(2 * j + 1), F.col("_ck_s"), *[F.col(k) for k in key]), F.lit(1 << 40))
              .cast("double")) / float(1 << 40)
        z = F.sqrt(-2 * F.log(u1)) * F.cos(2 * 3.141592653589793 * u2)
        zz = F.when(F.col("_ck_s") == 0, F.lit(0.0)).otherwise(z)
        normal.append(zz.alias(f"_ck_z{j}"))
        moved.append((F.col(f) + F.col(f"_ck_z{j}") * F.lit(float(sd[f] or 0.0))).alias(f))
    drawn, shipped, scale = s.select(*key, "_ck_s", *feats, *normal), None, None
    if forest is None:
        drawn = model.transform(drawn.select(*key, "_ck_s", *moved, *[f"_ck_z{j}" for j in range(n)]))
        scored = drawn.select(*key, "_ck_s", *[f"_ck_z{j}" for j in range(n)], vector_to_array_col("probability", 1).alias("_ck_y"))
    else:
        scored = drawn.select(*key, "_ck_s", *[f"_ck_z{j}" for j in range(n)], *[F.col(f).cast("double").alias(f"_ck_x{j}") for j, f in enumerate(feats)])
        shipped, scale = df.sparkSession.sparkContext.broadcast(forest), [float(sd[f] or 0.0) for f in feats]
    width, by_model, block = kernel_width or 0.75 * (n ** 0.5), forest is None, tree_scores.BLOCK
    # The upper half of X'X, then X'y; X's first column is the intercept.
    above, beside = np.triu_indices(n + 1)
    left, right = np.concatenate([above, np.arange(n + 1)]), np.concatenate([beside, np.full(n + 1, n + 1)])

    def chances(b, Z):
        known, out = shipped.value, np.empty(b.num_rows)
        x = np.column_stack([b[f"_ck_x{j}"].to_numpy(zero_copy_only=False) for j in range(n)]) + Z * scale
        for at in range(0, len(x), block):
            some = x[at:at + block]
            still = known.open(0, known.places(some[:, 0], 0))
            for j in range(1, n):
                still &= known.open(j, known.places(some[:, j], j))
            zero, one = known.votes(still)
            out[at:at + block] = one / (zero + one)
        return out

    def add(batches):
        for b in batches:
            if not b.num_rows:
                continue
            at = np.asarray(b["_ck_s"])
            begin = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            Z = np.column_stack([b[f"_ck_z{j}"].to_numpy(zero_copy_only=False) for j in range(n)])
            y = b["_ck_y"].to_numpy(zero_copy_only=False) if by_model else chances(b, Z)
            w = np.sqrt(np.exp(-(Z ** 2).sum(axis=1) / width ** 2))
            X = np.column_stack([np.ones(len(y)), Z, y]) * w[:, None]
            sums = np.add.reduceat(X[:, left] * X[:, right], begin)
            keys = [b[k].take(pa.array(begin)) for k in key]
            yield pa.RecordBatch.from_arrays([*keys, *[pa.array(c) for c in sums.T]], names=[*key, *[f"_ck_m{i}" for i in range(len(left))]])

    def solve(batches):
        for b in batches:
            sums = np.column_stack([b[f"_ck_m{i}"].to_numpy(zero_copy_only=False) for i in range(len(left))])
            A = np.zeros((len(sums), n + 1, n + 1))
            A[:, above, beside] = A[:, beside, above] = sums[:, :len(above)]
            A[:, range(1, n + 1), range(1, n + 1)] += ridge
            coef = np.linalg.solve(A, sums[:, len(above):, None])[:, 1:, 0]
            keys = [b[k].take(pa.array(np.repeat(np.arange(len(sums)), n))) for k in key]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(feats * len(sums), pa.string()), pa.array(coef.ravel())], names=[*key, "feature", "weight"])

    of_key = ", ".join(f"`{k}` {types[k]}" for k in key)
    parts = scored.mapInArrow(add, f"{of_key}, " + ", ".join(f"_ck_m{i} double" for i in range(len(left))))
    sums = parts.groupBy(*key).agg(*[F.sum(f"_ck_m{i}").alias(f"_ck_m{i}") for i in range(len(left))])
    return sums.mapInArrow(solve, f"{of_key}, feature string, weight double")


def anchors(model, df: DataFrame, instance: dict, features: Sequence[str], bins: int = 4,
            threshold: float = 0.95, max_rules: int = 5) -> DataFrame:
    """X07 (re-aimed): greedy anchor for one instance.  Each candidate
    predicate is "feature in the instance's quantile bin"; at each step the
    precision (share of covered rows predicted like the instance) and
    coverage of every extension are computed by one aggregate.  Returns the
    steps ``(step, rule, precision, coverage)``."""
    from cohortkit.functions.ordered import quantile_values
    probs = {f"q{i}": i / bins for i in range(1, bins)}
    qv = quantile_values(df, list(features), probs)
    preds = {}
    for f in features:
        edges = [qv[f][k] for k in probs]
        x = instance[f]
        lo = max([e for e in edges if e is not None and e < x], default=None)
        hi = min([e for e in edges if e is not None and e >= x], default=None)
        c = F.lit(True)
        if lo is not None:
            c = c & (F.col(f) > lo)
        if hi is not None:
            c = c & (F.col(f) <= hi)
        preds[f] = (c, f"{lo if lo is not None else '-inf'} < {f} <= {hi if hi is not None else 'inf'}")
    target = model.transform(df.sparkSession.createDataFrame([instance])).first()["prediction"]
    scored = model.transform(df).select(*features, (F.col("prediction") == target).cast("double").alias("_ck_same"))
    chosen, steps, cur = [], [], F.lit(True)
    spark = df.sparkSession
    for step in range(min(max_rules, len(features))):
        cands = [f for f in features if f not in chosen]
        aggs = []
        for f in cands:
            cov = cur & preds[f][0]
            aggs += [F.avg(F.when(cov, F.col("_ck_same"))).alias(f"p_{f}"), F.avg(cov.cast("double")).alias(f"c_{f}")]
        r = scored.agg(*aggs).first()
        best = max(cands, key=lambda f: ((r[f"p_{f}"] or 0.0), r[f"c_{f}"] or 0.0, f))
        chosen.append(best)
        cur = cur & preds[best][0]
        steps.append((step + 1, " AND ".join(preds[f][1] for f in chosen), float(r[f"p_{best}"] or 0.0),
                      float(r[f"c_{best}"] or 0.0)))
        if (r[f"p_{best}"] or 0.0) >= threshold:
            break
    return spark.createDataFrame(steps, "step int, rule string, precision double, coverage double")


def anchor_rules(model, df: DataFrame, instances: DataFrame, features: Sequence[str], key: Sequence[str] = ("id",), bins: int = 4,
                 threshold: float = 0.95, max_rules: int = 5) -> DataFrame:
    """X07 for many instances in one job: greedy anchors as in ``anchors``, ``(key..., step, features, rule, covered, same, precision, coverage)``.

    A row becomes the vector of its quantile bins, and rows are counted by vector and prediction (at most bins^features
    groups, combined before the shuffle).  Each group then adds its counts to every rule of up to ``max_rules`` predicates that it meets: the cube.
    Instances of equal bins and prediction share their rules, so the cube is looked up and walked greedily (highest precision,
    then coverage, then name, until ``threshold`` is reached) once per kind of instance, and instances take their kind's steps by one join.  A
    kind is what a key's rows are: their bins, predictions and numbers.  A missing value is a bin of its own.  An edge
    counts as reached within a relative 1e-9, so the rounding of interpolated edges moves no row.
    """
    from itertools import combinations

    import numpy as np
    import pyarrow as pa

    from cohortkit.functions.ordered import quantile_values
    from cohortkit.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    key, feats = list(key), list(features)
    probs = {f"q{i}": i / bins for i in range(1, bins)}
    found = quantile_values(df, feats, probs)
    edges = {f: [found[f][p] + 1e-9 * max(1.0, abs(found[f][p])) for p in probs if found[f][p] is not None] for f in feats}
    masks = [c for size in range(1, min(max_rules, len(feats)) + 1) for c in combinations(range(len(feats)), size)]

    def digit(f):
        x = F.col(f).cast("double")
        return F.when(x.isNull() | F.isnan(x), bins).otherwise(sum((F.when(x > e, 1).otherwise(0) for e in edges[f]), F.lit(0)))

    digits = F.array(*[digit(f) for f in feats])
    powers = np.array([[(bins + 1) ** f if f in c else 0 for c in masks] for f in range(len(feats))], np.int64)

    def met(frame, keep):
        """Every rule that the bins of a row meet: its mask and, as one number, its bins."""
        def each(batches):
            for b in batches:
                for at in range(0, b.num_rows, 256):
                    part = b.slice(at, 256)
                    rule = np.asarray(part["_ck_d"].flatten()).reshape(part.num_rows, -1).astype(np.int64) @ powers
                    of = pa.array(np.repeat(np.arange(part.num_rows), len(masks)))
                    yield pa.RecordBatch.from_arrays([*[part[c].take(of) for c in keep], pa.array(np.tile(np.arange(len(masks), dtype=np.int32), part.num_rows)), pa.array(rule.ravel())],
                                                     names=[*keep, "mask", "rule"])
        types = dict(frame.dtypes)
        return frame.select(*keep, "_ck_d").mapInArrow(each, ", ".join(f"`{c}` {types[c]}" for c in keep) + ", mask int, rule bigint")

    counts = _pred(model, df.select(*feats)).groupBy(digits.alias("_ck_d"), F.col("prediction").alias("_ck_p")).agg(F.count(F.lit(1)).alias("n"))
    cube = met(counts, ["_ck_p", "n"]).groupBy("mask", "rule", "_ck_p").agg(F.sum("n").alias("n"))
    asked = _pred(model, instances.select(*key, *feats)).groupBy(*key, digits.alias("_ck_d"), F.col("prediction").alias("_ck_own")).agg(F.count(F.lit(1)).alias("_ck_times"))
    asked = asked.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("_ck_d", "_ck_own", "_ck_times"))).alias("_ck_kind")).checkpoint(eager=True)
    kinds = asked.select("_ck_kind").distinct().withColumn("_ck_no", F.monotonically_increasing_id()).checkpoint(eager=True)
    wanted = met(kinds.select("_ck_no", F.explode("_ck_kind").alias("k")).select("_ck_no", "k.*"), ["_ck_no", "_ck_own", "_ck_times"])
    # Keep of the cube what a kind asks for; a kind and rule meet one row per prediction.
    times = F.col("n") * F.col("_ck_times")
    stats = wanted.join(cube, ["mask", "rule"]).groupBy("_ck_no", "mask").agg(
        F.sum(times).alias("covered"), F.sum(F.when(F.col("_ck_p") == F.col("_ck_own"), times).otherwise(0)).alias("same"))
    # One row per kind: at most as many rules as there are masks.
    stats = stats.groupBy("_ck_no").agg(F.collect_list(F.struct("mask", "covered", "same")).alias("_ck_rules")).join(kinds, "_ck_no")
    total = df.count()

    def described(f, d):
        if d == bins:
            return f"{feats[f]} is missing"
        lows, highs = ["-inf", *edges[feats[f]]], [*edges[feats[f]], "inf"]
        return f"{lows[d]} < {feats[f]} <= {highs[d]}"

    number = {frozenset(c): i for i, c in enumerate(masks)}

    def walk(rules, d):
        known = {r["mask"]: (r["covered"], r["same"]) for r in rules}
        chosen, out = [], []
        while len(chosen) < min(max_rules, len(feats)):
            options = [(known.get(number[frozenset([*chosen, f])], (0, 0)), f) for f in range(len(feats)) if f not in chosen]
            (covered, same), f = max(options, key=lambda o: (o[0][1] / o[0][0] if o[0][0] else 0.0, o[0][0], feats[o[1]]))
            chosen.append(f)
            precision = same / covered if covered else 0.0
            out.append({"step": len(chosen), "features": ",".join(feats[i] for i in chosen), "rule": " AND ".join(described(i, int(d[i])) for i in chosen),
                        "covered": covered, "same": same, "precision": precision, "coverage": covered / total})
            if precision >= threshold:
                break
        return out

    steps = [("step", pa.int32()), ("features", pa.string()), ("rule", pa.string()), ("covered", pa.int64()), ("same", pa.int64()), ("precision", pa.float64()), ("coverage", pa.float64())]

    def walked(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                found = [walk(rules, d) for rules, d in zip(part["_ck_rules"].to_pylist(), part["_ck_first"].to_pylist())]
                yield pa.RecordBatch.from_arrays([part["_ck_no"], pa.array(found, pa.list_(pa.struct(steps)))], names=["_ck_no", "_ck_steps"])

    of_kind = stats.select("_ck_no", "_ck_rules", F.col("_ck_kind")[0]["_ck_d"].alias("_ck_first")).mapInArrow(
        walked, "_ck_no bigint, _ck_steps array<struct<step: int, features: string, rule: string, covered: bigint, same: bigint, precision: double, coverage: double>>")
    found = asked.join(of_kind.join(kinds, "_ck_no").select("_ck_kind", "_ck_steps"), "_ck_kind")
    return found.select(*key, F.explode("_ck_steps").alias("s")).select(*key, "s.*")


def counterfactuals(model, df: DataFrame, instances: DataFrame, features: Sequence[str],
                    key: Sequence[str] = ("id",), max_distance: float | None = None) -> DataFrame:
    """X08 (re-aimed): for each instance, the nearest existing row that the
    model predicts differently (standardized Euclidean distance; of equally
    near ones the least key).  Exact: rows are indexed by cell and prediction, and an instance
    visits cells of another prediction in order of their lower bounds
    (``neighbors``), however many instances there are.
    An instance gets none only if all rows are predicted alike, or none is
    within ``max_distance`` where that is given; rows with a missing feature
    take no part.  Output ``(key…, cf_key…, distance)``."""
    from cohortkit.operators import neighbors
    key, feats = list(key), list(features)
    st = df.agg(*[F.stddev_pop(f).alias(f) for f in feats]).first()
    vec = neighbors.vector_of(feats, [st[f] or 1.0 for f in feats])
    index = neighbors.build_index(_pred(model, df), vec, key, tag=F.col("prediction"))
    best = neighbors.knn(index, _pred(model, instances), vec, 1, tag=F.col("prediction")).select(
        *key, *[F.col(f"nn_{k}").alias(f"cf_{k}") for k in key], "distance")
    return best if max_distance is None else best.where(F.col("distance") <= max_distance)


def _pred(model, df):
    return model.transform(df).select(*df.columns, "prediction")


def compare_explanations(a: DataFrame, b: DataFrame, item: str = "feature", score: str = "importance") -> DataFrame:
    """Spearman correlation of two importance vectors over their
    common features (average ranks)."""
    from cohortkit.functions.ordered import average_rank
    from cohortkit.session import checkpoint_dir
    checkpoint_dir(a.sparkSession)
    # One row per feature, read by both rankings and their join: made once, as an explanation may take a pass over all rows.
    j = a.select(item, F.col(score).alias("_a")).join(b.select(item, F.col(score).alias("_b")), item).checkpoint(eager=True)
    ra = average_rank(j, "_a", name="ra").select("_a", "ra")
    rb = average_rank(j, "_b", name="rb").select("_b", "rb")
    r = j.join(ra, "_a").join(rb, "_b")
    from cohortkit.operators.stats import safe_corr
    return r.agg(safe_corr("ra", "rb").alias("spearman"), F.count(F.lit(1)).alias("n_features"))
