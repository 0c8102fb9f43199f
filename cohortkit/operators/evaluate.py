"""Evaluation of scored tables ``(label, prediction, score)``.

Curves and AUCs are built from one row per distinct score with running
sums computed by the two-level ``prefix_sums`` (no single-task window), and
every trapezoid term is row-local: the previous curve point follows from the
exclusive running sums, so no ``lag`` over a global order is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.ordered import prefix_sums
from cohortkit.session import checkpoint_dir

# Inner edges of ten equal-width calibration bins on [0, 1],
# as produced by linspace(0, 1, 11) in double precision.
CALIBRATION_EDGES = [0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9]


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(tn, fp, fn, tp)`` in one pass."""
    y, p = F.col(label), F.col(prediction)
    return df.agg(F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                  F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))


def _safe_div(a, b):
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                           beta: float = 2.0) -> DataFrame:
    """Accuracy, precision, recall, F1 and F-beta (0 when undefined)."""
    c = confusion(df, label, prediction)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    prec, rec = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    b2 = beta * beta
    return c.select(
        _safe_div(tp + tn, tp + tn + fp + fn).alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
        _safe_div(2 * prec * rec, prec + rec).alias("f1"),
        _safe_div((1 + b2) * prec * rec, b2 * prec + rec).alias(f"f{int(beta) if beta == int(beta) else beta}"))


def score_table(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row per distinct score, descending, with positives/negatives
    at that score and inclusive (``tp``, ``fp``) / exclusive (``tp0``,
    ``fp0``) running counts, plus class totals ``P`` and ``N``."""
    g = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    s = prefix_sums(g, ["threshold"], {"tp0": F.col("pos"), "fp0": F.col("neg")}, descending=True)
    tot = g.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    # tot is a single row; attach it with a broadcast equi-join on a constant.
    s = s.withColumn("_ck", F.lit(1)).join(F.broadcast(tot.withColumn("_ck", F.lit(1))), "_ck").drop("_ck")
    return s.select("threshold", "pos", "neg", "tp0", "fp0", (F.col("tp0") + F.col("pos")).alias("tp"),
                    (F.col("fp0") + F.col("neg")).alias("fp"), "P", "N")


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """``(threshold, fpr, tpr)`` at every distinct score (no points
    dropped) plus the origin at threshold +inf."""
    s = score_table(df, label, score)
    pts = s.select(F.col("threshold").cast("double").alias("threshold"),
                   F.try_divide(F.col("fp"), F.col("N")).alias("fpr"), F.try_divide(F.col("tp"), F.col("P")).alias("tpr"))
    origin = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return pts.unionByName(origin)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", table: DataFrame | None = None) -> DataFrame:
    """Exact ROC-AUC with ties counted half (trapezoid over every
    distinct score, equal to the rank-sum statistic).  ``table``: the
    ``score_table`` where it is known."""
    s = score_table(df, label, score) if table is None else table
    term = F.col("neg") * (F.col("tp0") + 0.5 * F.col("pos"))
    return s.agg(F.try_divide(F.sum(term), F.first("P") * F.first("N")).alias("roc_auc"))


def pr_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """``(threshold, precision, recall)`` from the highest score down to
    the first threshold reaching full recall."""
    s = score_table(df, label, score)
    return s.where(F.col("tp0") < F.col("P")).select(
        F.col("threshold").cast("double").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), (F.col("tp") / F.col("P")).alias("recall"))


def pr_auc(df: DataFrame, label: str = "label", score: str = "score", table: DataFrame | None = None) -> DataFrame:
    """Trapezoid area under the PR curve, starting at (recall 0,
    precision 1)."""
    s = (score_table(df, label, score) if table is None else table).where(F.col("tp0") < F.col("P"))
    p_now = F.col("tp") / (F.col("tp") + F.col("fp"))
    p_prev = F.when(F.col("tp0") + F.col("fp0") == 0, F.lit(1.0)).otherwise(
        F.col("tp0") / (F.col("tp0") + F.col("fp0")))
    term = F.col("pos") / F.col("P") * (p_now + p_prev) / 2
    return s.agg(F.sum(term).alias("pr_auc"))


def calibration_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Ten equal-width bins; per non-empty bin the mean score and the
    fraction of positives."""
    b = sum((F.col(score) > F.lit(e)).cast("int") for e in CALIBRATION_EDGES)
    return df.where(F.col(score).isNotNull()).groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("fraction_positive"))


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction",
             score: str = "score") -> DataFrame:
    """All scalar metrics of one scored table in one row.  The rows are
    scored once, and both areas read one table of distinct scores."""
    checkpoint_dir(df.sparkSession)
    df = df.select(*dict.fromkeys([label, prediction, score])).checkpoint(eager=True)
    table = score_table(df, label, score).checkpoint(eager=True)
    m = classification_metrics(df, label, prediction)
    a = roc_auc(df, label, score, table)
    p = pr_auc(df, label, score, table)
    return m.withColumn("_ck", F.lit(1)).join(a.withColumn("_ck", F.lit(1)), "_ck").join(
        p.withColumn("_ck", F.lit(1)), "_ck").drop("_ck")


def compare_models(metrics: DataFrame, model: str = "model", metric_cols: Sequence[str] | None = None) -> DataFrame:
    """Metric × model table from one row of metrics per model."""
    cols = list(metric_cols or [c for c in metrics.columns if c != model])
    long = metrics.unpivot([model], cols, "metric", "value")
    models = sorted(r[0] for r in metrics.select(model).distinct().collect())
    return long.groupBy("metric").pivot(model, models).agg(F.first("value"))
