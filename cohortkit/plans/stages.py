"""The five stage drivers: preprocess → features → EDA → train → interpret.

Each stage is one lazy plan from DataFrame to DataFrame plus small tidy
metric tables; actions happen only where a value decides later columns
(fill values, category lists, vocabulary, top-k names, models).  Stages
exchange data either in memory (one chained plan) or through Parquet.
Config keys follow the reference's names where they exist.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions import temporal as tm
from cohortkit.operators import clean, features as fe, interpret as xp, joins, lab, ml, scale, select as sel, stats

DEFAULTS = {
    "numeric_fill": "median", "cat_fill_value": "UNKNOWN", "text_max_features": 100, "n_features": 30,
    "n_clusters": 3, "n_components": 2, "random_state": 42, "test_size": 0.2, "n_trials": 0, "cv_folds": 3,
    "balance_strategy": "class_weight", "max_interaction_inputs": 10,
    "models": ("random_forest", "gbt", "logistic"),
}


def _cfg(config):
    c = dict(DEFAULTS)
    c.update(config or {})
    return c


def preprocess(admissions: DataFrame, patients: DataFrame, labs: DataFrame, subject: str = "subject_id",
               admission: str = "hadm_id", config: dict | None = None):
    """Stage 1 (J01, J02, I01): admissions ⟕ patients on the subject key,
    ⟕ lab events on (subject, admission), then cleaned.  Returns
    ``(processed, metrics)``."""
    t0 = time.time()
    m = joins.merge(admissions, patients, [subject], how="left")
    keys = [k for k in (subject, admission) if k in labs.columns]
    m = joins.merge(m, labs, keys, how="left", skewed_right=True)
    out = clean.clean_data(m, keys=[subject, admission])
    metrics = {"rows": out.count(), "columns": len(out.columns), "seconds": time.time() - t0}
    return out, metrics


def engineer(df: DataFrame, config: dict | None = None, admission: str = "hadm_id",
             time_cols: Sequence[str] = ("ADMITTIME", "DISCHTIME", "DEATHTIME"),
             lab_order: Sequence[str] | None = None, categorical: Sequence[str] = ("insurance", "admission_type",
                                                                                   "admission_location"),
             text_key: str | None = None, text_cols: Sequence[str] = ("ICD_CODE_LIST", "ALL_DRUGS", "DEPARTMENTS"),
             keep: Sequence[str] = ("subject_id", "hadm_id")):
    """Stage 2: temporal (F02–F07) → lab (A03, W01, W02, F09) → one-hot
    (I04) → TF-IDF (T01) → interactions (F10) → selection (R05) → scaling
    (I03).  Column names are matched case-insensitively.  ``keep``
    columns (identifiers) pass through untouched: never interacted,
    selected or scaled.  Returns ``(features_df, registry)`` where registry
    maps category → names."""
    c = _cfg(config)
    lower = {x.lower(): x for x in df.columns}
    keep = [lower[k.lower()] for k in keep if k.lower() in lower]

    def has(n):
        return lower.get(n.lower())

    reg = {"temporal": [], "lab": [], "categorical": [], "text": [], "interactions": []}
    tcols = [has(t) for t in time_cols if has(t)]
    admit, disch, death = (has(time_cols[0]), has(time_cols[1]) if len(time_cols) > 1 else None,
                           has(time_cols[2]) if len(time_cols) > 2 else None)
    before = set(df.columns)
    df = tm.temporal_features(df, tcols, admit=admit, disch=disch, death=death)
    reg["temporal"] = [x for x in df.columns if x not in before]
    key = has(admission)
    lab_cols = [x for x in sel.select_by_substring(df, "lab_") if not x.endswith(("_lower", "_upper"))]
    if key and lab_cols and lab_order:
        before = set(df.columns)
        df = lab.lab_features(df, key, list(lab_order), lab_cols)
        reg["lab"] = [x for x in df.columns if x not in before]
    cats = [has(x) for x in categorical if has(x)]
    if cats:
        before = set(df.columns)
        df = scale.one_hot(df, cats)
        reg["categorical"] = [x for x in df.columns if x not in before]
    if text_key:
        for tc in [has(x) for x in text_cols if has(x)]:
            before = set(df.columns)
            df = fe.tfidf_features(df, tc, c["text_max_features"])
            reg["text"] += [x for x in df.columns if x not in before]
    before = set(df.columns)
    target = has(c["target_col"]) if c.get("target_col") else None
    fixed = keep + ([target] if target else [])
    inputs = [x for x in fe.interaction_inputs(df, 10 ** 6, exclude=fixed)
              if x not in set(sel.columns_of_kind(df.select(*reg["temporal"]), "numeric"))][:c["max_interaction_inputs"]]
    df = fe.interactions(df, inputs)
    reg["interactions"] = [x for x in df.columns if x not in before]
    if target:
        cand = [x for x in sel.columns_of_kind(df, "numeric") if x not in set(fixed)]
        picked, names = stats.select_features(df, target, cand, c["n_features"])
        df = df.select(*keep, *names, target)
    df = scale.standard_scale(df, exclude=fixed)
    return df, reg


def eda(df: DataFrame, target: str | None = None, config: dict | None = None) -> dict[str, DataFrame]:
    """Stage 3: missing values (A01), distributions (A02), correlations
    (R01, R02), tests by target (R03, R04), PCA (M01), k-means (M02)."""
    c = _cfg(config)
    num = [x for x in sel.columns_of_kind(df, "numeric") if x != target]
    txt = [x for x in sel.columns_of_kind(df, "string") if x != target]
    out = {"missing": clean.missing_counts(df), "distributions": stats.distributions(df, num),
           "pearson": stats.corr_matrix(df, num), "spearman": stats.corr_matrix(df, num, "spearman")}
    if target:
        out["t_tests"] = stats.welch_tests(df, target, num)
        if txt:
            out["chi2"] = stats.chi2_tests(df, target, txt)
    if len(num) >= 2:
        var, n95, proj = ml.pca_analysis(df, num)
        out["pca_variance"], out["pca_projection"] = var, proj
        summary, assigned, clusters = ml.kmeans_analysis(df, num, c["n_clusters"], c["random_state"])
        out["clusters"] = clusters
    return out


def train(df: DataFrame, label: str, key: Sequence[str], features: Sequence[str] | None = None,
          config: dict | None = None, save_dir: str | None = None):
    """Stage 4 (M10): drop incomplete rows (S04), binary label remap (P11),
    feature list (P03, target excluded), split, per-model fit and score,
    best by accuracy."""
    c = _cfg(config)
    data = sel.drop_any_null(df)
    data = sel.remap_binary_label(data, label)
    feats = list(features) if features else [x for x in sel.feature_columns(data, target=label)
                                             if x in set(sel.columns_of_kind(data, "numeric"))
                                             and x not in set(key)]
    strategies = {"class_weight": "weights", "sampling": "smote", "smote": "smote", None: None}
    if c["balance_strategy"] not in strategies:
        raise ValueError(f"unknown balance_strategy {c['balance_strategy']!r}")
    balance = strategies[c["balance_strategy"]]
    metrics, best, fitted = ml.train_and_evaluate(data, feats, label, key, models=tuple(c["models"]),
                                                  n_trials=c["n_trials"],
                                                  seed=c["random_state"], balance=balance, save_dir=save_dir,
                                                  train_share=1.0 - c["test_size"], folds=c["cv_folds"])
    return metrics, best, fitted, feats


def interpret(model, df: DataFrame, features: Sequence[str], label: str, key: Sequence[str],
              repeats: int = 5, seed: int = 42) -> dict[str, DataFrame]:
    """Stage 5: built-in importances (X01), permutation importance (X02),
    and the side-by-side report (S12)."""
    spark = df.sparkSession
    imp = xp.builtin_importances(model, features, spark)
    perm = xp.permutation_importance(model, df, features, label, key, repeats, seed)
    report = xp.importance_report(imp, perm.select("feature", F.col("importance_mean").alias("importance")))
    return {"importances": imp, "permutation": perm, "report": report}
