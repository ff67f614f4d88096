"""Model queries on the driver tables (rows-only check: no SQL twin, but for ``lr_cv_lines``).

All read the whole star schema through the end-to-end flow; models, folds,
trials and search ranges are those of the source's runs (``models.GBT_PRESETS``,
``models.SEARCH_SPACES``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gable.ml import end_to_end_sql
from gable.ml import features as MF
from gable.ml import models, search
from gable.ml.boosting import loss_table
from gable.operators import split
from gable.plans import star
from gable.plans.catalog import _bucket_sql, register, table
from gable.session import cut_lineage, scratch_path, spread


def model_frame(spark, d, model_type: str = "xgb"):
    """Stage-3 rows of every split -> (frame with keys, label and numeric
    features plus a fold column, feature names)."""
    rows, _ = star.run(spark, d)
    frame, feats = MF.select_feature_columns(rows, "price", model_type, keep=["o_orderkey", "split", "c_mktsegment"])
    frame = split.assign_fold(frame, "o_orderkey", 5, seed=42)
    return frame, feats


@register("end_to_end", end_to_end_sql.build())
def q_end_to_end(spark, d):
    rows, _ = star.run(spark, d)
    # log1p and ln(1 + x) may differ in the last bit between engines
    return rows.withColumn("qty_sum_log", F.round("qty_sum_log", 9))


@register("feature_matrix")
def q_feature_matrix(spark, d):
    frame, feats = model_frame(spark, d, "xgb")
    return MF.assemble(frame, feats, "price", keep=["o_orderkey", "split"], handle_invalid="keep").df


def _cv(spark, d, kind, params, model_type):
    frame, feats = model_frame(spark, d, model_type)
    train = frame.where(F.col("split") == "train")
    folds = models.cross_validate(train, feats, "price", kind, params)
    return folds.join(models.cv_table(folds), ["model", "split"])


@register("lr_cv")
def q_lr_cv(spark, d):
    return _cv(spark, d, "linear", None, "linear")


@register("lr_cv_lines", f"""
WITH rows AS (
  SELECT CAST({_bucket_sql('CAST(l_orderkey AS VARCHAR)', 'fold:42', 5)} AS INTEGER) AS fold,
         l_extendedprice AS y, l_quantity AS x1, l_discount AS x2
  FROM lineitem WHERE l_orderkey IS NOT NULL AND l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL AND l_discount IS NOT NULL),
origin AS (SELECT avg(y) AS oy, avg(x1) AS o1, avg(x2) AS o2 FROM rows),
z AS (SELECT fold, y, y - oy AS y0, x1 - o1 AS a, x2 - o2 AS b FROM rows, origin),
sums AS (SELECT fold, count(*) AS n, sum(y0) AS y, sum(a) AS a, sum(b) AS b, sum(a * a) AS aa, sum(a * b) AS ab,
                sum(b * b) AS bb, sum(a * y0) AS ay, sum(b * y0) AS yb FROM z GROUP BY fold),
train AS (SELECT k.fold AS k, sum(s.n) AS n, sum(s.y) AS y, sum(s.a) AS a, sum(s.b) AS b, sum(s.aa) AS aa,
                 sum(s.ab) AS ab, sum(s.bb) AS bb, sum(s.ay) AS ay, sum(s.yb) AS yb
          FROM sums k JOIN sums s ON s.fold <> k.fold GROUP BY k.fold),
centred AS (SELECT k, y / n AS my, a / n AS ma, b / n AS mb, aa - a * a / n AS aa, ab - a * b / n AS ab, bb - b * b / n AS bb,
                   ay - a * y / n AS ay, yb - b * y / n AS yb FROM train),
solved AS (SELECT k, my, ma, mb, (bb * ay - ab * yb) / (aa * bb - ab * ab) AS ca,
                  (aa * yb - ab * ay) / (aa * bb - ab * ab) AS cb FROM centred),
scored AS (SELECT k, CASE WHEN fold = k THEN 'val' ELSE 'train' END AS split, y0,
                  y0 - (my + ca * (a - ma) + cb * (b - mb)) AS err FROM z, solved)
SELECT k AS fold, split, count(*) AS n, round(avg(abs(err)), 4) AS mae, round(sqrt(avg(err * err)), 4) AS rmse,
       round(1 - sum(err * err) / (count(*) * var_pop(y0)), 9) AS r2
FROM scored GROUP BY k, split
""")
def q_lr_cv_lines(spark, d):
    """M1 on two features of all order lines; the lines of an order are in one fold."""
    lines = table(spark, d, "lineitem").dropna(subset=["l_orderkey", "l_extendedprice", "l_quantity", "l_discount"])
    lines = split.assign_fold(lines, "l_orderkey", 5, seed=42)
    folds = models.cross_validate(lines, ["l_quantity", "l_discount"], "l_extendedprice", "linear", materialize=False)
    return folds.select("fold", "split", "n", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"),
                        F.round("r2", 9).alias("r2"))


@register("rf_cv")
def q_rf_cv(spark, d):
    return _cv(spark, d, "rf", None, "rf")


@register("gbt_cv")
def q_gbt_cv(spark, d):
    return _cv(spark, d, "xgb", None, "xgb")


@register("early_stop_gbt")
def q_early_stop_gbt(spark, d):
    frame, feats = model_frame(spark, d)
    train, (val,), _ = MF.median_impute(frame.where(F.col("split") == "train"),
                                        [frame.where(F.col("split") == "val")], feats)
    model, n_trees = models.fit_early_stopping(train, val, feats, "price", "xgb")
    return models.importance_table(model, feats).withColumn("trees_kept", F.lit(n_trees))


@register("early_stop_losses")
def q_early_stop_losses(spark, d):
    """M5: training and validation loss after each tree, and the trees that are kept."""
    frame, feats = model_frame(spark, d)
    train, (val,), _ = MF.median_impute(frame.where(F.col("split") == "train"),
                                        [frame.where(F.col("split") == "val")], feats)
    return loss_table(spark, models.boosted_on_split(train, val, feats, "price", "xgb"))


@register("feature_elimination")
def q_feature_elimination(spark, d):
    frame, feats = model_frame(spark, d)
    train = frame.where(F.col("split") == "train")
    return search.recursive_feature_elimination(train, feats, "price", "cat")


@register("permutation_importance")
def q_permutation_importance(spark, d):
    frame, feats = model_frame(spark, d)
    train, (val,), _ = MF.median_impute(frame.where(F.col("split") == "train"),
                                        [frame.where(F.col("split") == "val")], feats)
    model = models.fit_matrix(models.make_regressor("xgb"), spread(cut_lineage(MF.assemble(train, feats, "price").df)))
    return search.permutation_importance(model, val, feats, "price")


@register("param_search")
def q_param_search(spark, d):
    frame, feats = model_frame(spark, d)
    return search.param_search(frame.where(F.col("split") == "train"), frame.where(F.col("split") == "val"),
                               feats, "price", "xgb", models.SEARCH_SPACES["general"],
                               n_trials=models.SEARCH_TRIALS["general"])


@register("reduced_retrain")
def q_reduced_retrain(spark, d):
    """The same CV on a fixed reduced feature list (available subset)."""
    frame, feats = model_frame(spark, d)
    wanted = ["qty_sum", "n_lines", "c_acctbal", "o_custkey_te_price", "priority", "not_a_feature"]
    reduced = [f for f in wanted if f in feats]
    folds = models.cross_validate(frame.where(F.col("split") == "train"), reduced, "price", "xgb")
    return models.cv_table(folds).withColumn("num_features", F.lit(len(reduced)))


@register("segment_models_score")
def q_segment_models_score(spark, d):
    frame, feats = model_frame(spark, d)
    path = scratch_path(spark, "segment-models")
    # as in the source, the final models are fitted on every row, the test split's too
    fitted = search.fit_segment_models(frame, "c_mktsegment", {"house": "HOUSEHOLD", "apartment": "BUILDING"}, feats,
                                       "price", "xgb", path=path,
                                       segment_params={n: models.GBT_PRESETS[f"xgb_{n}"] for n in ("house", "apartment")})
    loaded = search.load_segment_models(path, ["house", "apartment"], "xgb")
    medians = {name: med for name, (_, med) in fitted.items()}
    return search.score_by_segment(frame.where(F.col("split") == "test"), loaded, "c_mktsegment", "HOUSEHOLD",
                                   "house", "apartment", feats, medians, keep=["o_orderkey", "c_mktsegment"])


@register("lr_coefficients")
def q_lr_coefficients(spark, d):
    """M6 + H2: linear-model coefficients, top 20 by absolute value."""
    from gable.operators import metrics
    frame, feats = model_frame(spark, d, "linear")
    train, _, _ = MF.median_impute(frame.where(F.col("split") == "train"), [], feats)
    model = models.make_regressor("linear").fit(MF.assemble(train, feats, "price").df)
    return metrics.top_k(models.importance_table(model, feats), "coefficient", 20, by_abs=True)


@register("param_search_mae")
def q_param_search_mae(spark, d):
    """M8, segment variant: one segment's rows, objective = validation MAE."""
    frame, feats = model_frame(spark, d)
    seg = frame.where(F.col("c_mktsegment") == "HOUSEHOLD")
    return search.param_search(seg.where(F.col("split") == "train"), seg.where(F.col("split") == "val"),
                               feats, "price", "xgb", models.SEARCH_SPACES["segment"],
                               n_trials=models.SEARCH_TRIALS["segment"], criterion="mae")
