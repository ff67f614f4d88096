"""Evaluation, selection and ensembling tables (inventory F10-F12, F14,
H1-H4, M10).

Everything is one aggregate over the predictions; grouping columns (model,
split, fold) make many evaluations one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gable.plans.presets import GAP_ALLOWANCE, GAP_WEIGHT


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def regression_metrics(
    df: DataFrame, y: str, p: str, by: Sequence[str] = (), digits: int | None = None,
) -> DataFrame:
    """n, MAE, RMSE and R^2 = 1 - SSE / SST per group.

    SST is ``n * var_pop(y)``; a constant target gives R^2 = NULL (0/0). Only
    rows with both a target and a prediction count, in every figure.
    """
    err = F.col(y) - F.col(p)
    scored_y = F.when(err.isNotNull(), F.col(y))
    aggs = [
        F.count(err).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(err * err), F.count(err) * F.var_pop(scored_y))).alias("r2"),
    ]
    out = df.groupBy(*by).agg(*aggs)
    if digits is not None:
        out = out.withColumns({c: F.round(c, digits) for c in ("mae", "rmse", "r2")})
    return out


def gap_penalty(train_r2: Column | str, val_r2: Column | str,
                allowance: float = GAP_ALLOWANCE, weight: float = GAP_WEIGHT) -> Column:
    """max(0, (train - val) - allowance) * weight; NULL where either is."""
    gap = _c(train_r2) - _c(val_r2)
    return F.when(gap.isNotNull(), F.greatest(F.lit(0.0), gap - F.lit(allowance)) * F.lit(weight))


def penalised_scores(metrics: DataFrame, by: Sequence[str], split_col: str = "split",
                     train: str = "train", val: str = "val") -> DataFrame:
    """F11 on an F10 table: one row per group with train/val R^2, gap,
    penalty and score = val R^2 - penalty."""
    wide = metrics.groupBy(*by).agg(
        F.max(F.when(F.col(split_col) == train, F.col("r2"))).alias("train_r2"),
        F.max(F.when(F.col(split_col) == val, F.col("r2"))).alias("val_r2"),
        F.max(F.when(F.col(split_col) == val, F.col("mae"))).alias("val_mae"),
    )
    return wide.withColumns({
        "gap": F.col("train_r2") - F.col("val_r2"),
        "penalty": gap_penalty("train_r2", "val_r2"),
    }).withColumn("score", F.col("val_r2") - F.col("penalty"))


def cv_summary(fold_metrics: DataFrame, by: Sequence[str], cols: Sequence[str] = ("r2", "mae")) -> DataFrame:
    """mean of per-fold metrics."""
    return fold_metrics.groupBy(*by).agg(*[F.avg(c).alias(f"mean_{c}") for c in cols],
                                         F.count(F.lit(1)).alias("folds"))


def residual_histogram(df: DataFrame, y: str, p: str, bins: int = 40, by: Sequence[str] = ()) -> DataFrame:
    """equal-width histogram of residuals y - p between their min and
    max (last bin closed). Two small jobs: the range, then the counts."""
    r = F.col(y) - F.col(p)
    rng = df.agg(F.min(r).alias("lo"), F.max(r).alias("hi")).first()
    lo, hi = rng["lo"], rng["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, n long, bin_lo double, bin_hi double")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((r - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counts = df.groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumns({
        "bin_lo": F.lit(lo) + F.col("bin") * F.lit(width),
        "bin_hi": F.lit(lo) + (F.col("bin") + 1) * F.lit(width),
    })


def top_k(df: DataFrame, value: str, k: int, by_abs: bool = False, name: str = "feature") -> DataFrame:
    """H1 / H2: rows ordered by value (or |value|) descending, first k,
    name as a tie breaker, with a 1-based rank column."""
    key = F.abs(F.col(value)) if by_abs else F.col(value)
    ordered = df.orderBy(key.desc(), F.col(name).asc()).limit(k)
    w = Window.orderBy(key.desc(), F.col(name).asc())
    return ordered.withColumn("rank", F.row_number().over(w))


def arg_min(df: DataFrame, value: str, name: str) -> DataFrame:
    """H3: the name with the smallest value (smallest name on ties; NULL values never win)."""
    return df.where(F.col(value).isNotNull()).agg(F.min_by(F.col(name), F.struct(F.col(value), F.col(name))).alias(name),
                  F.min(value).alias(value))


def ensemble_weight_search(
    df: DataFrame, y: str, p1: str, p2: str, split_col: str = "split", train: str = "train",
    val: str = "val", grid: int = 21, criterion: str = "score",
) -> DataFrame:
    """M10 + H4: evaluate w*p1 + (1-w)*p2 on train and val for ``grid``
    evenly spaced w in [0, 1].

    One scan: every weight's sums are separate aggregate columns (no cross
    join of predictions with a weight table); the 21-row result is built
    from the single aggregate row. ``criterion`` 'score' maximises val R^2
    minus the gap penalty, 'mae' minimises val MAE; the first (smallest) w
    wins ties, as a running strict-improvement search does.
    """
    weights = [i / (grid - 1) for i in range(grid)]
    aggs = []
    for part in (train, val):
        in_part = F.col(split_col) == part
        yv = F.when(in_part, F.col(y))
        aggs += [F.count(yv).alias(f"n_{part}"), F.var_pop(yv).alias(f"vy_{part}")]
        for i, w in enumerate(weights):
            e = yv - (F.lit(w) * F.col(p1) + F.lit(1.0 - w) * F.col(p2))
            aggs += [F.sum(e * e).alias(f"sse_{part}_{i}"), F.avg(F.abs(e)).alias(f"mae_{part}_{i}")]
    row = df.agg(*aggs)
    rows = []
    for i, w in enumerate(weights):
        rows.append(F.struct(
            F.lit(i).alias("i"), F.lit(w).alias("w"),
            (F.lit(1.0) - F.try_divide(F.col(f"sse_{train}_{i}"), F.col(f"n_{train}") * F.col(f"vy_{train}"))).alias("train_r2"),
            (F.lit(1.0) - F.try_divide(F.col(f"sse_{val}_{i}"), F.col(f"n_{val}") * F.col(f"vy_{val}"))).alias("val_r2"),
            F.col(f"mae_{val}_{i}").alias("val_mae"),
        ))
    table = row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    table = table.withColumns({"gap": F.col("train_r2") - F.col("val_r2"),
                               "penalty": gap_penalty("train_r2", "val_r2")})
    table = table.withColumn("score", F.col("val_r2") - F.col("penalty"))
    # the table has ``grid`` rows, so an unpartitioned window is one tiny task
    whole = Window.partitionBy()
    if criterion == "mae":
        best = F.min(F.when(F.col("val_mae").isNotNull(), F.struct("val_mae", "i"))).over(whole)["i"]
    else:
        best = F.min(F.when(F.col("score").isNotNull(), F.struct((-F.col("score")).alias("s"), "i"))).over(whole)["i"]
    return table.withColumn("is_best", (F.col("i") == best).cast("int"))
