"""Entry points under the names a user of the source pipeline knows.

Each delegates to the Spark operators; inputs and outputs are DataFrames
(lazy until an action), fitted state is a :class:`Stage3Model`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from gable.ml.features import Matrix, assemble, select_feature_columns
from gable.operators import metrics
from gable.operators.stage3 import Stage3, Stage3Model
from gable.plans import property as prop
from gable.plans import presets as P
from gable.sources import files


def load_and_clean_stage1(spark: SparkSession, path: str) -> DataFrame:
    """Stage 1 from the raw listings CSV."""
    return prop.stage1(files.read_listings(spark, path))


def stage2_pipeline(df_clean: DataFrame) -> DataFrame:
    """Stage 2: clean rows only, outliers dropped."""
    return prop.stage2(df_clean)


def stage25_geo_enrichment(df_stage2: DataFrame, lookups: prop.Lookups) -> DataFrame:
    """Stage 2.5 with the loaded lookup tables."""
    return prop.stage25(df_stage2, lookups)


def load_lookups(spark: SparkSession, income: str, geo: str, postal: str, address: str) -> prop.Lookups:
    """The four support tables of stage 2.5 (A2-A5)."""
    return prop.load_lookups(spark, income, geo, postal, address)


def run_full_pipeline_with_split(spark: SparkSession, raw_path: str, lookups: prop.Lookups,
                                 save_dir: str | None = None) -> dict:
    """Stages 1-2.5, 70/15/15 split, stage 3 fitted on train."""
    return prop.run_full_pipeline(files.read_listings(spark, raw_path), lookups, out_dir=save_dir)


def export_enriched(spark: SparkSession, raw_path: str, lookups: prop.Lookups, output_path: str) -> DataFrame:
    """Stages 1-2.5 written once; returns the stage audit."""
    return prop.export(files.read_listings(spark, raw_path), lookups, output_path)


def Stage3Fitter() -> Stage3:  # noqa: N802  (kept as a class-like factory)
    """Leakage-safe stage 3 (K1, K2): ``Stage3Fitter().fit(train).transform(df)``."""
    return Stage3.preset("fitter")


def fit_stage3(df_train: DataFrame) -> Stage3Model:
    """Training-script variant (K3)."""
    return Stage3.preset("training").fit(df_train)


def transform_stage3(df: DataFrame, fitted: Stage3Model) -> DataFrame:
    """Training-script variant (K4)."""
    return fitted.transform(df)


def stage3_pipeline(df_stage2: DataFrame) -> DataFrame:
    """Unfitted one-shot variant: statistics from the frame itself (K6)."""
    return Stage3.preset("oneshot").fit_transform(df_stage2)


def prepare_X_y(df: DataFrame, model_type: str = "linear", target: str = P.TARGET_COL) -> Matrix:  # noqa: N802
    """Feature vector + label (K7 / K8); model_type linear | rf | xgb | training."""
    drop = P.MATRIX_DROP_TRAINING if model_type == "training" else P.MATRIX_DROP_ALWAYS
    frame, feats = select_feature_columns(df, target, model_type, drop=drop)
    return assemble(frame, feats, target)


def evaluate_regression(df: DataFrame, y: str = "label", p: str = "prediction", by=()) -> DataFrame:
    """MAE / RMSE / R^2."""
    return metrics.regression_metrics(df, y, p, by)


def penalty(train_r2: Column | str, val_r2: Column | str) -> Column:
    """Soft gap penalty."""
    return metrics.gap_penalty(train_r2, val_r2)
