"""Plausibility flags, outlier split and capping (inventory J1-J3, F8, I2, B13)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gable.functions import codes

FLAG_SUFFIX = "_unusual"


def flag_out_of_range(df: DataFrame, ranges: Mapping[str, tuple], suffix: str = FLAG_SUFFIX) -> DataFrame:
    """``<c>_unusual`` = 1 when c is present, not -1 and outside the
    inclusive range. Absent columns are skipped."""
    flags = {
        f"{c}{suffix}": codes.out_of_range_flag(c, lo, hi)
        for c, (lo, hi) in ranges.items() if c in df.columns
    }
    return df.withColumns(flags) if flags else df


def any_flag(df: DataFrame, suffix: str = FLAG_SUFFIX):
    """F8: row-wise sum of the flag columns > 0 (NULL when there are none)."""
    flags = [c for c in df.columns if c.endswith(suffix)]
    if not flags:
        return None, flags
    return reduce(add, [F.col(c) for c in flags]) > 0, flags


def split_outliers(df_flagged: DataFrame, suffix: str = FLAG_SUFFIX) -> tuple[DataFrame, DataFrame]:
    """(clean, outliers) from the flag columns, flags dropped.

    The two outputs are complementary filters of one plan; with no flag
    columns every row is clean and the outlier side is empty (B13).
    """
    cond, flags = any_flag(df_flagged, suffix)
    if cond is None:
        return df_flagged, df_flagged.limit(0)
    outliers = df_flagged.where(cond).drop(*flags)
    clean = df_flagged.where(~cond).drop(*flags)
    return clean, outliers


def label_outliers(df_flagged: DataFrame, label_col: str = "segment", suffix: str = FLAG_SUFFIX) -> DataFrame:
    """I2 as one pass: a label column 'clean' / 'outlier' instead of two
    filtered scans (use when both sides are written anyway)."""
    cond, flags = any_flag(df_flagged, suffix)
    if cond is None:
        return df_flagged.withColumn(label_col, F.lit("clean"))
    return df_flagged.withColumn(label_col, F.when(cond, "outlier").otherwise("clean")).drop(*flags)


def cap_values(df: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    """Values outside the range (the -1 sentinel exempt) become -1."""
    caps = {c: codes.cap_to_sentinel(c, lo, hi) for c, (lo, hi) in ranges.items() if c in df.columns}
    return df.withColumns(caps) if caps else df
