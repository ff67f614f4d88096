"""Encoding operators over column lists (inventory C1-C5, D1-D14).

Each applies one ``withColumns`` projection for all of its columns, so a
chain of them collapses into a single codegen'd Project.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gable.functions import codes, text
from gable.operators.columns import drop_values_keep_null, present


def extract_patterns(df: DataFrame, source: str, patterns: Mapping[str, str]) -> DataFrame:
    """One new column per regex (first group of the first match, NULL
    when nothing matches)."""
    return df.withColumns({name: text.regex_group(source, pat) for name, pat in patterns.items()})


def encode_yes_no(df: DataFrame, cols: Iterable[str], yes: str = "yes", no: str = "no") -> DataFrame:
    """C4 over a column list: yes -> 1, no -> 0, else NULL."""
    live = present(df, cols)
    return df.withColumns({c: text.yes_no(c, yes, no) for c in live}) if live else df


def clean_numeric_strings(df: DataFrame, cols: Iterable[str], remove: str = "m", strict: bool = False) -> DataFrame:
    """C5 over a column list; with ``strict`` the query fails on malformed text."""
    live = present(df, cols)
    return df.withColumns({c: text.clean_numeric_string(c, remove, strict) for c in live}) if live else df


def classify_labels(
    df: DataFrame, source: str, label_col: str, group_col: str,
    groups: Mapping[str, Sequence[str]], default: str = "Other",
) -> DataFrame:
    """C2 + C3: normalised label column and its group (default for NULL/unknown)."""
    df = df.withColumn(label_col, text.normalize_label(source))
    return df.withColumn(group_col, text.classify(label_col, groups, default, normalize=False))


def encode_binary_with_missing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """{1 -> 1, 0 -> 0, else / NULL -> -1} as int."""
    live = present(df, cols)
    return df.withColumns({c: codes.binary_with_missing(c) for c in live}) if live else df


def fill_sentinel(df: DataFrame, cols: Iterable[str], sentinel=codes.SENTINEL) -> DataFrame:
    """NULL -> sentinel on the listed numeric columns."""
    live = present(df, cols)
    return df.na.fill(sentinel, subset=live) if live else df


def fill_category(df: DataFrame, cols: Iterable[str], label: str = "Missing") -> DataFrame:
    """D3: NULL -> a 'Missing' category on the listed string columns."""
    live = present(df, cols)
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(label)) for c in live}) if live else df


def ordinal_encode(
    df: DataFrame, col: str, mapping: Mapping[str, int], missing_label: str | None = "Missing",
    default: int | None = None,
) -> DataFrame:
    """Label -> code through a fixed map.

    NULL is first read as ``missing_label`` (when given). An unmapped label
    gives NULL unless ``default`` is set (D8/D9 use -1).
    """
    if col not in df.columns:
        return df
    value = F.col(col).cast("string")
    if missing_label is not None:
        value = F.coalesce(value, F.lit(missing_label))
    return df.withColumn(col, codes.lookup(value, mapping, default).cast("int"))


def remap_values(
    df: DataFrame, col: str, drop: Sequence[str] = (), remaps: Sequence[Mapping[str, str]] = ()
) -> DataFrame:
    """Drop rows holding one of ``drop`` (NULL kept), then apply each
    value map in turn; unmapped values pass unchanged."""
    if col not in df.columns:
        return df
    if drop:
        df = drop_values_keep_null(df, col, drop)
    for mapping in remaps:
        df = df.withColumn(col, F.coalesce(codes.lookup(F.col(col), mapping), F.col(col)))
    return df


def add_missing_flags(df: DataFrame, cols: Iterable[str], suffix: str = "_missing") -> DataFrame:
    """``<c>_missing`` = 1 where c is the sentinel (NULL -> 0)."""
    live = present(df, cols)
    return df.withColumns({f"{c}{suffix}": codes.missing_flag(c) for c in live}) if live else df


def sentinel_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Sentinel -> NULL on the listed columns."""
    live = present(df, cols)
    return df.withColumns({c: codes.sentinel_to_null(c) for c in live}) if live else df


def missingness_handler(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Flags first, then sentinel -> NULL."""
    cols = list(cols)
    return sentinel_to_null(add_missing_flags(df, cols), cols)


def add_log_features(df: DataFrame, cols: Iterable[str], suffix: str = "_log") -> DataFrame:
    """``<c>_log`` = log1p(c) where c > 0, NULL otherwise."""
    live = present(df, cols)
    return df.withColumns({f"{c}{suffix}": codes.log1p_positive(c) for c in live}) if live else df
