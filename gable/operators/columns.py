"""Projection and filter operators (inventory B1-B14, A13-A15).

Column-list parameters are pruned against ``df.columns`` at plan time
(schema only, no job), matching the source pipeline's "only if present"
behaviour. Every operator returns a lazy DataFrame, so Catalyst pushes the
filters and the column pruning into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """The given columns that exist in ``df``, in the given order."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Raise ``ValueError`` naming the missing required columns."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing expected raw columns: {missing}")
    return df


def enforce_types(df: DataFrame, dtypes: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns that are present."""
    casts = {c: F.col(c).cast(t) for c, t in dtypes.items() if c in df.columns}
    return df.withColumns(casts) if casts else df


def stamp_version(df: DataFrame, column: str, version: str) -> DataFrame:
    """Constant version column for a stage."""
    return df.withColumn(column, F.lit(version))


def not_null_filter(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """B2: keep rows where every listed column is non-null."""
    cond = None
    for c in cols:
        term = F.col(c).isNotNull()
        cond = term if cond is None else cond & term
    return df if cond is None else df.where(cond)


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``subset``."""
    return df.na.drop(how="any", subset=list(subset))


def keep_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Membership filter (NULL is dropped)."""
    return df.where(F.col(col).isin(list(values)))


def drop_values_keep_null(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Anti-membership filter that keeps NULL rows, as ``~isin`` does on
    a dataframe library (SQL ``NOT IN`` would drop them)."""
    return df.where(~F.coalesce(F.col(col).isin(list(values)), F.lit(False)))


def drop_if_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop the listed columns; absent ones are ignored."""
    return df.drop(*present(df, cols))


def rename_if_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the listed columns that are present."""
    live = {old: new for old, new in mapping.items() if old in df.columns}
    return df.withColumnsRenamed(live) if live else df


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of numeric columns (booleans and strings excluded)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def keep_numeric(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Keep numeric columns only (plus the ``keep`` columns)."""
    names = set(numeric_columns(df)) | set(keep)
    return df.select(*[c for c in df.columns if c in names])


def drop_by_affix(
    df: DataFrame, prefixes: Sequence[str] = (), suffixes: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """Drop columns by name prefix / suffix."""
    gone = [
        c for c in df.columns
        if c not in keep and (any(c.startswith(p) for p in prefixes) or any(c.endswith(s) for s in suffixes))
    ]
    return df.drop(*gone)


def select_features(df: DataFrame, features: Sequence[str], strict: bool = True) -> DataFrame:
    """Strict selection (fails on a missing name) or lenient (available subset)."""
    if strict:
        return df.select(*features)
    return df.select(*present(df, features))


def empty_like(df: DataFrame) -> DataFrame:
    """An empty result with the same schema."""
    return df.limit(0)
