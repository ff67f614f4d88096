"""Lookup joins and enrichment (inventory E1-E13, I1, F2, F9).

Broadcast policy: a side is broadcast only when its row count is proven
small -- a fixed dimension built from constants, or a table whose count was
checked against ``max_rows``. Anything else is left to the planner, where
AQE turns a sort-merge join into a broadcast join at runtime if the shuffled
side is small, and splits skewed partitions when one key is hot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gable.session import cut_lineage

from gable.functions import codes, text

# Rows up to which a checked lookup is broadcast. A few million narrow rows
# stay well below executor memory; beyond that a shuffle join is cheaper
# than replicating the table to every executor.
BROADCAST_MAX_ROWS = 2_000_000


_COUNTS: dict[tuple, int] = {}


def bounded(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only after the row count is checked (one cheap job on
    a small lookup; the count is remembered per plan for the session)."""
    # plan + the files it reads: a table that gained files is counted again
    key = (df.semanticHash(), tuple(sorted(df.inputFiles())))
    n = _COUNTS.get(key)
    if n is None:
        n = _COUNTS[key] = df.count()
    return F.broadcast(df) if n <= max_rows else df


def fixed(df: DataFrame) -> DataFrame:
    """Broadcast hint for a dimension built from constants (size is known)."""
    return F.broadcast(df)


def lookup_join(
    left: DataFrame, right: DataFrame, left_on: str | Sequence[str], right_on: str | Sequence[str] | None = None,
    how: str = "left", null_safe: bool = False,
) -> DataFrame:
    """Equi-join on same-named keys (one key column kept) or
    on differently named keys (both kept). ``null_safe`` matches NULL keys
    to NULL keys (E12), as a dataframe-library merge does."""
    lk = [left_on] if isinstance(left_on, str) else list(left_on)
    rk = lk if right_on is None else ([right_on] if isinstance(right_on, str) else list(right_on))
    if lk == rk and not null_safe:
        return left.join(right, on=lk, how=how)
    cond = None
    for a, b in zip(lk, rk):
        la, rb = left[a], right[b]
        term = la.eqNullSafe(rb) if null_safe else la == rb
        cond = term if cond is None else cond & term
    out = left.join(right, on=cond, how=how)
    if lk == rk:  # null-safe on same names: keep the left key only
        out = out.drop(*[right[b] for b in rk])
    return out


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """one row per key, the first by the ``order`` columns (file order
    does not exist in Spark, so priority must be explicit; rows equal on
    every order column are interchangeable).

    An aggregate, not a window: ``min_by`` combines map-side, so a key
    holding a third of all rows is reduced in every map task before the
    shuffle instead of being sorted whole by one task.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) for c in order])
    first = F.min_by(F.struct(*[F.col(c) for c in rest]), rank).alias("__first")
    return df.groupBy(*keys).agg(first).select(*keys, "__first.*")


def two_name_lookup(
    df: DataFrame, first_name: str, second_name: str, value_cols: Sequence[str], key: str = "name",
    order_col: str | None = None,
) -> DataFrame:
    """I1 + F2: stack both name variants of each row into one (name, values)
    lookup, first variant winning when a name occurs in both; within a
    variant the row first in ``order_col`` (file order) wins, else the
    smallest value."""
    extra = [order_col] if order_col else []
    first = df.select(text.lower_strip(first_name).alias(key), *value_cols, *extra, F.lit(0).alias("__prio"))
    second = df.select(text.lower_strip(second_name).alias(key), *value_cols, *extra, F.lit(1).alias("__prio"))
    stacked = first.unionByName(second).where(F.col(key).isNotNull())
    # a real value goes before a missing one
    missing = {f"__missing_{c}": F.col(c).isNull() for c in value_cols}
    order = ["__prio"] + extra + list(missing) + list(value_cols)
    return keep_first(stacked.withColumns(missing), [key], order).drop("__prio", *extra, *missing)


def fallback_lookup(
    df: DataFrame, lookup: DataFrame, first_key: str, second_key: str, group_key: str,
    value_col: str, lookup_key: str = "name", keep_unmatched: bool = False, pairs: DataFrame | None = None,
) -> DataFrame:
    """Value by ``first_key``; rows still NULL get the value found by
    ``second_key``, resolved once per ``group_key`` (first match), then
    rows without any value are dropped (E7) unless ``keep_unmatched``.

    The per-group fallback map is an aggregate over the distinct (group,
    second name) pairs joined to the lookup, so it is as small as the number
    of groups; it is written once and broadcast if its count is small.
    """
    lookup = bounded(lookup.select(lookup_key, value_col))   # broadcast only when its count is small
    first = lookup.select(F.col(lookup_key).alias("__k1"), F.col(value_col).alias("__v1"))
    out = df.join(first, df[first_key] == first["__k1"], "left").drop("__k1")
    # per-group map: first matching second-name value (min name breaks ties).
    # ``pairs`` (group, second name) should come from the dimension that
    # supplied the names -- the same pairs, without a second pass over df.
    if pairs is None:
        pairs = df.select(group_key, second_key)
    pairs = pairs.select(group_key, second_key).where(F.col(group_key).isNotNull()).distinct()
    second = lookup.select(F.col(lookup_key).alias("__k2"), F.col(value_col).alias("__v2"))
    per_group = (
        pairs.join(second, pairs[second_key] == second["__k2"], "inner")
        .groupBy(group_key)
        .agg(F.min_by("__v2", F.struct(second_key, "__v2")).alias("__v2"))
    )
    # written once, so that its count is read and not computed; a hot group is not shuffled
    per_group = bounded(cut_lineage(per_group, columnar=True))
    out = out.join(per_group, on=group_key, how="left")
    out = out.withColumn(value_col, F.coalesce("__v1", "__v2")).drop("__v1", "__v2")
    return out if keep_unmatched else out.where(F.col(value_col).isNotNull())


def count_unmatched(df: DataFrame, col: str) -> DataFrame:
    """rows whose looked-up value is NULL."""
    return df.agg(F.count_if(F.col(col).isNull()).alias("n_unmatched"))


def benchmark_tables(spark, province_table: Mapping, region_table: Mapping) -> tuple[DataFrame, DataFrame]:
    """The province and region benchmark dimensions as DataFrames with
    their value columns already suffixed (``*_province`` / ``*_region``)."""
    prov = spark.createDataFrame(list(zip(*province_table.values())), list(province_table.keys()))
    prov = prov.withColumnsRenamed({"apt_avg_m2": "apt_avg_m2_province", "house_avg_m2": "house_avg_m2_province"})
    reg = spark.createDataFrame(list(zip(*region_table.values())), list(region_table.keys()))
    reg = reg.withColumnsRenamed({"apt_avg_m2": "apt_avg_m2_region", "house_avg_m2": "house_avg_m2_region"})
    return prov, reg


def enrich_benchmarks(
    df: DataFrame, spark, province_table: Mapping, region_table: Mapping, national: Mapping,
    province_key: str = "province_nl", region_key: str = "region", type_col: str = "property_type",
    apartment_value: str = "Apartment", province_table_key: str = "province", region_table_key: str = "region",
) -> DataFrame:
    """E9, E10, D15, D16 (E13): province and region benchmark columns (the
    table keys are kept, so ``province`` is NULL when no benchmark exists),
    the type-selected benchmarks and the national average by lower(type).

    The tables are constants, so their broadcast is size-bounded by
    construction.
    """
    prov, reg = benchmark_tables(spark, province_table, region_table)
    value_cols = ["apt_avg_m2_province", "house_avg_m2_province", "apt_avg_m2_region", "house_avg_m2_region"]
    prov = prov.withColumns({c: F.col(c).cast("double") for c in value_cols[:2]})
    reg = reg.withColumns({c: F.col(c).cast("double") for c in value_cols[2:]})
    stale = [c for c in [province_table_key, *value_cols] if c in df.columns and c != province_key]
    df = df.drop(*stale)
    df = lookup_join(df, fixed(prov), province_key, province_table_key)
    if region_table_key != region_key and region_table_key in df.columns:
        df = df.drop(region_table_key)
    df = lookup_join(df, fixed(reg), region_key, region_table_key)
    nat = {k.lower(): float(v["avg"]) for k, v in national.items()}
    return df.withColumns({
        "province_benchmark_m2": codes.select_by_type(type_col, apartment_value, "apt_avg_m2_province", "house_avg_m2_province"),
        "region_benchmark_m2": codes.select_by_type(type_col, apartment_value, "apt_avg_m2_region", "house_avg_m2_region"),
        "national_benchmark_m2": codes.lookup(F.lower(type_col), nat),
    })
