"""Fitted statistics: medians, modes, smoothed target encoding, group means
(inventory F3-F7, G1, E11, K5).

Scale design
------------
* Medians are exact without gathering a column anywhere: a
  ``percentile_approx`` pass brackets the middle ranks, a counting pass
  measures the bracket, and only a bounded bracket is collected. Wide
  brackets are narrowed by further passes over the bracket only.
* Modes and target-encoding statistics are ``groupBy`` aggregates over an
  unpivoted (column, value) view: one scan for all columns, partial
  aggregation before the shuffle, so a hot key costs one combined row per
  map task, not a giant group.
* Fitted tables are returned as DataFrames; they are joined back (broadcast
  only after their size is checked), never turned into python dicts of
  literals when their size grows with the data.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from gable.operators.columns import present
from gable.operators.joins import BROADCAST_MAX_ROWS
from gable.session import cut_lineage


def as_number(col: Column | str) -> Column:
    """Double with NaN read as missing (NULL), as a dataframe library's
    statistics skip NaN."""
    v = (F.col(col) if isinstance(col, str) else col).cast("double")
    return F.when(~F.isnan(v), v)


# ---------------------------------------------------------------------------
# medians (F6)
# ---------------------------------------------------------------------------

def exact_medians(
    df: DataFrame, cols: Sequence[str] | Mapping[str, Column], max_collect: int = 50_000, accuracy: int = 10_000,
    max_rounds: int = 8,
) -> dict[str, float | None]:
    """Exact median of each column, NULLs skipped, mean of the two middle
    values for an even count (a dataframe-library median). ``None`` for a
    column without values.

    Pass 1 brackets the middle ranks with ``percentile_approx``; pass 2
    counts rows below / inside the bracket and the distinct values inside;
    pass 3 collects the bracket as (value, count) pairs -- ties cost one
    pair, so a heavily tied column is as cheap as a small one. A bracket
    with too many distinct values is narrowed by another percentile pass
    restricted to it. Nothing but bounded (value, count) lists reaches the
    driver, and no task holds a whole column.
    """
    if isinstance(cols, Mapping):     # named expressions, e.g. one per CV fold
        vals = {name: as_number(expr) for name, expr in cols.items()}
    else:
        vals = {c: as_number(c) for c in cols}
    cols = list(vals)
    if not cols:
        return {}
    eps = 4.0 / accuracy
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(F.count(vals[c]).alias(f"n{i}"))
        aggs.append(F.percentile_approx(vals[c], [max(0.0, 0.5 - eps), min(1.0, 0.5 + eps)], accuracy).alias(f"b{i}"))
        aggs.append(F.min(vals[c]).alias(f"lo{i}"))
        aggs.append(F.max(vals[c]).alias(f"hi{i}"))
    row = df.agg(*aggs).first()
    state = {}
    for i, c in enumerate(cols):
        n = row[f"n{i}"]
        if not n:
            state[c] = None
            continue
        lo, hi = row[f"b{i}"] if row[f"b{i}"] else (row[f"lo{i}"], row[f"hi{i}"])
        state[c] = {"ranks": ((n - 1) // 2, n // 2), "lo": lo, "hi": hi, "min": row[f"lo{i}"], "max": row[f"hi{i}"]}
    result: dict[str, float | None] = {c: None for c in cols if state[c] is None}
    todo = [c for c in cols if state[c] is not None]

    # fused pass for columns whose bracket is provably small: rows strictly
    # inside it are at most (2 eps + 2 / accuracy) n and endpoint ties are
    # one (value, count) row each, so one grouped collect returns the
    # count below the bracket and the bracket's values together
    def bound(c):
        k1, k2 = state[c]["ranks"]
        return (2 * eps + 2.0 / accuracy) * (k1 + k2 + 1)

    fused = [c for c in todo if bound(c) <= max_collect]
    if fused:
        picked = F.array(*[
            F.when(vals[c] < state[c]["lo"], F.struct(F.lit(c).alias("c"), F.lit(0).alias("b"),
                                                      F.lit(None).cast("double").alias("v")))
            .when(vals[c].between(state[c]["lo"], state[c]["hi"]),
                  F.struct(F.lit(c).alias("c"), F.lit(1).alias("b"), vals[c].alias("v")))
            for c in fused])
        rows = (df.select(F.explode(F.filter(picked, lambda x: x.isNotNull())).alias("p"))
                .groupBy("p.c", "p.b", "p.v").agg(F.count(F.lit(1)).alias("k")).collect())
        below = {c: 0 for c in fused}
        pairs: dict[str, list] = {c: [] for c in fused}
        for r in rows:
            if r["b"] == 0:
                below[r["c"]] += r["k"]
            else:
                pairs[r["c"]].append((r["v"], r["k"]))
        for c in fused:
            k1, k2 = state[c]["ranks"]
            inside = sum(k for _, k in pairs[c])
            if not (below[c] <= k1 and k2 < below[c] + inside):
                continue                                    # approximation missed: iterative path
            pos, a, b = below[c], None, None
            for value, k in sorted(pairs[c]):
                if a is None and k1 < pos + k:
                    a = value
                if k2 < pos + k:
                    b = value
                    break
                pos += k
            result[c] = a if k1 == k2 else (a + b) / 2.0
            todo.remove(c)

    for _ in range(max_rounds):
        if not todo:
            break
        aggs = []
        for i, c in enumerate(todo):
            s, v = state[c], vals[c]
            aggs += [F.count_if(v < s["lo"]).alias(f"below{i}"),
                     F.count_if(v.between(s["lo"], s["hi"])).alias(f"inside{i}")]
        row = df.agg(*aggs).first()
        for i, c in enumerate(todo):
            state[c]["below"], state[c]["inside"] = row[f"below{i}"], row[f"inside{i}"]
        # distinct values can only exceed the limit when rows do: estimate
        # them (one more pass) just for those brackets
        crowded = [c for c in todo if state[c]["inside"] > max_collect and state[c]["lo"] != state[c]["hi"]]
        distinct = {c: state[c]["inside"] for c in todo}
        if crowded:
            row = df.agg(*[F.approx_count_distinct(F.when(vals[c].between(state[c]["lo"], state[c]["hi"]), vals[c]))
                           .alias(f"nd{i}") for i, c in enumerate(crowded)]).first()
            distinct.update({c: row[f"nd{i}"] for i, c in enumerate(crowded)})
        small, wide = [], []
        for c in todo:
            s = state[c]
            nd = distinct[c]
            k1, k2 = s["ranks"]
            if not (s["below"] <= k1 and k2 < s["below"] + s["inside"]):
                s["lo"], s["hi"] = s["min"], s["max"]      # approximation missed: whole range
                wide.append(c)
            elif s["lo"] == s["hi"]:
                result[c] = s["lo"]                        # both middle ranks are one tied value
            elif nd <= max_collect:
                small.append(c)
            else:
                wide.append(c)
        if small:
            picked = F.array(*[
                F.when(vals[c].between(state[c]["lo"], state[c]["hi"]), F.struct(F.lit(c).alias("c"), vals[c].alias("v")))
                for c in small
            ])
            pairs = (df.select(F.explode(F.filter(picked, lambda x: x.isNotNull())).alias("p"))
                     .groupBy("p.c", "p.v").agg(F.count(F.lit(1)).alias("k")).collect())
            by_col: dict[str, list] = {c: [] for c in small}
            for r in pairs:
                by_col[r["c"]].append((r["v"], r["k"]))
            for c in small:
                s = state[c]
                k1, k2 = s["ranks"]
                pos, a, b = s["below"], None, None
                for value, k in sorted(by_col[c]):
                    if a is None and k1 < pos + k:
                        a = value
                    if k2 < pos + k:
                        b = value
                        break
                    pos += k
                result[c] = a if k1 == k2 else (a + b) / 2.0
        if wide:
            aggs = []
            for i, c in enumerate(wide):
                s, v = state[c], vals[c]
                inside = max(s["inside"], 1)
                k1, k2 = s["ranks"]
                p1 = max(0.0, (k1 - s["below"]) / inside - eps)
                p2 = min(1.0, (k2 - s["below"] + 1) / inside + eps)
                aggs.append(F.percentile_approx(F.when(v.between(s["lo"], s["hi"]), v), [p1, p2], accuracy).alias(f"b{i}"))
            row = df.agg(*aggs).first()
            for i, c in enumerate(wide):
                if row[f"b{i}"]:
                    state[c]["lo"], state[c]["hi"] = row[f"b{i}"]
        todo = wide
    if todo:
        raise RuntimeError(f"median bracket did not converge for {todo}")
    return result


# ---------------------------------------------------------------------------
# modes (F7)
# ---------------------------------------------------------------------------

def modes(df: DataFrame, cols: Sequence[str], empty_value=0) -> dict[str, object]:
    """Most frequent non-null value per column, the smallest on ties;
    ``empty_value`` for a column without values. One job for all columns:
    numeric values travel as doubles (NaN read as missing), others as
    strings, in one unpivoted (column, value) aggregate."""
    cols = list(cols)
    if not cols:
        return {}
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = {c for c in cols if isinstance(types[c], NumericType)}
    entries = [F.struct(F.lit(c).alias("c"),
                        (as_number(c) if c in numeric else F.lit(None).cast("double")).alias("vn"),
                        (F.lit(None).cast("string") if c in numeric else F.col(c).cast("string")).alias("vs"))
               for c in cols]
    long = df.select(F.explode(F.array(*entries)).alias("p")).select("p.c", "p.vn", "p.vs") \
        .where(F.col("vn").isNotNull() | F.col("vs").isNotNull())
    counted = long.groupBy("c", "vn", "vs").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("c").agg(F.min_by(F.struct("vn", "vs"), F.struct(-F.col("n"), F.col("vn"), F.col("vs")))
                                    .alias("m"))
    out: dict[str, object] = {c: empty_value for c in cols}
    for r in best.collect():  # one row per column
        c = r["c"]
        if c in numeric:
            value = r["m"]["vn"]
            if types[c].typeName() in ("integer", "long", "short", "byte") and value is not None:
                value = int(value)
        else:
            value = r["m"]["vs"]
        out[c] = value
    return out


# ---------------------------------------------------------------------------
# imputation (K5)
# ---------------------------------------------------------------------------

def apply_imputation(
    df: DataFrame, medians: Mapping[str, float | None], binary_cols: Sequence[str],
    modes_: Mapping[str, object], skip: Sequence[str] = (),
) -> DataFrame:
    """Numeric -> median, binary -> 0, ordinal -> mode, in one projection.
    A ``None`` statistic leaves the column unchanged; ``skip`` columns are
    never touched."""
    exprs = {}
    types = {f.name: f.dataType for f in df.schema.fields}
    for c, med in medians.items():
        if c in types and c not in skip and med is not None and not (isinstance(med, float) and math.isnan(med)):
            v = F.col(c).cast("double")
            exprs[c] = F.when(v.isNull() | F.isnan(v), F.lit(float(med))).otherwise(v)
    for c in binary_cols:
        if c in types and c not in skip:
            base = exprs.get(c, F.col(c))
            exprs[c] = F.coalesce(base, F.lit(0).cast(types[c]))
    for c, mode in modes_.items():
        if c in types and c not in skip and mode is not None:
            base = exprs.get(c, F.col(c))
            if isinstance(types[c], StringType):
                exprs[c] = F.coalesce(base, F.lit(str(mode)))
            else:
                exprs[c] = F.coalesce(base, F.lit(mode).cast(types[c]))
    return df.withColumns(exprs) if exprs else df


# ---------------------------------------------------------------------------
# smoothed target encoding
# ---------------------------------------------------------------------------

@dataclass
class TargetEncoding:
    """Fitted encodings: ``table`` has (column, key, n, mean, te)."""

    table: DataFrame
    global_mean: float | None
    columns: list[str]
    alpha: float
    suffix: str
    sizes: dict[str, int] = field(default_factory=dict)

    def transform(self, df: DataFrame, fallback: bool = True, only_present: bool = True) -> DataFrame:
        """``<c><suffix>`` = encoding of c's value; unseen / NULL values
        take the global mean (or stay NULL without ``fallback``)."""
        for c in self.columns:
            if c not in df.columns:
                if only_present:
                    continue
                raise KeyError(c)
            out_col = f"{c}{self.suffix}"
            enc = self.table.where(F.col("column") == c).select(
                F.col("key").alias("__te_key"), F.col("te").alias("__te"))
            if self.sizes.get(c, BROADCAST_MAX_ROWS + 1) <= BROADCAST_MAX_ROWS:
                enc = F.broadcast(enc)
            df = df.drop(*[x for x in (out_col,) if x in df.columns])
            df = df.join(enc, F.col(c).cast("string") == F.col("__te_key"), "left").drop("__te_key")
            value = F.col("__te")
            if fallback and self.global_mean is not None:
                value = F.coalesce(value, F.lit(self.global_mean))
            df = df.withColumn(out_col, value).drop("__te")
        return df


def fit_target_encoding(
    df: DataFrame, cols: Sequence[str], target: str, alpha: float = 100.0, suffix: str = "_te",
    exact_decimal: tuple[int, int] | None = None, materialize: bool = True,
) -> TargetEncoding:
    """TE(v) = (n*mean + alpha*g) / (n + alpha) per column value,
    with g the target mean over all rows. One scan + one partially
    aggregated shuffle for all columns and the global mean together.

    ``exact_decimal=(p, s)`` sums the target as DECIMAL(p, s), which makes
    the means independent of summation order (money columns).
    """
    cols = present(df, cols)
    y = as_number(target)
    y_sum = y.cast(f"decimal({exact_decimal[0]},{exact_decimal[1]})") if exact_decimal else y
    entries = [F.struct(F.lit("__all__").alias("column"), F.lit(None).cast("string").alias("key"))]
    entries += [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("key")) for c in cols]
    long = df.select(F.explode(F.array(*entries)).alias("e"), y_sum.alias("y")).select("e.column", "e.key", "y")
    stats = long.groupBy("column", "key").agg(F.sum("y").alias("s"), F.count("y").alias("n"))
    stats = stats.withColumn("mean", F.try_divide(F.col("s").cast("double"), F.col("n"))).drop("s")
    if materialize:
        stats = cut_lineage(stats)
    # one small job: the global mean and the number of keys per column
    summary = stats.groupBy("column").agg(
        F.count_if(F.col("key").isNotNull()).alias("k"), F.max("mean").alias("m")).collect()
    g = next((r["m"] for r in summary if r["column"] == "__all__"), None)
    sizes = {r["column"]: r["k"] for r in summary if r["column"] != "__all__"}
    table = stats.where((F.col("column") != "__all__") & F.col("key").isNotNull())
    te = (F.col("n") * F.col("mean") + F.lit(alpha) * F.lit(g)) / (F.col("n") + F.lit(alpha))
    table = table.withColumn("te", te if g is not None else F.lit(None).cast("double"))
    return TargetEncoding(table, g, cols, alpha, suffix, sizes)


# ---------------------------------------------------------------------------
# group mean broadcast back to rows (G1)
# ---------------------------------------------------------------------------

def add_group_means(
    df: DataFrame, specs: Mapping[str, str], value: str, exact_decimal: tuple[int, int] | None = None,
) -> DataFrame:
    """G1: ``out = mean(value) over rows sharing key`` (NULL key -> NULL).

    Written as aggregate + join rather than a window: the aggregate combines
    map-side, so a key holding a third of the rows never becomes one
    in-memory window partition, and AQE broadcasts the per-key table when
    small or splits a skewed key on the row side.
    """
    y = as_number(value)
    y_sum = y.cast(f"decimal({exact_decimal[0]},{exact_decimal[1]})") if exact_decimal else y
    for out_col, key in specs.items():
        if key not in df.columns or value not in df.columns:
            continue
        per_key = (
            df.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.try_divide(F.sum(y_sum).cast("double"), F.count(y)).alias(out_col))
        )
        df = df.drop(*[c for c in (out_col,) if c in df.columns]).join(per_key, on=key, how="left")
    return df
