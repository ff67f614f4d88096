"""Mixing sources to target weights by capped water-filling.

A source's size is its number of words. The mix holds ``share`` of all words;
every source gets its weight's part of it, clamped at ``max_epochs`` times
its own size, and the excess is shared among the others by weight again until
no target is above its clamp. A clamped source stays clamped, so a round is
one aggregate over the sources with the water level of the last round.

Each document is then taken floor(target / size) times whole, and once more
if it comes early enough in a seeded order of its source. The cut in that
order is found by histograms (1,024 bins of the order's key, the bin with the
cut in 1,024 again, then that bin's few rows one by one), so a source with a
third of all rows is never sorted or held in one task. A source's taken words
miss its target by at most half a document.

Defined results: null text has no words; a null source is a source of its
own, last in order; documents with equal ids share their place in the order;
sources without words have target 0; an empty table gives no rows; extra
columns are kept by :func:`apply_mix` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gable.llm.common import materialise

_U_BITS, _BIN_BITS = 60, 10
WORDS = r"[^ \t-\r]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def order_key(doc_id: Column, seed: int) -> Column:
    """60 bits of md5: the place of a document in the seeded order."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def ranked_sources(rows: DataFrame) -> DataFrame:
    """source, source_size, rank (from 0, by code point, null last), without a
    global sort: ranks inside range partitions plus the partitions' offsets."""
    by_name = F.col("source").asc_nulls_last()
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    dealt = materialise(sums.repartitionByRange(by_name).withColumn("part", F.spark_partition_id()))
    counts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    local = F.row_number().over(Window.partitionBy("part").orderBy(by_name)) - 1
    return dealt.withColumn("local", local).join(offsets, "part").select(
        "source", "source_size", (F.col("before") + F.col("local")).alias("rank"))


def water_fill(sources: DataFrame, weights: list[float], share: float, max_epochs: float) -> DataFrame:
    """Add the target to ``sources`` (source, source_size, rank)."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    src = materialise(sources.select("source", "source_size", weight.alias("weight"),
                                     (F.col("source_size") * F.lit(float(max_epochs))).alias("clamp")))
    budget, level, clamped = (src.agg(F.sum("source_size")).first()[0] or 0) * share, 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > F.col("clamp")
        spent, left, n = src.agg(F.sum(F.when(above, F.col("clamp")).otherwise(0.0)),
                                 F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
                                 F.sum(above.cast("long"))).first()
        if not left or n == clamped:
            break
        level, clamped = (budget - spent) / left, n
    return src.select("source", "source_size", F.least(F.col("weight") * F.lit(level), F.col("clamp")).alias("target"))


def _boundary(bins: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source the bin in which the running size passes the extra words."""
    before = F.sum("bytes").over(Window.partitionBy("source").orderBy("bin")) - F.col("bytes")
    goals = targets.select(F.col("source").alias("of"), "extra", "base")
    held = (bins.withColumn("before", before).join(goals, F.col("source").eqNullSafe(F.col("of")))
            .withColumn("before", F.col("base") + F.col("before")))
    return held.where((F.col("before") <= F.col("extra")) & (F.col("extra") < F.col("before") + F.col("bytes"))).select(
        "source", "bin", F.col("before").alias("base"), "extra")


def fit_mix(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: int = 17,
            id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """source, source_size, target, whole (copies of every document) and cut
    (documents with an order key up to it are taken once more)."""
    rows = materialise(docs.select(F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
                                   order_key(F.col(id_col), seed).alias("u")))
    src = water_fill(ranked_sources(rows), list(weights), share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    src = materialise(src.withColumn("whole", whole).withColumn(
        "extra", F.col("target") - F.col("whole") * F.col("source_size")))
    # two rounds of histograms, then the rows of one small bin a source
    open_bins = src.select("source", "extra", F.lit(0).cast("long").alias("base"))
    part, shift = rows, _U_BITS
    for _ in range(2):
        shift -= _BIN_BITS
        bins = part.groupBy("source", F.shiftright("u", shift).alias("bin")).agg(F.sum("size").alias("bytes"))
        open_bins = materialise(_boundary(bins, open_bins))
        goals = open_bins.withColumnRenamed("source", "of")
        mine = F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("u", shift) == F.col("bin"))
        part = rows.join(goals, mine).select("source", "size", "u", "base", "extra", "bin")
    peers = Window.partitionBy("source").orderBy("u").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    tied = F.sum("size").over(Window.partitionBy("source", "u"))
    middle = F.col("base") + F.sum("size").over(peers) - tied / 2
    cuts = (part.withColumn("taken", middle <= F.col("extra")).groupBy("source", "bin")
            .agg(F.max(F.when(F.col("taken"), F.col("u"))).alias("last"))
            .select(F.col("source").alias("of"), F.coalesce("last", F.shiftleft("bin", shift) - 1).alias("cut")))
    joined = src.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left")
    return materialise(joined.select("source", "source_size", "target", "whole",
                                     F.coalesce("cut", F.lit(-1)).alias("cut")))


def _with_copies(rows: DataFrame, fitted: DataFrame) -> DataFrame:
    """``rows`` (row, doc_id, source, seed key u) with the fitted columns and copies."""
    fit = fitted.withColumnRenamed("source", "fit_source")
    return rows.join(fit, rows["source"].eqNullSafe(fit["fit_source"]), "left").withColumn(
        "copies", F.col("whole") + (F.col("u") <= F.col("cut")).cast("int"))


def apply_mix(docs: DataFrame, fitted: DataFrame, seed: int = 17, id_col: str = "doc_id",
              source_col: str = "source") -> DataFrame:
    """The mix itself: every document as often as it is taken, columns unchanged."""
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                       F.col(source_col).alias("source"), order_key(F.col(id_col), seed).alias("u"))
    taken = _with_copies(rows, fitted).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def mix(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: int = 17,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """What the mix takes of every document (one row a document)."""
    fitted = fit_mix(docs, weights, share, max_epochs, seed, id_col, text_col, source_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), n_words(F.col(text_col)).alias("size"),
                       F.col(source_col).alias("source"), order_key(F.col(id_col), seed).alias("u"))
    return _with_copies(rows, fitted).select("doc_id", "size", "source_size", "target",
                                             (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gable.llm.common import table
    return mix(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':17'), 1, 15) AS BIGINT) AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk
      FROM d GROUP BY source),
w AS (SELECT source, source_size, CAST([3, 1, 2][CAST(rk % 3 + 1 AS INT)] AS DOUBLE) AS weight,
             source_size * 2.0::DOUBLE AS clamp FROM s),
it AS (
  SELECT 0 AS k, 0.0::DOUBLE AS level
  UNION ALL
  SELECT k + 1, ((SELECT sum(source_size) FROM w) * 1.5::DOUBLE - c) / x FROM (
    SELECT k, (SELECT sum(CASE WHEN weight * level > clamp THEN clamp ELSE 0.0::DOUBLE END) FROM w) AS c,
           (SELECT sum(CASE WHEN weight * level > clamp THEN 0.0::DOUBLE ELSE weight END) FROM w) AS x
    FROM it WHERE k < 30)),
t AS (SELECT w.*, least(weight * (SELECT level FROM it WHERE k = 30), clamp) AS target FROM w),
f AS (SELECT t.*, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
r AS (
  SELECT doc_id, size, source_size, target, whole, target - whole * source_size AS extra,
         sum(size) OVER (PARTITION BY d.source ORDER BY u RANGE UNBOUNDED PRECEDING) AS upto,
         sum(size) OVER (PARTITION BY d.source, u) AS tied
  FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST((whole + CASE WHEN upto - tied / 2 <= extra THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM r
"""
