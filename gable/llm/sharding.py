"""Sharding by histogram sort, in DataFrame operations only.

Rows are ordered by a 62-bit key (38 bits of the text's hash, then 24 bits of
the id's hash: equal texts are neighbours, yet a text held by a third of all
rows can still be split). Splitters are found without sorting: each round
counts the exact bytes and rows below a bounded set of candidate boundaries,
in one aggregate with map-side combine, and only the intervals that still
hold a splitter are probed more finely, until every splitter meets the
tolerance. Then the rows are exchanged once, by range; the exact counts of
the last round give every range its first slot, so no task numbers more than
one range.

Law of the result: ``bytes``. Shard sizes differ from the mean by at most the
tolerance, or by one row where a row is larger than that.

Defined results: null text has size 8 and the crc of no bytes; a null id
hashes like a fixed value; repeated rows share a key and are neighbours; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gable.llm.common import materialise

KEY_BITS, ID_BITS = 62, 24


def sort_key(id_col: Column, text_col: Column) -> Column:
    text = F.shiftrightunsigned(F.xxhash64(text_col), 2)
    low = (1 << ID_BITS) - 1
    return text.bitwiseAND(F.lit(((1 << KEY_BITS) - 1) & ~low)).bitwiseOR(F.xxhash64(id_col).bitwiseAND(F.lit(low)))


def row_size(text_col: Column) -> Column:
    return F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 8


@dataclass
class Splitter:
    """A boundary: rows with a key below ``key`` count ``bytes`` and ``rows``."""
    key: int
    bytes: int
    rows: int


def find_splitters(rows: DataFrame, targets: list[tuple[float, float]], total: int, n_rows: int,
                   probes: int = 1 << 15) -> list[Splitter]:
    """Splitters for (target bytes below, tolerance), by rounds of counting.

    ``rows`` has key and size. A round probes at most ``probes`` boundaries
    (more only where there are more open intervals than an eighth of that),
    which bounds what reaches the driver.
    """
    found: dict[int, Splitter] = {}
    # open intervals: first key -> (bytes below, rows below); all are 2^shift wide
    shift, spans = KEY_BITS, {0: (0, 0)}
    wanted = {0: list(range(len(targets)))}
    while spans:
        bits = min(shift, max(3, (probes // len(spans)).bit_length() - 1))
        fine = shift - bits
        part = rows if shift == KEY_BITS else rows.where(
            F.shiftright("key", shift).isin([k >> shift for k in spans]))
        bins: dict[int, list[tuple[int, int, int]]] = {}
        for r in part.groupBy(F.shiftright("key", fine).alias("bin")).agg(
                F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect():
            bins.setdefault(r.bin << fine >> shift << shift, []).append((r.bin << fine, r.bytes, r.rows))
        after_spans, after_wanted = {}, {}
        for span, (below, rows_below) in spans.items():
            steps, at, counted = sorted(bins.get(span, [])), below, rows_below
            todo = iter(sorted(wanted[span], key=lambda i: targets[i][0]))
            i = next(todo, None)
            for key, size, n in steps:
                while i is not None and targets[i][0] <= at + size:
                    goal, tolerance = targets[i]
                    low, high = goal - at, at + size - goal
                    if min(low, high) <= tolerance or fine == 0:
                        found[i] = Splitter(key, at, counted) if low <= high else Splitter(
                            key + (1 << fine), at + size, counted + n)
                    else:
                        after_spans[key] = (at, counted)
                        after_wanted.setdefault(key, []).append(i)
                    i = next(todo, None)
                at, counted = at + size, counted + n
            while i is not None:  # beyond the last row
                found[i] = Splitter(1 << KEY_BITS, total, n_rows)
                i = next(todo, None)
        shift, spans, wanted = fine, after_spans, after_wanted
    return [found[i] for i in range(len(targets))]


def assign_shards(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
                  tolerance: float = 0.0005, rows_per_range: int = 2_000_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    ``tolerance`` is a share of the mean shard size. A shard is numbered in
    ranges of about ``rows_per_range`` rows, 8 at least.
    """
    text = F.col(text_col)
    rows = materialise(docs.select(
        F.col(id_col).alias("doc_id"), row_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        sort_key(F.col(id_col), text).alias("key")))
    total, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    per_shard = max(8, -(-n_rows // (n_shards * rows_per_range)))
    mean, step = total / n_shards, total / (n_shards * per_shard)
    # between two shards the tolerance is tight, inside a shard any near boundary will do
    targets = [(k * step, tolerance * mean if k % per_shard == 0 else 0.2 * step)
               for k in range(1, n_shards * per_shard)]
    cuts = find_splitters(rows, targets, total, n_rows)
    keys, firsts = [c.key for c in cuts], [0] + [c.rows for c in cuts]
    shard_keys = F.array(*[F.lit(k).cast("long") for k in keys[per_shard - 1::per_shard]])
    range_keys = F.array(*[F.array(*[F.lit(k).cast("long") for k in keys[s * per_shard:(s + 1) * per_shard - 1]])
                           for s in range(n_shards)])
    first = F.array(*[F.lit(n).cast("long") for n in firsts])
    below = lambda bounds: F.size(F.filter(bounds, lambda b: b <= F.col("key")))
    placed = (rows.withColumn("shard", below(shard_keys))
              .withColumn("range", F.col("shard") * per_shard + below(F.element_at(range_keys, F.col("shard") + 1))))
    at = F.element_at(first, F.col("range") + 1) - F.element_at(first, F.col("shard") * per_shard + 1)
    order = Window.partitionBy("range").orderBy("key", F.col("doc_id").asc_nulls_first(), "text_crc32")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (at + F.row_number().over(order) - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gable.llm.common import table
    return assign_shards(table(spark, sf_dir, "documents"), n_shards=24)
