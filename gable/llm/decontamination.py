"""Benchmark decontamination with a broadcast set of normalised n-grams.

Benchmark items are cut into windows of 13 words (an item of fewer words is
one window). The windows are hashed and broadcast; document tasks scan every
window of every whole text against the hashes, verify each hit word by word,
and report hit words and items. Contaminated documents, or only the hit
spans, can then be removed.

Only a checked number of windows is broadcast: beyond ``max_windows`` the
benchmark is dealt into blocks by window hash, and the documents pass one
block after the other (written between two), each pass adding its spans.

Normalisation: A-Z become lower case; words are runs of digits, a-z and
everything beyond ASCII. Defined results: null text and text without words
have no hits; items without words have no window; windows of an item without
id count as hits but list no item; repeated items and rows count as they
stand; an empty benchmark hits nothing; other columns are kept by
:func:`decontaminate` whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gable.llm.common import Shared, materialise, runs, table

WINDOW = 13
# every ASCII byte that is no word character becomes a space, A-Z become a-z
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_RESULT = "struct<n_words:long,spans:array<struct<start:long,stop:long>>,items:array<string>>"


def words(text: Column) -> Column:
    """Normalised words of a text, as an array."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.array_remove(F.split(F.translate(text, upper, lower), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row a distinct window: its words (blank-joined) and the items that hold it."""
    w = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (WINDOW - 1), F.lit(1)))
    each = w.select("item", "w", F.explode(starts).alias("at")).select(
        "item", F.array_join(F.slice("w", F.col("at"), WINDOW), " ").alias("window"))
    return each.groupBy("window").agg(F.collect_set("item").alias("items"))


class WindowIndex:
    """Windows of one block, by length: hashes for the scan, words for the check."""

    def __init__(self, windows: Iterable[tuple[str, list[str]]]):
        self.vocabulary: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], list[str]] = {}
        for window, items in windows:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in window.encode().split())
            self.items[ids] = items
        # one random odd multiplier a word and a place; id 0 is a word of no window
        self.mix = np.random.default_rng(7).integers(1, 1 << 63, len(self.vocabulary) + 1, dtype=np.uint64)
        self.place = np.random.default_rng(8).integers(1, 1 << 63, WINDOW, dtype=np.uint64) | np.uint64(1)
        self.hashes = {}
        for n in sorted({len(ids) for ids in self.items}):
            rows = np.array([ids for ids in self.items if len(ids) == n], dtype=np.int64)
            self.hashes[n] = np.unique(self.hash(rows))

    def hash(self, rows: np.ndarray) -> np.ndarray:
        return (self.mix[rows] * self.place[:rows.shape[1]]).sum(axis=1, dtype=np.uint64)

    def scan(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """(words, merged hit spans, items) of every text."""
        known = self.vocabulary.get
        # \x01 cannot be in a normalised text; it ends every document
        stream = b" ".join(t.translate(_BYTES) + b" \x01" for t in texts).split()
        ids = np.fromiter((-1 if w == b"\x01" else known(w, 0) for w in stream), dtype=np.int64, count=len(stream))
        ends = np.flatnonzero(ids < 0)
        firsts = np.concatenate([[0], ends[:-1] + 1])
        gaps = np.concatenate([[0], np.cumsum(ids <= 0)])
        found: list[tuple[int, int, list[str]]] = []
        for n, hashes in self.hashes.items():
            if len(ids) < n:
                continue
            at = np.flatnonzero(gaps[n:] == gaps[:-n])
            for k in range(0, len(at), 1 << 16):
                some = at[k:k + (1 << 16)]
                windows = ids[some[:, None] + np.arange(n)]
                for p in np.flatnonzero(np.isin(self.hash(windows), hashes)).tolist():
                    items = self.items.get(tuple(windows[p].tolist()))
                    if items is not None:
                        found.append((int(some[p]), n, items))
        out = [(int(b - a), [], set()) for a, b in zip(firsts, ends)]
        for at, n, items in sorted(found, key=lambda f: f[0]):
            doc = int(np.searchsorted(ends, at))
            _, spans, held = out[doc]
            start = at - int(firsts[doc])
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(spans[-1][1], start + n))
            else:
                spans.append((start, start + n))
            held.update(items)
        return [(n, spans, sorted(held)) for n, spans, held in out]


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _scanner(index_of):
    @F.pandas_udf(_RESULT)
    def scan(texts: pd.Series) -> pd.DataFrame:
        raw = [t.encode("utf-8", "replace") if t else b"" for t in texts]
        rows = [r for a, b in runs([len(t) for t in raw], 1 << 20) for r in index_of.value.scan(raw[a:b])]
        return pd.DataFrame({"n_words": [r[0] for r in rows],
                             "spans": [[{"start": a, "stop": b} for a, b in r[1]] for r in rows],
                             "items": [r[2] for r in rows]})

    return scan


def scan_documents(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                   item_text_col: str = "text", max_windows: int = 250_000) -> DataFrame:
    """row (all columns of ``docs``), n_words, spans (of words) and items."""
    spark = docs.sparkSession
    windows = materialise(item_windows(items, item_id_col, item_text_col))
    blocks = max(1, -(-windows.count() // max_windows))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    rows = rows.withColumn("spans", F.lit(None).cast("array<struct<start:long,stop:long>>")).withColumn(
        "items", F.lit(None).cast("array<string>"))
    for k in range(blocks):
        block = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k)
        index = Shared(spark, WindowIndex((r.window, r["items"]) for r in block.collect()))
        hit = _scanner(index)(F.col(f"row.`{text_col}`").cast("string"))
        rows = rows.select("row", hit.alias("hit"), F.col("spans").alias("old"), F.col("items").alias("had"))
        if blocks == 1:
            rows = rows.select("row", "hit.n_words", "hit.spans", "hit.items")
        else:
            rows = materialise(rows.select(
                "row", "hit.n_words", F.concat(F.coalesce("old", F.array()), "hit.spans").alias("spans"),
                F.array_union(F.coalesce("had", F.array()), "hit.items").alias("items")))
    return rows if blocks == 1 else rows.withColumn(
        "spans", F.pandas_udf(_merge, "array<struct<start:long,stop:long>>")("spans"))


def _merge(spans: pd.Series) -> pd.Series:
    return pd.Series([[{"start": a, "stop": b} for a, b in merge_spans([(s["start"], s["stop"]) for s in some])]
                      for some in spans])


def _without_spans(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, cuts in zip(texts, spans):
        if text and len(cuts):
            raw = text.encode("utf-8", "replace")
            at = [(m.start(), m.end()) for m in _WORD.finditer(raw.translate(_BYTES))]
            kept, last = [], 0
            for s in cuts:
                kept.append(raw[last:at[s["start"]][0]])
                last = at[s["stop"] - 1][1]
            text = b"".join([*kept, raw[last:]]).decode()
        out.append(text)
    return pd.Series(out, dtype=object)


def n_hit() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])


def is_contaminated(part: float = 0.05) -> Column:
    """At least ``part`` of the words are hit (and one)."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * round(1 / part) >= F.col("n_words"))


def decontaminate(docs: DataFrame, items: DataFrame, remove: str = "documents", part: float = 0.05,
                  **options) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) with
    the hit words of all documents cut out of the text."""
    text_col = options.get("text_col", "text")
    rows = scan_documents(docs, items, **options).withColumn("n_hit", n_hit())
    if remove == "spans":
        cut = F.pandas_udf(_without_spans, "string")(F.col(f"row.`{text_col}`"), F.col("spans"))
        return rows.select(*[(cut if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
    return rows.where(~is_contaminated(part)).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = scan_documents(docs, table(spark, sf_dir, "benchmark")).withColumn("n_hit", n_hit())
    ids = F.array_join(F.array_sort("items"), ",")
    return rows.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(ids.cast("binary"), 256).alias("items_sha256"), is_contaminated().alias("contaminated"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS k
       FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
       FROM d, ns, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
h AS (SELECT DISTINCT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM h, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
x AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN x ON d.doc_id = x.doc_id
"""
