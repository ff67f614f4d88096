"""MinHash near-duplicate detection with tensored banding.

A text's set is its distinct word n-grams. Two small collections of m sketches
are computed, each sketch the least values of r hash functions over the set. A
table key combines a sketch of the first collection with one of the second, so
m * m tables of 2 r minhashes a key cost 2 m r minhash functions instead
of 2 r m * m. Two sets of similarity s share a key unless all sketches
of one collection differ: with probability about 2 (1 - s ** r) ** m. With the
default m = 10, r = 2 that is 0.000005 at s = 0.85 and less above.

A class goes out once for each of its m sketches of the first collection, its m
others beside it, so m rows name its m * m buckets: all buckets that share a
first sketch meet in one task, which tells them apart by the second. There a
pair that meets in several buckets is told once, and large buckets with
common members become one group if comparing the union is no more work than comparing
them one by one. A first sketch of more rows than ``tile_rows`` (65,536, about 7 MB) is
dealt over several tasks by class; its buckets go on as members of their tables.

Pairs of small buckets are checked one by one, members of large ones in the blocks
of :mod:`linking`, always on the full sets (bitmap bound, then the sorted
arrays). A bucket of any size is compared whole. Components of the links, by :mod:`components`.

Defined results: null text and text without words have an empty set, link with
nothing and are their own component; texts of fewer words than n are one n-gram;
equal sets link (they have equal keys); repeated rows, null and repeated ids are
rows like others (a component's id is the least id in it); an empty table
gives no rows; other columns are kept by :func:`keep_one` whatever their names.
Texts of any length are taken whole; minhashes are taken of 65,536 elements at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gable.llm import linking
from gable.llm.common import table
from gable.llm.shingles import mix

_PIECE = 1 << 16


def miss_probability(similarity: float, m: int = 10, r: int = 2) -> float:
    """Probability that two sets of this similarity share no key."""
    return 1 - (1 - (1 - similarity ** r) ** m) ** 2


def sketches(num: int, den: int, m: int = 10, r: int = 2, seed: int = 1):
    """The m sketches of a set in the first collection, named by their place too, then its m of the second."""
    places = np.arange(2 * m * r, dtype=np.uint64)
    factor = (mix(places + np.uint64(seed << 20)) | np.uint64(1))[:, None]
    shift = mix(places + np.uint64((seed + 1) << 20))[:, None]
    place = mix(np.arange(1, m + 1, dtype=np.uint64))

    def found(elements: np.ndarray) -> np.ndarray:
        if len(elements) * den < num * (len(elements) + 1):  # not even a set with one element more links
            return elements[:0]
        least = np.full(2 * m * r, np.iinfo(np.uint64).max, dtype=np.uint64)
        for a in range(0, len(elements), _PIECE):
            least = np.minimum(least, (elements[a:a + _PIECE] * factor + shift).min(axis=1))
        both = mix(mix(least + places).reshape(2, m, r).sum(axis=2, dtype=np.uint64))
        return np.concatenate([mix(both[0] + place), both[1]])

    return found


def table_key(first: np.ndarray, second: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The key of a sketch of the first collection with the one of the second at a place."""
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + second + mix(place.astype(np.uint64) + np.uint64(1)))


def tensored_keys(num: int, den: int, m: int = 10, r: int = 2, seed: int = 1):
    """The m * m table keys of a set: every sketch of one collection with every one of the other."""
    of = sketches(num, den, m, r, seed)

    def keys(elements: np.ndarray) -> np.ndarray:
        both = of(elements)
        return table_key(both[:m, None], both[None, m:], np.arange(m)[None, :]).ravel() if len(both) else both

    return keys


def _split_buckets(first: np.uint64, classes: np.ndarray, second: np.ndarray, small: int):
    """Of the classes of one first sketch: pairs (x, y: rows) of small buckets, groups [(key, rows)] of large ones."""
    count, m = second.shape
    x, y, large = [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
    for j in range(m):
        order = np.argsort(second[:, j], kind="stable")
        value = second[order, j]
        starts = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        sizes = np.diff(np.concatenate([starts, [count]]))
        for size in np.unique(sizes[(sizes > 1) & (sizes <= small)]).tolist():
            held = order[starts[sizes == size][:, None] + np.arange(size)]
            one, other = np.triu_indices(size, 1)
            x.append(held[:, one].ravel())
            y.append(held[:, other].ravel())
        for start, size in zip(starts[sizes > small].tolist(), sizes[sizes > small].tolist()):
            key = table_key(first[None], value[start:start + 1], np.array([j]))[0]
            large.append((key, order[start:start + size]))
    label = np.arange(count)  # buckets with common members have one label
    while large:
        before = label
        label = label.copy()
        for _, rows in large:
            label[rows] = label[rows].min()
        label = label[label]
        if (label == before).all():
            break
    groups, merged = [], np.full(count, -1)
    together: dict[int, list] = {}
    for bucket in large:
        together.setdefault(int(label[bucket[1][0]]), []).append(bucket)
    for of, buckets in together.items():
        union = np.unique(np.concatenate([rows for _, rows in buckets]))
        if len(union) ** 2 <= sum(len(rows) ** 2 for _, rows in buckets):
            groups.append((buckets[0][0], union))
            merged[union] = of
        else:
            groups += buckets
    pairs = np.unique(np.concatenate(x) * count + np.concatenate(y))
    x, y = pairs // count, pairs % count
    apart = (merged[x] < 0) | (merged[x] != merged[y])
    return x[apart], y[apart], groups


def split_tiles(m: int):
    """From (tile: a first sketch, part, class, rest: the m second ones): pairs and members of buckets (b null)."""
    def split(batches: Iterator[pa.RecordBatch], small: int) -> Iterator[pa.RecordBatch]:
        for tiles, parts, classes, second in linking.whole_tiles(batches, m):
            starts, sizes = linking.tile_bounds(tiles, parts)
            whole = parts[starts] == 0
            for size in np.unique(sizes[whole & (sizes > 1) & (sizes <= small)]).tolist():  # no bucket is large
                held = starts[whole & (sizes == size)][:, None] + np.arange(size)
                one, other = np.triu_indices(size, 1)
                x, y = held[:, one].ravel(), held[:, other].ravel()
                meet = (second[x] == second[y]).any(axis=1)
                x, y = x[meet], y[meet]
                if len(x):
                    yield linking.tile_rows(tiles[x], classes[x], classes[y])
            for start, size in zip(starts[whole & (sizes > small)].tolist(), sizes[whole & (sizes > small)].tolist()):
                of = slice(start, start + size)
                x, y, groups = _split_buckets(tiles[of].view(np.uint64)[0], classes[of], second[of], small)
                if len(x):
                    yield linking.tile_rows(tiles[of][x], classes[of][x], classes[of][y])
                for key, rows in groups:
                    yield linking.tile_rows(np.full(len(rows), key).view(np.int64), classes[of][rows])
            dealt = np.flatnonzero(parts > 0)
            if len(dealt):
                keys = table_key(tiles[dealt].view(np.uint64)[:, None], second[dealt], np.arange(m)[None, :])
                yield linking.tile_rows(keys.ravel().view(np.int64), np.repeat(classes[dealt], m))

    return split


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 85, den: int = 100, m: int = 10, r: int = 2,
                    id_col: str = "doc_id", text_col: str = "text", tile_rows: int = 1 << 16, **options) -> DataFrame:
    """doc_id, key, n_shingles, class, component, component_id, n_links of every document."""
    found = linking.Profile(linking.text_rows(docs, id_col, text_col), n, sketches(num, den, m, r), counted=m, tile_rows=tile_rows)
    linked = linking.link(found, found.stored(), num, den, split_tiles=split_tiles(m), **options)
    return linking.document_links(found, linked)


def keep_one(docs: DataFrame, n: int = 5, num: int = 85, den: int = 100, id_col: str = "doc_id",
             text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component, chosen as :func:`linking.keep_one_of_each` tells."""
    told = near_duplicates(docs, n, num, den, id_col=id_col, text_col=text_col, **options)
    return linking.keep_one_of_each(docs, told, id_col, text_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = near_duplicates(table(spark, sf_dir, "documents"))
    return told.select("doc_id", "n_shingles", "component_id",
                       F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "n_links")
