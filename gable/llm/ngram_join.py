"""Exact n-gram Jaccard self-join with size-banded tiles and bitmap signatures.

1. A text's set is its distinct word n-grams (hashed to 64 bits, sorted).
   Texts with equal sets form a class; from here on classes are compared.
2. Two sets that reach the threshold t share one of the |x| - ceil(t |x|) + 1
   first elements of each, whatever the order of elements. The order is from
   rare to common, by counts of hash cells over all texts, so a line or
   passage of many texts names no tile unless a text has little else. A
   set goes to one tile for each of those elements; no link is lost. Sets too
   small to link with any other set go to none.
3. Tiles are compared as :mod:`linking` tells: pairs of small ones, blocks of
   size bands of larger ones. Bit counts of parity bitmaps of hashed elements
   bound the overlap from above (common elements cancel, so every bit in which
   two bitmaps differ is an element only one set has); pairs that may reach the
   threshold are checked by intersecting the sorted arrays. Every pair of different
   sets that links is found and counted once.
4. Components of the links, by :mod:`components`.

The result has a row for each document: its set's size, class, number of links
(other rows it links with, copies of its own set included) and component.

Defined results: null text and text without words have an empty set, link
with nothing and are their own component; texts of fewer words than n are one
n-gram; equal sets link however often they occur; repeated rows stand for
themselves; null and repeated ids are rows like others (a component's id is
the least id in it); an empty table gives no rows; other columns are kept by
:func:`keep_one` whatever their names. Texts of any length are taken whole, a
task holds the sets of about 2 MB of text, or of one text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from gable.llm import linking
from gable.llm.common import table


def rare_elements(num: int, den: int):
    """The elements of a set that name its tiles: as many of the rarest as every linked pair shares one of."""
    def tiles(elements: np.ndarray, cells: linking.Cells) -> np.ndarray:
        size = len(elements)
        if size * den < num * (size + 1):  # not even a set with one element more links
            return elements[:0]
        order = np.argsort(cells.of(elements), kind="stable")  # ties by element: arrays are sorted
        return elements[order[:size - -(-num * size // den) + 1]]

    return tiles


def similarity_classes(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id",
                       text_col: str = "text", **options) -> DataFrame:
    """doc_id, key, n_shingles, class, component, component_id, n_links of every document."""
    found = linking.Profile(linking.text_rows(docs, id_col, text_col), n)
    linked = linking.link(found, found.named(rare_elements(num, den)), num, den, **options)
    return linking.document_links(found, linked)


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
             text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: the one with the least id.

    Null ids come last; of rows with that id the one of the least key of id and
    text stays, and one of fully repeated rows. Documents without words all stay.
    """
    told = similarity_classes(docs, n, num, den, id_col, text_col, **options)
    return linking.keep_one_of_each(docs, told, id_col, text_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")
