"""Runs of repeated words in texts, by recompression.

A run is a stretch of words with smallest period q that no neighbouring word
extends, and of at least max(``least_words``, ``exponent`` * q) words.

1. *Harmonic grid.* A stretch of 4 q words or more holds four places in a row of
   the grid 0, q, 2 q, ... So for every q the words on its grid are compared with
   the next ones; only three equal neighbours in a row make a candidate. That is
   n / q comparisons for every q, n log n in all, as arrays.
2. *Recompression.* The texts that have candidates are turned into one
   run-length grammar (:mod:`recompression`); longest common extensions on it
   give how far a candidate's period holds to the right and to the left, exactly.
3. A stretch found with several periods has the least of them; stretches found at
   several places of the grid are one.

Texts are taken in pieces of about ``_WORDS`` words, or one text, whatever its
length; every text is one task's work. Nothing is shuffled.

Defined results: null and empty texts and texts without words have no words and no runs;
a null id counts as an empty string; repeated rows stand for themselves; an
empty table gives no rows; other columns are kept whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gable.llm.common import runs as pieces
from gable.llm.common import table
from gable.llm.recompression import Grammar

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_WORDS = 1 << 18
Run = tuple[int, int, int]  # start, length, period


def _candidates(ids: np.ndarray, sizes: np.ndarray, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of the harmonic grids whose next ``exponent`` - 1 words equal theirs, by rising period.

    ``ids`` are the words of texts one after another, longest text first, with a
    number of its own after each text, so that no candidate spans two texts.
    """
    ends = np.cumsum(sizes + 1)
    places, periods, held = [], [], 0
    for q in range(1, int(sizes[0]) // exponent + 1):
        texts = int(np.searchsorted(-sizes, -exponent * q, side="right"))  # texts of at least exponent * q words
        grid = ids[:ends[texts - 1]:q]
        same = grid[1:] == grid[:-1]
        for _ in range(exponent - 2):
            if not same.any():
                break
            same = same[1:] & same[:-1]
        at = np.flatnonzero(same)
        if len(at):
            places.append(at * q)
            periods.append(np.full(len(at), q))
            held += len(at)
        if held and (held > _WORDS or q & (q + 1) == 0):  # what is found so far saves work on its multiples
            yield np.concatenate(places), np.concatenate(periods)
            places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def _stretches(grammar: Grammar, at: np.ndarray, period: np.ndarray, least_words: int, exponent: int) -> np.ndarray:
    """Rows (start, end, period) as far as the candidates' periods hold, long enough ones."""
    right = grammar.lce(at, at + period)
    left = grammar.lce(at - 1, at + period - 1, forward=False)
    found = np.column_stack([at - left, at + period + right, period])
    return np.unique(found[found[:, 1] - found[:, 0] >= np.maximum(least_words, exponent * period)], axis=0)


def _within(known: np.ndarray, at: np.ndarray, period: np.ndarray, exponent: int) -> np.ndarray:
    """Candidates that lie in a known stretch whose period divides theirs: they would find it again."""
    if not len(known):
        return np.zeros(len(at), dtype=bool)
    run = known[np.maximum(0, np.searchsorted(known[:, 0], at, side="right") - 1)]
    return (run[:, 0] <= at) & (at + (exponent - 1) * period < run[:, 1]) & (period % run[:, 2] == 0)


def find_runs(texts: list[np.ndarray], least_words: int = 6, exponent: int = 4) -> list[list[Run]]:
    """The runs of every text (an array of word numbers), by start and period."""
    if exponent < 3:
        raise ValueError("the grid needs an exponent of 3 at least")
    out: list[list[Run]] = [[] for _ in texts]
    order = sorted((k for k, t in enumerate(texts) if len(t) >= max(exponent, least_words)), key=lambda k: -len(texts[k]))

    def laid_out(order):
        sizes = np.array([len(texts[k]) for k in order], dtype=np.int64)
        top = max(int(texts[k].max()) for k in order) + 1
        ids = np.concatenate([np.append(texts[k], top + place) for place, k in enumerate(order)])
        return ids, sizes, np.concatenate([[0], np.cumsum(sizes + 1)])

    if not order:
        return out
    ids, sizes, starts = laid_out(order)
    some = np.zeros(len(order), dtype=bool)
    for at, _ in _candidates(ids, sizes, exponent):
        some[np.searchsorted(starts, at, side="right") - 1] = True
    order = [k for k, s in zip(order, some) if s]
    if not order:
        return out
    ids, sizes, starts = laid_out(order)
    grammar, known = Grammar(ids), np.empty((0, 3), dtype=np.int64)
    for at, period in _candidates(ids, sizes, exponent):
        new = ~_within(known, at, period, exponent)
        if new.any():
            known = np.concatenate([known, _stretches(grammar, at[new], period[new], least_words, exponent)])
            # the least period of every stretch
            known = known[np.lexsort((known[:, 2], known[:, 1], known[:, 0]))]
            known = known[np.concatenate([[True], (known[1:, :2] != known[:-1, :2]).any(axis=1)])] if len(known) else known
    text = np.searchsorted(starts, known[:, 0], side="right") - 1
    for k, (start, end, period) in zip(text.tolist(), (known - np.column_stack([starts[text], starts[text], 0 * text])).tolist()):
        out[order[k]].append((start, end - start, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def kept_words(size: int, found: list[Run]) -> np.ndarray:
    """Which words stay when every run keeps its first period alone."""
    change = np.zeros(size + 1, dtype=np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def repeat_tail(words: list[str], doc_id: str) -> list[str]:
    """The words with a tail that repeats, in every tenth text by the crc32 of its id: cases for :func:`query`."""
    h, n = zlib.crc32(doc_id.encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def _scan(batches: Iterator[pa.RecordBatch], least_words: int, exponent: int,
          change: Callable[[list[str], str], list[str]] | None) -> Iterator[tuple[pa.RecordBatch, list, list]]:
    """Pieces of batches (column 0 the id, 1 the text) with their words and runs."""
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for a, b in pieces([len(t) for t in texts], 6 * _WORDS):
            words, numbers, arrays = [], {}, []
            for i, text in zip(batch.column(0).slice(a, b - a).to_pylist(), texts[a:b]):
                found = _WORD.findall(text)
                words.append(change(found, "" if i is None else i) if change else found)
                arrays.append(np.array([numbers.setdefault(w, len(numbers)) for w in words[-1]], dtype=np.int64))
            yield batch.slice(a, b - a), words, find_runs(arrays, least_words, exponent)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _with_runs(docs: DataFrame, id_col: str, text_col: str, least_words: int, exponent: int, change, collapse: bool) -> DataFrame:
    """(row, n_words, runs, collapsed): ``row`` is the document, ``collapsed`` its kept words joined by a space."""
    def scan(batches):
        for rows, words, found in _scan(batches, least_words, exponent, change):
            told = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found]
            text = [" ".join(np.array(w, dtype=object)[kept_words(len(w), r)]) if r else " ".join(w) for w, r in zip(words, found)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(2), pa.array([len(w) for w in words], pa.int64()), pa.array(told, pa.list_(_RUN)),
                 pa.array(text if collapse else [None] * len(text), pa.string())], names=["row", "n_words", "runs", "collapsed"])

    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    held = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), row)
    shape = (f"row {held.schema['row'].dataType.simpleString()}, n_words long, "
             "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
    return held.mapInArrow(scan, shape)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 6,
                  exponent: int = 4) -> DataFrame:
    """(row, n_words, runs) of every document: ``row`` holds its columns, ``runs`` (start, length, period) in words."""
    return _with_runs(docs, id_col, text_col, least_words, exponent, None, False).drop("collapsed")


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 6,
             exponent: int = 4) -> DataFrame:
    """``docs`` whose runs keep their first period: such texts are their kept words joined by a space, others stay as they are."""
    told = _with_runs(docs, id_col, text_col, least_words, exponent, None, True)
    new = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col(f"row.`{text_col}`"))
    return told.select(*[(new if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def digests(docs: DataFrame) -> DataFrame:
    """The columns of op11 for (doc_id, text), every tenth text with a repeated tail."""
    def digest(batches):
        for rows, words, found in _scan(batches, 6, 4, repeat_tail):
            best = [min(r, key=lambda x: (-x[1], x[0], x[2])) if r else (None, None, None) for r in found]
            listed = ["".join("%d,%d,%d\n" % x for x in r) for r in found]
            text = [" ".join(np.array(w, dtype=object)[kept_words(len(w), r)]) if r else " ".join(w) for w, r in zip(words, found)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(2), pa.array([len(r) for r in found], pa.int64()),
                 *(pa.array([b[k] for b in best], pa.int64()) for k in range(3)),
                 pa.array([None if b[0] is None else 1000 * b[1] // b[2] for b in best], pa.int64()),
                 *(pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in x]) for x in (listed, text))],
                names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    held = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long"))
    return held.mapInArrow(digest, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
                                   "runs_sha256 string, collapsed_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
