"""Toxicity by a weighted lexicon and Aho-Corasick matching.

Texts are folded first: lower case, look-alike letters of other scripts and
full-width forms to Latin, digits and signs that stand for letters to those
letters, invisible characters dropped, everything else to blanks. Terms start
at a word's start; a term with a closing blank is a whole word, one without
is a stem.

Lexicon and weights are learned from labelled rows that are not held out.
Word stems and whole words are counted once a document; a term qualifies by
its share of the toxic documents and its log odds against all clean ones. Of
stems that extend each other the closed one is kept (no longer one has nearly
its support), and one that a shorter term explains as well goes. Exception
phrases (a term with its neighbour) are given, or learned: pairs that clean
documents hold and toxic ones do not. The score is a logistic function of the
matched weight, as it stands and per hundred words, fitted on the same rows.

Learning is bounded: ``max_toxic`` toxic and ``max_clean`` clean documents,
chosen by a hash of the id. Every term and every exception of these documents that
qualifies is in the lexicon. Scoring reads every whole text.

Words and stems have four letters at least (shorter words are no terms). Every sign
that is no letter or digit, of any script, is a blank. In scripts written without
blanks (Han, Kana, Thai, Lao, Khmer, Myanmar) every letter is a word of its own,
and a term is two or three of them in a row.

Defined results: null and empty texts match nothing and get the lowest
score; null labels are not learned from; where no toxic or no clean row is
labelled, or the table of documents or of labels is empty, all scores are 0; of
copies of a text one is learned from, toxic if any is; repeated rows are scored each;
a text of any length is one automaton pass; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gable.llm.common import Shared, is_held_out, materialise, table

# fixed values: look-alikes by Latin letter, and signs read as letters
HOMOGLYPHS = {
    "a": "аαɑ", "b": "ьв", "c": "сϲ", "d": "ԁ", "e": "еєε", "g": "ɡ", "h": "һн", "i": "іιı", "j": "ј", "k": "кκ",
    "l": "ӏ", "m": "м", "n": "пη", "o": "оοσ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ", "t": "тτ", "u": "υ",
    "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уγ", "z": "ᴢ",
}
SIGNS = {"a": "4@", "b": "8", "e": "3", "g": "9", "i": "1l", "o": "0", "s": "5$", "t": "7"}
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
_STEMS = range(4, 9)
_SOLID = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff])")
_SIGN = re.compile(r"[^\w ]|_")


def folding() -> dict[int, str | None]:
    """Translation table of the folding; l and 1 fold to i together."""
    table = {c: " " for c in range(128) if not chr(c).isalnum()}
    table |= {0xFF21 + k: chr(97 + k) for k in range(26)} | {0xFF41 + k: chr(97 + k) for k in range(26)}
    for letters in (HOMOGLYPHS, SIGNS):
        for latin, alike in letters.items():
            table |= {ord(c): latin for c in alike}
    for code in [c for c, latin in table.items() if latin == "l"]:
        table[code] = "i"
    return table | {ord(c): None for c in INVISIBLE}


def fold(text: str | None, table: dict) -> str:
    if not text:
        return " "
    folded = text.lower().translate(table)
    if not folded.isascii():  # the table has the ASCII signs
        folded = _SOLID.sub(r" \1 ", _SIGN.sub(" ", folded))
    return f" {folded} "


def terms_of(folded: str) -> set[str]:
    """Stems and whole words of a folded text, each with its leading blank."""
    out, words = set(), folded.split()
    for word in set(words):
        if len(word) >= _STEMS[0] and not word.isdigit():
            out.add(f" {word} ")
            out.update(f" {word[:k]}" for k in _STEMS if k <= len(word))
    if not folded.isascii():  # two and three letters in a row of a script without blanks
        solid = [bool(_SOLID.fullmatch(w)) for w in words]
        for n in (2, 3):
            out.update(f" {' '.join(words[k:k + n])} " for k in range(len(words) - n + 1) if all(solid[k:k + n]))
    return out


def qualified_terms(counted: DataFrame, n_toxic: int, n_clean: int, least: float, min_odds: float) -> DataFrame:
    """(term, odds) of the closed terms with enough support and odds, of all counted ones."""
    counted = materialise(counted.where(F.col("toxic") >= least).where(F.col("toxic") * n_clean > F.col("clean") * n_toxic))
    # a whole word extends its longest counted stem, a stem the one a letter shorter
    stem = F.when(F.col("term").endswith(" "), F.expr(f"left(term, 1 + least(length(term) - 2, {_STEMS[-1]}))")).otherwise(
        F.expr("left(term, length(term) - 1)"))
    longest = counted.groupBy(stem.alias("term")).agg(F.max("toxic").alias("longest"))
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    good = counted.withColumn("odds", odds).where(F.col("odds") >= min_odds).join(longest, "term", "left")
    return good.where(F.coalesce("longest", F.lit(0)) < 0.9 * F.col("toxic")).select("term", "odds")


def choose_terms(odds: dict[str, float]) -> dict[str, float]:
    """Qualified terms that no shorter one explains as well, to weights."""
    shorter = lambda t: (t[:k] for k in range(1 + _STEMS[0], len(t)))
    return {t: odds[t] for t in sorted(odds) if not any(s in odds and odds[s] >= odds[t] - 0.5 for s in shorter(t))}


class Matcher:
    """The automaton of terms and exception phrases."""

    def __init__(self, weights: dict[str, float], exceptions: list[str]):
        self.table = folding()
        self.machine = ahocorasick.Automaton()
        for term, weight in weights.items():
            self.machine.add_word(term, (len(term), weight))
        for phrase in exceptions:
            whole = " " + " ".join(fold(phrase, self.table).split()) + " "
            self.machine.add_word(whole, (len(whole), None))
        self.empty = not len(self.machine)
        if not self.empty:
            self.machine.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, stop, weight) of terms outside of exception phrases."""
        if self.empty:
            return []
        found = [(end + 1 - n, end + 1, w) for end, (n, w) in self.machine.iter(folded)]
        spared = [(a, b) for a, b, w in found if w is None]
        return [(a, b, w) for a, b, w in found if w is not None and not any(x <= a and b <= y for x, y in spared)]

    def fold(self, text: str | None) -> str:
        return re.sub(" +", " ", fold(text, self.table))

    def features(self, text: str | None) -> tuple[float, float, int]:
        """log of the matched weight, log of it per hundred words, hits."""
        folded = self.fold(text)
        found = self.hits(folded)
        total = sum(w for _, _, w in found)
        return math.log1p(total), math.log1p(100.0 * total / max(folded.count(" ") - 1, 1)), len(found)


def _tally(batches: Iterator[pa.RecordBatch], terms) -> Iterator[pa.RecordBatch]:
    """Sums of terms(text) by label, added up in the task before the shuffle."""
    sums: dict[str, list[int]] = {}

    def flush():
        yield pa.RecordBatch.from_pydict({
            "term": pa.array(list(sums), pa.string()), "toxic": pa.array([v[1] for v in sums.values()], pa.int64()),
            "clean": pa.array([v[0] for v in sums.values()], pa.int64())})
        sums.clear()

    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            for term in terms(text):
                sums.setdefault(term, [0, 0])[label] += 1
            if len(sums) > 100_000:
                yield from flush()
    yield from flush()


def count_terms(sample: DataFrame, terms) -> DataFrame:
    parts = sample.mapInArrow(lambda batches: _tally(batches, terms), "term string, toxic long, clean long")
    return parts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


class Model:
    def __init__(self, matcher: Matcher, weights: dict[str, float], bias: float, slopes: list[float]):
        self.matcher, self.weights, self.bias, self.slopes = matcher, weights, bias, slopes

    def score(self, text: str | None) -> tuple[float, int]:
        x, y, n = self.matcher.features(text)
        z = self.bias + self.slopes[0] * x + self.slopes[1] * y
        return (1 / (1 + math.exp(-z)) if z > -700 else 0.0), n


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_toxic: int = 4_000, max_clean: int = 4_000, min_share: float = 0.004, min_documents: int = 4,
        min_odds: float = 2.5, exceptions: tuple[str, ...] = ()) -> Model:
    """Learn lexicon, exceptions and score (see the module's docstring)."""
    given = labels.where(F.col(label_col).isin(0, 1) & ~is_held_out(F.col(id_col))).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"),
        F.pmod(F.xxhash64(F.col(id_col), F.lit("toxicity sample")), F.lit(1_000_000)).alias("u"))
    totals = {r.label: r.n for r in given.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    spark = docs.sparkSession
    nothing = Model(Matcher({}, []), {}, -1000.0, [0.0, 0.0])
    if len(totals) < 2:
        return nothing
    bound = F.when(F.col("label") == 1, F.lit(max_toxic / totals[1])).otherwise(F.lit(max_clean / totals[0]))
    chosen = materialise(given.where(F.col("u") < bound * 1_000_000).select("id", "label").distinct())
    if chosen.count() <= 2 * (max_toxic + max_clean):  # as expected of the hash: the texts stay where they are
        chosen = F.broadcast(chosen)
    # one copy of a text, whatever its label: copies would lend their words weight
    sample = materialise(docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                         .join(chosen, "id").groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("copy"))
                         .agg(F.first("text").alias("text"), F.max("label").alias("label")).drop("copy"))
    n = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return nothing
    letters = folding()
    counted = count_terms(sample, lambda text: terms_of(fold(text, letters)))
    least = max(min_documents, min_share * n[1])
    weights = choose_terms({r.term: r.odds for r in qualified_terms(counted, n[1], n[0], least, min_odds).collect()})
    plain = Shared(spark, Matcher(weights, []))

    def phrases(text: str) -> set[str]:
        folded = plain.value.fold(text)
        out = set()
        for a, b, _ in plain.value.hits(folded):
            stop = folded.index(" ", max(b - 1, a + 1))
            word, before, after = folded[a + 1:stop], folded[:a].rpartition(" ")[2], folded[stop + 1:].partition(" ")[0]
            out |= {f"{before} {word}"} if before else set()
            out |= {f"{word} {after}"} if after else set()
        return out

    # phrases of a term's neighbours in at most max_clean documents, in three of them at least: bounded as the sample is
    spared = [r.term for r in count_terms(sample, phrases).where("clean >= 3 and toxic = 0").orderBy("term").collect()]
    matcher = Matcher(weights, [*exceptions, *spared])
    shared = Shared(spark, matcher)

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([list(shared.value.features(t)[:2]) for t in texts])

    points = materialise(sample.select(features("text").alias("x"), "label"))
    fitted = LogisticRegression(regParam=1e-3, labelCol="label").fit(points.select(array_to_vector("x").alias("features"), "label"))
    return Model(matcher, weights, float(fitted.intercept), [float(c) for c in np.maximum(fitted.coefficients.toArray(), 0)])


def scorer(spark: SparkSession, model: Model):
    """Column function of a text: struct of score and n_terms."""
    shared = Shared(spark, model)

    @F.pandas_udf("score double, n_terms long")
    def score(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.score(t) for t in texts], columns=["score", "n_terms"])

    return score


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    told = scorer(spark, fit(docs, table(spark, sf_dir, "labels")))(F.col("text"))
    rows = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), told.alias("told"))
    return rows.select("doc_id", "held_out", "told.score", (F.col("told.score") >= 0.5).cast("int").alias("predicted"),
                       "told.n_terms")
