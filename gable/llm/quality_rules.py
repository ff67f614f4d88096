"""Quality rules as a learned decision list, in DataFrame operations only.

Every text gets exact counts (words, characters in words, symbols, repeated
lines, words in repeated 8-word windows), from array functions on the row:
windows are hashed, a row whose hashes are all distinct has no repeat, and
only the others sort their (hash, position) pairs.

The list is learned from labelled statistics by sequential covering: a rule
is a conjunction of thresholds, grown by the condition with the largest
information gain on the growing rows, pruned on other rows to the prefix with
the best precision, accepted if it is precise enough there, and the rows it
covers leave. Rows are first reduced to counts by grid cell (map-side
combined), so a step is a small aggregate, and only its histograms (a few
hundred rows) reach the driver. The list becomes one CASE expression.

Defined results: null and empty texts have no words and fail the base rule;
rows without a label, with a label besides 0 and 1, or held out are not
learned from; without labels the list is empty and only the base rule
removes; repeated rows stand for themselves; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gable.llm.common import is_held_out, materialise, table

SPACE, WINDOW = r"[ \t-\r]", 8
# ratio features and their threshold grids (fixed, so that rules read well)
_SHARES = (0.002, 0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.18, 0.25, 0.35, 0.5, 0.7, 0.9)
GRIDS: dict[str, tuple[float, ...]] = {
    "mean_word": (2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0, 5.5, 6.0, 6.5, 7.0, 8.0, 10.0, 14.0),
    "symbol_share": _SHARES, "upper_share": _SHARES, "digit_share": _SHARES, "mark_share": _SHARES,
    "dup_line_share": _SHARES, "repeat_share": _SHARES, "distinct_share": _SHARES,
    "words": (20, 40, 80, 160, 320, 640, 1280, 2560, 5120),
    "line_words": (1, 2, 3, 5, 8, 12, 20, 40, 80, 160),
}


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, the exact counts and the ratio features."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = lambda chars: F.regexp_count("text", F.lit(chars)).cast("long")
    c = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: F.rlike(line, F.lit(r"[^ \t-\r]")))
    c = c.select("doc_id", F.array_remove(F.split("text", SPACE + "+"), "").alias("words"), lines.alias("lines"),
                 (F.length("text") - found(SPACE)).cast("long").alias("word_chars"),
                 found(r"[#*$%&|<>]").alias("n_symbols"), found(r"\p{Lu}").alias("n_upper"),
                 found(r"[0-9]").alias("n_digits"), found(r"[!?]").alias("n_marks"))
    c = c.withColumn("n_words", F.size("words").cast("long")).withColumn("n_lines", F.size("lines").cast("long"))
    c = c.withColumn("n_dup_lines", F.col("n_lines") - F.size(F.array_distinct("lines")))
    c = c.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).drop("words", "lines")
    starts = F.sequence(F.lit(1), (F.col("n_words") - (WINDOW - 1)).cast("int"))
    c = c.withColumn("windows", F.when(F.col("n_words") >= WINDOW, F.transform(
        starts, lambda i: F.xxhash64(F.slice("hashes", i, WINDOW)))))
    c = c.withColumn("n_distinct", F.size(F.array_distinct("hashes")).cast("long")).drop("hashes")
    # only where two windows are equal: sort, mark neighbours with equal hashes, back to text order
    pairs = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    c = c.withColumn("pairs", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), pairs)).drop("windows")
    like = lambda x, i: F.coalesce(x["h"] == F.get("pairs", i)["h"], F.lit(False))
    c = c.withColumn("at", F.array_sort(F.transform(
        F.filter("pairs", lambda x, i: like(x, i - 1) | like(x, i + 1)), lambda x: x["i"]))).drop("pairs")
    step = lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("at", i + 1) - p, F.lit(WINDOW)))
    c = c.withColumn("n_repeat_words", F.coalesce(F.aggregate(
        F.transform("at", step), F.lit(0).cast("long"), lambda n, x: n + x), F.lit(0))).drop("at")
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0)).alias
    return c.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words")("mean_word"), share("n_symbols", "word_chars")("symbol_share"),
        share("n_upper", "word_chars")("upper_share"), share("n_digits", "word_chars")("digit_share"),
        share("n_marks", "word_chars")("mark_share"), share("n_dup_lines", "n_lines")("dup_line_share"),
        share("n_repeat_words", "n_words")("repeat_share"), share("n_distinct", "n_words")("distinct_share"),
        F.col("n_words").cast("double").alias("words"), share("n_words", "n_lines")("line_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


# --- the decision list -----------------------------------------------------

@dataclass(frozen=True)
class Condition:
    """``feature >= threshold`` or ``feature < threshold``."""
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= self.threshold if self.above else c < self.threshold

    def on_cells(self) -> Column:
        bin_ = GRIDS[self.feature].index(self.threshold) + 1
        return F.col(self.feature) >= bin_ if self.above else F.col(self.feature) < bin_


@dataclass
class DecisionList:
    """Ordered rules; a row is removed by the first rule that covers it."""
    rules: list[tuple[Condition, ...]] = field(default_factory=list)

    def rule_number(self) -> Column:
        """Number of the first rule that covers the row (from 1), or null."""
        out = F.lit(None).cast("int")
        for k in reversed(range(len(self.rules))):
            out = F.when(_all(c.column() for c in self.rules[k]), F.lit(k + 1)).otherwise(out)
        return out

    def describe(self) -> list[str]:
        return [" and ".join(f"{c.feature} {'>=' if c.above else '<'} {c.threshold}" for c in r) for r in self.rules]


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def cells(labelled: DataFrame) -> DataFrame:
    """Grid cells (bin of every feature) with counts of junk and good rows.

    ``labelled`` has the features, bad (0/1) and growing (boolean).
    """
    bins = [sum(((F.col(f) >= t).cast("int") for t in grid), F.lit(0)).alias(f) for f, grid in GRIDS.items()]
    return labelled.select(*bins, "bad", "growing").groupBy(*GRIDS, "growing").agg(
        F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"))


def _histograms(rows: DataFrame) -> dict[str, list[tuple[int, int]]]:
    """(junk, good) of every bin of every feature."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in GRIDS]))
    out = {f: [(0, 0)] * (len(g) + 1) for f, g in GRIDS.items()}
    for r in rows.select(each.alias("e"), "p", "n").groupBy("e.f", "e.b").agg(F.sum("p").alias("p"), F.sum("n").alias("n")).collect():
        out[r.f][r.b] = (r.p, r.n)
    return out


def _best(histograms: dict, least: int) -> tuple[float, Condition | None, int, int]:
    """The condition with the largest gain, and the junk and good rows left."""
    best: tuple[float, Condition | None, int, int] = (0.0, None, 0, 0)
    purity = lambda p, n: math.log2(p / (p + n)) if p else -math.inf
    for f, bins in histograms.items():
        all_p, all_n = sum(b[0] for b in bins), sum(b[1] for b in bins)
        p = n = 0
        for k, t in enumerate(GRIDS[f]):
            p, n = p + bins[k][0], n + bins[k][1]
            for above, (a, b) in ((False, (p, n)), (True, (all_p - p, all_n - n))):
                if a >= least and (gain := a * (purity(a, b) - purity(all_p, all_n))) > best[0] + 1e-9:
                    best = gain, Condition(f, above, t), a, b
    return best


def learn(labelled: DataFrame, max_rules: int = 12, max_conditions: int = 4, min_precision: float = 0.95,
          min_rows: int = 10) -> DecisionList:
    """Sequential covering over the cells of ``labelled``."""
    left, found = materialise(cells(labelled)), DecisionList()
    least = min_rows
    while len(found.rules) < max_rules:
        rule: list[Condition] = []
        growing = left.where("growing")
        while len(rule) < max_conditions:
            _, condition, _, n = _best(_histograms(growing.where(_all(c.on_cells() for c in rule))), least)
            if condition is None:
                break
            rule.append(condition)
            if n == 0:
                break
        if not rule:
            break
        # prune: the prefix with the best precision on the other rows, the shortest of equals
        covered = [_all(c.on_cells() for c in rule[:k + 1]) for k in range(len(rule))]
        got = left.where(~F.col("growing")).agg(*[F.coalesce(F.sum(F.when(c, F.col(x))), F.lit(0)).alias(f"{x}{k}")
                                                  for k, c in enumerate(covered) for x in "pn"]).first()
        value = [(got[f"p{k}"] + 1) / (got[f"p{k}"] + got[f"n{k}"] + 2) for k in range(len(rule))]
        k = max(range(len(rule)), key=lambda j: (round(value[j], 3), -j))
        if got[f"p{k}"] == 0 or got[f"p{k}"] < min_precision * (got[f"p{k}"] + got[f"n{k}"]):
            break
        found.rules.append(tuple(rule[:k + 1]))
        left = left.where(~covered[k])
    return found


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", **options) -> DecisionList:
    """Learn from the statistics of labelled documents that the base rule passes."""
    given = labels.where(F.col(label_col).isin(0, 1) & ~is_held_out(F.col(id_col))).select(
        F.col(id_col).alias("doc_id"), (1 - F.col(label_col)).alias("bad"),
        (F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 > 1).alias("growing"))
    return learn(stats.where(~base_failed()).join(given, "doc_id"), **options)


def apply_rules(stats: DataFrame, rules: DecisionList) -> DataFrame:
    told = stats.withColumn("base_failed", base_failed()).withColumn("rule", rules.rule_number())
    return told.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = materialise(text_counts(table(spark, sf_dir, "documents")))
    return apply_rules(stats, fit(stats, table(spark, sf_dir, "labels")))
