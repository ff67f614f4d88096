"""Spelling variants by a relational trie frontier.

1. Words are counted in every task before they are shuffled.
2. The words of the vocabulary are spelled into an edge table (node, ch): a
   node is the string that leads to it, so the table needs no numbers and is
   built by one distinct.
3. A frontier of states (word, position, node, edits) is joined with the edge table
   level by level. A state without an edit goes on along its own word (it needs no
   join: every prefix of a word is a node), replaces a letter (any other edge of
   its node) or drops one (the node stays). A state with its edit, new or not, has to find
   the edge of its next letter, and only those that do are written. At its word's end
   it has to find the edge without a letter, which the nodes of whole words have:
   that is a neighbour. Insertions are deletions of the longer word, so
   each pair is found from one side at least and read from both.
4. An edit lies in one half of a word. Words are spelled forwards and
   backwards (marked ``>`` and ``<``), and a state starts behind the first half,
   at the node its own letters lead to. So no state branches near the root,
   where nodes have many edges and are few, and no word is walked twice.

A word longer than ``levels`` letters is not walked letter by letter: one edit
leaves one half of two words equal, so long words meet by equal halves, and
are then compared letter by letter. This is exact too.

Defined results: null text has no words; a null id counts as an empty string; empty and very
long texts and words are taken whole; a form of equal counts is the least in
code-point order; repeated rows count as often as they occur; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gable.llm.common import discard, materialise, table

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
_HELD = 1 << 18  # words a task counts before it sends them


def _typed(docs: DataFrame, id_col: str, text_col: str, least: int, every: int) -> DataFrame:
    """(word, n): words of at least ``least`` letters as often as a task has read them.

    A word is a run of A-Z, a-z and U+00C0 to U+00FF with A-Z lowered. Where
    ``every`` divides the crc32 of ``id:word`` a letter is left out.
    """
    def count(batches):
        held = Counter()

        def out():
            words = [w.decode("latin-1") for w in held]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())],
                                              names=["word", "n"])

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                start = zlib.crc32(b"%s:" % ("" if i is None else str(i)).encode())
                # beyond U+00FF nothing is a letter: "?" is a blank too
                for word, k in Counter(text.encode("latin-1", "replace").translate(_LETTERS).split()).items():
                    if len(word) < least:
                        continue
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                    if every and h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least:
                            continue
                    held[word] += k
                if len(held) > _HELD:
                    yield out()
                    held.clear()
        yield out()

    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(count, "word string, n long")


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = 5,
               least_count: int = 3, every: int = 97) -> DataFrame:
    """(word, n) of the words of at least so many letters and occurrences."""
    typed = _typed(docs, id_col, text_col, least_letters, every)
    return typed.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _halves(words: DataFrame) -> DataFrame:
    """(spelled, start): each word forwards and backwards, and the position behind its first half."""
    size = F.length("word")
    return words.select(F.explode(F.array(
        F.struct(F.concat(F.lit(">"), "word").alias("spelled"), (F.floor(size / 2) + 1).cast("int").alias("start")),
        F.struct(F.concat(F.lit("<"), F.reverse("word")).alias("spelled"), (F.ceil(size / 2) + 1).cast("int").alias("start")),
    )).alias("s")).select("s.*")


def _walk(words: DataFrame, levels: int) -> DataFrame:
    """(word, near): pairs of which the first has at most ``levels`` letters and the second no more than the first."""
    spelled = materialise(_halves(words.where(F.length("word") <= levels)))
    # edges of a word behind its first half (a shorter neighbour's states start no earlier), and one without a letter at its end
    at = F.explode(F.sequence(F.floor((F.length("spelled") - 1) / 2).cast("int") + 1, F.length("spelled")))
    edges = spelled.select("spelled", at.alias("at")).select(
        F.substring("spelled", F.lit(1), F.col("at")).alias("node"),
        F.substring("spelled", F.col("at") + 1, F.lit(1)).alias("ch"))
    edges = materialise(edges.distinct())

    word, position, node = F.col("word"), F.col("position"), F.col("node")
    letter, following = (F.substring(word, position + k, F.lit(1)) for k in (1, 2))  # position counts the mark; "" beyond the end
    going, tables = None, []
    for level in itertools.count():
        # a word that still walks here has 2 * level + 1 letters at least and started behind its half, so its node is that long too
        deep = edges.where(F.length("node") > 2 * level)
        whole = spelled.where(F.col("start") + level < F.length("spelled")).select(
            F.col("spelled").alias("word"), (F.col("start") + level).alias("position"),
            F.substring("spelled", F.lit(1), F.col("start") + level).alias("node"))
        on = bool(whole.take(1))
        if not on and (going is None or not going.take(1)):
            break
        # the next one of equal letters is dropped, not this one
        edited = whole.where(letter != following).select(word, (position + 1).alias("position"), node).union(
            whole.join(deep, "node").where((F.col("ch") != letter) & (F.col("ch") != "")).select(
                word, (position + 1).alias("position"), F.concat(node, "ch").alias("node")))
        if going is not None:
            edited = edited.union(going) if on else going
        new = materialise(edited.withColumn("ch", letter).join(deep, ["node", "ch"], "left_semi").select(
            word, (position + 1).alias("position"), F.concat(node, "ch").alias("node")))
        tables.append(new)
        going = new.where(position <= F.length(word))
    found = spelled.select("spelled", F.lit("").alias("node")).where("false")
    for new in tables:
        found = found.union(new.where(position > F.length(word)).select("word", "node"))
    pairs = materialise(found.select(_plain("spelled").alias("word"), _plain("node").alias("near")).distinct())
    discard(spelled, edges, *tables)
    return pairs


def _plain(spelled: str):
    rest = F.substring(spelled, 2, 1 << 30)
    return F.when(F.col(spelled).startswith("<"), F.reverse(rest)).otherwise(rest)


def _meet(words: DataFrame) -> DataFrame:
    """(word, near): pairs of long words, by the half that an edit leaves equal."""
    size = F.length("word")
    most = F.explode(F.array(size, size + 1)).alias("most")  # letters of the longer word of a pair
    keys = words.select("word", most).withColumn("half", F.floor((F.col("most") - 1) / 2).cast("int"))
    keys = keys.select("word", F.explode(F.array(
        F.sha2(F.concat_ws(" ", F.lit("p"), "most", F.substring("word", F.lit(1), F.col("half"))).cast("binary"), 256),
        F.sha2(F.concat_ws(" ", F.lit("s"), "most", F.substring("word", size - F.col("half") + 1, F.col("half"))).cast("binary"), 256),
    )).alias("key"))
    other = keys.select(F.col("word").alias("near"), "key")
    pairs = keys.join(other, "key").where(F.col("word") < F.col("near")).select("word", "near").distinct()

    def compare(batches):
        for batch in batches:
            ok = [_one_edit(a, b) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield batch.filter(pa.array(ok, pa.bool_()))

    return pairs.mapInArrow(compare, "word string, near string")


def _one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    same = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[same + 1:] == b[same + 1:] if len(a) == len(b) else a[same:] == b[same + 1:]


def neighbours(words: DataFrame, levels: int = 40) -> DataFrame:
    """(word, near): every word with every word that differs from it in exactly one letter, both ways.

    ``words`` has a column ``word`` of distinct strings.
    """
    found = _walk(words, levels)
    long = words.where(F.length("word") >= levels).select("word")
    if words.where(F.length("word") > levels).take(1):
        found = found.union(_meet(long))
    return found.union(found.select("near", "word")).distinct()


def variant_groups(counted: DataFrame, ratio: int = 2, levels: int = 40) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``counted`` (word, n).

    The form is the near word of largest n, if that is ``ratio`` times the word's
    n at least; the root is where following forms ends (counts grow, so it ends).
    """
    words = materialise(counted.select("word", "n"))
    near = materialise(neighbours(words, levels))
    best = near.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    told = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.struct(F.col("best.near").alias("word"), (-F.col("best.less")).alias("n"))).alias("f"))
    told = materialise(told.select("word", "n", "n_near", F.col("f.word").alias("form"), F.col("f.n").alias("form_n")))
    roots = materialise(told.where("form is not null").select("word", F.col("form").alias("root")))
    while True:  # a root that has a form itself takes that one's root: chains halve each time
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not roots.join(further, "root", "left_semi").take(1):
            break
        new = materialise(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
        discard(roots)
        roots = new
    discard(near, words)
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(vocabulary(table(spark, sf_dir, "documents")))
