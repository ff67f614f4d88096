"""Periodic runs, MinHash near duplicates and spelling variants: brute force and odd rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_rows import EN
from pyspark.sql import functions as F
from test_llm_operators import SMALL, brute_components, rows_of

from gable.llm import minhash, ngram_join, periodic_runs, spelling
from gable.llm.common import table
from gable.llm.recompression import Grammar


# --- periodic runs ---------------------------------------------------------

def brute_runs(words, least=6, exponent=4):
    found = set()
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            if words[i] == words[i + q]:
                start = i
                while i + q < len(words) and words[i] == words[i + q]:
                    i += 1
                if i + q - start >= max(least, exponent * q) and not any(
                        all(words[k] == words[k + p] for k in range(start, i + q - p)) for p in range(1, q)):
                    found.add((start, i + q - start, q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@given(st.lists(st.integers(0, 2), min_size=2, max_size=60), st.data())
@settings(max_examples=150, deadline=None)
def test_lce_matches_comparing_letter_by_letter(letters, data):
    s, n = np.array(letters), len(letters)
    i, j = data.draw(st.integers(0, n - 1)), data.draw(st.integers(0, n - 1))
    if i == j:
        return
    right = next((k for k in range(n) if max(i, j) + k >= n or s[i + k] != s[j + k]), n)
    left = next((k for k in range(n) if min(i, j) - k < 0 or s[i - k] != s[j - k]), n)
    grammar = Grammar(s)
    assert (grammar.lce([i], [j])[0], grammar.lce([i], [j], forward=False)[0]) == (right, left)


@given(st.lists(st.tuples(st.lists(st.integers(0, 3), max_size=25), st.lists(st.integers(0, 3), min_size=1, max_size=6),
                          st.integers(0, 9)), max_size=5))
@settings(max_examples=150, deadline=None)
def test_runs_match_brute_force(parts):
    texts = [np.array(noise + unit * times + noise[:3], dtype=np.int64) for noise, unit, times in parts]
    assert periodic_runs.find_runs(texts) == [brute_runs(t.tolist()) for t in texts]


def test_runs_of_long_texts():
    rng = np.random.default_rng(0)
    unit = rng.integers(0, 10 ** 6, 700)
    text = np.concatenate([rng.integers(0, 9, 50), np.tile(unit, 6)[:3000], np.zeros(9000, np.int64) + 5, rng.integers(0, 10 ** 6, 20_000)])
    got = periodic_runs.find_runs([text, np.zeros(200_000, np.int64), text[::-1]])
    assert (50, 3000, 700) in [r for r in got[0] if r[2] > 100] and any(r[2] == 1 and r[1] >= 9000 for r in got[0])
    assert got[1] == [(0, 200_000, 1)] and len(got[2]) == len(got[0])


def brute_digests(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        a, p = h // 10 % n, 1 + (n - h // 10 % n) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{m},{q}\n" for s, m, q in runs),
                                                          " ".join(w for k, w in enumerate(words) if k not in gone))]
    return (doc_id, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2], *sha)


def test_periodic_runs_query_and_odd_rows(spark, odd_docs, no_docs):
    docs = table(spark, SMALL, "documents")
    want = sorted(brute_digests(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 20_000)
    got = {r.doc_id: tuple(r) for r in periodic_runs.query(spark, SMALL).collect()}
    assert len(got) == docs.count() and [got[w[0]] for w in want] == want and any(w[1] for w in want)
    short = odd_docs.where("text is null or length(text) < 5000")
    told = sorted((tuple(r) for r in periodic_runs.digests(short).collect()), key=str)
    assert told == sorted((brute_digests(r.doc_id, r.text) for r in short.collect()), key=str)
    assert periodic_runs.digests(no_docs).count() == 0 and periodic_runs.periodic_runs(no_docs).count() == 0
    assert periodic_runs.digests(odd_docs).count() == odd_docs.count()


def test_collapse_keeps_one_period_and_all_columns(spark, odd_docs, no_docs):
    kept = periodic_runs.collapse(odd_docs)
    assert kept.columns == odd_docs.columns and rows_of(kept)[11].text == EN and rows_of(kept)[4].text == EN
    assert rows_of(kept)[0].text is None and rows_of(kept)[2].text == " \n\t" and periodic_runs.collapse(no_docs).count() == 0
    # clashing names: the operator's own columns are beside the row
    clash = odd_docs.withColumnsRenamed({"row": "runs", "size": "collapsed", "spans": "n_words2"})
    told = {r.row.doc_id: r for r in periodic_runs.periodic_runs(clash).collect()}
    assert [tuple(r) for r in told[11].runs] == [(0, 4 * len(EN.split()), len(EN.split()))] and told[1].runs == []


# --- MinHash ---------------------------------------------------------------

def test_tensored_keys_are_as_likely_shared_as_told():
    rng = np.random.default_rng(3)
    keys = minhash.tensored_keys(85, 100, m=3, r=2)
    for share in (0.9, 0.5):
        met = 0
        for _ in range(600):
            size = 200
            common = int(size * 2 * share / (1 + share))
            pool = rng.integers(0, 2 ** 63, 2 * size - common, dtype=np.uint64)
            met += len(np.intersect1d(keys(np.sort(pool[:size])), keys(np.sort(pool[size - common:])))) > 0
        expected = 1 - minhash.miss_probability(common / (2 * size - common), 3, 2)
        assert abs(met / 600 - expected) < 0.08
    assert minhash.miss_probability(0.85) < 1e-5
    assert len(np.unique(minhash.tensored_keys(85, 100)(np.arange(50, dtype=np.uint64)))) == 100


@pytest.mark.parametrize("small, rows", [(6, 1024), (3, 8)])
def test_near_duplicates_match_brute_force(spark, small, rows):
    rng = np.random.default_rng(rows)
    docs = []
    for group in range(14):
        base = [f"w{rng.integers(300)}" for _ in range(int(rng.integers(1, 120)))]
        for _ in range(int(rng.integers(1, 24))):
            docs.append((len(docs), " ".join(w if rng.random() > 0.02 else f"e{rng.integers(9)}" for w in base)))
    docs += [(len(docs), None), (len(docs) + 1, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in
           minhash.near_duplicates(df, small_tile=small, block_rows=rows).collect()}
    assert got == brute_components(docs, 5, 85, 100)


def test_near_duplicates_of_a_hot_sketch_dealt_over_tasks_match_brute_force(spark):
    rng = np.random.default_rng(5)
    base = [f"w{rng.integers(400)}" for _ in range(90)]
    docs = [(k, " ".join(w if rng.random() > 0.01 else f"e{rng.integers(40)}" for w in base)) for k in range(150)]
    docs += [(200 + k, " ".join(f"v{rng.integers(500)}" for _ in range(40))) for k in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    expected = brute_components(docs, 5, 85, 100)
    assert max(links for _, _, links in expected.values()) > 50
    for limit in (3, 40, 1 << 16):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in
               minhash.near_duplicates(df, tile_rows=limit, block_rows=16).collect()}
        assert got == expected, limit


@pytest.mark.parametrize("parts", [1, 3])
def test_buckets_told_apart_in_a_task_are_those_of_the_table_keys(parts):
    """Every pair of classes with a common table key is a pair or in one group; no other pair is told."""
    import pyarrow as pa

    rng, m, n = np.random.default_rng(parts), 3, 80
    first, second = rng.integers(0, 4, (n, m)).astype(np.uint64), rng.integers(0, 9, (n, m)).astype(np.uint64)
    first += np.arange(m, dtype=np.uint64) * np.uint64(10)  # a first sketch is named by its place too
    rows = sorted((int(first[c, i]), c % parts + (parts > 1), c, second[c].tobytes()) for c in range(n) for i in range(m))
    rows = [r for r in rows for _ in range(1 + r[2] % 2)]  # repeats
    table_of = pa.table([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                        names=["tile", "part", "class", "rest"])
    pairs, groups = set(), {}
    for out in minhash.split_tiles(m)(table_of.to_batches(max_chunksize=17), 4):
        for tile, a, b in zip(*(out.column(c).to_pylist() for c in ("tile", "a", "b"))):
            if b is None:
                groups.setdefault(tile, set()).add(a)
            else:
                pairs.add((a, b))
    told = pairs | {(a, b) for g in groups.values() for a in g for b in g if a < b}
    expected = {(a, b) for a in range(n) for b in range(a + 1, n)
                if any(first[a, i] == first[b, i] and (second[a] == second[b]).any() for i in range(m))}
    assert expected <= told and pairs <= expected
    if parts > 1:
        assert told == expected


def test_minhash_query_agrees_with_the_exact_join(spark):
    docs = table(spark, SMALL, "documents")
    exact = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.similarity_classes(docs, 5, 85, 100).collect()}
    got = minhash.query(spark, SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in got} == exact
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_minhash_keep_one_on_odd_rows(odd_docs, no_docs):
    assert minhash.keep_one(no_docs).count() == 0
    kept = minhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None and i in (4, 5, 6)) == [4] and {0, 1, 2, 3, 8, 9, 10} <= set(ids) and None not in ids


# --- spelling variants -----------------------------------------------------

def brute_vocabulary(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            count[word] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def brute_variants(counts):
    cut = {}
    for w in counts:
        for k in range(len(w)):
            cut.setdefault((w[:k], w[k + 1:]), set()).add(w)
    out = {}
    for w in counts:
        near = {v for k in range(len(w)) for v in cut[w[:k], w[k + 1:]]} - {w}
        near |= {w[:k] + w[k + 1:] for k in range(len(w))} & set(counts)
        near |= {v for k in range(len(w) + 1) for v in cut.get((w[:k], w[k:]), ())}
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best and counts[best] >= 2 * counts[w] else None
        out[w] = (form, len(near))
    roots = {}
    for w in counts:
        r = w
        while out[r][0]:
            r = out[r][0]
        roots[w] = r
    return {w: (out[w][0], roots[w], counts[w], out[w][1], counts.get(out[w][0])) for w in counts}


@pytest.mark.parametrize("levels", [40, 6, 1])
def test_variants_match_brute_force(spark, levels):
    rng = np.random.default_rng(levels)
    counts = {}
    for _ in range(250):
        word = "".join(rng.choice(list("abé"), int(rng.integers(1, 10))))
        counts[word] = int(rng.integers(1, 60))
    counts["long" * 30], counts["long" * 29 + "lon"], counts["song" + "long" * 29] = 9, 4, 1
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variant_groups(df, levels=levels).collect()}
    assert got == brute_variants(counts)


def test_spelling_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    counts = brute_vocabulary(rows)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.query(spark, SMALL).collect()}
    assert got == brute_variants(counts) and any(v[0] for v in got.values())


def test_spelling_on_odd_rows(spark, odd_docs, no_docs):
    assert spelling.variant_groups(spelling.vocabulary(no_docs)).count() == 0
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()] + [(k, "Œuvre œuvre ŒUVRE ÀÉÎõüÿ× ÀÉÎõü÷× " + "y" * 70 + " " + "y" * 69) for k in range(90, 95)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variant_groups(spelling.vocabulary(docs)).collect()}
    assert got == brute_variants(brute_vocabulary(rows)) and "y" * 70 in got and "ÀÉÎõüÿ×" in got
