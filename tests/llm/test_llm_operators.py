"""Every operator on odd rows and on an empty table, and against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gable.llm import (components, decontamination, language_id, mixing, ngram_join, quality_rules, secret_scan, sharding,
                       token_files, toxicity, warc)

from odd_rows import EN

SMALL = "/root/testdata/sf0.001"


def items(spark, texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "item_id long, text string")


def rows_of(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_decontamination(spark, odd_docs, no_docs):
    bench = items(spark, [EN, None, "", "one", EN])
    assert decontamination.scan_documents(no_docs, bench).count() == 0
    got = {r.row.doc_id: r for r in decontamination.scan_documents(odd_docs, bench).collect()}
    assert (got[0].n_words, got[0].spans) == (0, []) and got[3]["items"] == ["3"]
    assert got[4]["items"] == ["0", "4"] and got[6].spans[0].stop == len(EN.split()) and got[8].spans == []
    # blocks of one window give what one block gives
    many = {r.row.doc_id: r for r in decontamination.scan_documents(odd_docs, bench, max_windows=3).collect()}
    assert {k: (v.spans, sorted(v["items"])) for k, v in many.items()} == {k: (v.spans, v["items"]) for k, v in got.items()}
    left = decontamination.decontaminate(odd_docs, bench)
    assert left.columns == odd_docs.columns and {r.doc_id for r in left.collect()} == {0, 1, 2, 8, 9, 10}
    cut = rows_of(decontamination.decontaminate(odd_docs, bench, remove="spans"))
    assert cut[7].text == " indeed" and cut[8].text == rows_of(odd_docs)[8].text
    assert decontamination.scan_documents(odd_docs, bench.where("false")).count() == odd_docs.count()


def test_sharding(spark, odd_docs, no_docs):
    assert sharding.assign_shards(no_docs).count() == 0
    got = sharding.assign_shards(odd_docs, n_shards=3).collect()
    assert len(got) == odd_docs.count() and min(r["size"] for r in got) == 8
    from gable.llm.common import table
    rows = sharding.assign_shards(table(spark, SMALL, "documents"), n_shards=6).toPandas()
    for _, part in rows.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    sums = rows.groupby("shard")["size"].sum()
    assert len(sums) == 6 and sums.max() - sums.min() <= 2 * rows["size"].max()


def test_mixing(spark, odd_docs, no_docs):
    assert mixing.mix(no_docs).count() == 0 and mixing.apply_mix(no_docs, mixing.fit_mix(no_docs)).count() == 0
    got = mixing.mix(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(r.taken <= 2 * r["size"] for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(odd_docs).collect()))
    assert mixing.apply_mix(odd_docs, mixing.fit_mix(odd_docs)).columns == odd_docs.columns
    # one source is clamped, the rest shares its excess by weight
    src = spark.createDataFrame([("a", 10, 0), ("b", 1000, 1), ("c", 1000, 2)], "source string, source_size long, rank long")
    target = {r.source: r.target for r in mixing.water_fill(src, [3, 1, 2], 0.5, 2.0).collect()}
    assert target == pytest.approx({"a": 20.0, "b": 985 / 3, "c": 985 * 2 / 3})


def test_toxicity(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(200)] + [(None, None, None)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(
        [(k, f"some calm words here number {k} " + ("you grumpf fool" if k % 2 else "clown fish swim")) for k in range(200)],
        "doc_id long, text string")
    model = toxicity.fit(docs, labels, exceptions=("grumpf cake",))
    score = lambda t: model.score(t)[0]
    assert score("a Grumpf!") > 0.5 and score("a gruмpf") > 0.5 and score("a GRUMPF" + " calm" * 200) > 0.4
    assert score("a grumpf cake") < 0.5 and score("a clown fish") < 0.5 and score(None) == score("") < 0.5
    assert toxicity.fit(docs, labels.where("false")).score("grumpf")[0] < 0.5
    told = toxicity.scorer(spark, model)
    assert odd_docs.select(told(F.col("text")).alias("s")).where("s.score between 0 and 1").count() == odd_docs.count()
    assert no_docs.select(told(F.col("text")).alias("s")).count() == 0


def test_toxicity_weighs_rare_terms_behind_many_common_ones(spark):
    rng = np.random.default_rng(5)
    common = ["".join(map(chr, rng.integers(97, 123, 10))) for _ in range(1_500)]  # 9,000 terms, a little more often toxic
    docs = []
    for k in range(200):
        words = [w for w in common if rng.random() < (0.5 if k % 2 else 0.35)]
        docs.append((k, " ".join(words + ["grumpf"] * (k % 10 == 1))))
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(200)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), labels)
    assert model.weights and all(" grumpf ".startswith(t) for t in model.weights)


def brute_components(docs, n, num, den):
    sets, parent = {}, {}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, t in docs:
        w = re.findall(r"[^ \t-\r]+", (t or "").translate(low))
        k = min(n, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
        parent[i] = i

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids, links = sorted(sets), dict.fromkeys(sets, 0)
    for x in range(len(ids)):
        for y in range(x):
            a, b = sets[ids[x]], sets[ids[y]]
            if a and b and len(a & b) * den >= num * len(a | b):
                links[ids[x]] += 1
                links[ids[y]] += 1
                r, s = find(ids[x]), find(ids[y])
                parent[max(r, s)] = min(r, s)
    return {i: (len(sets[i]), find(i), links[i]) for i in ids}


@pytest.mark.parametrize("n, num", [(4, 85), (5, 80), (1, 50)])
def test_ngram_join_matches_brute_force(spark, n, num):
    rng = np.random.default_rng(n)
    docs = []
    for group in range(14):
        base = [f"w{rng.integers(300)}" for _ in range(int(rng.integers(1, 90)))]
        for _ in range(int(rng.integers(1, 24))):
            text = [w if rng.random() > 0.02 else f"e{rng.integers(9)}" for w in base]
            docs.append((len(docs), " ".join(text)))
    docs += [(len(docs), None), (len(docs) + 1, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in
           ngram_join.similarity_classes(df, n=n, num=num, small_tile=3, block_rows=8).collect()}
    assert got == brute_components(docs, n, num, 100)


def test_ngram_join_of_the_given_table_matches_brute_force(spark):
    from gable.llm.common import table
    df = table(spark, SMALL, "documents")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.similarity_classes(df).collect()}
    assert got == brute_components([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], 4, 85, 100)


def test_links_by_pairs_of_blocks_and_by_overlapping_groups(spark):
    """One cluster whose members differ in size, cut into many blocks; chains of overlapping tiles."""
    words = [f"w{k}" for k in range(400)]
    docs = [(k, " ".join(words[a:a + 60 + k % 40])) for k, a in enumerate(list(range(0, 120)) + list(range(0, 120, 2)))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for small, rows in ((2, 4), (4, 50), (500, 50)):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.similarity_classes(
            df, n=2, num=80, small_tile=small, block_rows=rows, block_elements=rows * 90).collect()}
        assert got == brute_components(docs, 2, 80, 100)


def test_null_and_repeated_ids_link_and_one_of_each_component_stays(spark):
    t = " ".join(f"t{k}" for k in range(40))

    def kept(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return sorted(((r.doc_id, r.text) for r in ngram_join.keep_one(df).collect()), key=str)

    assert kept([(1, t), (2, EN), (2, t + " z")]) == [(1, t), (2, EN)]
    assert len(kept([(None, t), (None, t + " z"), (None, EN)])) == 2
    assert kept([(None, t), (7, t + " z"), (7, t + " z"), (7, None), (7, None)]) == [(7, t + " z"), (7, None), (7, None)]
    # a class of null ids alone is the bridge between two others
    a, b, c = (" ".join(f"t{k}" for k in range(x, x + 60)) for x in (0, 4, 8))
    assert kept([(5, a), (None, b), (6, c)]) == [(5, a)]


def test_keep_one(odd_docs, no_docs):
    assert ngram_join.keep_one(no_docs).count() == 0
    kept = ngram_join.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert [i for i in ids if i in (4, 5, 6)] == [4] and {0, 1, 2, 3, 8, 9, 10} <= set(ids)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 99), (99, 100)], "a long, b long")
    got = {r.node: r.component for r in components.components(links).collect()}
    assert got == {k: 0 for k in range(41)} | {99: 99, 100: 99}


def test_secret_scan(spark, odd_docs, no_docs):
    assert secret_scan.span_report(no_docs).count() == 0
    assert secret_scan.span_report(odd_docs).count() == odd_docs.count()
    key, shared = "Zk3v9Qw7Lp2Xt8Rb5Nd1Yh4", "Cp0y1Ed2Ex3Am4Pl5Ev6Al7Ue8"
    texts = [f"é😀 x token: abc token = 'abcdefghijkl' {key}", "AKIAABCDEFGHIJKLMN deadbeefdeadbeef", f"say {shared}", f"{shared}", f"{shared} ok"]
    docs = spark.createDataFrame([(k, t, f"o{k}") for k, t in enumerate(texts)], "doc_id long, text string, source string")
    got = rows_of(secret_scan.span_report(docs))
    t = texts[0]
    assign, own = (t.index("token = "), t.index("'", t.index("abcdefg"))), t.index(key)
    assert got[0].spans == f"assign:{assign[0]}:{assign[1]},owned:{own}:{own + len(key)}"
    assert got[0].base_sha256 == hashlib.sha256(f"assign:{assign[0]}:{assign[1]}".encode()).hexdigest()
    assert (got[1].n_access, got[1].n_hex, got[1].spans) == (1, 1, "access:0:18,hex:19:35")
    assert all(got[k].spans == "" for k in (2, 3, 4))  # many owners: an example


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_token_files_round_trip(spark, odd_docs, no_docs, planes):
    from tokenizers import Tokenizer
    path = token_files.default_tokenizer()
    assert token_files.token_files(no_docs, path).count() == 0
    manifest = token_files.write_token_files(odd_docs, path, block_ids=1000, planes=planes)
    got = sorted(token_files.read_token_files(manifest, with_ids=True).collect(), key=lambda r: r.start)
    known, at = Tokenizer.from_file(path), 0
    want = sorted(((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in odd_docs.collect()))
    for r, (doc, text) in zip(got, want, strict=True):
        ids = known.encode(text, add_special_tokens=False).ids + [1]
        assert (r.doc_id if r.doc_id is not None else -1, r.start, r.ids) == (doc, at, ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_warc(spark):
    rows = [(1, "http://a/ b\r\n", "<p>é</p>"), (2, None, "<p>é</p>"), (2, "u", "<p>é</p>"), (3, "u", None), (4, "u", ""),
            (None, "u", "<p>é</p>"), (5, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 5000), (None, None, "solo")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = warc.write_bundles(pages, frame_bytes=500)
    got = warc.read_bundles(index, with_payload=True).collect()
    kind = sorted(((r.page_id or 0), r.record_type, r.refers_to, r.payload_bytes) for r in got)
    assert kind[0][:2] == (0, "response") or kind[0][:3] == (0, "revisit", 2)
    assert [k for k in kind if k[0] == 1] == [(1, "revisit", 2, 9)]
    assert [k for k in kind if k[0] == 2] == [(2, "response", None, 9)] * 2
    assert [k for k in kind if k[0] in (3, 4)] == [(3, "revisit", 4, 0), (4, "response", None, 0)]
    place = index.where("page_id = 5").first()
    assert bytes(warc.read_record(place.bundle, place.frame, place.offset)["payload"]).decode() == rows[6][2]
    assert warc.read_bundles(warc.write_bundles(pages.where("false"))).count() == 0
    high = warc.read_bundles(warc.write_bundles(pages, min_payload=100)).where("record_type = 'revisit'")
    assert high.count() == 0


def test_language_id(spark, odd_docs, no_docs):
    from gable.llm.common import is_held_out, table
    docs = table(spark, SMALL, "documents")
    model = language_id.fit(docs)
    told = docs.select("lang", is_held_out(F.col("doc_id")).alias("h"), language_id.predictor(spark, model)(F.col("text")).alias("t"))
    assert told.where("h and lang = t.lang_pred").count() >= 0.95 * told.where("h").count()
    odd = {r.doc_id: r.t for r in odd_docs.select("doc_id", language_id.predictor(spark, model)(F.col("text")).alias("t")).collect()}
    assert all((odd[k].lang_pred, odd[k].score) == ("und", 0.0) for k in (0, 1, 2, 10))
    kept = language_id.keep_identified(odd_docs, model)
    assert kept.columns == odd_docs.columns and language_id.keep_identified(no_docs, model).count() == 0
    assert language_id.fit(no_docs).predict(["some text"]) == [("und", 0.0, True)]


def test_language_id_rejects_what_it_has_not_learned(spark):
    import base64
    import random

    from gable.llm.common import is_held_out, table
    docs = table(spark, "/root/testdata/sf0.01", "documents").where("text is not null and lang is not null")
    held = [(r.lang, r.text) for r in docs.where(is_held_out(F.col("doc_id"))).collect()]
    model, draw = language_id.fit(docs), random.Random(7)
    own = [rejected for _, _, rejected in model.predict([t for _, t in held])]
    assert sum(own) <= 0.02 * len(held)
    letters = " ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 9))) for _ in range(100))
    odd = [letters, letters[:60], base64.b64encode(draw.randbytes(700)).decode(), "for i in range(n):\n    if x[i] is None:\n        return {}\n" * 5]
    assert all(rejected for _, _, rejected in model.predict(odd))
    for lang in ("de", "en", "es", "fr"):
        left_out = [t for x, t in held if x == lang and len(t) >= 200]
        told = language_id.fit(docs.where(F.col("lang") != lang)).predict(left_out)
        assert len(told) > 5 and sum(rejected for _, _, rejected in told) >= 0.9 * len(told)


def test_quality_rules(spark, odd_docs, no_docs):
    assert quality_rules.text_counts(no_docs).count() == 0
    stats = quality_rules.text_counts(odd_docs)
    for r, d in zip(sorted(stats.collect(), key=lambda r: str(r.doc_id)), sorted(odd_docs.collect(), key=lambda r: str(r.doc_id))):
        text = d.text or ""
        w = re.findall(r"[^ \t-\r]+", text)
        windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        seen, hit = {}, set()
        for x in windows:
            seen[x] = seen.get(x, 0) + 1
        for i, x in enumerate(windows):
            hit |= set(range(i, i + 8)) if seen[x] > 1 else set()
        lines = [x for x in text.split("\n") if re.search(r"[^ \t-\r]", x)]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(hit))
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    told = rows_of(quality_rules.apply_rules(stats, quality_rules.fit(stats, nothing)))
    assert not told[0].kept and told[8].kept and told[11].base_failed
    # a planted rule is found
    cols = {f: F.lit(0.5) for f in quality_rules.GRIDS}
    rows = spark.range(2000).withColumns(cols | {"symbol_share": F.rand(3), "bad": (F.col("symbol_share") >= 0.5).cast("int"),
                                                 "growing": F.col("id") % 3 > 0})
    assert quality_rules.learn(rows).describe() == ["symbol_share >= 0.5"]


def test_pipeline_stages(spark):
    import corpus_pipeline
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "mixing", "token_files"]
    from gable.llm.common import materialise, table
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, SMALL))
        assert docs.columns == columns and docs.count() > 100
    assert corpus_pipeline.run(spark, SMALL).count() == docs.count()


@pytest.mark.parametrize("name", ["op1_decontamination", "op3_mixing", "op8_warc_bundles"])
def test_queries_match_sql(spark, name):
    from gable.llm.queries import ORACLE, QUERIES
    from oracle import duck, rows_of as normal
    assert normal(QUERIES[name](spark, SMALL).toPandas()) == normal(duck(SMALL).execute(ORACLE[name]).df())


def test_encoder_matches_the_tokenizer():
    from tokenizers import Tokenizer

    path = token_files.default_tokenizer()
    encoder, whole = token_files.Encoder(path, 1, limit=5), Tokenizer.from_file(path)
    assert encoder.known.model is not None
    texts = ["A\x1cb", "<|endoftext|> X", "ΣΑΣ İi", "don't I'LL", "naïve café", "e\u0301 Å", "ŉ ﬁ ß ẞ ÷×", "a.b,c. d.,",
             " x y\u0085z", "x1y22", "ñandú. Ærø, ÿ.", "word Word, word. WORD", "", "漢字 かな", "straße" * 300]
    for text, got in zip(texts, encoder.encode(texts)):
        ids = whole.encode(text, add_special_tokens=False).ids + [1]
        assert np.frombuffer(got, "<u4").tolist() == ids, text
    assert encoder.encode([None]) == [encoder.end]


def test_encoder_takes_the_whole_way_when_the_model_differs():
    class Other:
        """A tokenizer whose model does not see what its encode sees."""
        class model:
            @staticmethod
            def tokenize(word):
                return []

        def encode(self, piece, add_special_tokens):
            return type("Encoding", (), {"ids": [len(piece)]})

    known = token_files.Pieces(Other())
    assert known.model is None and np.frombuffer(known["abc"], "<u4").tolist() == [3]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_gives_the_ids_of_every_tokenizer_of_the_package(spark, name):
    import public_tokenizers
    from tokenizers import Tokenizer
    from gable.llm.common import table

    path = public_tokenizers.path(name)
    whole, encoder = Tokenizer.from_file(path), token_files.Encoder(path, 1)
    texts = [r.text for r in table(spark, SMALL, "documents").select("text").limit(120).collect()]
    texts += [None, "", " a  b", "Don't STOP.\n\tx", "a<|endoftext|>b", "naïve İstanbul ΣΑΣ", "x\x1cy", "1234 12.5, ..", "日本語 テスト"]
    for text, got in zip(texts, encoder.encode(texts)):
        want = whole.encode(text, add_special_tokens=False).ids if text else []
        assert np.frombuffer(got, "<u4").tolist() == [*want, 1], text
    assert encoder.by_piece == (name == "word_bpe_49k.json")


def test_toxicity_learns_quoted_words_and_scripts_without_blanks(spark):
    bad, docs = ("zogar", "\u201czogar\u201d", "\u574f\u86cb"), []
    for k in range(300):
        words = f"some calm words here number {k}"
        docs.append((k, f"{words} {bad[k // 2 % 3]} you" if k % 2 else f"{words} \u597d\u4eba fine"))
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(300)], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(df, labels)
    score = lambda t: model.score(t)[0]
    assert score("a \u201cZOGAR\u201d b") > 0.5 and score("zogar") > 0.5 and score("\u4f60\u574f\u86cb\u4e86") > 0.5
    assert score("zoggerat is calm") < 0.5 and score("calm words") < 0.5 and score("\u597d\u4eba") < 0.5
    assert toxicity.fit(df.where("false"), labels).score("zog") == (0.0, 0)
    assert not any("\u201c" in t for t in model.weights)


def test_toxicity_held_out_accuracy(spark):
    from gable.llm.common import table
    sf = "/root/testdata/sf0.1"
    told = toxicity.query(spark, sf).join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id").where("held_out and toxic is not null")
    n = {(r.toxic, r.predicted): r["count"] for r in told.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] >= 0.9 * (n[1, 1] + n.get((1, 0), 0)) and n.get((0, 1), 0) <= 0.01 * n[0, 0]
