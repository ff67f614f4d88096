"""Language id by nearest centroid.

Texts become TF-IDF vectors over hashed byte n-grams (1 to 3 bytes of the
lower-cased text, non-letters as blanks), normalised to length 1. Every
language has several centroids, found by spherical k-means; a text gets the
language of the nearest centroid by cosine. A text that is farther from it
than all but a small share of the language's own texts is rejected (0.5 %,
measured on texts of the sample against centroids found without them). Texts of
few distinct n-grams are farther from any centroid, so a language has a limit
for each band of these, learned from texts and pieces of texts; none is above
half the median of its whole texts, as nothing foreign comes nearer. A language
of which fewer than two different texts are learned from rejects nothing.

Learning takes a bounded sample: about ``per_lang`` documents a language,
chosen by a hash of the id among rows that have a language and are not held
out. Each language's sample is clustered in one task.

Defined results: null text and text without a letter are ``und`` with score
0 and rejected; rows without a language are not learned from; where nothing
can be learned all rows are ``und``; other columns pass through unchanged.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gable.llm.common import Shared, is_held_out, materialise, runs, table

DIMS = 4096
_BANDS = 25  # half octaves of the distinct n-grams, up to DIMS
_PIECES = [4, 6, 8, 11, 16, 23, 32, 45, 64, 91, 128, 181, 256, 512, 1024]  # letters
_BLANKS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def counts(texts: list[str]) -> np.ndarray:
    """log(1 + count) of hashed n-grams, one row a text."""
    raw = [b" " + t.lower().encode("utf-8", "replace").translate(_BLANKS) + b" " for t in texts]
    stream = np.frombuffer(b"\0\0".join(raw) + b"\0\0", dtype=np.uint8).astype(np.uint32)
    row = np.repeat(np.arange(len(raw)), [len(r) + 2 for r in raw])[:-2]
    a, b, c = stream[:-2], stream[1:-1], stream[2:]
    out = np.zeros(len(raw) * DIMS, dtype=np.float32)
    for n, code, ok in ((1, a, a > 32), (2, a << 8 | b, (a > 0) & (b > 0) & (a + b > 64)),
                        (3, a << 16 | b << 8 | c, (a > 0) & (b > 0) & (c > 0) & (a + b + c > 96))):
        cell = ((code[ok] + np.uint32(n << 24)) * np.uint32(2654435761) >> np.uint32(20)).astype(np.int64)
        out += np.bincount(row[ok] * DIMS + cell, minlength=len(out)).astype(np.float32)
    return np.log1p(out, out=out).reshape(len(raw), DIMS)


def unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)


def cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; the first centroids are mutually farthest texts."""
    picked = unit(vectors.mean(axis=0, keepdims=True))
    while len(picked) < min(k, len(vectors)):
        picked = np.vstack([picked, vectors[np.argmin((vectors @ picked.T).max(axis=1))]])
    for _ in range(rounds):
        nearest = np.argmax(vectors @ picked.T, axis=1)
        picked = unit(np.vstack([vectors[nearest == j].mean(axis=0) if (nearest == j).any() else picked[j]
                                 for j in range(len(picked))]))
    return picked


def bands(raw: np.ndarray) -> np.ndarray:
    """Half octave of the distinct n-grams of every row of :func:`counts`."""
    return np.rint(2 * np.log2(np.maximum((raw > 0).sum(axis=1), 1))).astype(int)


def own_limits(texts: list[str], vectors: np.ndarray, idf: np.ndarray, k: int, own_lost: float) -> np.ndarray:
    """Of each band, the cosine that all but ``own_lost`` of a language's own texts reach.

    Each half of the texts is held against the centroids of the other half;
    a text is always in the same half as its copies. No band's limit is above
    half the median cosine of the whole texts.
    """
    half = np.array([zlib.crc32(t.encode("utf-8", "replace")) % 2 for t in texts], dtype=int)
    if len(texts) > 1 and half.min() == half.max() and len(set(texts)) > 1:
        half = (np.unique(texts, return_inverse=True)[1] % 2).astype(int)
    seen: list[tuple[np.ndarray, np.ndarray]] = []
    whole: list[np.ndarray] = []
    for h in (0, 1):
        if not (half == h).any() or not (half != h).any():
            continue
        others = cluster(vectors[half != h], k).T
        own = [t for t, x in zip(texts, half) if x == h and any(map(str.isalpha, t))]
        n_whole, cosines = len(own), []
        # pieces of the start and the middle stand for the short texts, of which a sample has few
        own += [t[a:a + n] for t in own for n in _PIECES if n < len(t) for a in {0, len(t) // 2}]
        for a, b in runs([max(len(t), 2048) for t in own], 1 << 20):
            raw = counts(own[a:b])
            cosines.append((unit(raw * idf) @ others).max(axis=1))
            seen.append((bands(raw), cosines[-1]))
        whole += [np.concatenate(cosines)[:n_whole]] if cosines else []
    out = np.zeros(_BANDS)
    if seen:
        most = np.median(np.concatenate(whole)) / 2
        band, cosine = np.concatenate([s[0] for s in seen]), np.concatenate([s[1] for s in seen])
        for j in range(_BANDS):
            near = cosine[band == j]
            # a band that the sample does not show takes the limit of the next smaller one
            out[j] = min(most, np.quantile(near, own_lost, method="lower")) if len(near) else out[j - 1] if j else 0.0
    return out


class Centroids:
    """The fitted model; small (a few vectors and limits a language)."""

    def __init__(self, langs: list[str], vectors: np.ndarray, limits: np.ndarray, idf: np.ndarray):
        self.langs, self.vectors, self.limits, self.idf = langs, vectors, limits, idf

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out: list[tuple[str, float, bool]] = []
        sizes = [max(len(t) if t else 0, 2048) for t in texts]  # 2 KB a text bounds the matrix of a run
        for a, b in runs(sizes, 1 << 20):
            part = [t or "" for t in texts[a:b]]
            if not self.langs:
                out += [("und", 0.0, True)] * len(part)
                continue
            raw = counts(part)
            cosine = unit(raw * self.idf) @ self.vectors.T
            for text, j, c, band in zip(part, cosine.argmax(axis=1).tolist(), cosine.max(axis=1).tolist(), bands(raw).tolist()):
                if not any(map(str.isalpha, text)):
                    out.append(("und", 0.0, True))
                else:
                    out.append((self.langs[j], min(max(c, 0.0), 1.0), bool(c < self.limits[j, band])))
        return out


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        per_lang: int = 2_000, centroids: int = 3, own_lost: float = 0.005) -> Centroids:
    """Learn from rows that are not held out (see the module's docstring).

    ``own_lost`` is the share of a language's own texts that is given up: a
    text is rejected below the cosine that all others of its band reach.
    """
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & ~is_held_out(F.col(id_col))).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(F.col(id_col), F.lit("language sample")), F.lit(1_000_000)).alias("u"))
    totals = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    limit = F.col("n") * F.col("u") < F.lit(per_lang * 1_000_000)
    sample = materialise(rows.join(F.broadcast(totals), "lang").where(limit).select("lang", "text"))

    def document_frequencies(part: pd.DataFrame) -> pd.DataFrame:
        df = np.zeros(DIMS)
        for a, b in runs([max(len(t), 2048) for t in part["text"]], 1 << 20):
            df += (counts(part["text"][a:b].tolist()) > 0).sum(axis=0)
        return pd.DataFrame({"n": [len(part)], "df": [df.tolist()]})

    stats = sample.groupBy("lang").applyInPandas(document_frequencies, "n long, df array<double>").collect()
    if not stats:
        return Centroids([], np.zeros((0, DIMS)), np.zeros((0, _BANDS)), np.ones(DIMS))
    # every language weighs the same, however many of its rows there are
    share = np.mean([np.array(r.df) / r.n for r in stats], axis=0)
    idf = (1.0 + np.log((1 + 1e-3) / (share + 1e-3))).astype(np.float32)

    def find(part: pd.DataFrame) -> pd.DataFrame:
        texts = part["text"].tolist()
        vectors = np.vstack([unit(counts(texts[a:b]) * idf) for a, b in runs([max(len(t), 2048) for t in texts], 1 << 20)])
        low = own_limits(texts, vectors, idf, centroids, own_lost).tolist()
        found = cluster(vectors, centroids)
        return pd.DataFrame({"lang": part["lang"].iloc[0], "vector": [v.tolist() for v in found], "low": [low] * len(found)})

    got = sorted(sample.groupBy("lang").applyInPandas(find, "lang string, vector array<float>, low array<double>").collect(),
                 key=lambda r: (r.lang, r.vector))
    return Centroids([r.lang for r in got], np.array([r.vector for r in got], dtype=np.float32),
                     np.array([r.low for r in got]), idf)


def predictor(spark: SparkSession, model: Centroids):
    """Column function of a text: struct of lang_pred, score and rejected."""
    shared = Shared(spark, model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(shared.value.predict(texts.tolist()), columns=["lang_pred", "score", "rejected"])

    return predict


def keep_identified(docs: DataFrame, model: Centroids, text_col: str = "text") -> DataFrame:
    """``docs`` without the rejected rows."""
    whole = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    told = whole.withColumn("told", predictor(docs.sparkSession, model)(F.col(f"row.`{text_col}`")))
    return told.where("not told.rejected").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    told = predictor(spark, fit(docs))(F.col("text"))
    return docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), told.alias("told")).select(
        "doc_id", "held_out", "told.*")
