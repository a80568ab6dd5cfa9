"""Language ID: nearest of several centroids per language.

A text becomes an L2-normalised TF-IDF vector of hashed byte n-grams of its
letters (every other byte is a blank, blanks collapse). Each language has
``clusters`` unit centroids from a spherical k-means over a bounded sample; a
text gets the language of the centroid with the highest cosine, and is
rejected when that cosine is below the language's floor for texts with as many
different n-grams: a share of a low quantile over all learning rows of the language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segscore.llm.common import cut_lineage, release, text_slices, with_columns

GRAMS = (2, 3, 4)
DIM = 1 << 14
#: Rows whose dense vectors are held at once.
ROWS = 64
#: A language rejects texts below this share of that quantile of its learning rows' closeness.
FLOOR, QUANTILE = 0.35, 0.05
#: Bands of different n-grams in a text; one with fewer learning rows than BAND_ROWS takes the language's quantile.
BANDS = np.array([16, 64, 256, 1024])
BAND_ROWS = 100
#: Different n-grams of a text at which its cosine to a dense centroid is about 0.7.
HALF = 600
#: Closeness is counted in steps of 1 / STEPS.
STEPS = 1000
MAX_LANGUAGES = 1000
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


@dataclass
class Centroids:
    languages: list[str]
    owner: np.ndarray  # language index of each centroid
    unit: np.ndarray  # centroids x DIM
    floor: np.ndarray  # languages x bands: least closeness that a language accepts
    idf: np.ndarray


def gram_counts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Dense (texts x DIM) counts of the hashed n-grams of texts that lie one
    after another in ``raw``; n-grams do not cross texts or blanks twice."""
    n = len(at) - 1
    a = _FOLD[raw]
    upper = np.zeros(len(a), bool)
    upper[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
    a[upper] += 32  # Latin-1 capitals to their small letters
    doc = np.repeat(np.arange(n), np.diff(at))
    keep = np.ones(len(a), bool)
    keep[1:] = (a[1:] != 32) | (a[:-1] != 32) | (doc[1:] != doc[:-1])
    a, doc = a[keep].astype(np.uint32), doc[keep]
    out = np.zeros(n * DIM, np.int64)
    code = np.zeros(len(a), np.uint32)
    for g in range(1, max(GRAMS) + 1):
        if len(a) < g:
            break
        code = (code[:len(a) - g + 1] << np.uint32(8)) | a[g - 1:]
        if g in GRAMS:
            inside = doc[:len(code)] == doc[g - 1:]
            h = (code + np.uint32(g)) * np.uint32(2654435761)
            slot = (h ^ (h >> np.uint32(15))) * np.uint32(2246822519) >> np.uint32(18)
            where = doc[:len(code)] * DIM + slot
            out += np.bincount(where[inside], minlength=n * DIM)
    return out.reshape(n, DIM)


def unit_rows(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit_vectors(np.log1p(counts, dtype=np.float32) * idf)


def unit_vectors(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def cosines(raw: np.ndarray, at: np.ndarray, m: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(texts x centroids) cosines, and per text its band and the cosine that a
    clean text of as many different n-grams may reach; a cosine's share of that
    is its closeness."""
    counts = gram_counts(raw, at)
    used = (counts > 0).sum(axis=1)
    return unit_rows(counts, m.idf) @ m.unit.T, np.searchsorted(BANDS, used, "right"), np.sqrt(used / (used + HALF))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """At most ``k`` unit centroids from a seeded start. Each leans half on the
    mean of all rows, so a small cluster does not win by its noise."""
    k = min(k, len(x))
    own = np.random.default_rng(seed).permutation(len(x)) % k
    mean = unit_vectors(x.sum(axis=0, keepdims=True))
    c = np.repeat(mean, k, axis=0)
    for _ in range(rounds):
        new = unit_vectors(np.stack([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(k)]))
        done, c = np.allclose(new, c), new
        own = np.argmax(x @ c.T, axis=1)
        if done:
            break
    return unit_vectors(c + mean)


def fit_languages(df: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = 500,
                  clusters: int = 4) -> Centroids:
    """Learns from rows with a letter and a language. Each language gives about
    ``per_language`` rows (seeded by row; all, if fewer): the documented bound of
    what the model is fitted on. Vectors and clustering are Spark tasks, one
    language a group of bounded size; the driver gets the centroids."""
    df = df.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    df = df.filter(F.col("lang").isNotNull() & has_letter(F.col("text")))
    sizes = df.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return Centroids([], np.zeros(0, int), np.zeros((0, DIM), np.float32), np.zeros((0, len(BANDS) + 1)), np.ones(DIM, np.float32))
    spark = df.sparkSession
    share = spark.createDataFrame([(r["lang"], min(1.0, per_language / r["n"])) for r in sizes], "lang string, share double")
    draw = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(5)), F.lit(1 << 30)) / (1 << 30)
    sample = (df.withColumn("draw", draw).join(F.broadcast(share), "lang").filter("draw < share").select("lang", "text"))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            slots, counts = [], []
            for _, _, raw, at in text_slices(b.column(1), rows=ROWS):
                for row in gram_counts(raw, at):
                    used = np.flatnonzero(row)
                    slots.append(used.astype("<u2").tobytes())
                    counts.append(row[used].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(slots, pa.binary()), pa.array(counts, pa.binary())],
                                             names=["lang", "slots", "counts"])

    vectors = cut_lineage(sample.mapInArrow(sparse, "lang string, slots binary, counts binary").repartition(8))

    def document_frequency(batches):
        seen, rows = np.zeros(DIM, np.int64), 0
        for b in batches:
            for s in b.column(0).to_pylist():
                seen[np.frombuffer(s, "<u2")] += 1
                rows += 1
        yield pa.RecordBatch.from_arrays([pa.array([seen.tobytes()]), pa.array([rows])], names=["seen", "rows"])

    parts = vectors.select("slots").mapInArrow(document_frequency, "seen binary, rows long").collect()  # 8 rows
    seen = sum(np.frombuffer(p["seen"], np.int64) for p in parts)
    idf = (np.log((1 + sum(p["rows"] for p in parts)) / (1 + seen)) + 1).astype(np.float32)

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((len(pdf), DIM), np.float32)
        for i, (s, c) in enumerate(zip(pdf["slots"], pdf["counts"])):
            counts[i, np.frombuffer(s, "<u2")] = np.frombuffer(c, "<u4")
        x = unit_rows(counts, idf)
        cent = spherical_kmeans(x, clusters)
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]] * len(cent), "unit": [c.astype("<f4").tobytes() for c in cent]})

    found = vectors.groupBy("lang").applyInPandas(cluster, "lang string, unit binary").collect()
    found.sort(key=lambda r: (r["lang"], r["unit"]))  # at most MAX_LANGUAGES x clusters rows
    languages = sorted({r["lang"] for r in found})
    model = Centroids(languages, np.array([languages.index(r["lang"]) for r in found]),
                      np.stack([np.frombuffer(r["unit"], "<f4") for r in found]), np.zeros((len(languages), len(BANDS) + 1)), idf)
    model.floor = floors(df, model)
    return model


def floors(df: DataFrame, model: Centroids) -> np.ndarray:
    """``Centroids.floor`` from the closeness of every row of ``df(text, lang)``
    to its own language: one pass, counted by language and band."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def closeness(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        m = shared.value
        number = {name: i for i, name in enumerate(m.languages)}
        for b in batches:
            lang = np.array([number.get(x, -1) for x in b.column(1).to_pylist()], int)
            band, step = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows, np.int32)
            for lo, hi, raw, at in text_slices(b.column(0), limit=1 << 19, rows=ROWS):
                sim, band[lo:hi], reach = cosines(raw, at, m)
                own = np.where(m.owner == lang[lo:hi, None], sim, 0).max(axis=1)
                step[lo:hi] = np.clip(own / np.where(reach > 0, reach, 1), 0, 8) * STEPS
            yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(band), pa.array(step)], names=["lang", "band", "step"])

    steps = df.select("text", "lang").mapInArrow(closeness, "lang long, band int, step int").filter("lang >= 0")
    low = F.percentile("step", F.lit(QUANTILE)).alias("low")
    rows = steps.rollup("lang", "band").agg(F.count(F.lit(1)).alias("n"), low).filter("lang is not null").collect()
    out = np.zeros((len(model.languages), len(BANDS) + 1))  # at most MAX_LANGUAGES x bands rows
    for r in sorted(rows, key=lambda r: r["band"] is not None):  # the language's own quantile first
        if r["band"] is None:
            out[r["lang"]] = FLOOR * r["low"] / STEPS
        elif r["n"] >= BAND_ROWS:
            out[r["lang"], r["band"]] = FLOOR * r["low"] / STEPS
    return out


def predict_languages(df: DataFrame, model: Centroids, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with ``lang_pred`` (``und`` for null texts
    and texts without a letter, or if nothing was learned), ``score`` (cosine to
    the nearest centroid, 0 to 1) and ``rejected`` (``und``, or less close than
    that centroid's language accepts). Columns of those names are replaced."""
    df = df.drop(*[c for c in ("lang_pred", "score", "rejected") if c != text_col]).withColumn("_l_letter", has_letter(F.col(text_col)))
    names = df.columns
    at, letter = names.index(text_col), names.index("_l_letter")
    shared = df.sparkSession.sparkContext.broadcast(model)  # languages x clusters x DIM floats, bounded above

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        m = shared.value
        for b in batches:
            n = b.num_rows
            best, cosine, least = np.zeros(n, int), np.zeros(n), np.ones(n)
            if len(m.languages):
                for lo, hi, raw, offsets in text_slices(b.column(at), limit=1 << 19, rows=ROWS):
                    sim, band, reach = cosines(raw, offsets, m)
                    best[lo:hi] = np.argmax(sim, axis=1)
                    cosine[lo:hi] = sim[np.arange(hi - lo), best[lo:hi]]
                    least[lo:hi] = m.floor[m.owner[best[lo:hi]], band] * reach
            known = b.column(letter).to_numpy(zero_copy_only=False).astype(bool) & (len(m.languages) > 0)
            cosine = np.where(known, np.clip(cosine, 0, 1), 0.0)
            pred = [m.languages[m.owner[j]] if k else UNKNOWN for j, k in zip(best, known)]
            gone = ~known | (cosine < least)
            cols = [c for i, c in enumerate(b.columns) if i != letter]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(pred, pa.string()), pa.array(cosine), pa.array(gone)],
                                             names=[c for c in names if c != "_l_letter"] + ["lang_pred", "score", "rejected"])

    schema = with_columns(df.drop("_l_letter"), lang_pred="string", score="double", rejected="boolean")
    return df.mapInArrow(nearest, schema)


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """crc32 of the id as text falls in ``fold``; null ids are held out too."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(True))


def language_id(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **kw) -> DataFrame:
    """Fits on the rows of ``df`` that are not held out (crc32(id) mod 5 is not
    0) and predicts every row: the columns of ``df``, ``held_out`` and those of
    ``predict_languages``. Only the text is an input of a prediction. Repeated
    rows get equal predictions; an empty table gives an empty result."""
    df = df.drop(*[c for c in ("held_out",) if c not in (id_col, text_col, lang_col)])
    out = held_out(id_col, 5, 0)
    model = fit_languages(df.filter(~out), text_col, lang_col, **kw)
    return predict_languages(df.withColumn("held_out", out), model, text_col)
