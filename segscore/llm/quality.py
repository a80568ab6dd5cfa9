"""Quality classifier: hashed word n-gram logistic regression.

Features of a text are its words' unigrams and bigrams and the unigrams,
bigrams and trigrams of its words' shapes (runs of small letters, capitals,
digits and marks, and whether a word repeats the one before), hashed to
``SPACE`` slots and weighted by log(1 + count) over the text's norm. The model
is trained with FTRL updates; a score is one sparse dot product.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segscore.llm import linear
from segscore.llm.common import cut_lineage, texts, with_columns
from segscore.llm.langid import held_out

SPACE = 1 << 20
#: Words whose hashes a worker remembers.
REMEMBERED = 200_000
_RUNS = ((re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[0-9]+"), b"0"),
         (re.compile(rb"([^\w])\1+"), rb"\1\1"))
_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """word -> (32 bits of its hash, 32 bits of its shape's hash); bounded."""

    def __missing__(self, word: bytes) -> int:
        shape = word
        for pattern, to in _RUNS:
            shape = pattern.sub(to, shape)
        value = xxhash.xxh32_intdigest(word.lower()) << 32 | xxhash.xxh32_intdigest(shape, 1)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


def features(text: bytes, known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(distinct slots, values) of one text; slot 0 is the bias, value 1."""
    words = text.split()
    both = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    word, shape = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    same = np.zeros(len(words), np.uint64)
    same[1:] = word[1:] == word[:-1]
    shape = shape * np.uint64(2) + same
    found = []
    for kind, base, longest in ((1, word, 2), (4, shape, 3)):
        code = np.zeros(len(words), np.uint64)
        for g in range(longest):
            if len(words) <= g:
                break
            code = (code[:len(words) - g] ^ (base[g:] + np.uint64(kind + g))) * _MIX
            code ^= code >> np.uint64(29)
            found.append(code)
    if not found:
        return np.zeros(1, np.int64), np.ones(1)
    slots, count = np.unique((np.concatenate(found) % np.uint64(SPACE - 1)).astype(np.int64) + 1, return_counts=True)
    value = np.log1p(count)
    value *= 3 / np.sqrt(value @ value)
    return np.r_[0, slots], np.r_[1.0, value]


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str, learn, bound: int) -> DataFrame:
    """(id, text, y, draw): at most ``bound`` labelled documents in a seeded
    order. Labels repeated for an id count once (the larger), null labels and
    ids do not; of documents that repeat an id one is taken. The chosen labels
    are at most ``bound`` rows, so they are broadcast and the texts stay put."""
    y = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).filter(learn)
         .groupBy(F.col(id_col).alias("_y_id")).agg(F.max(label_col).cast("int").alias("y"))
         .withColumn("draw", F.xxhash64("_y_id", F.lit(17))).orderBy("draw", "_y_id").limit(bound))
    return docs.join(F.broadcast(y), F.col(id_col) == F.col("_y_id")).dropDuplicates(["_y_id"])


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                bound: int = 12_000, passes: int = 2) -> np.ndarray:
    """Weights learned from at most ``bound`` labelled documents that are not
    held out (crc32(id) mod 3 is not 1). Features are made in parallel; the
    bounded sample's FTRL passes are one task; the driver gets the weights."""
    sample = labelled_sample(docs.select(id_col, F.col(text_col).alias("_y_text")), labels, id_col, label_col, ~held_out(id_col, 3, 1), bound)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in batches:
            made = [features(t, known) for t in texts(b.column(2))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([s.astype("<i4").tobytes() for s, _ in made], pa.binary()),
                 pa.array([v.astype("<f4").tobytes() for _, v in made], pa.binary())], names=["draw", "y", "slots", "vals"])

    rows = cut_lineage(sample.select("draw", "y", "_y_text").mapInArrow(extract, "draw long, y int, slots binary, vals binary"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw, y, x = [], [], []
        for b in batches:
            draw += b.column(0).to_pylist()
            y += b.column(1).to_pylist()
            x += [(np.frombuffer(s, "<i4").astype(np.int64), np.frombuffer(v, "<f4").astype(float))
                  for s, v in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
        order = np.argsort(np.array(draw, np.int64), kind="stable")
        w = linear.train([x[i] for i in order], np.array(y)[order] > 0, SPACE, passes, alpha=0.3, l1=0.3, l2=0.1) if x else np.zeros(SPACE)
        yield pa.RecordBatch.from_arrays([pa.array([w.astype("<f4").tobytes()], pa.binary())], names=["w"])

    return np.frombuffer(rows.repartition(1).mapInArrow(learn, "w binary").first()["w"], "<f4")


def score_quality(df: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with ``score`` and ``predicted``; a null or
    blank text has only the bias. Columns of those names are replaced."""
    df = df.drop(*[c for c in ("score", "predicted") if c != text_col])
    at, names = df.columns.index(text_col), df.columns
    shared = df.sparkSession.sparkContext.broadcast(weights)  # SPACE floats

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, w = WordHashes(), shared.value
        for b in batches:
            margin = [float(w[s] @ v) for s, v in (features(t, known) for t in texts(b.column(at)))]
            p = linear.sigmoid(np.array(margin, float))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                             names=[*names, "score", "predicted"])

    return df.mapInArrow(score, with_columns(df, score="double", predicted="int"))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The columns of ``docs`` with ``held_out``, ``score`` (probability of
    label 1) and ``predicted``. No labels give the score 0.5 everywhere;
    repeated rows score alike; an empty table gives an empty result."""
    weights = fit_quality(docs, labels, id_col, text_col, **kw)
    df = docs.drop(*[c for c in ("held_out",) if c not in (id_col, text_col)])
    return score_quality(df.withColumn("held_out", held_out(id_col, 3, 1)), weights, text_col)
