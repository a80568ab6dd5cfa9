"""Toxicity by a classifier chain.

Categories are predicted one after another: each is a sparse linear model over
the text's terms and the log-odds of all earlier categories. While training,
a later model sees the earlier categories' out-of-fold predictions, so it
learns from probabilities as uncertain as those it will get.

``labels`` marks one category (``toxic``). Two weaker ones lead up to it and
are read off the training sample alone: ``insult``, a toxic document with a
term that is at least ten times as frequent in toxic documents, and
``severe``, one with ``SEVERE`` or more different such terms.

Terms are a text's distinct lower-case words and the words' first three to
five characters. Only terms that occur in ``LEAST`` or more toxic training
documents are features, each by its own text, so no two terms share a weight.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segscore.llm import linear
from segscore.llm.common import with_columns
from segscore.llm.langid import held_out
from segscore.llm.quality import labelled_sample

CATEGORIES = ("insult", "severe", "toxic")
SEVERE = 3
LEAST = 3
FOLDS = 3
PREFIXES = (3, 4, 5)
REMEMBERED = 200_000
_WORD = re.compile(r"\w+")


def terms(word: str) -> list[str]:
    return [word] + ["^" + word[:k] for k in PREFIXES if len(word) >= k]


def distinct_words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


class Chain:
    """Vocabulary and one weight vector per category. Slot 0 is the bias, the
    next slots are the earlier categories, the rest are terms."""

    def __init__(self, vocabulary: dict[str, int], weights: list[np.ndarray]):
        self.vocabulary, self.weights = vocabulary, weights

    def slots_of(self, known: dict[str, tuple[int, ...]], words: set[str]) -> np.ndarray:
        found: set[int] = set()
        for w in words:
            s = known.get(w)
            if s is None:
                s = tuple(self.vocabulary[t] for t in terms(w) if t in self.vocabulary)
                if len(known) < REMEMBERED:
                    known[w] = s
            found.update(s)
        return np.fromiter(sorted(found), np.int64, len(found))

    def probabilities(self, slots: np.ndarray) -> list[float]:
        out: list[float] = []
        for w in self.weights:
            margin = w[0] + w[slots].sum() + sum(w[1 + j] * logit(p) for j, p in enumerate(out))
            out.append(float(linear.sigmoid(margin)))
        return out


def logit(p):
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p)) / 4


def fit_chain(words: list[set[str]], toxic: np.ndarray, passes: int = 4) -> Chain:
    """Learns the chain from a bounded sample of word sets."""
    toxic = np.asarray(toxic, bool)
    in_toxic: Counter[str] = Counter()
    for i in np.flatnonzero(toxic):
        in_toxic.update({t for w in words[i] for t in terms(w)})
    names = sorted(t for t, n in in_toxic.items() if n >= LEAST)
    first = 1 + len(CATEGORIES)
    vocabulary = {t: first + i for i, t in enumerate(names)}
    chain = Chain(vocabulary, [])
    known: dict[str, tuple[int, ...]] = {}
    rows = [chain.slots_of(known, w) for w in words]
    size = first + len(names)

    bad, all_ = np.zeros(size), np.zeros(size)
    for slots, t in zip(rows, toxic):
        all_[slots] += 1
        bad[slots] += t
    rate = (bad + 0.5) / (toxic.sum() + 1)
    clean = (all_ - bad + 0.5) / ((~toxic).sum() + 1)
    telling = rate > 10 * clean
    telling[:first] = False
    hits = np.array([telling[s].sum() for s in rows]) if rows else np.zeros(0)
    targets = {"insult": toxic & (hits > 0), "severe": toxic & (hits >= SEVERE), "toxic": toxic}

    fold = np.arange(len(rows)) % FOLDS
    earlier = np.zeros((len(rows), 0))
    for j, category in enumerate(CATEGORIES):
        y = targets[category]
        def example(i, p=earlier, j=j):
            return np.r_[0, 1:1 + j, rows[i]], np.r_[1.0, logit(p[i]), np.ones(len(rows[i]))]
        made = [example(i) for i in range(len(rows))]
        kw = dict(size=size, passes=passes, alpha=0.1, l1=1.0, l2=0.5)
        held = np.zeros(len(rows))
        for f in range(FOLDS):
            part = np.flatnonzero(fold != f)
            w = linear.train([made[i] for i in part], y[part], **kw) if len(part) else np.zeros(size)
            for i in np.flatnonzero(fold == f):
                held[i] = linear.sigmoid(w[made[i][0]] @ made[i][1])
        chain.weights.append(linear.train(made, y, **kw) if made else np.zeros(size))
        earlier = np.c_[earlier, held]
    if len(rows):  # 0.5 stands where the out-of-fold predictions separate the label best
        cut = best_cut(earlier[:, -1], toxic)
        chain.weights[-1][0] -= np.log(cut / (1 - cut))
    return chain


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The cut between neighbouring predictions with the highest F1, kept
    within 0.1 and 0.9; the middle of the best stretch on ties."""
    o = np.argsort(-p, kind="stable")
    p, hit = p[o], np.cumsum(y[o])
    f1 = 2 * hit / (np.arange(1, len(p) + 1) + max(int(y.sum()), 1))
    last = np.r_[p[1:] != p[:-1], True]
    best = np.flatnonzero(last & (f1 >= f1[last].max() - 1e-12))
    below = p[min(best[-1] + 1, len(p) - 1)]
    return float(np.clip((p[best[0]] + below) / 2, 0.1, 0.9))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, bound: int = 12_000) -> Chain:
    """The chain learned in one task from at most ``bound`` labelled documents
    that are not held out (crc32(id) mod 3 is not 1); the driver gets the model."""
    sample = labelled_sample(docs.select(id_col, F.col(text_col).alias("_y_text")), labels, id_col, "toxic", ~held_out(id_col, 3, 1), bound)

    def split(batches):
        for b in batches:
            sets = ["\n".join(sorted(distinct_words(t))) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sets, pa.string())], names=["draw", "y", "words"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            rows += zip(*(c.to_pylist() for c in b.columns))
        rows.sort(key=lambda r: r[0])
        model = fit_chain([set(w.split("\n")) - {""} for _, _, w in rows], np.array([y > 0 for _, y, _ in rows], bool))
        used = [t for t, s in model.vocabulary.items() if any(w[s] for w in model.weights)]
        head = 1 + len(CATEGORIES)
        keep = [*range(head), *(model.vocabulary[t] for t in used)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([used], pa.list_(pa.string())), pa.array([[w[keep].tolist() for w in model.weights]], pa.list_(pa.list_(pa.float64())))],
            names=["terms", "weights"])

    got = (sample.select("draw", "y", "_y_text").mapInArrow(split, "draw long, y int, words string").repartition(1)
           .mapInArrow(learn, "terms array<string>, weights array<array<double>>").first())
    head = 1 + len(CATEGORIES)
    return Chain({t: head + i for i, t in enumerate(got["terms"])}, [np.array(w) for w in got["weights"]])


def score_toxicity(df: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with ``p_insult``, ``p_severe``, ``score``
    (probability of toxic) and ``predicted``; a null or blank text has only the
    biases. Columns of those names are replaced."""
    added = ["p_insult", "p_severe", "score", "predicted"]
    df = df.drop(*[c for c in added if c != text_col])
    at, names = df.columns.index(text_col), df.columns
    shared = df.sparkSession.sparkContext.broadcast(chain)  # terms of a bounded sample

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value, {}
        for b in batches:
            p = np.array([model.probabilities(model.slots_of(known, distinct_words(t))) for t in b.column(at).to_pylist()], float)
            p = p.reshape(-1, len(CATEGORIES))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *(pa.array(p[:, j]) for j in range(len(CATEGORIES))), pa.array((p[:, -1] >= 0.5).astype(np.int32))],
                names=names + added)

    return df.mapInArrow(score, with_columns(df, p_insult="double", p_severe="double", score="double", predicted="int"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The columns of ``docs`` with ``held_out`` and those of ``score_toxicity``.
    Without labels every score is 0.5; repeated rows score alike; an empty
    table gives an empty result."""
    chain = fit_toxicity(docs, labels, id_col, text_col, **kw)
    df = docs.drop(*[c for c in ("held_out",) if c not in (id_col, text_col)])
    return score_toxicity(df.withColumn("held_out", held_out(id_col, 3, 1)), chain, text_col)
