"""Ranked lexical search turned round: the items' terms are the index, the documents pass by.

An inverted index over the terms of a block of items is broadcast. Every
document's term counts stream through it: its terms look up the items that
hold them, the integer scores add up by item, and each item keeps a bounded
heap of its best documents. A task hands on one heap an item, and heaps are
merged in two steps. The documents are read twice: once for the collection's
counts (documents, terms, documents by item term), once for the scores.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segscore.llm.common import texts

#: Terms are runs of ASCII digits and letters and of all characters beyond ASCII; only A-Z are folded.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: (term, item) pairs of one block of items: the bound of a broadcast index.
PAIRS = 1 << 20
#: Contributions added up at once.
AT_ONCE = 1 << 21


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order, repeats included."""
    return text.translate(_FOLD).split()


class Index:
    """term -> the items of one block that hold it, and how often."""

    def __init__(self, items: list[list[bytes]]):
        found: dict[bytes, list[tuple[int, int]]] = {}
        for i, words in enumerate(items):
            for w, n in Counter(words).items():
                found.setdefault(w, []).append((i, n))
        self.items = len(items)
        self.place = {w: j for j, w in enumerate(found)}
        size = np.array([len(v) for v in found.values()], np.int64)
        self.first = np.r_[0, np.cumsum(size)].astype(np.int64)
        flat = np.array([p for v in found.values() for p in v], np.int64).reshape(-1, 2)
        self.item, self.times = flat[:, 0], flat[:, 1]


class Heaps:
    """The ``k`` best (score, id) of every item; equal scores keep the smaller id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.zeros(items, np.int64)  # what a newcomer has to reach

    def push(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        good = score >= np.maximum(self.least[item], 1)
        if not good.any():
            return
        item, score, doc = (np.concatenate(x) for x in ((self.item, item[good]), (self.score, score[good]), (self.doc, doc[good])))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        start = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
        rank = np.arange(len(item)) - np.repeat(start, np.diff(np.r_[start, len(item)]))
        stay = rank < self.k
        self.item, self.score, self.doc, rank = item[stay], score[stay], doc[stay], rank[stay]
        full = rank == self.k - 1
        self.least[self.item[full]] = self.score[full]


def document_weights(lengths: list[int], n_docs: int, n_terms: int) -> np.ndarray:
    """12 * m by document; the products may pass 64 bits, the results do not."""
    return np.array([12 * (75 + 25 * n * n_docs // n_terms) for n in lengths], np.int64)


def add_up(index: Index, weight: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, slope: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, item, score) of every pair that shares a term; ``doc`` ascends."""
    gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + slope[doc]))
    many = index.first[term + 1] - index.first[term]
    at = np.repeat(index.first[term] - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(int(many.sum()))
    pair = np.repeat(doc, many) * index.items + index.item[at]
    part = np.repeat(gain, many) * index.times[at]
    order = np.argsort(pair, kind="stable")
    pair, part = pair[order], part[order]
    start = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, np.int64)
    total = np.add.reduceat(part, start) if len(start) else part
    return pair[start] // index.items, pair[start] % index.items, total


def collection_counts(docs: DataFrame, place) -> tuple[int, int, dict[bytes, int]]:
    """Documents with a term, all their terms, and the documents that hold each
    term of ``place`` (a broadcast dictionary, so the answer is as bounded)."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = place.value.keys()
        n_docs = n_terms = 0
        held: Counter = Counter()
        for b in batches:
            for t in texts(b.column(0)):
                words = terms(t)
                if words:
                    n_docs += 1
                    n_terms += len(words)
                    held.update(known & set(words))
        rows = [(None, n_docs, n_terms), *((w, n, 0) for w, n in held.items())]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
                                          pa.array([r[2] for r in rows], pa.int64())], names=["term", "docs", "terms"])

    got = (docs.select("_text").mapInArrow(tally, "term binary, docs long, terms long")
           .groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).collect())
    whole = next((r for r in got if r.term is None), None)
    return (whole.docs, whole.terms, {bytes(r.term): r.docs for r in got if r.term is not None}) if whole else (0, 0, {})


def search_block(docs: DataFrame, items: list, k: int) -> DataFrame:
    """``(item, doc_id, score)``: heaps of one block of items, one an item and task, merged once."""
    spark = docs.sparkSession
    index = Index([terms((r.text or "").encode()) for r in items])
    shared = spark.sparkContext.broadcast(index)
    n_docs, n_terms, held = collection_counts(docs, spark.sparkContext.broadcast(index.place))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(w, 0) + 1))) for w in index.place], np.int64)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, heaps = shared.value, Heaps(shared.value.items, k)
        known = ix.place
        ids: list[int] = []
        lengths: list[int] = []
        found: list[tuple[int, int, int]] = []
        size = 0

        def flush():
            if found:
                doc, term, tf = np.array(found, np.int64).T
                d, item, score = add_up(ix, weight, doc, term, tf, document_weights(lengths, n_docs, n_terms))
                heaps.push(item, score, np.array(ids, np.int64)[d])

        for b in batches:
            for key, t in zip(b.column(0).to_pylist(), texts(b.column(1))):
                words = terms(t)
                place = len(ids)
                ids.append(key)
                lengths.append(len(words))
                for w, n in Counter(w for w in words if w in known).items():
                    j = known[w]
                    found.append((place, j, n))
                    size += int(ix.first[j + 1] - ix.first[j])
                if size >= AT_ONCE:
                    flush()
                    ids, lengths, found, size = [], [], [], 0
        flush()
        yield pa.RecordBatch.from_arrays([pa.array(heaps.item), pa.array(heaps.doc), pa.array(heaps.score)], names=["item", "doc_id", "score"])

    heaps = docs.filter("_id is not null").select("_id", "_text").mapInArrow(stream, "item long, doc_id long, score long")
    parts = max(1, int(heaps.rdd.getNumPartitions() ** 0.5))
    best = Window.partitionBy("item", "part").orderBy(F.col("score").desc(), "doc_id")
    heaps = heaps.withColumn("part", F.spark_partition_id() % parts)
    named = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(items)], "item long, item_id long")
    return (heaps.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .join(F.broadcast(named), "item").select("item", "item_id", "doc_id", "score"))


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", k: int = 20, pairs: int = PAIRS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents of the highest
    score above 0 for every item, equal scores by ascending id.

    Null and blank texts have no terms. Rows of ``items`` that repeat id and
    text count once; an id with several texts is ranked for each of them; a
    null item id is an id. Every row of ``docs`` is a document, so one that
    repeats is ranked as often; a document without an id counts in the
    collection but is not ranked. Other columns are ignored. Items are taken in
    blocks of about ``pairs`` terms, an item lying whole in one block; the
    driver holds one block's items, and the documents are read twice a block.
    An empty table on either side gives no rows."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text")).distinct()
    letters = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + int(letters) // (2 * pairs)  # a term has a letter and, but for the last, a gap
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    out = None
    for block in range(blocks):
        rows = asked.filter(F.col("block") == block).collect()
        if rows:
            found = search_block(docs, rows, k).withColumn("block", F.lit(block))
            out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = Window.partitionBy("block", "item").orderBy(F.col("score").desc(), "doc_id")
    return (out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
