"""Ranked lexical search and hard-negative mining against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from segscore.llm import blocks as blocks_module
from segscore.llm import lexical
from segscore.llm import negatives as negatives_module
from segscore.llm.lexical import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k):
    counted = [(d, Counter(plain_terms(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    out = []
    for item, text in set(items):
        words = plain_terms(text)
        scores = []
        for d, c, n in held:
            if d is None:
                continue
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            s = 0
            for w in words:
                if c[w]:
                    df = sum(1 for _, o, _ in held if o[w])
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m))
            if s > 0:
                scores.append((-s, d))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def test_terms_follow_the_pattern():
    for t in ["Ab-c d_e 1x\tÜber ÄÖ z q{a}b`c@d[e]\x7ff\x00g", "", "...", "É'été", "日本 語a1"]:
        assert [w.decode() for w in lexical.terms(t.encode())] == plain_terms(t)


@pytest.mark.parametrize("pairs", [1 << 20, 20])
def test_ranked_search_equals_brute_force(spark, pairs):
    r = np.random.default_rng(5)
    vocabulary = ["the", "The", "of", "x1", "née", "日本", "zeta", "rare", "a-b", "..."]
    docs = [(i, " ".join(r.choice(vocabulary, int(r.integers(0, 30)), p=[.2, .1, .2, .1, .1, .1, .1, .02, .05, .03]))) for i in range(300)]
    docs += [docs[7], docs[7], (None, "the rare rare"), (900, None), (901, ""), (902, "rare " * 4000), (903, "the\x00of"), (-5, docs[7][1])]
    items = [(1, "the of of"), (1, "the of of"), (1, "rare née"), (2, None), (3, "nothing-here"), (None, "日本 x1"), (4, "THE the"), (5, "")]
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, score string, item_id int").repartition(5)
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = sorted((tuple(x) for x in ranked_search(d, q, k=7, pairs=pairs).collect()), key=str)
    assert got == plain_search(docs, items, 7)


def test_ranked_search_without_rows(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search(d.limit(0), q).count() == 0
    assert ranked_search(d, q.limit(0)).count() == 0
    assert ranked_search(d.select("doc_id", d.text.substr(1, 0).alias("text")), q).count() == 0


def test_length_weights_past_64_bits():
    assert lexical.document_weights([10**9], 10**11, 10**13)[0] == 12 * (75 + 25 * 10**9 * 10**11 // 10**13)


def test_heaps_keep_smaller_ids_on_ties():
    h = lexical.Heaps(2, 2)
    h.push(np.array([0, 0, 1]), np.array([5, 5, 0]), np.array([9, 8, 1]))
    h.push(np.array([0, 0, 0]), np.array([5, 4, 6]), np.array([7, 1, 30]))
    assert list(zip(h.item, h.score, h.doc)) == [(0, 6, 30), (0, 5, 7)]


# ------------------------------------------------------- hard negatives
def plain_negatives(rows, every, positives, negatives, low, high, scale):
    seen = []
    for i, x, label in rows:
        if i is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        r = (i, label, tuple(math.floor(int(scale) * c) if abs(c) > 1e300 else math.floor(scale * c) for c in x), tuple(x))
        if r not in seen:
            seen.append(r)
    out = []
    for a in seen:
        if a[0] % every:
            continue
        dot = lambda o: sum(p * q for p, q in zip(a[2], o[2]))
        same = sorted((-dot(o), o[0]) for o in seen if o[1] == a[1] and o[0] != a[0] and len(o[2]) == len(a[2]))[:positives]
        for s, p in same:
            ok = sorted((-dot(o), o[0]) for o in seen if o[1] != a[1] and len(o[2]) == len(a[2])
                        and low * -s <= 100 * dot(o) <= high * -s)[:negatives]
            out += [(a[0], p, r + 1, n, -s, -t) for r, (t, n) in enumerate(ok)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(i, x, label, "c") for i, x, label in rows], "vec_id long, embedding array<double>, label int, key string")
    return sorted(tuple(r) for r in negatives_module.hard_negatives(df.repartition(3), **kw).collect())


@pytest.mark.parametrize("dim,block", [(6, 4096), (6, 64), (1, 64)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, dim, block):
    monkeypatch.setattr(negatives_module, "ROW_BLOCK", block)
    r = np.random.default_rng(dim)
    rows = [(i, [float(v) for v in np.round(r.normal(size=dim) + 0.4, 1)], int(r.integers(0, 3))) for i in range(400)]
    rows += [rows[3], rows[50], rows[50], (50, rows[51][1], 1), (None, rows[1][1], 1), (500, None, 1), (550, rows[2][1], None),
             (600, [float("nan")] * dim, 1), (601, [float("inf")] * dim, 1), (602, [None] * dim, 1), (650, [1.0, 2.0], 0),
             (651, [1.0, 2.0], 0), (652, [0.5, 1.0], 2), (700, [], 1), (701, [], 1), (-50, rows[9][1], 2)]
    want = plain_negatives(rows, 50, 5, 3, 50, 95, 256)
    assert len(want) > 20
    assert mined(spark, rows) == want


def test_hard_negatives_of_large_components(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(v) for v in r.integers(1, 1 << 20, 256)], i % 2) for i in range(60)]
    rows += [(61, [1e20] * 256, 0), (62, [1e22] + [0.0] * 255, 1)]
    most = (1 << 63) - 1
    want = plain_negatives(rows, 7, 5, 3, 50, 95, 256)
    assert any(w[4] > most for w in want) and any(w[4] < most for w in want)
    assert mined(spark, rows, every=7) == sorted((*w[:4], min(w[4], most), min(w[5], most)) for w in want)


def test_products_do_not_overflow():
    v = np.full((1, 256), 1 << 31, np.int64)
    assert blocks_module.products(v, v[0])[0] == 256 << 62
    assert blocks_module.products(v // 2**20, v[0] // 2**20).dtype == np.int64
    assert blocks_module.whole(np.array([[1e308, -0.5]]), 256.0)[0].tolist() == [int(1e308) * 256, -256 * 1 // 2]


def test_walk_visits_every_row_once_in_order_of_bounds():
    r = np.random.default_rng(3)
    v = r.integers(-50, 50, (700, 8))
    index = negatives_module.MultiIndex(np.arange(700), np.zeros(700, np.int64), v)
    q = r.integers(-50, 50, 8)
    seen, last = [], np.inf
    for then, low, at in index.walk(q):
        score = index.values[at] @ q
        assert not len(at) or (score.max() <= last and score.min() >= low)
        seen += at.tolist()
        last = then
    assert sorted(seen) == list(range(700))


def test_hard_negatives_without_rows(spark):
    assert mined(spark, [(50, [1.0], 1)]) == []
    df = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    assert negatives_module.hard_negatives(df).count() == 0
