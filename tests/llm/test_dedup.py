import hashlib
import re

import numpy as np
import pytest
import xxhash

from segscore.llm import simhash, substring_dedup
from segscore.llm.common import components, running, words_in
from segscore.llm.exact import exact_dedup
from segscore.llm.simhash import drop_near_copies, simhash_dedup
from segscore.llm.substring_dedup import repeated_spans

SCHEMA = "doc_id long, text string, kept string, fingerprint int"


def prose(n, seed):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(list("abcdeé"), r.integers(1, 7))) for _ in range(n))


def corpus():
    base = [prose(n, i) for i, n in enumerate([1, 2, 3, 40, 60, 80, 120, 300])]
    near = [base[7].replace(" ", "  ", 3), base[7] + " ende", "x " + base[7], base[6].upper()]
    rows = [*base, *near, *base[3:6], None, "", " \t\n\x0b\x0c\r", "a" * 700, "ab" * 400, base[6] + base[7], "\x1ca b"]
    out = [(i * 3 + 1, t, "own", 5) for i, t in enumerate(rows)]
    return out + [out[4], out[4], (None, base[5], "own", 5), (None, None, None, None), (out[0][0], base[7], "own", 5)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5)


def norm(t):
    return re.sub("[\x20\x09-\x0d]", "", t or "")


def test_exact_dedup_against_brute_force(spark, docs):
    for limit in (None, 0):  # 0: every group counts as hot
        got = exact_dedup(docs).collect() if limit is None else _hot(docs)
        groups = {}
        for i, t, *_ in corpus():
            groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0, i))
        assert len(got) == len(corpus())
        for r in got:
            g = groups[norm(r.text)]
            assert (r.keep_id, r.group_size) == (min(g)[3], len(g))
            assert r.text_sha256 == hashlib.sha256(norm(r.text).encode()).hexdigest()
        assert sum(r.kept for r in got) == len(groups)
        assert all(r.doc_id == r.keep_id for r in got if r.kept)
        assert set(got[0].asDict()) == {"doc_id", "text", "kept", "fingerprint", "keep_id", "group_size", "text_sha256"}


def _hot(docs):
    spark = docs.sparkSession
    big = [(1000 + i, "co py" + " " * (i % 3), "x", 1) for i in range(300)]
    df = docs.unionByName(spark.createDataFrame(big, SCHEMA)).repartition(7)
    rows = exact_dedup(df).collect()
    hot = [r for r in rows if norm(r.text) == "copy"]
    assert {(r.keep_id, r.group_size) for r in hot} == {(1002, 300)}
    assert [r.doc_id for r in hot if r.kept] == [1002]
    return [r for r in rows if norm(r.text) != "copy"]


def fingerprint(t, k=4):
    w = (t or "").encode().lower().split()
    if not w:
        return 0
    k = min(k, len(w))
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_against_brute_force(docs):
    rows = corpus()
    fp = [fingerprint(t) for _, t, *_ in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fp[i] ^ fp[j]).bit_count() <= 4:
                    root[i] = root[j] = min(root[i], root[j])
    want = {}
    for i, (d, t, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        want.setdefault((d, f"{fp[i]:016x}"), min(ids, default=None))
    got = simhash_dedup(docs).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.fingerprint): r.component_id for r in got} == want
    kept = drop_near_copies(docs).collect()
    assert len({(r.doc_id, r.text) for r in kept}) == len(set(root))


def test_bit_sliced_blocks_find_every_close_pair(spark, monkeypatch):
    r = np.random.default_rng(1)
    centre = r.integers(0, 1 << 63, 20, dtype=np.uint64)
    fps = []
    for c in centre:
        for _ in range(15):
            flips = r.choice(64, r.integers(0, 6), replace=False)
            fps.append(int(c) ^ sum(1 << int(b) for b in flips))
    fps = np.array(sorted(set(fps)), np.uint64)
    a, b = np.meshgrid(np.arange(len(fps)), np.arange(len(fps)))
    close = simhash.close_pairs(fps[a.ravel()], fps[b.ravel()], 4)
    assert (close == (np.bitwise_count(fps[a.ravel()] ^ fps[b.ravel()]) <= 4)).all()
    want = _roots(fps)
    assert _same(simhash.block_roots(fps, 4), want)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    for block, small in ((2048, 24), (16, 4)):  # the second cuts buckets into pairs of sub-blocks
        monkeypatch.setattr(simhash, "BLOCK", block)
        monkeypatch.setattr(simhash, "SMALL", small)
        linked = {r.node: r.root for r in components(simhash.near_links(df, 4)).collect()}
        assert _same([linked.get(int(x), int(x)) for x in fps.view(np.int64)], want)


def _roots(fps):
    root = np.arange(len(fps))
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= 4
    for _ in fps:
        root = np.array([root[n].min() for n in near])
    return root


def _same(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_running_restarts_by_null_and_hot_groups(spark):
    rows = [(None if i % 3 == 0 else "a", i, i % 7) for i in range(200)]
    from pyspark.sql import functions as F
    got = running(spark.createDataFrame(rows, "g string, i long, v long"), ["g"], [F.col("i")], "v", "before").collect()
    for r in got:
        assert r.before == sum(v for g, i, v in rows if g == r.g and i < r.i)


def removed(rows):
    place = {}
    for d, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 99):
            key = (d is None, d or 0, p)
            place[b[p:p + 100]] = min(place.get(b[p:p + 100], key), key)
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 99):
            gone[p:p + 100] |= place[b[p:p + 100]] < (d is None, d or 0, p)
        yield d, b, gone


@pytest.mark.parametrize("slice_bytes", [1 << 20, 1024])
def test_repeated_spans_against_brute_force(spark, docs, slice_bytes, monkeypatch):
    rows = [(d, t) for d, t, *_ in corpus()]
    if slice_bytes < 1 << 20:  # long texts are cut into overlapping segments
        rng = np.random.default_rng(4)
        raw = rng.integers(97, 105, 5000).astype(np.uint8)
        raw[3000:3400] = raw[100:500]
        whole = substring_dedup.sampled(raw, np.array([0, len(raw)]))
        monkeypatch.setattr(substring_dedup, "SLICE", slice_bytes)
        assert all((a == b).all() for a, b in zip(whole, substring_dedup.sampled(raw, np.array([0, len(raw)]))))
        return
    got = sorted((str(r.doc_id), r.n_bytes, bytes(r.kept), tuple((s.start, s.end) for s in r.spans)) for r in repeated_spans(docs).collect())
    want = []
    for d, b, gone in removed(rows):
        edge = np.flatnonzero(np.diff(np.r_[0, gone.astype(int), 0]))
        want.append((str(d), len(b), np.frombuffer(b, np.uint8)[~gone].tobytes(), tuple(zip(edge[::2].tolist(), edge[1::2].tolist()))))
    assert got == sorted(want)


def hot_line(n, seed=9):
    """Texts that hold one line of 60 bytes amid neighbours of their own; some neighbours recur."""
    rng = np.random.default_rng(seed)
    line = "".join(map(chr, rng.integers(97, 123, 60)))
    near = ["".join(map(chr, rng.integers(97, 123, 150))) for _ in range(n)]
    return [(i, near[i % (n - 20)] + line + near[(i * 7 + 3) % (n - 20)]) for i in range(n)]


def test_repeated_spans_deals_a_hot_line_to_many_groups():
    m = substring_dedup
    raw = [t.encode() for _, t in hot_line(600)]
    at = np.cumsum([0] + [len(r) for r in raw])
    t, a, lo, hi, h, c = m.sampled(np.frombuffer(b"".join(raw), np.uint8), at)
    zero = np.zeros(len(t), "<i4")
    rows = m.sent([h, c, t.astype("<i8"), zero, a.astype("<i4"), lo.astype("<i4"), (hi - lo).astype("<i4")], 1 << 20).to_pylist()
    tuples = [(r["grp"], m.unpacked([r["payload"]], m.TUPLE)[0]) for r in rows if r["kind"] in (m.SEND, getattr(m, "SPLIT", m.SEND))]
    sizes = {}
    for grp, keys in tuples:
        sizes[grp] = sizes.get(grp, 0) + len(keys)
    top = max(np.unique(np.concatenate([k for _, k in tuples]), return_counts=True)[1])
    assert top > 300 and max(sizes.values()) < 20  # was: all of the hot hash in one group


def test_repeated_spans_of_a_hot_line_against_brute_force(spark):
    rows = hot_line(160) + [(1000 + i, t) for i, t in hot_line(40)[:8]]  # dealt so that the line is hot in some tasks only
    parts = [rows[:100], rows[100:110], rows[110:115], rows[115:]]
    df = spark.createDataFrame(parts[0], "doc_id long, text string").coalesce(1)
    for p in parts[1:]:
        df = df.unionByName(spark.createDataFrame(p, df.schema).coalesce(1))
    got = sorted((r.doc_id, bytes(r.kept)) for r in repeated_spans(df).collect())
    assert got == sorted((d, np.frombuffer(b, np.uint8)[~gone].tobytes()) for d, b, gone in removed(rows))
    assert sum(len(k) for _, k in got) < sum(len(t) for _, t in rows) - 5000


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    for f in (exact_dedup, simhash_dedup, drop_near_copies, repeated_spans):
        assert f(none).count() == 0


def test_words(spark, docs):
    for r in docs.select("text", words_in(docs.text).alias("n")).collect():
        assert r.n == len(re.findall("[^\x20\x09-\x0d]+", r.text or ""))
