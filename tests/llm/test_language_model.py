"""The Pitman-Yor scores: seats against the exact distribution, scores against plain recomputation."""

import math
import zlib

import numpy as np
import pytest
import xxhash

from segscore.llm import pitman_yor
from segscore.llm.pitman_yor import Setting, Shard, chunk_rows, counted, numbered, score_corpus, seat, unpacked

SF = "/root/testdata/sf0.001"


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def words_of(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        t = t.replace(c, " ")
    return [w for w in t.split(" ") if w] + [""]


def tables_expected(c, a, d):
    """Mean tables of c customers where a seating weighs a per table and (n - d) per joined table."""
    s = {1: a}
    for n in range(1, c):
        s = {t: s.get(t, 0) * (n - d * t) + s.get(t - 1, 0) * a for t in range(1, n + 2)}
    return sum(t * w for t, w in s.items()) / sum(s.values())


@pytest.mark.parametrize("c,a,d", [(2, 1.0, 0.5), (8, 2.0, 0.6), (30, 0.05, 0.8), (30, 40.0, 0.3)])
def test_seats_follow_the_exact_distribution(c, a, d):
    t = seat(np.full(20000, c), np.full(20000, a), d, np.random.default_rng(4), passes=30)
    assert 1 <= t.min() and t.max() <= c
    assert abs(t.mean() - tables_expected(c, a, d)) < 0.02 * tables_expected(c, a, d) + 0.01


def test_seats_of_hot_dishes_and_none():
    rng = np.random.default_rng(1)
    c = np.array([0, 1, 5000, 3, 0, 2048, 1025])
    t = seat(c, np.full(7, 50.0), 0.5, rng)
    assert t[[0, 1, 4]].tolist() == [0, 1, 0] and (t >= np.minimum(c, 1)).all() and (t <= c).all()
    assert t[2] > t[6] > t[3]
    assert seat(np.zeros(0, np.int64), np.zeros(0), 0.5, rng).tolist() == []


def one_shard(documents, held=None, setting=Setting()):
    """A shard of all texts, and the number of every word in it."""
    held = held or [False] * len(documents)
    own, ask = chunk_rows(0, list(range(len(documents))), held, documents, 1)
    _, answer = numbered(0, 1, [ask[4]], [0])
    rows = counted(0, own[4], [answer[4]], 1, 1, 1)
    words = sorted({w for t in documents for w in t.split()} | {b""})
    key = {xxhash.xxh64_intdigest(w): w for w in words}
    number = dict(zip((key[k] for k in unpacked(ask[4])[1].tolist()), unpacked(answer[4])[1].tolist()))
    return Shard([r[4] for r in rows[1:]], setting, (1, 0), 1), number


def test_predictive_probabilities_add_up():
    r = np.random.default_rng(2)
    vocabulary = [f"w{i}".encode() for i in range(12)]
    documents = [b" ".join(r.choice(vocabulary, 30, p=np.arange(1, 13) / 78)) for _ in range(20)]
    # held-out texts put every word behind one context and behind one that was never seen
    probes = [b"w3 w4 " + w for w in vocabulary] + [b"w3 w4", b"w3 w4 new"] + [b"x y " + w for w in vocabulary] + [b"x y", b"x y new"]
    m, number = one_shard(documents + probes, [False] * 20 + [True] * len(probes))
    at = {w: int(np.flatnonzero(m.key == n)[0]) for w, n in number.items()}
    root = m.local_root()
    learnt = [at[w] for w in [*vocabulary, b""]]
    assert abs(root[learnt].sum() + root[at[b"new"]] - 1) < 1e-12  # all words that were not learnt are one
    m.sweep(root)
    p = m.trigrams(m.bigrams(root))
    for a, b in ((b"w3", b"w4"), (b"x", b"y")):
        context = np.flatnonzero(m.pair_key == pitman_yor._mixed(m.key[[at[a]]], m.key[[at[b]]])[0])[0]
        mine = m.pair == context
        assert set(m.word[mine]) == {at[w] for w in [*vocabulary, b"", b"new"]}
        assert abs(p[mine].sum() - 1) < 1e-9


def test_packing_round_trip():
    r = np.random.default_rng(8)
    for x in (np.zeros(0, np.int64), np.array([0]), r.integers(0, 1 << 40, 99), r.integers(-5, 5, 9), r.normal(size=7),
              r.integers(0, 1 << 63, 5).astype(np.uint64) * np.uint64(2) + np.uint64(1)):
        (back,) = unpacked(pitman_yor.packed(x))
        assert back.dtype == x.dtype and back.tolist() == x.tolist()


@pytest.mark.parametrize("common", [1 << 22, 5, 1])
def test_renumbering_keeps_the_numbers(monkeypatch, common):
    monkeypatch.setattr(pitman_yor, "COMMON", common)
    r = np.random.default_rng(3)
    for x in (r.integers(0, 20, 100), r.integers(1, 20, 100), np.array([0]), np.array([7, 7]), r.integers(0, 1 << 40, 50)):
        if common > 100 and x.max() < common or common < 100:
            key, at = pitman_yor.renumbered(x, 4)
            assert key[at].tolist() == x.tolist() and len(set(key.tolist())) == len(key) == len(set(x.tolist()))
            order = list(zip(pitman_yor.spread(key, 4).tolist(), key.tolist()))
            assert order == sorted(order)


def test_trigrams_give_every_token_its_place():
    r = np.random.default_rng(8)
    lengths = r.integers(1, 9, 40)
    seq = r.integers(1, 9, lengths.sum())
    three, ends, at = pitman_yor.trigrams(seq, lengths, 3)
    want, i = [], 0
    for n in lengths:
        t = [0, 0, *seq[i:i + n].tolist()]
        want += [tuple(t[j:j + 3]) for j in range(n)]
        i += n
    assert [tuple(three[:, a]) for a in at] == want
    assert len({tuple(t) for t in three.T}) == three.shape[1] and ends[-1] == three.shape[1]
    for s in range(3):
        mine = three[1, ends[s]:ends[s + 1]]
        assert (pitman_yor.spread(mine, 3) == s).all() and (np.diff(mine) >= 0).all()


def test_scores_where_no_seat_is_free_to_vary(spark):
    """One learnt text without repeated words: every dish has one customer, so
    the probabilities are a closed form."""
    learnt, other = next(i for i in range(99) if not held(i)), [i for i in range(99) if held(i)][:4]
    rows = [(learnt, "A b\tc d"), (other[0], "a b c d"), (other[1], "b c x"), (other[2], None), (other[3], "d \n c")]
    s = Setting()
    (d1, d2, d3), (s1, s2, s3) = s.discount, s.strength
    train = [None, None, *words_of(rows[0][1])]
    seen3 = {tuple(train[i - 2:i + 1]) for i in range(2, len(train))}
    seen2, seen1 = {x[1:] for x in seen3}, {x[2] for x in seen3}

    def p1(w):
        n = len(seen1)
        return ((w in seen1) * (1 - d1) + (s1 + d1 * n) / (n + 1)) / (s1 + n)

    def p2(v, w):
        n = sum(x[0] == v for x in seen2)
        return (((v, w) in seen2) * (1 - d2) + (s2 + d2 * n) * p1(w)) / (s2 + n)

    def p3(u, v, w):
        n = sum(x[:2] == (u, v) for x in seen3)
        return (((u, v, w) in seen3) * (1 - d3) + (s3 + d3 * n) * p2(v, w)) / (s3 + n)

    got = {r.doc_id: r for r in score_corpus(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        seq = [None, None, *words_of(t)]
        want = sum(math.log10(p3(*seq[j - 2:j + 1])) for j in range(2, len(seq)))
        assert abs(got[i].score - want) < 1e-5 * len(seq)


def plain_counts(rows):
    train = [w for i, t in rows if i is not None and not held(i) for w in words_of(t)]
    count = {}
    for w in train:
        count[w] = count.get(w, 0) + 1
    out = []
    for i, t in rows:
        words = words_of(t)
        out.append((i, i is None or held(i), len(words), sum(w in count for w in words), len(train),
                    sum(math.log10((count.get(w, 0) + 1) / (len(train) + len(count) + 1)) for w in words)))
    return out


@pytest.mark.parametrize("cut", [False, True])
def test_counts_and_base_scores_on_a_whole_table(spark, monkeypatch, cut):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    extra = [(None, "the the"), (10**6, None), (10**6 + 1, ""), rows[3], rows[3], (10**6 + 2, "xxq " * 5000), (10**6 + 3, "the  the\x0bthe")]
    df = docs.select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame([(i, t, "x") for i, t in extra], "doc_id long, text string, lang string"))
    df = df.withColumnRenamed("lang", "score")
    if cut:
        monkeypatch.setattr(pitman_yor, "CHUNK_BYTES", 20_000)
        monkeypatch.setattr(pitman_yor, "SHARD_BYTES", 100_000)
        monkeypatch.setattr(pitman_yor, "OWNER_BYTES", 200_000)
        monkeypatch.setattr(pitman_yor, "SHARD_MOST", 4_000)
    got = score_corpus(df).collect()
    want = plain_counts(rows + extra)
    show = lambda r: (str(r[0]), *r[1:5])
    assert sorted(map(show, got)) == sorted(map(show, want))
    base = {w[0]: w[5] for w in want}
    assert all(abs(g.base_score - base[g.doc_id]) < 1e-6 * abs(base[g.doc_id]) for g in got)
    fresh = [g for g in got if g.held_out and g.n_tokens > 5]
    assert sum(g.score for g in fresh) > sum(g.base_score for g in fresh)
    assert all(abs(math.log10(g.perplexity) + g.score / g.n_tokens) < 1e-9 for g in got)
    totals[cut] = sum(g.score for g in fresh)
    if len(totals) == 2:  # splitting shards changes draws, not the model
        assert abs(totals[0] - totals[1]) < 0.02 * abs(totals[0])


totals = {}


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert score_corpus(df).count() == 0
    only_held = next(i for i in range(99) if held(i))
    r = score_corpus(spark.createDataFrame([(only_held, "a b")], "doc_id long, text string")).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and abs(r.score) < 1e-9
