"""Rare-class resamplers (M13-M16, U3, U4), built on the exact kNN.

Randomness is ``md5`` of (id, draw, seed): identical on task retries and in
a second SQL engine. Synthetic rows carry ``src_id``/``syn_j`` and an id
hashed from them; originals keep theirs.

* SMOTE (Chawla et al. 2002): the minority grows to the majority count;
  row i makes ⌊G/n⌋ or ⌈G/n⌉ samples (hash order decides which), each on
  the segment to one of its k minority neighbours.
* ADASYN (He et al. 2008): sample counts ∝ the majority share among each
  minority point's k neighbours in the whole table (rounded half to even).
* ENN (Wilson 1972): drop rows whose 3 neighbours do not all share its class.
* Tomek links (Tomek 1976): drop both ends of mutual 1-NN opposite-class pairs.

Generation is chunked: a point that must make many samples is split into
chunks that are spread over tasks before exploding, so one rare row can
never produce all synthetic rows inside a single task.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segscore.functions.scalar import qcol
from segscore.operators.knn import knn
from segscore.operators.ranking import global_running
from segscore.operators.stats import hash_uniform
from segscore.session import cut_lineage

CHUNK = 10_000


#: Synthetic ids lie below this bound; ids of real rows have to lie above it.
SYNTHETIC_BELOW = -(1 << 61)


def synthetic_id(src: Column, j: Column, seed: int) -> Column:
    """A 60-bit hash of (source, draw, seed) in a range of its own."""
    h = F.md5(F.concat_ws(":", src.cast("string"), j.cast("string"), F.lit(str(seed)), F.lit("syn")))
    return F.lit(SYNTHETIC_BELOW) - F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def _counts_even(minor: DataFrame, g: int, seed: int, id_col: str) -> DataFrame:
    n = minor.count()
    q, rem = divmod(g, n)
    keyed = minor.select(qcol(id_col).alias("src_id"),
                         F.md5(F.concat_ws(":", qcol(id_col).cast("string"), F.lit(str(seed)), F.lit("pick"))).alias("_h"))
    r = global_running(keyed, [F.col("_h").asc(), F.col("src_id").asc()], rank_col="_r")
    return r.select("src_id", (F.lit(q) + (F.col("_r") <= F.lit(rem)).cast("long")).alias("cnt"))


def _generate(df: DataFrame, features: list[str], counts: DataFrame, nn: DataFrame, k_eff: int, seed: int,
              label: str, id_col: str, minority: int) -> DataFrame:
    """counts(src_id, cnt) × minority neighbours nn(qid, nid, rank) → synthetic rows.

    A source meets its features and those of its at most k neighbours first,
    one row a source; only then are its draws made, in chunks spread over the
    tasks. No exchange follows, so few sources cannot crowd one task."""
    values = F.array(*[qcol(f).cast("double") for f in features])
    base = df.select(qcol(id_col).alias("src_id"), values.alias("_a"))
    near = nn.join(df.select(qcol(id_col).alias("nid"), values.alias("_b")), "nid")
    near = near.groupBy(F.col("qid").alias("src_id")).agg(F.sort_array(F.collect_list(F.struct("rank", "_b"))).alias("_near"))
    src = counts.filter(F.col("cnt") > 0).join(near, "src_id").join(base, "src_id")
    ch = src.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("cnt") - 1) / CHUNK).cast("long"))))
    ch = ch.repartition("src_id", "chunk")
    j = F.explode(F.sequence(F.col("chunk") * CHUNK, F.least(F.col("cnt"), (F.col("chunk") + 1) * CHUNK) - 1))
    rows = ch.select("src_id", "_a", "_near", j.alias("syn_j"))
    u_nn = hash_uniform(F.col("src_id"), F.col("syn_j"), F.lit(seed), F.lit("nn"))
    u_gap = hash_uniform(F.col("src_id"), F.col("syn_j"), F.lit(seed), F.lit("gap"))
    rows = rows.select("src_id", "syn_j", "_a", F.element_at("_near", (F.floor(u_nn * k_eff) + 1).cast("int"))["_b"].alias("_b"), u_gap.alias("gap"))
    return rows.select(
        synthetic_id(F.col("src_id"), F.col("syn_j"), seed).alias(id_col),
        F.lit(minority).cast("int").alias(label),
        *[(F.col("_a")[i] + F.col("gap") * (F.col("_b")[i] - F.col("_a")[i])).alias(f) for i, f in enumerate(features)],
        F.lit(True).alias("synthetic"), F.col("src_id"), F.col("syn_j").cast("long"),
    )


def _complete_minority(df: DataFrame, features: list[str], label: str, minority: int) -> DataFrame:
    """Minority rows without a missing feature: only they have neighbours."""
    minor = df.filter(qcol(label) == minority)
    for f in features:
        minor = minor.filter(qcol(f).isNotNull() & ~F.isnan(qcol(f)))
    return minor


def _with_flags(df: DataFrame, features: list[str], label: str, id_col: str) -> DataFrame:
    return df.select(qcol(id_col).alias(id_col), qcol(label).cast("int").alias(label), *[qcol(f) for f in features],
                     F.lit(False).alias("synthetic"), F.lit(None).cast("long").alias("src_id"),
                     F.lit(None).cast("long").alias("syn_j"))


def _class_counts(df: DataFrame, label: str, minority: int) -> tuple[int, int]:
    r = df.agg(F.sum((qcol(label) == minority).cast("long")).alias("a"),
               F.sum((qcol(label) != minority).cast("long")).alias("b")).collect()[0]
    return int(r["a"] or 0), int(r["b"] or 0)


def smote_synthetic(df: DataFrame, features: list[str], k: int = 5, seed: int = 42, label: str = "label",
                    id_col: str = "id", minority: int = 1) -> DataFrame:
    """The synthetic rows that even out the classes; none if they are even or
    fewer than 2 minority rows have all features. Rows with a missing feature
    have no neighbours, so every synthetic row is dealt to one without."""
    df = cut_lineage(df.select(qcol(id_col), qcol(label), *[qcol(f) for f in features]))
    n_min, n_maj = _class_counts(df, label, minority)
    g = n_maj - n_min
    none = _with_flags(df, features, label, id_col).limit(0)
    if g <= 0:
        return none
    minor = _complete_minority(df, features, label, minority)
    n_eligible = minor.count()
    if n_eligible < 2:
        warnings.warn("SMOTE needs at least 2 complete minority rows; input returned unchanged")
        return none
    k_eff = min(k, n_eligible - 1)
    nn = knn(minor, features, k_eff, id_col=id_col)
    return _generate(df, features, _counts_even(minor, g, seed, id_col), nn, k_eff, seed, label, id_col, minority)


def smote(df: DataFrame, features: list[str], k: int = 5, seed: int = 42, label: str = "label",
          id_col: str = "id", minority: int = 1) -> DataFrame:
    """M13 + U3: originals ∪ synthetic minority rows."""
    orig = _with_flags(df, features, label, id_col)
    syn = smote_synthetic(df, features, k, seed, label, id_col, minority)
    return cut_lineage(orig.unionByName(syn))


def adasyn(df: DataFrame, features: list[str], k: int = 5, seed: int = 42, label: str = "label",
           id_col: str = "id", minority: int = 1) -> DataFrame:
    """Density-weighted counts, minority-neighbour interpolation. The
    missing rows are shared out among the minority rows that have all features;
    with fewer than 2 of them the input comes back unchanged."""
    df = cut_lineage(df.select(qcol(id_col), qcol(label), *[qcol(f) for f in features]))
    orig = _with_flags(df, features, label, id_col)
    n_min, n_maj = _class_counts(df, label, minority)
    g = n_maj - n_min
    minor = _complete_minority(df, features, label, minority)
    n_eligible = minor.count()
    if g <= 0 or n_eligible < 2:
        return orig
    allnn = knn(df, features, k, id_col=id_col, query=qcol(label) == minority)
    lab = df.select(qcol(id_col).alias("nid"), qcol(label).alias("_nl"))
    # majority neighbours per minority point, as an integer m_i; the share
    # m_i / Σm is the density ratio, and counts are round-half-even of
    # m_i·G/Σm computed exactly in integers
    m = allnn.join(lab, "nid").groupBy("qid").agg(F.sum((F.col("_nl") != minority).cast("long")).alias("m"))
    total = int(m.agg(F.sum("m")).collect()[0][0] or 0)
    if total <= 0:
        warnings.warn("ADASYN: no minority point has a majority neighbour; input returned unchanged")
        return orig
    num = F.col("m") * F.lit(g)
    q, rem = F.floor(num / F.lit(total)).cast("long"), num % F.lit(total)
    up = F.when(2 * rem > total, 1).when((2 * rem == total) & (q % 2 == 1), 1).otherwise(0)
    counts = m.select(F.col("qid").alias("src_id"), (q + up).cast("long").alias("cnt"))
    k_eff = min(k, n_eligible - 1)
    nn = knn(minor, features, k_eff, id_col=id_col)
    return cut_lineage(orig.unionByName(_generate(df, features, counts, nn, k_eff, seed, label, id_col, minority)))


def edited_nn(df: DataFrame, features: list[str], k: int = 3, label: str = "label", id_col: str = "id") -> DataFrame:
    """ENN (kind 'all', every class cleaned) → U4 left-anti join."""
    nn = knn(df, features, k, id_col=id_col)
    lab = df.select(qcol(id_col).alias("nid"), qcol(label).alias("_nl"))
    me = df.select(qcol(id_col).alias("qid"), qcol(label).alias("_ql"))
    bad = nn.join(lab, "nid").join(me, "qid").filter(F.col("_nl") != F.col("_ql")).select(
        F.col("qid").alias(id_col)).distinct()
    return df.join(bad, id_col, "left_anti")


def tomek_clean(df: DataFrame, features: list[str], label: str = "label", id_col: str = "id") -> DataFrame:
    """Remove both rows of every Tomek link → U4 left-anti join."""
    nn = knn(df, features, 1, id_col=id_col).select("qid", "nid")
    lab = df.select(qcol(id_col).alias("i"), qcol(label).alias("l"))
    mutual = nn.alias("a").join(nn.alias("b"), (F.col("a.qid") == F.col("b.nid")) & (F.col("a.nid") == F.col("b.qid")))
    links = (mutual.select(F.col("a.qid").alias("x"), F.col("a.nid").alias("y"))
             .join(lab.withColumnRenamed("i", "x").withColumnRenamed("l", "lx"), "x")
             .join(lab.withColumnRenamed("i", "y").withColumnRenamed("l", "ly"), "y")
             .filter(F.col("lx") != F.col("ly")))
    return df.join(links.select(F.col("x").alias(id_col)).distinct(), id_col, "left_anti")


def smote_enn(df: DataFrame, features: list[str], k: int = 5, seed: int = 42, label: str = "label",
              id_col: str = "id", minority: int = 1) -> DataFrame:
    """SMOTE, then ENN(3) on the resampled table."""
    return edited_nn(smote(df, features, k, seed, label, id_col, minority), features, 3, label, id_col)


def smote_tomek(df: DataFrame, features: list[str], k: int = 5, seed: int = 42, label: str = "label",
                id_col: str = "id", minority: int = 1) -> DataFrame:
    """SMOTE, then Tomek-link removal."""
    return tomek_clean(smote(df, features, k, seed, label, id_col, minority), features, label, id_col)
