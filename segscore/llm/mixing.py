"""Mixing sources to target weights by capped water-filling.

A document's size is its number of ``[^\\x20\\x09-\\x0D]+`` words. Each source
gets a share of the budget by its weight; a source whose share exceeds its
size times ``max_epochs`` is clamped there and the excess is shared again, in
proportion to the weights of the sources that are left, until none exceeds.
A source with target / size = e then takes every document floor(e) times and
a seeded sample of them once more: in the order of md5(seed:id) the documents
whose middle lies before the fractional part of the source's size.

Sources are a table, not a driver-side list: their order, the water-filling
rounds and the sample's running sums are Spark jobs; the driver sees two
numbers a round. A hot source is split by the range sort of ``running``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segscore.llm.common import cut_lineage, running, words_in

ADDED = ["size", "source_size", "target", "copies", "taken"]


def water_fill(sources: DataFrame, budget: float) -> DataFrame:
    """``sources(weight, cap, ...)`` with ``target``: the share of ``budget`` by
    weight, none above its ``cap``, excess shared again by weight.

    Each round clamps every source whose share reaches its cap, so a round
    only raises the level and there are at most as many rounds as distinct
    cap-to-weight ratios that lie between two levels (a few in practice). If
    all caps together are below the budget every source ends at its cap."""
    open_ = F.lit(True)
    level = None
    while True:
        at = sources.agg(
            F.coalesce(F.sum(F.when(~open_, F.col("cap"))), F.lit(0.0)).alias("clamped"),
            F.coalesce(F.sum(F.when(open_, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if not at["weight"]:
            return sources.withColumn("target", F.col("cap"))
        new = (budget - at["clamped"]) / at["weight"]
        if level is not None and new <= level:
            break
        level = new
        open_ = F.col("weight") * F.lit(level) <= F.col("cap")
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), F.col("cap")))


def mix_sources(
    df: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: int = 2,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """All rows and columns of ``df`` with ``size``, ``source_size``,
    ``target`` (of the source), ``copies`` (how often the mix takes the
    document) and ``taken`` (size times copies).

    Sources in code-point order, null last and a source of its own, take the
    ``weights`` in turn. Null and blank texts have size 0 and follow the rule
    of their source. Rows with equal id, source and size tie and share one
    decision. Columns of ``df`` named like the added ones are replaced. An
    empty table gives an empty result."""
    df = df.drop(*[c for c in ADDED if c not in (id_col, text_col, source_col)])
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    rows = cut_lineage(df.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("src"), words_in(F.col(text_col)).alias("size"),
    ).groupBy("id", "src", "size").agg(F.count(F.lit(1)).alias("rows")).withColumn("mass", F.col("size") * F.col("rows")))

    sources = rows.groupBy("src").agg(F.sum("mass").alias("source_size")).withColumn("one", F.lit(1))
    sources = sources.withColumn("last", F.col("src").isNull().cast("int")).withColumn("all", F.lit(0))
    ranked = running(sources, ["all"], [F.col("last"), F.col("src")], "one", "place")
    ranked = ranked.withColumn("weight", F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")))
    ranked = cut_lineage(ranked.select("src", "source_size", "weight", (F.col("source_size") * max_epochs).cast("double").alias("cap")))
    budget = (ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] or 0) * share
    plan = water_fill(ranked, float(budget))
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = plan.withColumn("whole", F.floor(epochs)).withColumn(
        "part", F.col("target") - F.col("whole") * F.col("source_size")).select(
        F.col("src").alias("_src"), "source_size", "target", "whole", "part")

    placed = running(rows.withColumn("draw", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"))),
                     ["src"], [F.col("draw"), F.col("id"), F.col("size")], "mass", "before")
    middle: Column = F.col("before") + F.col("mass") / 2
    decided = placed.join(plan, F.col("src").eqNullSafe(F.col("_src"))).select(
        F.col("id").alias("_m_id"), F.col("src").alias("_m_src"), F.col("size").alias("_m_size"),
        F.col("source_size").alias("_m_total"), F.col("target").alias("_m_target"),
        (F.col("whole") + F.when(middle < F.col("part"), 1).otherwise(0)).cast("long").alias("_m_copies"))
    sized = df.withColumn("size", words_in(F.col(text_col)))
    same = (F.col(id_col).eqNullSafe(F.col("_m_id")) & F.col(source_col).eqNullSafe(F.col("_m_src"))
            & (F.col("size") == F.col("_m_size")))
    return sized.join(decided, same, "left").select(
        *df.columns, "size", F.col("_m_total").alias("source_size"), F.col("_m_target").alias("target"),
        F.col("_m_copies").alias("copies"), (F.col("size") * F.col("_m_copies")).alias("taken"))


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mixed corpus itself: each row of ``mix_sources`` as often as its
    ``copies`` says (rows with 0 copies go)."""
    return (mixed.filter("copies > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*columns))
