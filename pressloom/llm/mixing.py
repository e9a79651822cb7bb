"""Mixing sources to target token weights.

Words are counted per source; a target share per source and its size give a repetition rate.
Every document is emitted floor(rate) times, and once more where a seeded hash of it, read as a
number in [0, 1), is below the fraction of the rate. All steps are column expressions.

A source's target stops at ``cap`` times its size; what it cannot take is shared again by weight
among the others, until none is above. That is a level L with target = min(weight * L, cap * size)
and targets that add up to the total. L only rises while sources stop, so it is found by a few
aggregates over the source table; only L's two sums come to the driver.

Edge cases: null text has no words, null is a source of its own, a source without words takes
nothing, repeated rows with one id draw alike, rows without an id draw by their text, and an empty
table gives an empty mix. Added columns whose names are taken get underscores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import fresh, word_count
from pressloom.operators.joins import lookup
from pressloom.operators.ranking import number_rows
from pressloom.session import materialize

WEIGHTS = (5, 2, 1)


def _join_key(source: Column) -> Column:
    """The source as a join key under which null equals null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def source_targets(sizes: DataFrame, source: str = "source", size: str = "size", weights: tuple[int, ...] = WEIGHTS,
                   share_pct: int = 150, cap: int = 2) -> DataFrame:
    """Per source: _key, source_size, target and rate. Weights repeat in code point order, null last."""
    totals = sizes.groupBy(F.col(source).alias("_source")).agg(F.sum(size).alias("source_size"))
    keyed = totals.select(F.col("_source").isNull().cast("int").alias("_last"), _join_key(F.col("_source")).alias("_key"),
                          F.coalesce("source_size", F.lit(0)).cast("bigint").alias("source_size"))
    ranked = number_rows(keyed, [], [F.col("_last").asc(), F.col("_key").asc()])
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("rn") - 1, F.lit(len(weights))) + 1).cast("int"))
    table = materialize(ranked.select("_key", "source_size", weight.cast("bigint").alias("weight")), "sources")
    total = (table.agg(F.sum("source_size").alias("n")).collect()[0]["n"] or 0) * share_pct / 100
    level = None
    while True:
        free = F.lit(True) if level is None else F.col("weight") * F.lit(level) < cap * F.col("source_size")
        sums = table.agg(
            F.sum(F.when(free, F.col("weight")).otherwise(0)).alias("w"),
            F.sum(F.when(free, 0).otherwise(cap * F.col("source_size"))).alias("c"),
        ).collect()[0]
        reached = (total - sums["c"]) / sums["w"] if sums["w"] else level or 0.0
        if level is not None and reached <= level:
            break
        level = reached
    target = F.least(F.col("weight") * F.lit(float(level)), (cap * F.col("source_size")).cast("double"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return table.withColumn("target", target).withColumn("rate", rate).drop("weight")


def draw(key: Column, instead: Column, seed: int) -> Column:
    """A repeatable number in [0, 1) for a row."""
    bits = F.when(key.isNull(), F.xxhash64(F.lit(seed), F.lit("text"), instead)).otherwise(F.xxhash64(F.lit(seed), key))
    return F.shiftrightunsigned(bits, 11).cast("double") * F.lit(2.0**-53)


def plan_mix(docs: DataFrame, sizes: DataFrame, key: str = "doc_id", source: str = "source", instead: str | None = None,
             seed: int = 17, **targets) -> tuple[DataFrame, dict[str, str]]:
    """All rows with how often each is taken.

    ``sizes`` holds ``source`` and ``size`` of every row (it may be ``docs`` itself). Returns the
    rows and the names of the added columns: copies, source_size, target. A source may hold any
    share of the rows: the join to its target is salted or broadcast.
    """
    table = source_targets(sizes, source, **targets)
    names = {n: fresh(docs, n) for n in ("copies", "source_size", "target")}
    k, total, target, rate = (fresh(docs, n) for n in ("_key", "_total", "_target", "_rate"))
    small = table.select(F.col("_key").alias(k), F.col("source_size").alias(total), F.col("target").alias(target), F.col("rate").alias(rate))
    joined = lookup(docs.withColumn(k, _join_key(F.col(source))), small, k, [key])
    extra = draw(F.col(key), F.col(instead) if instead else F.lit(0), seed) < F.col(rate) - F.floor(rate)
    copies = (F.floor(rate) + extra.cast("int")).cast("bigint")
    out = joined.select(*docs.columns, copies.alias(names["copies"]), F.col(total).alias(names["source_size"]), F.col(target).alias(names["target"]))
    return out, names


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = 17, **targets) -> DataFrame:
    """The mixed rows themselves, each as often as it is taken, with a copy number from 1."""
    sizes = docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    planned, names = plan_mix(docs, sizes, key, source, text, seed, **targets)
    n = F.col(names["copies"])
    copy_no = fresh(docs, "copy_no")
    taken = planned.where(n > 0).withColumn(copy_no, F.explode(F.sequence(F.lit(1), n.cast("int"))))
    return taken.select(*docs.columns, copy_no)


def mix_report(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = 17) -> DataFrame:
    """Per row: doc_id, size, source_size, target and the words the mix takes of it.

    The words are counted once; the narrow rows are stored, since both passes read them.
    """
    narrow = materialize(docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        F.when(F.col(key).isNull(), F.xxhash64(F.col(text))).alias("text_hash")), "sizes")
    planned, _ = plan_mix(narrow, narrow, "doc_id", "source", "text_hash", seed)
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
