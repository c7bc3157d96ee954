"""Mixing of sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.llm.common import table

#: Most sources whose rates are broadcast (about 100 bytes each); beyond it they are joined by shuffle.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Number of words [^\\x20\\x09-\\x0D]+; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def target_rates(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """source, source_size, target, rate from (source, source_size), one row for each source.

    Sources by code point, null last, weigh weights[0], weights[1], ..., repeating. They share the whole size by
    weight; a target stops at `most` times its source's size and the excess is shared anew by weight. The level of
    that sharing is found in closed form: in order of cap / weight, the first k sources are capped, for the least k
    whose level does not exceed the next source's cap / weight. A source of size 0 has target and rate 0.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    rest = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("w", w).withColumn("cap", most * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("w"))
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest)
    s = s.withColumn("level", level).withColumn("k", F.row_number().over(by_ratio))
    s = s.withColumn("open", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("k", "level"))).over(every)["level"])
    s = s.withColumn("target", F.least("cap", F.col("w") * F.coalesce("open", F.lit(0.0))))
    return s.select("source", "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0, seed: int = 7) -> DataFrame:
    """All columns of docs, and size, source_size, target, rate, copies, taken.

    A document is taken floor(rate) times, and once more if its hash, seeded and spread evenly over 0 to 1, is below
    the fraction of the rate; so reruns agree, and rows with the same doc_id fare alike (rows without one, too).
    Null and empty texts have size 0 and their copies take no words. Columns of docs with those names are replaced.
    An empty table gives an empty result.
    """
    added = ("size", "source_size", "target", "rate", "copies", "taken")
    own = docs.drop(*added, "_rate_of").withColumn("size", word_count(F.col("text")))
    sizes = own.groupBy("source").agg(F.sum("size").alias("source_size"))
    rates = target_rates(sizes, weights, most).withColumnRenamed("source", "_rate_of")
    if own.select("source").distinct().limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 11) / F.lit(float(1 << 53))
    whole = F.floor("rate").cast("long")
    out = own.join(rates, own.source.eqNullSafe(rates["_rate_of"]), "left").drop("_rate_of")
    out = out.withColumn("copies", whole + (draw < F.col("rate") - whole).cast("long"))
    return out.withColumn("taken", F.col("size") * F.col("copies"))


def emitted(mixed: DataFrame) -> DataFrame:
    """Each row of mix() as often as it is taken, with copy_no from 1."""
    return mixed.filter("copies > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))


def op7_source_mixing(spark, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken")
