"""Ranks, top-k, quantile bins and thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.functions.exprs import clip, cut, flag, safe_div
from flowmart.operators.quantiles import exact_quantiles


def pct_rank(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Mean rank of equal values over the number of values in the group; null stays null."""
    valued = Window.partitionBy(*keys, F.col(value).isNull())
    ties = F.count(value).over(Window.partitionBy(*keys, value))
    place = F.rank().over(valued.orderBy(value)) + (ties - 1) / 2
    return df.withColumn(name, F.when(F.col(value).isNotNull(), place / F.count(value).over(Window.partitionBy(*keys))))


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int, name: str = "rank") -> DataFrame:
    """The best k rows of each group; order should end in something unique."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= k)


def with_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float, name: str) -> DataFrame:
    return df.join(df.groupBy(*keys).agg(F.percentile(value, q).alias(name)), list(keys), "left")


def top_quantile_flag(df: DataFrame, keys: Sequence[str], value: str, q: float, name: str) -> DataFrame:
    """1 where the value reaches its group's quantile."""
    return with_quantile(df, keys, value, q, "_q").withColumn(name, flag(F.col(value) >= F.col("_q"))).drop("_q")


def adaptive_threshold(df: DataFrame, keys: Sequence[str], value: str, floor: float, q: float) -> DataFrame:
    """threshold: the larger of a floor and the group's quantile."""
    return df.groupBy(*keys).agg(F.greatest(F.lit(floor), F.percentile(value, q)).alias("threshold"))


def score_gap(df: DataFrame, keys: Sequence[str], value: str, tie: str, k: int) -> DataFrame:
    """The best value less the k-th (or last, in smaller groups) of each group."""
    ranked = top_k(df, keys, [F.desc(value), tie], k, "_rn")
    return ranked.groupBy(*keys).agg((F.max(value) - F.min(value)).alias("gap"), F.count("*").alias("n"))


def extremes(df: DataFrame, value: str, tie: Sequence[str], n: int) -> DataFrame:
    """The n smallest and n largest rows."""
    low = df.orderBy(F.col(value).asc_nulls_last(), *tie).limit(n).withColumn("side", F.lit("low"))
    return low.unionByName(df.orderBy(F.col(value).desc_nulls_last(), *tie).limit(n).withColumn("side", F.lit("high")))


def quantile_edges(df: DataFrame, value: str, q: int) -> list[float]:
    """The edges of q quantile bins, equal ones once."""
    return sorted(set(exact_quantiles(df, value, [i / q for i in range(q + 1)])))


def qcut(df: DataFrame, value: str, q: int, name: str) -> DataFrame:
    """Number of the quantile bin, from 0; bins are closed on the right and equal edges are dropped."""
    edges = quantile_edges(df, value, q)
    return df.withColumn(name, cut(value, edges, [str(i) for i in range(len(edges) - 1)]).cast("int"))


def winsorize(df: DataFrame, value: str, low: float = 0.01, high: float = 0.99, least: int = 10) -> DataFrame:
    """Clips at two quantiles if there are at least so many values."""
    if df.filter(F.col(value).isNotNull()).limit(least).count() < least:
        return df
    return df.withColumn(value, clip(value, *exact_quantiles(df, value, [low, high])))


def global_pct_rank(df: DataFrame, value: str, name: str, buckets: int = 256) -> DataFrame:
    """Percent rank over the whole table, without a window that holds it: values are counted, and the counts below a
    value are those of the buckets below its own, by approximate quantile, and of the values below it in its bucket."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_n"))
    edges = sorted(set(counts.agg(F.percentile_approx(value, [i / buckets for i in range(1, buckets)], 1000)).first()[0] or []))
    b = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e < F.col(value))) if edges else F.lit(0)
    counts = counts.withColumn("_b", b)
    sums = counts.groupBy("_b").agg(F.sum("_n").alias("_s"))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = sums.select("_b", F.coalesce(F.sum("_s").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_low"), F.sum("_s").over(every).alias("_all"))
    within = F.coalesce(F.sum("_n").over(Window.partitionBy("_b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = counts.join(F.broadcast(sums), "_b").select(value, ((F.col("_low") + within + (F.col("_n") + 1) / 2) / F.col("_all")).alias(name))
    return df.join(ranks, value, "left")


def risk_score(df: DataFrame, cols: Sequence[str], name: str = "risk_norm") -> DataFrame:
    """Mean over the columns of the percent ranks of their winsorised values, as far as a row has them. A row without
    any has the median of the others; 0.5 if there is none or no column."""
    out = df
    for c in cols:
        ranked = global_pct_rank(winsorize(out.withColumn("_w", F.col(c)), "_w"), "_w", "_r")
        out = ranked.withColumnRenamed("_r", f"_rank_{c}").drop("_w")
    known = [F.col(f"_rank_{c}") for c in cols]
    total, n = sum((F.coalesce(x, F.lit(0.0)) for x in known), F.lit(0.0)), sum((x.isNotNull().cast("int") for x in known), F.lit(0))
    out = out.withColumn(name, clip(safe_div(total, n), 0.0, 1.0)).drop(*[f"_rank_{c}" for c in cols])
    middle = exact_quantiles(out, name, [0.5]) if cols else []
    return out.withColumn(name, F.coalesce(name, F.lit(middle[0] if middle else 0.5)))
