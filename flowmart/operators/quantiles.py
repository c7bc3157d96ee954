"""Quantiles of whole tables: exact ones by counted buckets, and mergeable sketches by column and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of a round, and rows of a bucket from which its values are counted one by one.
BUCKETS, SMALL = 256, 10_000


def exact_quantiles(df: DataFrame, value: str, shares: Sequence[float], buckets: int = BUCKETS, small: int = SMALL) -> list[float]:
    """The values at these shares of the ordered column, interpolated between neighbours; [] if it has no value.

    No task sorts the column. A value's place is looked for in buckets between approximate quantiles: they are counted, and
    the one that holds the place is cut into buckets anew, until it has one value or at most `small` rows; only the
    values of that are counted and read. A round leaves about one row in `buckets`. Null and NaN aren't values.
    """
    v = F.col(value).cast("double").alias("v")
    rows = df.select(v).filter("v is not null and not isnan(v)")
    n = rows.count()
    if not n:
        return []
    places = sorted({int(f) for s in shares for f in (s * (n - 1) // 1, -(-s * (n - 1) // 1))})
    found: dict[int, float] = {}

    def look(part: DataFrame, below: int, size: int, wanted: list[int]) -> None:
        """The values at the places `wanted` of the whole, which are in `part` of `size` rows above `below` others."""
        if size <= small:
            at = below
            for r in sorted(part.groupBy("v").count().collect()):
                for p in wanted:
                    if at <= p < at + r["count"]:
                        found[p] = r.v
                at += r["count"]
            return
        edges = sorted(set(part.agg(F.percentile_approx("v", [i / buckets for i in range(1, buckets)], 10 * buckets)).first()[0]))
        # Odd buckets are the edges themselves, which may be very common values; even ones lie between two of them.
        first = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e < F.col("v")))
        bucket = 2 * first + F.array_contains(F.array(*map(F.lit, edges)), F.col("v")).cast("int")
        told = part.select("v", bucket.alias("b"))
        at = below
        for r in sorted(told.groupBy("b").agg(F.count("*").alias("many"), F.min("v").alias("low"), F.max("v").alias("high")).collect()):
            here = [p for p in wanted if at <= p < at + r.many]
            if here and r.low == r.high:
                found.update(dict.fromkeys(here, r.low))
            elif here:
                look(part.filter((F.col("v") >= r.low) & (F.col("v") <= r.high)), at, r.many, here)
            at += r.many

    look(rows, 0, n, places)
    out = []
    for s in shares:
        low, high = int(s * (n - 1) // 1), int(-(-s * (n - 1) // 1))
        out.append(found[low] + (found[high] - found[low]) * (s * (n - 1) - low))
    return out


def profile_sketches(df: DataFrame, day: str | Column, columns: Sequence[str], k: int = 200, log_k: int = 12) -> DataFrame:
    """(column, day): n (values), nulls, low, high, and sketches of the column's quantiles (kll) and distinct values (hll).

    Rows of the result are meant to be stored and merged for any range of days. Rank errors of a quantile are about
    1.65 / k^0.9 (1.3 % at 200), standard errors of distinct counts 1.04 / 2^(log_k / 2) (1.6 % at 12). NaN counts as
    null; a column without values on a day has null sketches.
    """
    value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    per_day = df.select((F.col(day) if isinstance(day, str) else day).alias("day"), *[value(c).alias(c) for c in columns]).groupBy("day")
    made = per_day.agg(*[
        F.struct(F.count(c).alias("n"), (F.count("*") - F.count(c)).alias("nulls"), F.min(c).alias("low"), F.max(c).alias("high"), F.when(F.count(c) > 0, F.kll_sketch_agg_double(c, k)).alias("kll"), F.when(F.count(c) > 0, F.hll_sketch_agg(F.col(c).cast("string"), log_k)).alias("hll")).alias(c)
        for c in columns
    ])
    parts = ("n", "nulls", "low", "high", "kll", "hll")
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(c)[x].alias(x) for x in parts]) for c in columns])).alias("x")
    return made.select("day", each).select("x.column", "day", *[f"x.{x}" for x in parts])


def merged_profile(sketches: DataFrame, shares: Sequence[float] = (0.05, 0.5, 0.95)) -> DataFrame:
    """column, n, nulls, low, high, distinct, quantiles (one for each share) over all days of the sketches given."""
    g = sketches.groupBy("column").agg(F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("kll").alias("_kll"), F.hll_union_agg("hll").alias("_hll"))
    known = lambda c: F.when(F.col("n") > 0, c)
    return g.select("column", "n", "nulls", "low", "high", F.coalesce(known(F.hll_sketch_estimate("_hll")), F.lit(0)).alias("distinct"), known(F.kll_sketch_get_quantile_double("_kll", F.array(*map(F.lit, shares)))).alias("quantiles"))


def shares_below(df: DataFrame, points: DataFrame) -> DataFrame:
    """column, under, upto: which shares of the column's values in df are below its point, and at most it.

    points (column, point) has one row for each column. They become one row that every task holds beside its rows: one
    pass, and no row of df is shuffled. Null and NaN aren't values; both shares are null if there are none, or no point.
    """
    columns = sorted(r["column"] for r in points.select("column").distinct().collect())
    if not columns:
        return points.select("column", F.lit(None).cast("double").alias("under"), F.lit(None).cast("double").alias("upto"))
    at = points.agg(*[F.max(F.when(F.col("column") == c, F.col("point"))).alias(f"_at{i}") for i, c in enumerate(columns)])
    value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    both = df.select(*[value(c).alias(f"_v{i}") for i, c in enumerate(columns)]).crossJoin(F.broadcast(at))
    share = lambda test: F.avg(test.cast("double"))
    one = both.agg(*[F.struct(F.lit(c).alias("column"), share(F.col(f"_v{i}") < F.col(f"_at{i}")).alias("under"), share(F.col(f"_v{i}") <= F.col(f"_at{i}")).alias("upto")).alias(f"_s{i}") for i, c in enumerate(columns)])
    return one.select(F.explode(F.array(*[F.col(f"_s{i}") for i in range(len(columns))])).alias("x")).select("x.*")
