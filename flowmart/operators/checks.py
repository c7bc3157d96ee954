"""Quality, audit and parity checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.functions.exprs import flag
from flowmart.operators.joins import assert_unique


def assert_no_nulls(df: DataFrame, cols: Sequence[str]) -> None:
    row = df.agg(*[F.sum(flag(F.col(c).isNull())).alias(c) for c in cols]).first()
    bad = {c: row[c] for c in cols if row[c]}
    if bad:
        raise ValueError(f"nulls: {bad}")


def assert_same_rows(before: DataFrame, after: DataFrame) -> None:
    a, b = before.count(), after.count()
    if a != b:
        raise ValueError(f"{a} rows became {b}")


def null_profile(df: DataFrame, cols: Sequence[str], top: int = 30) -> DataFrame:
    """Nulls and infinite values of each column, the worst first; one pass."""
    kinds = dict(df.dtypes)
    inf = lambda c: F.sum(flag(F.abs(c) == float("inf"))) if kinds[c] in ("double", "float") else F.lit(0)
    one = df.agg(F.count("*").alias("_n"), *[e for c in cols for e in (F.sum(flag(F.col(c).isNull())).alias(f"{c}|n"), inf(c).alias(f"{c}|i"))])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"{c}|n"), F.lit(0)).cast("long").alias("nulls"), F.coalesce(F.col(f"{c}|i"), F.lit(0)).cast("long").alias("infinite")) for c in cols])).alias("x")
    out = one.select("_n", rows).select("x.*", F.when(F.col("_n") > 0, F.col("x.nulls") / F.col("_n")).alias("null_share"))
    return out.orderBy(F.desc("nulls"), "column").limit(top)


def formula_checks(df: DataFrame, checks: Mapping[str, tuple[Column, Column]], tol: float = 1e-9) -> DataFrame:
    """For each named identity how many rows were checked and how many differ (a null on one side differs)."""

    def off(a: Column, b: Column) -> Column:
        return flag((a.isNull() != b.isNull()) | (F.abs(a - b) > tol))

    one = df.agg(*[e for k, (a, b) in checks.items() for e in (F.count("*").alias(f"{k}|n"), F.sum(off(a, b)).alias(f"{k}|bad"))])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check"), F.col(f"{k}|n").alias("rows"), F.coalesce(F.col(f"{k}|bad"), F.lit(0)).alias("mismatches")) for k in checks])).alias("x")).select("x.*")


def compare_tables(a: DataFrame, b: DataFrame, keys: Sequence[str], rtol: float = 1e-9, atol: float = 1e-9, sample: int | None = None) -> DataFrame:
    """A row for each common column: keys on one side only, rows compared, and values that differ: numbers by tolerance,
    others exactly. sample: compare only so many keys, those with the smallest hashes."""
    assert_unique(a, keys)
    assert_unique(b, keys)
    kinds = dict(a.dtypes)
    cols = [c for c in a.columns if c in b.columns and c not in keys]
    left = a.select(*keys, F.struct(*cols).alias("_a"))
    if sample:
        left = left.orderBy(F.xxhash64(*keys), *keys).limit(sample)
    both = left.join(b.select(*keys, F.struct(*cols).alias("_b")), list(keys), "left" if sample else "full_outer")

    def differs(c: str) -> Column:
        x, y = F.col(f"_a.`{c}`"), F.col(f"_b.`{c}`")
        if kinds[c] in ("double", "float"):
            return ~F.coalesce((x.isNull() & y.isNull()) | (F.abs(x - y) <= atol + rtol * F.abs(y)), F.lit(False))
        return ~x.eqNullSafe(y)

    here = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    one = both.agg(
        F.sum(flag(F.col("_b").isNull())).alias("_l"), F.sum(flag(F.col("_a").isNull())).alias("_r"), F.sum(flag(here)).alias("_n"), *[F.sum(flag(here & differs(c))).alias(f"{c}|d") for c in cols]
    )
    return one.select("_l", "_r", "_n", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}|d").alias("different")) for c in cols])).alias("x")).select(
        "x.column", F.coalesce("_n", F.lit(0)).alias("compared"), F.coalesce("_l", F.lit(0)).alias("only_left"), F.coalesce("_r", F.lit(0)).alias("only_right"), F.coalesce("x.different", F.lit(0)).alias("different")
    )


def lookahead_audit(build: Callable[[DataFrame], DataFrame], source: DataFrame, keys: Sequence[str], cutoff, date_col: str = "date") -> DataFrame:
    """compare_tables() of the features up to the cutoff as built from the whole source, and from the source cut there.
    Features that only know the past don't differ."""
    whole = build(source).filter(F.col(date_col) <= cutoff)
    return compare_tables(whole, build(source.filter(F.col(date_col) <= cutoff)), keys)


def lag_audit(delivered: DataFrame, rebuilt: DataFrame, entity: str, date_col: str, features: Sequence[str], lags: int = 3, rtol: float = 1e-6, atol: float = 1e-9, share: float = 0.99) -> DataFrame:
    """With which lag the delivered features were built: (feature, compared, m0 to m{lags}, built_lag, same_day).

    rebuilt has the same-day values, a row for each (entity, date); a delivered value is held against the rebuilt one of
    its own day and of the 1 to `lags` rows before. Compared are the rows that have all of these values; built_lag is
    the lag with the most matches if that is at least `share` of them and no other lag has as many, else null. same_day
    says that it is 0: the feature knows its own day. Delivered rows that rebuilt lacks don't count. A feature without
    rows to compare has null.
    """
    w = Window.partitionBy(entity).orderBy(date_col)
    past = rebuilt.select(entity, date_col, *[F.struct(*[F.lag(f, k).over(w).cast("double").alias(f"l{k}") for k in range(lags + 1)]).alias(f"_{f}") for f in features])
    both = delivered.select(entity, date_col, *[F.col(f).cast("double").alias(f) for f in features]).join(past, [entity, date_col])
    each = both.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("v"), F.col(f"_{f}").alias("p")) for f in features])).alias("x")).select("x.*")
    all_there = F.col("v").isNotNull()
    for k in range(lags + 1):
        all_there = all_there & F.col(f"p.l{k}").isNotNull()
    same = lambda k: F.abs(F.col("v") - F.col(f"p.l{k}")) <= atol + rtol * F.abs(F.col(f"p.l{k}"))
    counts = each.groupBy("feature").agg(F.sum(flag(all_there)).cast("long").alias("compared"), *[F.sum(flag(all_there & same(k))).cast("long").alias(f"m{k}") for k in range(lags + 1)])
    found = F.array(*[F.col(f"m{k}") for k in range(lags + 1)])
    best = F.array_max(found)
    clear = (F.col("compared") > 0) & (best >= share * F.col("compared")) & (F.size(F.filter(found, lambda m: m == best)) == 1)
    return counts.withColumn("built_lag", F.when(clear, F.array_position(found, best) - 1)).withColumn("same_day", F.col("built_lag") == 0)


def freshness(df: DataFrame, day: str, member: str, need, least_rows: int, least_members: int) -> DataFrame:
    """Latest day, its rows and members, and a state: NO_DATA, STALE, AHEAD, PARTIAL or OK; one pass over day counts."""
    days = df.groupBy(day).agg(F.count("*").alias("rows"), F.count_distinct(member).alias("members"))
    one = days.agg(F.max(F.struct(F.col(day).alias("d"), "rows", "members")).alias("x"), F.count("*").alias("days"))
    d = F.col("x.d")
    state = F.when(d.isNull(), "NO_DATA").when(d < need, "STALE").when(d > need, "AHEAD").when((F.col("x.rows") < least_rows) | (F.col("x.members") < least_members), "PARTIAL").otherwise("OK")
    return one.select(d.alias("latest"), F.col("x.rows").alias("rows"), F.col("x.members").alias("members"), "days", state.alias("state"))


def latest_hour(df: DataFrame, ts: str, entity: str, need: int, least_entities: int = 1) -> DataFrame:
    """The latest day, its latest hour that at least so many entities have, how many, and whether it is `need` or later;
    no row for an empty table."""
    hours = df.filter(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("latest"), F.hour(ts).alias("hour")).agg(F.count_distinct(entity).alias("entities"))
    last = hours.agg(F.max("latest").alias("latest"))
    fine = F.when(F.col("entities") >= least_entities, F.struct("hour", "entities"))
    g = hours.join(F.broadcast(last), "latest").groupBy("latest").agg(F.max(fine).alias("x"))
    return g.select("latest", F.col("x.hour").alias("hour"), F.col("x.entities").alias("entities"), F.coalesce(F.col("x.hour") >= need, F.lit(False)).alias("ready"))


def readiness(df: DataFrame, entity: str, rows: int, day: str = "date") -> DataFrame:
    """Share of entities with at least so many days."""
    g = df.groupBy(entity).agg(F.count_distinct(day).alias("n"))
    return g.agg(F.count("*").alias("entities"), F.avg(flag(F.col("n") >= rows)).alias("ready_share"))


def assert_all(checks: Sequence[Callable[[], None]]) -> None:
    """Runs all checks and fails with all their messages."""
    failed = []
    for check in checks:
        try:
            check()
        except ValueError as e:
            failed.append(str(e))
    if failed:
        raise ValueError("; ".join(failed))
