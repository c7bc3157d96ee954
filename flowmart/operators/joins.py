"""Joins, deduplication and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_keep(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], keep: str = "last") -> DataFrame:
    """The first or last row of each key by order, which should be unique within a key."""
    wanted = [F.col(o) if isinstance(o, str) else o for o in order]
    if keep == "last":
        wanted = [o.desc_nulls_last() for o in wanted]
    w = Window.partitionBy(*keys).orderBy(*wanted)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns that a frame lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    twice = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"key {tuple(keys)} isn't unique: {twice[0]}")


def left_join_checked(left: DataFrame, right: DataFrame, on: Sequence[str], validate: str = "many_to_one") -> DataFrame:
    """A left join that fails if the right side (for one_to_one also the left) repeats a key, or if columns clash."""
    clash = sorted({*left.columns} & {*right.columns} - {*on})
    if clash:
        raise ValueError(f"columns on both sides: {', '.join(clash)}")
    assert_unique(right, on)
    if validate == "one_to_one":
        assert_unique(left, on)
    return left.join(right, list(on), "left")


def join_modules(core: DataFrame, modules: Mapping[str, DataFrame], keys: Sequence[str] = ("date", "ticker"), date_col: str = "date") -> DataFrame:
    """core with every module joined in order of name, on the keys that it has; columns that clash are an error."""
    out = core
    for name in sorted(modules):
        on = [k for k in keys if k in modules[name].columns]
        if date_col not in on:
            raise ValueError(f"module {name} has no {date_col}")
        clash = sorted({*out.columns} & {*modules[name].columns} - {*on})
        if clash:
            raise ValueError(f"module {name} repeats columns: {', '.join(clash)}")
        out = out.join(modules[name], on, "left")
    return out


def outer_by_symbol(series: DataFrame, date_col: str, symbol_col: str, value_col: str, symbols: Sequence[str], prefix: str = "") -> DataFrame:
    """A row for each date and a column for each symbol: the full outer join of all series in one grouping."""
    return series.groupBy(date_col).agg(*[F.max(F.when(F.col(symbol_col) == s, F.col(value_col))).alias(f"{prefix}{s}") for s in symbols])


def band_join(df: DataFrame, bands: DataFrame, value: str, low: str = "lo", high: str = "hi") -> DataFrame:
    """The band with lo <= value < hi, left join. Bands are a hand-written step table, so they are broadcast."""
    return df.join(F.broadcast(bands), (F.col(value) >= F.col(low)) & (F.col(value) < F.col(high)), "left")


def time_block(on: Column, kind: str, width: int) -> Column:
    """The number of the time block of `width` days (of a number: of `width` units); later blocks have larger numbers."""
    if kind == "date":
        return F.floor(F.unix_date(on) / width)
    if kind.startswith("timestamp"):
        return F.floor(F.unix_micros(on.cast("timestamp")) / (width * 86_400_000_000))
    return F.floor(on / width)


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], on: str, values: Sequence[str], strict: bool = False, max_age_days: int | None = None, width: int = 64) -> DataFrame:
    """left with `values` of the latest row of right at or before (strict: before) its time, of the same key.

    Rows go by key and time block, so that one key with all rows is spread over its blocks. The last right row of each
    block is carried over the small table of (key, block) into every later block up to the next one with right rows.
    Within a block one ordered window holds what was carried in, the right rows and the left rows; no range join
    multiplies rows. `width` is the length of a block in days (of a numeric time: in its units).

    right should be unique by key and time; of rows that aren't, one is taken. Right rows without time match nothing,
    left rows without time find nothing; null keys match one another. Also adds {on}_found, the time of that row.
    """
    kind = dict(left.dtypes)[on]
    held = F.struct(F.col(on).alias("_at"), *[F.col(v) for v in values])
    block = time_block(F.col(on), kind, width).alias("_block")
    a = left.select("*", block, F.lit(None).cast(right.select(held.alias("h")).schema["h"].dataType).alias("_held"), F.lit(0 if strict else 1).alias("_side"))
    b = right.filter(F.col(on).isNotNull()).select(*by, on, block, held.alias("_held"), F.lit(1 if strict else 0).alias("_side"))
    last = b.groupBy(*by, "_block").agg(F.max_by("_held", on).alias("_last"))
    spans = left.filter(F.col(on).isNotNull()).select(*by, block).distinct().withColumn("_last", F.lit(None).cast(last.schema["_last"].dataType)).withColumn("_asks", F.lit(1))
    before = Window.partitionBy(*by).orderBy("_block").rangeBetween(Window.unboundedPreceding, -1)
    carried = spans.unionByName(last.withColumn("_asks", F.lit(0))).withColumn("_held", F.last("_last", ignorenulls=True).over(before))
    carried = carried.filter("_asks = 1 and _held is not null").select(*by, "_block", "_held", F.lit(-1).alias("_side"))
    both = a.unionByName(b, allowMissingColumns=True).unionByName(carried, allowMissingColumns=True)
    # What was carried in has no time of its own and so comes first.
    w = Window.partitionBy(*by, "_block").orderBy(F.col(on).asc_nulls_first(), "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = both.withColumn("_last", F.last("_held", ignorenulls=True).over(w)).filter(F.col("_side") == (0 if strict else 1))
    if max_age_days is not None:
        out = out.withColumn("_last", F.when(F.date_diff(F.col(on), F.col("_last._at")) <= max_age_days, F.col("_last")))
    return out.select(*left.columns, *[F.col(f"_last.{v}").alias(v) for v in values], F.col("_last._at").alias(f"{on}_found"))


def next_session(days: DataFrame, date_col: str = "date", name: str = "next_date") -> DataFrame:
    """Each distinct date and the one after it (null for the last). One row for each day, so one ordered window holds."""
    distinct = days.select(date_col).dropna().distinct()
    return distinct.withColumn(name, F.lead(date_col).over(Window.orderBy(date_col)))


def fill_missing(primary: DataFrame, fallback: DataFrame, keys: Sequence[str], wanted: DataFrame | None = None) -> DataFrame:
    """primary, and the rows of fallback whose key it lacks (only keys that wanted has, if given)."""
    more = fallback.join(primary.select(*keys).distinct(), list(keys), "left_anti")
    if wanted is not None:
        more = more.join(wanted, [c for c in wanted.columns if c in keys], "left_semi")
    return primary.unionByName(more, allowMissingColumns=True)


def insert_new(stage: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.unionByName(stage.join(target.select(*keys).distinct(), list(keys), "left_anti"), allowMissingColumns=True)


def missing_keys(first: DataFrame, second: DataFrame, seen: DataFrame) -> DataFrame:
    """All pairs of two key lists (such as days and members) that seen has no row for. The pairs are the result's own
    size: both lists are dimensions, not facts."""
    expected = first.distinct().join(F.broadcast(second.distinct()), how="cross")
    return expected.join(seen.select(*expected.columns).distinct(), expected.columns, "left_anti")


def semi_filter(df: DataFrame, keys: DataFrame) -> DataFrame:
    return df.join(keys.distinct(), keys.columns, "left_semi")


def scd_merge(existing: DataFrame, current: DataFrame, key: str, now: Column) -> DataFrame:
    """The dimension after a new reading: existing (key, is_active, first_seen, last_seen, last_change) and current (key).

    Seen members are active and last seen now; missing ones become inactive and keep when they were seen. The last
    change is now where the state changed or the member is new. Also tells the transition of each member.
    """
    e = existing.select(key, F.col("is_active").alias("_was"), "first_seen", "last_seen", "last_change")
    both = e.join(current.select(key).distinct().withColumn("_here", F.lit(True)), key, "full_outer")
    here, was = F.coalesce("_here", F.lit(False)), F.col("_was")
    move = F.when(was.isNull(), "new").when(was & ~here, "deactivated").when(~was & here, "reactivated").otherwise("same")
    return both.select(
        key,
        here.alias("is_active"),
        F.when(here, F.coalesce("first_seen", now)).otherwise(F.col("first_seen")).alias("first_seen"),
        F.when(here, now).otherwise(F.col("last_seen")).alias("last_seen"),
        F.when(move == "same", F.col("last_change")).otherwise(now).alias("last_change"),
        move.alias("transition"),
    )


def scd_counts(merged: DataFrame) -> DataFrame:
    """How many members of scd_merge() are new, deactivated, reactivated and the same, and how many are active, in one row."""
    moves = ("new", "deactivated", "reactivated", "same")
    return merged.agg(*[F.count_if(F.col("transition") == m).alias(m) for m in moves], F.count_if("is_active").alias("active"), F.count("*").alias("members"))


def key_sets(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each distinct key and where it stands: both, left or right."""
    left, right = a.select(*keys).distinct().withColumn("_l", F.lit(1)), b.select(*keys).distinct().withColumn("_r", F.lit(1))
    side = F.when(F.col("_l").isNull(), "right").when(F.col("_r").isNull(), "left").otherwise("both")
    return left.join(right, list(keys), "full_outer").select(*keys, side.alias("side"))
