"""Writing, replacing and upserting tables that are partitioned by date."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.operators.joins import concat, dedup_keep


def write_table(df: DataFrame, path: str, by: str | None = "date") -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(by) if by else writer).parquet(path)


def replace_dates(df: DataFrame, path: str, by: str = "date") -> None:
    """Writes the dates that df holds in place of those of the table; other dates stay untouched on disk."""
    df.repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def replaced(existing: DataFrame, new: DataFrame, by: str = "date") -> DataFrame:
    """The table as replace_dates() leaves it."""
    return concat([existing.join(new.select(by).distinct(), by, "left_anti"), new])


def one_each(new: DataFrame, keys: Sequence[str], recency: str | None = None) -> DataFrame:
    """One row of each key: the latest by recency, then the last as JSON, so that a repetition takes the same."""
    return dedup_keep(new, keys, [*([recency] if recency else []), F.to_json(F.struct(*new.columns))])


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str], now: Column, recency: str | None = None) -> DataFrame:
    """existing (with _inserted_at, _updated_at) with the rows of new put over those of the same key.

    Of several rows of a key in new the latest by recency wins, of equal ones (and without recency) the last as JSON. The insert time of a known key is kept; the update time
    of every row written is now. Columns that only new has are added.
    """
    fresh = one_each(new, keys, recency)
    known = existing.select(*keys, F.col("_inserted_at").alias("_since"))
    fresh = fresh.join(known, list(keys), "left").withColumns({"_inserted_at": F.coalesce("_since", now), "_updated_at": now}).drop("_since")
    return concat([existing.join(fresh.select(*keys), list(keys), "left_anti"), fresh])


def write_upsert(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], now: Column, by: str = "date", recency: str | None = None) -> None:
    """upsert() into a partitioned table: only the partitions that new touches are read and written. Doing it again
    with the same rows changes nothing but the update time."""
    try:
        existing = spark.read.option("mergeSchema", True).parquet(path)
    except Exception as e:  # no table yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        first = one_each(new, keys, recency)
        return replace_dates(first.withColumns({"_inserted_at": now, "_updated_at": now}), path, by)
    touched = existing.join(new.select(by).distinct(), by, "left_semi")
    merged = upsert(touched, new, keys, now, recency)
    staged = f"{path.rstrip('/')}__staged/{uuid.uuid4().hex}"
    merged.write.parquet(staged)  # a table can't be read and overwritten in one plan
    return replace_dates(spark.read.parquet(staged), path, by)


LEDGER = "name string, number long, state string, stage string, dates array<string>, at timestamp"


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """What batches a table has taken: (name, number, state, stage, dates, at), state being staged or done."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{path.rstrip('/')}__ledger")
    except Exception as e:  # no batch yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LEDGER)


def ledger_upsert(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], now: Column, name: str, number: int, by: str = "date", recency: str | None = None, before_swap: Callable[[], None] | None = None) -> str:
    """upsert() of batch `number` of the stream `name` into a table partitioned by `by`, with a ledger beside it.

    A batch that the ledger has as done is left out ("known"). Else its touched partitions are merged into a staging
    folder of its own, the ledger says so, the partitions are swapped, and the ledger says done. After a crash between
    any two of these the batch is simply done again. Rows bear the number of the batch they came with (_batch), and of
    one stream an older batch doesn't put its values over those of a newer one, whenever it comes. If another batch of
    the same partitions was done since the staging, it is staged anew on what is there then. `before_swap` is called
    between staging and swap. The ledger is a few rows a batch; lists of the dates of one batch are read by the driver.
    """
    base = path.rstrip("/")

    def done() -> dict[tuple[str, int], set[str]]:
        return {(r.name, r.number): set(r.dates or ()) for r in ledger(spark, path).filter("state = 'done'").collect()}

    def note(state: str, stage: str, dates: list[str]) -> None:
        row = spark.createDataFrame([(name, number, state, stage, dates)], "name string, number long, state string, stage string, dates array<string>")
        row.withColumn("at", F.current_timestamp()).write.mode("append").parquet(f"{base}__ledger")

    seen = done()
    if (name, number) in seen:
        return "known"
    new = one_each(batch, keys, recency).withColumns({"_stream": F.lit(name), "_batch": F.lit(number).cast("long")})
    dates = [r[0] for r in new.select(F.col(by).cast("string")).distinct().collect()]
    while dates:
        try:
            existing = spark.read.option("mergeSchema", True).parquet(path).withColumn(by, F.col(by).cast(new.schema[by].dataType))
            newer = existing.filter((F.col("_stream") == name) & (F.col("_batch") > number)).select(*keys)
            merged = upsert(existing.join(new.select(by).distinct(), by, "left_semi"), new.join(newer, list(keys), "left_anti"), keys, now)
        except Exception as e:  # no table yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            merged = new.withColumns({"_inserted_at": now, "_updated_at": now})
        stage = f"{base}__staged/{name}-{number}-{uuid.uuid4().hex}"
        merged.write.parquet(stage)
        note("staged", stage, dates)
        if before_swap:
            before_swap()
        now_done = done()
        if not any(set(dates) & there for who, there in now_done.items() if who not in seen):
            replace_dates(spark.read.parquet(stage), path, by)
            break
        seen = now_done
    note("done", "", dates)
    return "done"


def widen(existing: DataFrame, new: DataFrame) -> DataFrame:
    """existing with the columns that only new has, as nulls."""
    return concat([existing, new.limit(0)])


def seed_and_fill(store: DataFrame, modules: Sequence[DataFrame], day, keys: Sequence[str] = ("date", "ticker")) -> DataFrame:
    """Rows of one date for every key that a module or the store has, with the modules' values over the store's.
    Modules by date alone give their values to all keys."""
    per_key = [m.filter(F.col(keys[0]) == day) for m in modules if set(keys) <= set(m.columns)]
    per_day = [m.filter(F.col(keys[0]) == day) for m in modules if not set(keys) <= set(m.columns)]
    own = store.filter(F.col(keys[0]) == day)
    out = concat([x.select(*keys) for x in [own, *per_key]]).distinct().join(own, list(keys), "left")
    for m in [*per_key, *per_day]:
        on = [k for k in keys if k in m.columns]
        values = [c for c in m.columns if c not in on]
        out = out.join(m.select(*on, *[F.col(c).alias(f"_new_{c}") for c in values]), on, "left")
        out = out.withColumns({c: F.coalesce(f"_new_{c}", c) if c in out.columns else F.col(f"_new_{c}") for c in values}).drop(*[f"_new_{c}" for c in values])
    return out


def prune(df: DataFrame, day: str, last, keep_days: int) -> DataFrame:
    """Without rows older than keep_days before `last`."""
    return df.filter(F.date_diff(F.lit(last), F.col(day)) <= keep_days)
