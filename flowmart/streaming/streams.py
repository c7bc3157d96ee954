"""The same operators on streams; each equals its batch twin on the same rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from flowmart.operators.bars import first_of, last_of
from flowmart.sources.sinks import ledger_upsert, write_upsert


def stream_events(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """New files of a folder as they come."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).format(fmt).load(path)


def stream_dedup(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """The first row of each key within the delay."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_bars(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], price: str, volume: str, width: str, delay: str | None, slide: str | None = None) -> DataFrame:
    """Tumbling (or sliding) bars; a bar comes out when the watermark has passed its end. Without delay the watermark is
    the one that df has, such as that of stream_dedup()."""
    span = F.window(ts, width, slide) if slide else F.window(ts, width)
    g = (df.withWatermark(ts, delay) if delay else df).groupBy(*keys, span.alias("w")).agg(
        first_of(price, *order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), last_of(price, *order).alias("close"), F.sum(volume).alias("volume"), F.count("*").alias("ticks"), F.sum(F.col(price) * F.col(volume)).alias("_pv")
    )
    return g.select(*keys, F.col("w.start").alias("bucket"), "open", "high", "low", "close", "volume", "ticks", (F.col("_pv") / F.nullif("volume", F.lit(0.0))).alias("vwap"))


#: What the stream state of a day hands out when the day is over.
DAY_END = "ticker string, day string, ticks long, vwap double, high double, touched boolean, released boolean"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class DayState(StatefulProcessor):
    """Of each (ticker, day): sums for the price by volume, and when the limit was first touched and last not held.

    Nothing in it depends on the order of arrival: the limit was released if a row below it is later than the first
    row at it. One row comes out when the watermark passes the end of the day; the timer for that also clears the
    state, so a state lasts as long as its day and the delay. (Time to live is for processing time only.)
    """

    def __init__(self, limit: float):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "ticks long, pv double, v double, high double")
        self.touched = handle.getValueState("touched", "at long, event_id long")
        self.below = handle.getValueState("below", "at long, event_id long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        ticks, pv, v, high = self.sums.get() if self.sums.exists() else (0, 0.0, 0.0, float("-inf"))
        first_touch, last_below = (x.get() if x.exists() else None for x in (self.touched, self.below))
        for pdf in rows:
            if not ticks:
                self.handle.registerTimer(int(pdf["ends"].iloc[0]))
            ticks, pv, v = ticks + len(pdf), pv + float((pdf["price"] * pdf["volume"]).sum()), v + float(pdf["volume"].sum())
            high = max(high, float(pdf["price"].max()))
            at = pdf["price"] >= self.limit
            places = lambda part: zip(part["at"].tolist(), part["event_id"].tolist(), strict=True)
            first_touch = min([*([tuple(first_touch)] if first_touch else []), *places(pdf[at])], default=None)
            last_below = max([*([tuple(last_below)] if last_below else []), *places(pdf[~at])], default=None)
        self.sums.update((ticks, pv, v, high))
        for state, place in ((self.touched, first_touch), (self.below, last_below)):
            if place:
                state.update(tuple(place))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        ticks, pv, v, high = self.sums.get()
        first_touch, last_below = (tuple(x.get()) if x.exists() else None for x in (self.touched, self.below))
        for state in (self.sums, self.touched, self.below):
            state.clear()
        released = bool(first_touch and last_below and last_below > first_touch)
        yield pd.DataFrame({"ticker": [key[0]], "day": [key[1]], "ticks": [ticks], "vwap": [pv / v if v else None], "high": [high], "touched": [first_touch is not None], "released": [released]})

    def close(self) -> None:
        pass


def stream_state(df: DataFrame, limit: float, delay: str = "1 hour") -> DataFrame:
    """A row for each (ticker, day) of df (ticker, ts, event_id, price, volume) once the watermark is past the day's
    end; none before. Days are those of the session's time zone. Rows later than `delay` behind the newest are dropped,
    rows without ticker, ts or price too. Needs the RocksDB state store, which this sets for the session."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = df.filter("ticker is not null and price is not null").withWatermark("ts", delay)
    day = F.to_date("ts")
    rows = rows.select("ticker", F.date_format("ts", "yyyy-MM-dd").alias("day"), "ts", F.unix_micros("ts").alias("at"), F.unix_millis(F.date_add(day, 1).cast("timestamp")).alias("ends"), F.coalesce("event_id", F.lit(-1)).cast("long").alias("event_id"), "price", F.coalesce("volume", F.lit(0.0)).alias("volume"))
    return rows.groupBy("ticker", "day").transformWithStateInPandas(DayState(limit), DAY_END, "Append", "EventTime")


def upsert_batches(path: str, keys: Sequence[str], now: Callable[[int], Column], by: str = "date") -> Callable[[DataFrame, int], None]:
    """For foreachBatch: upserts each micro-batch; a batch that is replayed leaves the same table."""

    def write(batch: DataFrame, number: int) -> None:
        write_upsert(batch.sparkSession, path, batch, keys, now(number), by)

    return write


def ledger_batches(path: str, keys: Sequence[str], name: str, now: Callable[[int], Column], by: str = "date", recency: str | None = None) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: ledger_upsert() of each micro-batch, under the name of the stream."""

    def write(batch: DataFrame, number: int) -> None:
        ledger_upsert(batch.sparkSession, path, batch, keys, now(number), name, number, by, recency)

    return write
