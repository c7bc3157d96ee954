"""Queries that run streams to the end of their input. Each has the SQL of its batch twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.plans.catalog import query, r, rd, shared_folder
from flowmart.streaming import streams as T

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def to_end(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """What a stream has written when all its input is read."""
    spark = stream.sparkSession
    out = shared_folder(spark, label)
    writer = stream.writeStream.trigger(availableNow=True).outputMode(mode).option("checkpointLocation", f"{out}/_state")
    writer.format("parquet").option("path", f"{out}/rows").start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def events(spark: SparkSession, sf: str) -> DataFrame:
    raw = T.stream_events(spark, f"{sf}/events.parque?", EVENTS)  # a pattern, as the table may be one file or a folder
    return raw.select("event_id", F.col("event_type").alias("ticker"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"), F.lit(1.0).alias("volume"), "props")


@query("", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def s1_stream_events(spark, sf):
    from flowmart.sources.readers import parse_event_json

    return to_end(parse_event_json(events(spark, sf).select("event_id", "props"), "props", "k long", {"k": "k"}), "s1")


@query("v_ticks", "SELECT DISTINCT ticker, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day FROM v_ticks")
def s2_stream_dedup(spark, sf):
    e = events(spark, sf).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return to_end(T.stream_dedup(e, ["ticker", "day"], "ts", "40 days").select("ticker", "day"), "s2")


BARS = """SELECT ticker, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bucket, arg_min(price, (ts, event_id)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ts, event_id)) AS close, sum(volume) AS volume, count(*) AS ticks FROM v_ticks
  GROUP BY ticker, date_trunc('hour', v_ticks.ts) HAVING date_trunc('hour', v_ticks.ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM v_ticks)"""


@query("v_ticks", BARS)
def s3_stream_bars(spark, sf):
    """The bars that the watermark has closed when the input ends."""
    b = T.stream_bars(events(spark, sf), ["ticker"], "ts", ["ts", "event_id"], "price", "volume", "1 hour", "10 minutes")
    return to_end(b, "s3").select("ticker", F.date_format("bucket", "yyyy-MM-dd HH:mm:ss").alias("bucket"), "open", "high", "low", "close", "volume", "ticks")


@query("v_ticks", "WITH t AS (SELECT ticker, strftime(ts, '%Y-%m-%d') AS day, price, ts, event_id, price >= 450 AS up FROM v_ticks), u AS (SELECT *, max(up::INT) OVER (PARTITION BY ticker, day ORDER BY ts, event_id) AS was FROM t) "
       "SELECT ticker, day, count(*) AS ticks, floor(avg(price) * 1e4 + 0.4871) / 1e4 AS vwap, max(price) AS high, max(was) = 1 AS touched, max((was = 1 AND NOT up)::INT) = 1 AS released FROM u GROUP BY ticker, day "
       "HAVING day::DATE + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM v_ticks)")  # fmt: skip
def s4_stream_state(spark, sf):
    """A row for each (ticker, day) that the watermark has closed when the input ends."""
    return to_end(T.stream_state(events(spark, sf), 450.0), "s4").withColumn("vwap", rd("vwap", 4))


@query("v_ticks", "SELECT ticker, event_id, strftime(ts, '%Y-%m-%d') AS date, price FROM v_ticks")
def s5_stream_upsert(spark, sf):
    e = events(spark, sf).select("ticker", "event_id", F.date_format("ts", "yyyy-MM-dd").alias("date"), "price")
    out, target = shared_folder(spark, "s5"), shared_folder(spark, "s5rows")
    sink = T.upsert_batches(target, ["date", "ticker", "event_id"], lambda number: F.lit(number).cast("timestamp"))
    e.writeStream.trigger(availableNow=True).option("checkpointLocation", out).foreachBatch(sink).start().awaitTermination()
    return spark.read.parquet(target).select("ticker", "event_id", F.col("date").cast("string").alias("date"), "price")


SLIDING = f"""SELECT ticker, strftime(s, '%Y-%m-%d %H:%M:%S') AS bucket, arg_min(price, (ts, event_id)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ts, event_id)) AS close, sum(volume) AS volume, count(*) AS ticks, {r('sum(price * volume) / sum(volume) AS vwap', n=4)}
  FROM (SELECT *, unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS s FROM v_ticks) GROUP BY ticker, s HAVING s + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM v_ticks)"""


@query("v_ticks", SLIDING)
def s6_stream_chain(spark, sf):
    """Every event twice, once each after dedup, in sliding bars, upserted with a ledger of batches: one stream."""
    e = events(spark, sf)
    once = T.stream_dedup(e.unionByName(e), ["event_id"], "ts", "10 minutes")
    bars = T.stream_bars(once, ["ticker"], "ts", ["ts", "event_id"], "price", "volume", "1 hour", None, "30 minutes")
    out, target = shared_folder(spark, "s6"), shared_folder(spark, "s6rows")
    sink = T.ledger_batches(target, ["ticker", "bucket"], "s6", lambda number: F.lit(number).cast("timestamp"))
    bars.withColumn("date", F.to_date("bucket")).writeStream.trigger(availableNow=True).option("checkpointLocation", out).foreachBatch(sink).start().awaitTermination()
    done = spark.read.parquet(target)
    return done.select("ticker", F.date_format("bucket", "yyyy-MM-dd HH:mm:ss").alias("bucket"), "open", "high", "low", "close", "volume", "ticks", rd("vwap", 4).alias("vwap"))
