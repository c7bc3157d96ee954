"""Line dedup over levelled sorted runs of line hashes.

A run is a table of (h1, h2, keeper) in buckets of h1, sorted by hash. A new batch of lines is anti-joined with
the runs bucket by bucket (the buckets line up, so the runs aren't shuffled again); the keys that no run holds go
into a run of their own. When a level has `fanout` runs they are compacted into one run of the next level.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.llm.common import BLANKS, ascii_lower, shared_path, shuffle_partitions, stored, table

#: What a row without doc_id counts as: a document below all others.
NO_ID = -(1 << 63)


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def hashes(key: Column) -> Column:
    """128 bits in two independent longs."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """A store of line hashes that have been seen, each with the document that keeps the line."""

    def __init__(self, spark: SparkSession, fanout: int = 4):
        self.spark, self.fanout, self.buckets, self.levels = spark, fanout, shuffle_partitions(spark), [[]]

    def _write(self, rows: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        rows = rows.repartition(self.buckets, "h1").sortWithinPartitions("h1", "h2")
        rows.write.bucketBy(self.buckets, "h1").sortBy("h1", "h2").option("path", shared_path(self.spark, name)).saveAsTable(name)
        return self.spark.table(name)

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def keepers(self) -> DataFrame:
        """h1, h2, keeper over all runs; each key is in one run only."""
        empty = self.spark.createDataFrame([], "h1 long, h2 long, keeper long")
        return reduce(DataFrame.unionByName, self.runs(), empty)

    def add(self, lines: DataFrame) -> DataFrame:
        """lines (h1, h2, doc_id): the keys that no run holds, each with its largest doc_id of this batch; they are now held."""
        fresh = lines.groupBy("h1", "h2").agg(F.max("doc_id").alias("keeper"))
        for run in self.runs():
            fresh = fresh.join(run, ["h1", "h2"], "left_anti")
        run = self._write(fresh)
        self.levels[0].append(run)
        self._compact()
        return run

    def _compact(self) -> None:
        for n, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                if n + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[n + 1].append(self._write(reduce(DataFrame.unionByName, level)))
                self.levels[n] = []


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 5, fanout: int = 3) -> DataFrame:
    """All columns of docs, with text less its repeated lines, and n_lines (before) and n_dropped.

    A line's key is the line without white space at both ends, A-Z lower-cased. A key of at least min_chars code
    points that is found in at least min_docs documents loses all its lines but those in the largest doc_id that
    holds it; within that document all of them stay. Batches go from the largest doc_id down, so the first batch to
    hold a key has its keeper.

    A null or empty text is one empty line, and comes back as the empty text. Rows with the same doc_id are one
    document for the counts and lose the same keys. Rows without doc_id are together one document below all others.
    Columns named n_lines or n_dropped in docs are replaced; all others may have any names. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rest = F.struct(*[c for c in columns if c != "text"]).alias("own")
    own = docs.select(rest, "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"))
    keys = F.array_distinct(F.transform(F.filter(F.transform(lines_of(F.col("text")), line_key), lambda k: F.char_length(k) >= min_chars), hashes))
    lines = stored(own.select(F.col("_id").alias("doc_id"), F.explode(keys).alias("k")).select("k.h1", "k.h2", "doc_id"), "lines")

    # Both sides of the two joins with the lines are stored tables, so that Spark can split a line that is very common.
    common = stored(lines.groupBy("h1", "h2").agg(F.count_distinct("doc_id").alias("n")).filter(F.col("n") >= min_docs).drop("n"), "common")
    repeated = stored(lines.join(common, ["h1", "h2"]), "repeated")
    cuts = repeated.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)
    runs = LineRuns(spark, fanout)
    for low, high in zip([*cuts, None], [None, *cuts], strict=True):
        batch = repeated
        batch = batch if low is None else batch.filter(F.col("doc_id") > low)
        batch = batch if high is None else batch.filter(F.col("doc_id") <= high)
        runs.add(batch)

    drops = repeated.join(stored(runs.keepers(), "keepers"), ["h1", "h2"]).filter("doc_id != keeper")
    drops = drops.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set(F.struct("h1", "h2")).alias("_drop"))
    joined = own.join(drops, "_id", "left").withColumn("_lines", lines_of(F.col("text")))

    def stays(line: Column) -> Column:
        k = line_key(line)
        return (F.char_length(k) < min_chars) | ~F.array_contains(F.col("_drop"), hashes(k))

    kept = F.when(F.col("_drop").isNull(), F.col("_lines")).otherwise(F.filter("_lines", stays))
    out = joined.withColumn("_kept", kept).withColumns({"n_lines": F.size("_lines").cast("long"), "n_dropped": (F.size("_lines") - F.size("_kept")).cast("long")})
    made = {"text": F.array_join("_kept", "\n")}
    return out.select(*[made.get(c, F.col("own")[c]).alias(c) for c in columns], "n_lines", "n_dropped")


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), c AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), s AS (
  SELECT k.doc_id, k.pos, k.line, c.key IS NULL OR k.doc_id = c.keeper AS stays FROM k LEFT JOIN c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM s GROUP BY doc_id
"""
