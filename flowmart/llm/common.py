"""What the text operators share: table access, the shared folder, hashing of lines and folds."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: The white space of the contracts: blank and \x09 to \x0D.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else the checkpoint folder that was set, else
    one in the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared").rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, **options) -> DataFrame:
    """df as a table in the shared folder: lineage is cut, and lost executors don't cost a recomputation. The folder's
    owner clears it; results that are computed later still read these tables."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def merged(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """left.join(right, on) by sorting both. For rows that an explode made and tables of such rows: Spark sizes them as
    the rows they came from, or as a well packed file, and would broadcast what may be hundreds of times larger, all of
    it through the driver."""
    return left.join(right.hint("merge"), on)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def crc_fold(c: Column, n: int) -> Column:
    """crc32 of the id as text, mod n; null ids count as the empty text."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_texts(docs: DataFrame, fn: Callable[[list[bytes | None]], list], added: str, carry: list[str], text: str = "text", block_bytes: int = 2_000_000) -> DataFrame:
    """Columns `carry` of docs and the columns `added` (DDL), which fn makes from the whole texts as UTF-8, a block of
    rows at a time. A block has about block_bytes of text, or one longer text. Only the texts go to Python and only
    what fn makes comes back; the columns carried wait in the JVM, which spills them."""
    new = StructType.fromDDL(added)
    fields = list(to_arrow_schema(new))

    def run(column: pa.Array) -> pa.Array:
        texts = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
        ends = np.cumsum(np.array([0 if n is None else n for n in pc.binary_length(texts).to_pylist()], np.int64))
        parts, at = [], 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + block_bytes, "right")))
            made = fn(texts.slice(at, stop - at).to_pylist())
            parts.append(pa.StructArray.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, type=f.type) for x, f in zip(made, fields, strict=True)], fields=fields))
            at = stop
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct(fields))

    name = "_made"
    while name in carry:
        name += "_"
    # Not deterministic for the optimiser, which would else call fn once more for each filter on its results.
    told = F.arrow_udf(run, new).asNondeterministic()
    return docs.select(*carry, told(F.col(text)).alias(name)).select(*carry, f"{name}.*")


def hashed_sample(docs: DataFrame, label: str, most: int, seed: int = 0) -> list[Row]:
    """At most `most` rows (text, label) of each label, for fitting a classifier: those whose text hashes below the
    share of the label's distinct texts that is wanted, each text once. Rows with null or empty text or null label don't come."""
    rows = docs.filter(F.col(label).isNotNull() & (F.col("text") != "")).select("text", label)
    counts = rows.select(label, F.xxhash64("text").alias("_text")).distinct().groupBy(label).count().collect()
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("text")), 11) / F.lit(float(1 << 53))
    wanted = F.lit(False)
    for r in counts:
        wanted = wanted | ((F.col(label) == F.lit(r[0])) & (draw < min(1.0, 1.5 * most / r[1])))
    seen: dict = {r[0]: {} for r in counts}
    for r in rows.filter(wanted).dropDuplicates([label, "text"]).withColumn("_draw", draw).orderBy("_draw", "text").toLocalIterator() if counts else ():
        if len(seen[r[1]]) < most:
            seen[r[1]].setdefault(r[0], r)
    return [r for k in sorted(seen) for r in seen[k].values()]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, seed: int = 0) -> tuple[list[Row], dict[int, int]]:
    """At most `most` rows (text, label) of each label 0 and 1 for fitting a classifier, each text once, and how many
    labelled rows there are of each. Labels (doc_id, label) are drawn first, by hash of their id; the ids drawn are
    few by that bound, so they are broadcast to find their texts."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
    there = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    drawn = [r for y in sorted(there) for r in known.filter(F.col("y") == y).orderBy(order, "doc_id").limit(most).collect()]
    ids = F.broadcast(docs.sparkSession.createDataFrame(drawn, "doc_id long, y int"))
    rows = docs.select("doc_id", "text").join(ids, "doc_id").select("text", "y").filter("text is not null")
    once: dict = {}
    for r in rows.toLocalIterator():
        once[r.text] = max(once.get(r.text, r.y), r.y)
    return [Row(text=t, y=y) for t, y in sorted(once.items())], there
