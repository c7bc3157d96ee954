"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is cut into two segments. Of two fingerprints that differ in at most two bits, one
segment differs in at most one bit. So each segment is indexed as it is, and once for each of its bits with that
bit blanked out. Equal keys meet in one equality join: under a blanked bit only fingerprints where it is 0 meet
those where it is 1, so a pair meets once for each segment. The whole fingerprints then decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.llm.common import merged, stored, table

BLOCK = 1 << 15
#: Words of which a task remembers the hash, about 200 bytes each; others are hashed again where they stand.
WORDS = 50_000


def fingerprint(data: bytes | None, words_in_shingle: int = 3) -> int:
    """The 64 majority bits of the XXH64 (seed 42) of all word shingles; 0 where there is no word."""
    words = (data or b"").lower().split()
    if not words:
        return 0
    text, k = b" ".join(words), min(words_in_shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - k + 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[k - 1 :].tolist(), strict=True)
    hashes = np.fromiter((digest(text[s:e], 42) for s, e in spans), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, BLOCK):
        ones += np.unpackbits(hashes[i : i + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits((ones * 2 > n).astype(np.uint8), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, words_in_shingle: int = 3) -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of every row; null and empty texts have fp 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(x.as_py(), words_in_shingle) for x in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("t")).mapInArrow(run, "doc_id long, fp long")


def links(reps: DataFrame) -> DataFrame:
    """Pairs (a, b) of the ids of distinct fingerprints (fp, rep) that differ in one or two bits."""
    k = reps.select("fp", "rep", F.explode(F.sequence(F.lit(0), F.lit(65))).alias("k"))
    k = k.selectExpr("fp", "rep", "k div 2 as p", "k % 2 as s", "shiftrightunsigned(fp, cast(32 * (k % 2) as int)) & 4294967295 as v")
    k = k.selectExpr(
        "fp",
        "rep",
        "p",
        "shiftleft(s, 38) | shiftleft(p, 32) | if(p = 32, v, v & ~shiftleft(1L, cast(p as int))) as key",
        "if(p = 32, 2, shiftrightunsigned(v, cast(p as int)) & 1) as side",
    )
    a = k.filter("side != 1").selectExpr("key", "p", "fp as fa", "rep as ra")
    b = k.filter("side != 0").selectExpr("key", "fp as fb", "rep as rb")
    met = merged(a, b, "key").filter("bit_count(fa ^ fb) <= 2 and (p < 32 or fa < fb)")
    return met.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of edges (a, b): root is the smallest node reachable.

    Large-star and small-star steps in turn. Each is a grouped minimum and an equality join, so a hub is a skewed
    join key, never a group in one task. The edges are written after each round; two numbers tell whether they changed.
    """
    now, before = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "links"), None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").selectExpr("v as u", "m as v").unionByName(low.selectExpr("u", "m as v"))
        now = stored(small.filter("u != v").distinct(), "links")


def near_duplicates(docs: DataFrame, words_in_shingle: int = 3) -> DataFrame:
    """doc_id, fp, component_id of every row of docs (doc_id, text, whatever else).

    component_id is the smallest doc_id reachable over links of two or fewer differing bits. Null and empty texts
    have fingerprint zero and are linked like any other. Rows that share a doc_id each take part with their own
    text. A row without doc_id comes back with its fingerprint and the component of the documents that share it
    (null if none does); it adds no link. An empty table gives an empty result.
    """
    sig = stored(fingerprints(docs, words_in_shingle), "fingerprints")
    reps = stored(sig.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "reps")
    roots = components(links(reps))
    classes = reps.join(roots, reps.rep == roots.node, "left").select(F.col("fp"), F.coalesce("root", "rep").alias("component_id"))
    return sig.join(classes, "fp", "left").select("doc_id", "fp", "component_id")


class WordHashes(dict):
    """Word -> its hash. At most WORDS of them are remembered."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, 42)
        if len(self) < WORDS:
            self[word] = h
        return h


def stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words (of all words, if there are fewer), from the hashes of the words."""
    size = min(size, len(words))
    n = len(words) - size + 1 if size else 0
    x = words[:n]
    for j in range(1, size):
        x = stir(x) * np.uint64(0x9E3779B97F4A7C15) + words[j : j + n]
    return stir(x)


def words_hashed(data: bytes | None, known: WordHashes) -> np.ndarray:
    words = (data or b"").lower().split()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def op5_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
