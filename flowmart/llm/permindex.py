"""Nearest neighbours by a permutation index.

A vector is known by the order of its nearest pivots. Each block of vectors posts them in an inverted file for each
pivot, with the place that the pivot has. A query reads the files of its own nearest pivots and ranks what it finds by
the footrule distance of the two orders; the best are reranked by inner product on the original vectors. Blocks of
queries meet blocks of vectors in grouped tasks, so no task holds more than a block of each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowmart.llm.common import stored, table

PIVOTS, PREFIX = 256, 64
#: Rows in a block of vectors and of queries, and the share of a block that is reranked.
BLOCK, QUERY_BLOCK, RERANK = 8_192, 2_048, 0.25


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id and v of the vectors that take part: no null or non-finite component, not all zero, of the commonest length."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    fine = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec_col, lambda x: x != 0)
    rows = df.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).filter(fine)
    rows = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("v") == (sizes.n if sizes else 0))


def nearest_pivots(sims: np.ndarray, prefix: int) -> np.ndarray:
    return np.argsort(-sims, axis=1, kind="stable")[:, :prefix]


class PermutationIndex:
    """Pivots from a hashed sample of the vectors. Vectors of unequal length (norm) are lifted onto a sphere by one
    more component, so that the largest inner product with a query is the nearest point."""

    def __init__(self, rows: DataFrame, pivots: int = PIVOTS, prefix: int = PREFIX, seed: int = 13):
        drawn = rows.orderBy(F.xxhash64(F.lit(seed), "v"), "id").select("v").limit(4 * pivots).collect()
        top = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first().m or 1.0
        self.norm2 = float(top)
        picked = np.unique(np.array([r.v for r in drawn], np.float64), axis=0) if drawn else np.zeros((0, 1))
        picked = np.random.default_rng(seed).permutation(picked)[:pivots]
        self.pivots, self.prefix = self.lift(picked), min(prefix, max(len(picked), 1))

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([x, np.sqrt(np.maximum(self.norm2 - (x * x).sum(1, keepdims=True), 0))])

    def post(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The inverted files of a block: bounds of each pivot's file, and of all postings the row and k - place."""
        near = nearest_pivots(self.lift(x) @ self.pivots.T, self.prefix)
        order = np.argsort(near.ravel(), kind="stable")
        bounds = np.searchsorted(near.ravel()[order], np.arange(len(self.pivots) + 1))
        return bounds, order // self.prefix, (self.prefix - order % self.prefix).astype(np.int32)

    def search(self, q_id: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, rerank: float) -> tuple[list, list, list]:
        """For each query its k best of the block, among the share `rerank` of it with the least footrule distance."""
        by_id = np.argsort(ids, kind="stable")
        ids, x = ids[by_id], x[by_id]
        bounds, row, weight = self.post(x)
        mine = nearest_pivots(np.hstack([q, np.zeros((len(q), 1))]) @ self.pivots.T, self.prefix)
        many = min(len(ids), max(int(np.ceil(rerank * len(ids))), 4 * k))
        out: tuple[list, list, list] = ([], [], [])
        for i in range(len(q)):
            files = [slice(bounds[p], bounds[p + 1]) for p in mine[i]]
            rows = np.concatenate([row[f] for f in files])
            # the footrule distance is a constant less twice the sum of k - max(place, place) over the shared pivots
            shared = np.concatenate([np.minimum(weight[f], self.prefix - place) for place, f in enumerate(files)])
            gain = np.bincount(rows, shared, len(ids))
            found = np.flatnonzero(gain >= np.partition(gain, len(ids) - many)[len(ids) - many])
            score = (x[found] * q[i]).sum(1)
            score[ids[found] == q_id[i]] = -np.inf
            best = found[order := np.argsort(-score, kind="stable")[:k]]
            ok = score[order] > -np.inf
            out[0].extend([q_id[i]] * int(ok.sum()))
            out[1].extend(ids[best[ok]].tolist())
            out[2].extend(score[order][ok].tolist())
        return out


def nearest(df: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, rerank: float = RERANK, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row of df where is_query holds, the k other rows found with the
    largest inner product, in double precision; all of them, if there are fewer. Ties go to the smaller id.

    Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part, nor
    do rows without id; rows with a query's own id aren't its neighbours. Repeated vectors are found each by its id.
    Columns of df with other names don't matter. An empty table gives an empty result.
    """
    spark = df.sparkSession
    rows = stored(usable(df, id_col, vec_col), "vectors")
    asked = rows.withColumnsRenamed({"id": id_col}).filter(is_query).withColumnsRenamed({id_col: "id"})
    n, m = rows.count(), asked.count()
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-m // query_block))
    shared = spark.sparkContext.broadcast(PermutationIndex(rows))
    part = lambda seed, many: F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(many))
    left = asked.select("id", "v", part(1, query_blocks).alias("qb"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("cb"))
    right = rows.select("id", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))).alias("qb"), part(2, blocks).alias("cb"))

    def matrix(t: pa.Table) -> np.ndarray:
        column = t.column("v").combine_chunks()
        return column.flatten().to_numpy().reshape(t.num_rows, -1)

    def run(q: pa.Table, c: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if q.num_rows and c.num_rows:
            found = shared.value.search(q.column("id").to_numpy(), matrix(q), c.column("id").to_numpy(), matrix(c), k, rerank)
        return pa.table([pa.array(x, kind) for x, kind in zip(found, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "vec_id", "score"])

    found = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_permutation_index(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
