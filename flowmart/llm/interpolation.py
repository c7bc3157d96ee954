"""Language-model scores by deleted interpolation.

The maximum-likelihood estimates of a word after its predecessor, of a word alone, and of any word at all are mixed
with weights that depend on how frequent the predecessor is. The weights are learned by expectation-maximisation on
the counts of a tenth of the training documents that is held back from the estimates; for scoring, the estimates use
all training documents.

All words and all pairs count, however rare. Documents are read once into blocks of about BLOCK tokens. Each block
sends every word and pair it holds once, with its counts, to the range of hashes that it falls in; there they are
summed, and the sums go back to the block in the same order. So a frequent word costs a range one entry a block. Where
there are more than FAN blocks, a range is summed by groups of that many first, and each group is answered by itself,
so neither a task nor the driver holds more than a block, FAN blocks' share of a range, or the cells of the mixture.

The weights see the estimates of the tokens held back rounded to half powers of two (log_cells), so that what the
driver maximises over is a table of bounded size; scores use the estimates as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructField, StructType

from flowmart.llm.common import crc_fold, stored, table

END = b"\n"  # no word holds it
KEPT, HELD, OTHER = 0, 1, 2
#: Tokens of a block, about how many words and pairs of all blocks meet in one range of hashes, and how many blocks are summed at once.
BLOCK, RANGE, FAN = 200_000, 1_000_000, 4_096
#: Bytes of the row groups of the stored blocks. A reader holds one of each column.
GROUP_BYTES = 8 << 20
#: Buckets of predecessors by the binary logarithm of their count (0: never seen), and steps of both estimates.
BUCKETS, STEPS = 48, 64
SQUEEZE, UNSQUEEZE = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
BLOCK_COLUMNS = "block long, n_tokens long, n_kept long, n_held long, parts binary, sizes binary, words binary, tokens binary"


def tokens(text: bytes | None) -> list[bytes]:
    words = (text or b"").lower().split()
    words.append(END)
    return words


def packed(x: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next ones, and so on: small or sorted numbers compress well so. They
    are compressed here, so that Spark moves, sorts and holds them so."""
    return SQUEEZE.compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes())


def unpacked(data: bytes | pa.Buffer, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(UNSQUEEZE.decompress(data), np.uint8).reshape(size, -1).T).view(kind).ravel()


class Numbers(dict):
    """Word -> its number in the block, in the order seen."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Block:
    def __init__(self):
        self.ids, self.texts, self.parts, self.picked, self.rows, self.size = Numbers(), [], [], [], [], 0

    def add(self, text: bytes | None, part: int, row: int) -> None:
        words = tokens(text)
        self.texts.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
        self.parts.append(part)
        self.picked.append(row)
        self.size += len(words)

    def take(self, own: pa.StructArray) -> None:
        """Keeps the rows picked from this batch."""
        if self.picked:
            self.rows.append(own.take(pa.array(self.picked)))
            self.picked = []

    def columns(self, number: int) -> list:
        sizes, parts = np.array([len(x) for x in self.texts], np.int64), np.array(self.parts, np.uint8)
        words = np.fromiter((xxhash.xxh64_intdigest(w, 8) for w in self.ids), np.uint64, len(self.ids))
        n = [int(sizes[parts == k].sum()) for k in (KEPT, HELD)]
        return [number, self.size, *n, parts.tobytes(), sizes.tobytes(), words.tobytes(), packed(np.concatenate(self.texts))]


def blocks_of(docs: DataFrame, own: list[str], part: Column) -> DataFrame:
    """BLOCK_COLUMNS and docs, an array of the columns `own`, of docs: a row for each block. Blocks of
    odd number hold the documents held back, those of even number all others."""
    rows = docs.select(F.struct(*own).alias("own"), part.cast("int").alias("part"), F.col("text").cast("binary").alias("text"))
    schema = StructType([*StructType.fromDDL(BLOCK_COLUMNS).fields, StructField("docs", ArrayType(rows.schema["own"].dataType))])
    arrow, most = to_arrow_schema(schema), BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, number = [Block(), Block()], TaskContext.get().partitionId() << 32

        def flush(held: int) -> pa.RecordBatch:
            nonlocal number
            b, made[held] = made[held], Block()
            number += 2
            kept = pa.concat_arrays(b.rows)
            docs = pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept)
            return pa.RecordBatch.from_arrays([*(pa.array([x], arrow.field(i).type) for i, x in enumerate(b.columns(number + held))), docs], names=arrow.names)

        for batch in batches:
            structs, parts, texts = batch.column(0), batch.column(1).to_pylist(), batch.column(2)
            for i, part in enumerate(parts):
                held = int(part == HELD)
                made[held].add(texts[i].as_py(), part, i)
                if made[held].size >= most:
                    made[held].take(structs)
                    yield flush(held)
            for b in made:
                b.take(structs)
        for held in (0, 1):
            if made[held].size:
                yield flush(held)

    return rows.mapInArrow(run, schema)


class Keys(NamedTuple):
    """Of a block: its token numbers and their predecessors', each token's place among the distinct pairs, the hashes
    of all words (even) and then all pairs (odd) in ascending order, and where each stood before."""

    tokens: np.ndarray
    before: np.ndarray
    pair: np.ndarray
    key: np.ndarray
    order: np.ndarray
    n_words: int


def keys_of(words: bytes | pa.Buffer, numbers: bytes | pa.Buffer, sizes: np.ndarray) -> Keys:
    """The predecessor of a text's first word is the end of a text."""
    h, w = np.frombuffer(words, np.uint64), unpacked(numbers, np.int32)
    v = np.empty_like(w)
    v[1:] = w[:-1]
    v[np.cumsum(sizes) - sizes] = w[-1]
    code, pair = np.unique(v.astype(np.int64) * len(h) + w, return_inverse=True)
    x = h[code // len(h)] * np.uint64(0x9E3779B97F4A7C15) + h[code % len(h)]
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    key = np.concatenate((h & ~np.uint64(1), (x ^ (x >> np.uint64(32))) | np.uint64(1)))
    order = np.argsort(key)
    return Keys(w, v, pair, key[order], order, len(h))


def sent(blocks: DataFrame, bits: int) -> DataFrame:
    """range, block, keys, kept, held: each block's words and pairs in each of the 2^bits ranges of hashes, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {name: batch.column(name)[i] for name in batch.schema.names}
                sizes = np.frombuffer(r["sizes"].as_buffer(), np.int64)
                k = keys_of(r["words"].as_buffer(), r["tokens"].as_buffer(), sizes)
                part = np.repeat(np.frombuffer(r["parts"].as_buffer(), np.uint8), sizes)
                n_pairs = len(k.key) - k.n_words
                counts = []
                for p in (KEPT, HELD):
                    of = part == p
                    both = np.concatenate((np.bincount(k.tokens[of], minlength=k.n_words), np.bincount(k.pair[of], minlength=n_pairs)))
                    counts.append(both[k.order].astype(np.int32))
                at = k.key >> np.uint64(64 - bits) if bits else np.zeros_like(k.key)
                starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
                cuts = list(zip(starts.tolist(), [*starts[1:].tolist(), len(at)], strict=True))
                columns = [pa.array([packed(x[a:b]) for a, b in cuts], pa.binary()) for x in (k.key, *counts)]
                yield pa.RecordBatch.from_arrays([pa.array(at[starts].astype(np.int64)), pa.array([r["block"].as_py()] * len(cuts), pa.int64()), *columns], names=["range", "block", "keys", "kept", "held"])

    return blocks.select("block", "parts", "sizes", "words", "tokens").mapInArrow(run, "range long, block long, keys binary, kept binary, held binary")


def joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.concatenate([unpacked(x.as_buffer(), kind) for x in column] or [np.zeros(0, kind)])


def sums_of(got: pa.Table, kind: type = np.int32) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The distinct keys of the rows, the place of each of their keys among those, and the sums of kept and held."""
    key, place = np.unique(joined(got["keys"], np.uint64), return_inverse=True)
    return key, place, [np.bincount(place, joined(got[c], kind), len(key)).astype(np.int64) for c in ("kept", "held")]


def answered(got: pa.Table, place: np.ndarray, kept: np.ndarray, total: np.ndarray, distinct: int) -> pa.Table:
    """The sums at `place` cut into the rows of `got`; the first one also tells `distinct`."""
    ends = np.cumsum([zstandard.frame_content_size(x.as_buffer()) // 8 for x in got["keys"]]).tolist()
    cuts = list(zip([0, *ends], ends, got["block"].to_pylist(), strict=False))
    sums = [packed(total[place[a:b]]) for a, b, _ in cuts], [packed(kept[place[a:b]]) if block % 2 else None for a, b, block in cuts]
    return pa.table([got["block"], got["range"], *(pa.array(x, pa.binary()) for x in sums), pa.array([distinct] + [0] * (len(ends) - 1), pa.int64())], names=["block", "range", "total", "kept", "distinct"])


def distinct_words(key: np.ndarray, total: np.ndarray) -> int:
    return int((((key & np.uint64(1)) == 0) & (total > 0)).sum())


def summed(rows: DataFrame, groups: int = 1) -> DataFrame:
    """block, range, total, kept: what sent() sent, with the sums over all blocks: of all training documents, and for
    blocks held back also of those kept; and on one row of each range, how many distinct words training documents have
    there. With more than one group the blocks are dealt to that many groups, which are summed and answered apart."""
    out = "block long, range long, total binary, kept binary, distinct long"

    def run(got: pa.Table) -> pa.Table:
        key, place, (kept, held) = sums_of(got)
        return answered(got, place, kept, kept + held, distinct_words(key, kept + held))

    if groups == 1:
        return rows.groupBy("range").applyInArrow(run, out)

    def part(got: pa.Table) -> pa.Table:
        key, _, (kept, held) = sums_of(got)
        return pa.table([got["range"][:1], *(pa.array([packed(x)], pa.binary()) for x in (key, kept, held))], names=["range", "keys", "kept", "held"])

    def whole(got: pa.Table) -> pa.Table:
        key, _, (kept, held) = sums_of(got, np.int64)
        return pa.table([got["range"][:1], *(pa.array([packed(x)], pa.binary()) for x in (key, kept, kept + held)), pa.array([distinct_words(key, kept + held)], pa.int64())], names=["range", "keys", "kept", "total", "distinct"])

    def answer(got: pa.Table, sums: pa.Table) -> pa.Table:
        if not got.num_rows:
            return pa.table([pa.array([], x) for x in (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64())], names=["block", "range", "total", "kept", "distinct"])
        key, kept, total = (joined(sums[c], kind) for c, kind in (("keys", np.uint64), ("kept", np.int64), ("total", np.int64)))
        return answered(got, np.searchsorted(key, joined(got["keys"], np.uint64)), kept, total, sums["distinct"][0].as_py() if sums["lot"][0].as_py() == sums["first"][0].as_py() else 0)

    dealt = stored(rows.withColumn("lot", F.pmod(F.xxhash64(F.col("block")), F.lit(groups).cast("long"))), "sent")
    parts = dealt.groupBy("range", "lot").applyInArrow(part, "range long, keys binary, kept binary, held binary")
    totals = parts.groupBy("range").applyInArrow(whole, "range long, keys binary, kept binary, total binary, distinct long")
    lots = dealt.select("range", "lot").distinct().groupBy("range").agg(F.collect_set("lot").alias("lots"))
    totals = totals.join(lots, "range").withColumn("first", F.array_min("lots")).withColumn("lot", F.explode("lots")).drop("lots")
    return dealt.groupBy("range", "lot").cogroup(totals.groupBy("range", "lot")).applyInArrow(answer, out)


class Looked(NamedTuple):
    """For each token of a block how often its predecessor, it, and the two together stand in the part counted."""

    before: np.ndarray
    word: np.ndarray
    pair: np.ndarray
    sizes: np.ndarray


def looked_up(block: pa.Table, counts: pa.Table, part: str) -> Looked:
    words, numbers, sizes = (block[c][0].as_buffer() for c in ("words", "tokens", "sizes"))
    sizes = np.frombuffer(sizes, np.int64)
    k = keys_of(words, numbers, sizes)
    counts = counts.sort_by("range")
    n = np.empty(len(k.key), np.int64)
    n[k.order] = joined(counts[part], np.int64)
    return Looked(n[k.before], n[k.tokens], n[k.n_words :][k.pair], sizes)


def estimates(before: np.ndarray, word: np.ndarray, pair: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the predecessors, pair estimates, word estimates."""
    bucket = np.minimum(np.frexp(before.astype(np.float64))[1], BUCKETS - 1)
    return bucket, np.minimum(pair / np.maximum(before, 1), 1.0), word / max(n, 1)


def log_cells(bucket: np.ndarray, f2: np.ndarray, f1: np.ndarray) -> np.ndarray:
    """Bucket and both estimates as one number: 0 for an estimate of 0, else 1 and up, by half powers of two."""
    q = lambda f: np.where(f > 0, np.clip(np.round(-2 * np.log2(np.maximum(f, 1e-30))) + 1, 1, STEPS - 1), 0).astype(np.int64)
    return (bucket * STEPS + q(f2)) * STEPS + q(f1)


def learn(cells: list[tuple[int, int]], anything: float, rounds: int = 60) -> np.ndarray:
    """The weights (pair, word, any) of each bucket by expectation-maximisation; cells: those of log_cells(), how often."""
    weights = np.tile([0.4, 0.5, 0.1], (BUCKETS, 1))
    weights[0] = [0, 0.9, 0.1]
    if not cells:
        return weights
    cell, n = np.array(cells, np.int64).T
    b, n = cell // STEPS**2, n.astype(float)
    value = lambda q: np.where(q > 0, 2.0 ** (-(q - 1) / 2), 0.0)
    f = np.stack([value(cell // STEPS % STEPS), value(cell % STEPS), np.full(len(cell), anything)], axis=1)
    for _ in range(rounds):
        p = weights[b] * f
        p *= (n / p.sum(1))[:, None]
        new = np.stack([np.bincount(b, p[:, k], BUCKETS) for k in range(3)], axis=1) + weights
        new[0, 0] = 0
        weights = new / new.sum(1, keepdims=True)
    return weights


class Model(NamedTuple):
    """Tables of blocks and of their summed counts; tokens and distinct words of the training documents; weights."""

    blocks: DataFrame
    counts: DataFrame
    n: int
    distinct: int
    weights: np.ndarray


def fit(docs: DataFrame, own: list[str], part: Column) -> Model:
    """The model of docs, which also holds the blocks of all docs with their columns `own`."""
    blocks = stored(blocks_of(docs, own, part), "blocks", **{"parquet.block.size": GROUP_BYTES})
    n_all, n_kept, n_held, n_blocks = (x or 0 for x in blocks.agg(F.sum("n_tokens"), F.sum("n_kept"), F.sum("n_held"), F.count("*")).first())
    counts = sent(blocks, max(0, math.ceil(math.log2(max(n_all, 1) / RANGE))))
    counts = stored(summed(counts, max(1, -(-n_blocks // FAN))), "counts", **{"parquet.block.size": GROUP_BYTES})
    distinct = counts.agg(F.sum("distinct")).first()[0] or 0

    def cells(block: pa.Table, sums: pa.Table) -> pa.Table:
        x = looked_up(block, sums, "kept")
        c, n = np.unique(log_cells(*estimates(x.before, x.word, x.pair, n_kept)), return_counts=True)
        return pa.table([pa.array(c, pa.int64()), pa.array(n, pa.int64())], names=["cell", "n"])

    odd = "block % 2 = 1"
    held = blocks.filter(odd).select("block", "sizes", "words", "tokens").groupBy("block").cogroup(counts.filter(odd).select("block", "range", "kept").groupBy("block"))
    found = held.applyInArrow(cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    return Model(blocks, counts, n_kept + n_held, distinct, learn([(r.cell, r.n) for r in found], 1 / (distinct + 1)))


def log_score(docs: DataFrame, part: Column) -> DataFrame:
    """All columns of docs but text, and n_tokens, n_known, train_tokens, base_score, score.

    part: KEPT or HELD for the documents to learn from (HELD: those for the mixture weights), OTHER for the rest. All
    are scored, whole; a null text is an empty one, whose only token is the end. Repeated rows count and score each.
    Without training tokens every word is as likely as any. Columns with the added names are replaced. An empty table
    gives an empty result.
    """
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    own = [c for c in docs.columns if c not in (*added, "text")]
    model = fit(docs, own, part)
    n, distinct, weights = model.n, model.distinct, model.weights
    new = StructType.fromDDL("n_tokens long, n_known long, train_tokens long, base_score double, score double").fields
    schema = StructType([docs.schema[c] for c in own] + new)
    names = schema.names

    def run(block: pa.Table, sums: pa.Table) -> pa.Table:
        x = looked_up(block, sums, "total")
        begin = np.cumsum(x.sizes) - x.sizes
        b, f2, f1 = estimates(x.before, x.word, x.pair, n)
        p = weights[b, 0] * f2 + weights[b, 1] * f1 + weights[b, 2] / (distinct + 1)
        base = np.log10((x.word + 1) / (n + distinct + 1))
        made = [x.sizes, np.add.reduceat((x.word > 0).astype(np.int64), begin), np.full(len(begin), n), np.add.reduceat(base, begin), np.add.reduceat(np.log10(p), begin)]
        return pa.table([*block["docs"].combine_chunks().flatten().flatten(), *map(pa.array, made)], names=names)

    left = model.blocks.select("block", "sizes", "words", "tokens", "docs").groupBy("block")
    return left.cogroup(model.counts.select("block", "range", "total").groupBy("block")).applyInArrow(run, schema)


def op8_deleted_interpolation(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_fold(F.col("doc_id"), 7) == 2
    back = F.pmod(F.xxhash64("doc_id"), F.lit(10)) == 0
    part = F.when(held_out, OTHER).when(back, HELD).otherwise(KEPT)
    return log_score(docs, part).withColumn("held_out", held_out)
