"""Phrase collocations by Rabin-Karp fingerprints.

A block of texts is one array of bytes: lower-cased, each run of blanks one blank, each end of a piece a break. Prefix sums
of a polynomial over it give the fingerprint of any run of words by one subtraction. Shuffles add up fingerprints, first of
one and two words, then of three and four where every two of their words are frequent. Only the blocks' occurrences
of frequent fingerprints are read again: each points to its place, the bytes there are held against those of the
first place with the fingerprint, and the phrase is written out once for the block. What is counted in the end is the
phrase itself, so that two phrases of one fingerprint stay two.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart.llm.common import shuffle_partitions, stored, table

#: What ends a piece, and the blanks between words.
ENDS, BLANK = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Bytes of text that are worked on at once; longer texts are cut between words.
BLOCK = 1_000_000
#: Bits of the filter for each frequent fingerprint, and bits at most: beyond, more passes the filter, but nothing is lost.
BITS_A_KEY, MOST_BITS = 32, 1 << 28
WORDS = 4

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: What a byte becomes: 0 ends a piece, 32 is a blank, others are of a word.
KINDS = np.arange(256, dtype=np.uint8)
KINDS[65:91] += 32
KINDS[list(BLANK)] = 32
#: Byte values that UTF-8 hasn't stand for the ends of a piece and of a text; a zero byte is of a word.
PIECE, TEXT = 0xFF, 0xFE
KINDS[list(ENDS)] = PIECE
PASS_ON = re.compile(rb"[^ \t.,;:!?\n\x0b\x0c\r]*(?:[ \t]+[^ \t.,;:!?\n\x0b\x0c\r]+){0,3}")


def cut(text: bytes, most: int = BLOCK) -> Iterator[tuple[bytes, int]]:
    """Parts of a text, and how many bytes of a part its phrases may begin in; what follows are words that they run on to."""
    at = 0
    while at < len(text):
        stop = at + most
        while stop < len(text) and KINDS[text[stop]] not in (32, PIECE):
            stop += 1
        if stop >= len(text):
            yield text[at:], len(text) - at
            return
        yield text[at : PASS_ON.match(text, stop).end()], stop - at
        at = stop


class Block:
    """The words of some texts (with a number for the language of each): where they begin and end in `data`, and what
    follows from prefix sums of the polynomial over its bytes."""

    def __init__(self, parts: list[tuple[bytes, int]], langs: list[int]):
        raw = np.frombuffer(b"".join(x for t, _ in parts for x in (t, b"\xfe")), np.uint8)
        sizes = np.array([len(t) + 1 for t, _ in parts], np.int64)
        first = np.cumsum(sizes) - sizes
        limit = np.repeat(first + np.array([n for _, n in parts], np.int64), sizes)
        kind = KINDS[raw]
        word = (kind != 32) & (kind < TEXT)
        # One blank or break stays of those between two words: the first of a run, a break if the run has one.
        gap = ~word
        opens = gap & np.concatenate(([True], word[:-1]))
        run = np.cumsum(opens) - 1
        breaks = np.zeros(int(run[-1]) + 1 if len(run) else 0, bool)
        breaks[run[kind >= TEXT]] = True
        keep = word | opens
        data = kind[keep]
        at = np.flatnonzero(keep)
        there = np.flatnonzero(gap[keep])
        data[there] = np.where(breaks, 10, 32)
        self.data = data
        inside = word[keep].astype(np.int8)
        edge = np.diff(np.concatenate(([0], inside, [0])))
        self.start, self.stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        here = at[self.start]
        self.mine = here < limit[here]  # phrases that begin here are of this part
        self.lang = np.repeat(np.array(langs, np.int64), sizes)[here]
        after = self.stop.copy()
        self.on = np.zeros(len(after), bool)  # whether the next word is of the same piece
        if len(after) > 1:
            self.on[:-1] = data[after[:-1]] == 32
        with np.errstate(over="ignore"):
            up = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(data), BASE))), dtype=np.uint64)[:-1]
            self.down = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(data), INVERSE))), dtype=np.uint64)
            self.sums = np.concatenate(([np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)))

    def runs(self, words: int) -> np.ndarray:
        """The words (by number) where a phrase of so many words begins."""
        fine = self.mine.copy()
        for k in range(words - 1):
            fine[len(fine) - k - 1 :] = False
            fine[: len(fine) - k] &= self.on[k:]
        return np.flatnonzero(fine)

    def prints(self, first: np.ndarray, words: int, seeds: np.ndarray) -> np.ndarray:
        """The fingerprints of the phrases of so many words that begin at the words `first`, stirred with their language."""
        a, b = self.start[first], self.stop[first + words - 1]
        with np.errstate(over="ignore"):
            h = (self.sums[b] - self.sums[a]) * self.down[a] + seeds[self.lang[first]]
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            return h ^ (h >> np.uint64(29))


def blocks(batch: pa.RecordBatch, most: int = BLOCK) -> Iterator[tuple[Block, list[str], np.ndarray]]:
    """Blocks of the rows (lang, text) of a batch, with the languages of the batch and the seeds for them."""
    names = batch.column(0).to_pylist()
    langs = sorted(set(names))
    number = {x: i for i, x in enumerate(langs)}
    seeds = np.array([xxhash.xxh64_intdigest(x.encode(), 7) for x in langs], np.uint64)
    parts, of, size = [], [], 0
    for name, text in zip(names, batch.column(1), strict=True):
        for part in cut(text.as_py() or b"", most):
            parts.append(part)
            of.append(number[name])
            size += len(part[0])
            if size >= most:
                yield Block(parts, of), langs, seeds
                parts, of, size = [], [], 0
    if parts:
        yield Block(parts, of), langs, seeds


class Filter:
    """A bitmap of fingerprints: those that went in pass, and few others do."""

    def __init__(self, keys: DataFrame):
        many = keys.count()
        self.bits = min(MOST_BITS, 1 << max(10, (many * BITS_A_KEY).bit_length()))
        place = F.expr(f"key & {self.bits - 1}L")
        words = keys.select(F.shiftright(place, 6).alias("w"), F.expr(f"shiftleft(1L, cast({self.bits - 1}L & key & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
        self.map = np.zeros(self.bits // 64, np.int64)
        self.map[words.column("w").to_numpy()] = words.column("b").to_numpy()

    def passes(self, prints: np.ndarray) -> np.ndarray:
        at = prints & np.uint64(self.bits - 1)
        return (self.map.view(np.uint64)[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def counted(rows: DataFrame, lengths: tuple[int, ...], shared, least: int) -> DataFrame:
    """key: the fingerprints of phrases of so many words that occur `least` times, where all two neighbouring words of
    them pass the filter (if there is one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value if shared else None
        for batch in batches:
            for block, _, seeds in blocks(batch):
                fine = None
                if known:
                    two = np.flatnonzero(block.on)
                    fine = np.zeros(len(block.on), bool)
                    fine[two] = known.passes(block.prints(two, 2, seeds))
                found = []
                for n in lengths:
                    first = block.runs(n)
                    for k in range(n - 1 if known else 0):
                        first = first[fine[first + k]]
                    found.append(block.prints(first, n, seeds))
                key, count = np.unique(np.concatenate(found), return_counts=True)
                if len(key):
                    yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(count.astype(np.int64))], ["key", "f"])

    return rows.mapInArrow(run, "key long, f long").groupBy("key").agg(F.sum("f").alias("f")).filter(F.col("f") >= least).select("key")


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray, step: int = 1 << 20) -> np.ndarray:
    """Whether the `size` bytes at a are those at b, for each pair of places."""
    out = np.ones(len(a), bool)
    ends = np.cumsum(size)
    at = 0
    while at < len(a):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + step, "right")))
        own = size[at:stop]
        step_in = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
        differs = data[np.repeat(a[at:stop], own) + step_in] != data[np.repeat(b[at:stop], own) + step_in]
        out[at:stop] = np.add.reduceat(differs, np.cumsum(own) - own) == 0
        at = stop
    return out


def written_out(rows: DataFrame, shared) -> DataFrame:
    """lang, words, phrase, f: of each block the phrases whose fingerprint passes the filter, with their exact number
    there; and, as words 0, the number of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for block, langs, seeds in blocks(batch):
                names = pa.array(langs)
                total = np.bincount(block.lang[block.mine], minlength=len(langs))
                yield pa.record_batch([names, pa.array(np.zeros(len(langs), np.int32)), pa.array([b""] * len(langs)), pa.array(total)], ["lang", "words", "phrase", "f"])
                for n in range(1, WORDS + 1):
                    first = block.runs(n)
                    prints = block.prints(first, n, seeds)
                    fine = known.passes(prints)
                    first, prints = first[fine], prints[fine]
                    while len(first):
                        _, head, of = np.unique(prints, return_index=True, return_inverse=True)
                        a, size = block.start[first], block.stop[first + n - 1] - block.start[first]
                        same = (size == size[head][of]) & (block.lang[first] == block.lang[first[head]][of])
                        same[same] = same_bytes(block.data, a[same], a[head][of][same], size[same])
                        f = np.bincount(of[same], minlength=len(head))
                        phrases = [block.data[s : s + k].tobytes() for s, k in zip(a[head].tolist(), size[head].tolist(), strict=True)]
                        yield pa.record_batch([names.take(pa.array(block.lang[first[head]])), pa.array(np.full(len(head), n, np.int32)), pa.array(phrases, pa.binary()), pa.array(f)], ["lang", "words", "phrase", "f"])
                        first, prints = first[~same], prints[~same]  # other phrases with a fingerprint of one of these

    return rows.mapInArrow(run, "lang string, words int, phrase binary, f long").groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))


def exact(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def phrases(docs: DataFrame, least: int = 30) -> DataFrame:
    """lang, words, phrase, f of all phrases of 1 to 4 words that occur at least `least` times in a language, and as
    words 0 the number of its words."""
    spark = docs.sparkSession
    rows = docs.filter(F.col("text") != "").select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("t"))
    short = stored(counted(rows, (1, 2), None, least), "short")
    pairs = spark.sparkContext.broadcast(Filter(short))
    long = stored(counted(rows, (3, 4), pairs, least), "long")
    frequent = spark.sparkContext.broadcast(Filter(short.unionByName(long)))
    found = written_out(rows, frequent).filter((F.col("f") >= least) | (F.col("words") == 0))
    return stored(found.select("lang", "words", F.col("phrase").cast("string").alias("phrase"), "f"), "phrases")


def collocations(docs: DataFrame, least: int = 30, inside: int = 80, top: int = 2_000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases by score, a (both falling) and phrase.

    A-Z are lower-cased. Texts are cut into pieces at any of . , ; : ! ? and at line ends (x0A to x0D), and these into
    words at blanks and tabs. a is how often a phrase of 2 to 4 words occurs within pieces, at least `least` times; a cut
    after its first words makes parts that occur l and r times, and floor(2000000 a / (l + r)) of the lowest-scoring
    cut counts, the first of equals. n counts the words of the language. A phrase goes that lies inside a longer
    one which occurs at least `inside` percent as often. All of it is exact: decimals of 38 digits.

    Rows without language are of `und`, as are those whose lang says so. Null, empty and repeated texts count as they
    stand; other columns don't matter. Ties beyond the phrase can't be. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    known = phrases(docs, least)
    whole = known.filter("words = 0").select("lang", F.col("f").alias("n"))
    counts = known.filter("words > 0")
    w = F.split("phrase", " ")
    run = lambda a, b: F.array_join(F.slice(F.col("w"), a, b), " ")
    found = counts.filter("words > 1").select("lang", "phrase", F.col("f").alias("a"), "words", w.alias("w"))
    cuts = found.select("lang", "phrase", "a", F.col("words"), "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", run(F.lit(1), F.col("k")).alias("first"), run(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    part = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(n))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("c")).select("lang", "phrase", "c.a", "c.l", "c.r", "c.score")
    longer = found.filter("words > 2").select("lang", "a", "w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("m"))
    longer = longer.select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)).alias("at"))
    longer = longer.select("lang", run(F.col("at"), F.col("m")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(F.col("longest").isNull() | (100 * exact("longest") < inside * exact("a")))
    order = "order by score desc, a desc, phrase"
    # A language's phrases are ranked in parts first, so that the last sort has `top` of each part.
    salted = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(max(1, round(shuffle_partitions(spark) ** 0.5)))))
    best = salted.withColumn("rank", F.expr(f"row_number() over (partition by lang, part {order})")).filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.expr(f"cast(row_number() over (partition by lang {order}) as long)")).filter(F.col("rank") <= top)
    return best.join(F.broadcast(whole), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS MATERIALIZED (
  SELECT lang, row_number() OVER () AS id, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), t AS (
  SELECT lang, id, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM w
), t4 AS MATERIALIZED (
  SELECT lang, w1, lead(w1, 1) OVER d AS w2, lead(w1, 2) OVER d AS w3, lead(w1, 3) OVER d AS w4 FROM t WINDOW d AS (PARTITION BY id ORDER BY i)
), g AS (
  SELECT lang, 1 AS m, w1 AS phrase FROM t4 UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM t4 WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, concat_ws(' ', w1, w2, w3) FROM t4 WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, concat_ws(' ', w1, w2, w3, w4) FROM t4 WHERE w4 IS NOT NULL
), f AS MATERIALIZED (
  SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30
), n AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang
), c AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
  FROM c, (SELECT unnest([1, 2, 3]) AS k), f x, f y
  WHERE k < c.m AND x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ') AND y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
), scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, array_to_string(w[i:i + p - 1], ' ') AS phrase, max(a) AS longest
  FROM c, (SELECT unnest([2, 3]) AS p), (SELECT unnest([1, 2, 3]) AS i) WHERE p < c.m AND i + p - 1 <= c.m GROUP BY ALL
), kept AS (
  SELECT s.* FROM scored s LEFT JOIN longer o ON s.lang = o.lang AND s.phrase = o.phrase
  WHERE o.longest IS NULL OR 100::HUGEINT * o.longest < 80::HUGEINT * s.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
