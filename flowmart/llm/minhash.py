"""MinHash near-duplicates by bottom-k sketches.

One hash function orders all word shingles; a document's sketch is the KEPT smallest hashes of its set, the whole set if
it is smaller. Inverted lists of retained values tell which sketches overlap, the smallest hashes of the union of two
sketches estimate their similarity, and the full sets decide.

A pair that the estimate lets through shares a known number of retained values. So a sketch with too many values that
no other one retains has no partner, and its document goes no further; most do. Of the others the full sets are counted
alike, which is exact, and they get a finer sketch. Of that only the rarest values need a place in the lists: as many
as may differ, and one more. Values that one sketch alone retains take those places without an entry, and a passage
that many documents share comes last and mostly gets none. All that a sketch has of values that aren't busy comes
before its busy ones. So a pair that meets in a busy list and in no other has nothing but busy values in common, and
the number of these bounds its similarity: most copies with many edits drop out. What is left in long lists are groups
of near copies. They are first held against the most central sketch of the list and joined; then only what isn't
joined yet meets the list, in ranges of the set's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart.llm.common import merged, stored, table
from flowmart.llm.simhash import WordHashes, components, shingles, words_hashed

#: Hashes of a sketch, and the chance at which the estimate may miss a pair that is just similar enough.
KEPT, MISS = 128, 1e-9
#: Hashes of the finer sketches that the lists are made of, and entries from which a list is busy.
FINE, BUSY = 1_024, 32
#: Ratio of the bounds of a range of set sizes.
RANGE = 1.04


def least_common(kept: int, percent: int, miss: float = MISS) -> int:
    """The most hashes c so that of `kept` drawn from a union with that share in common fewer than c are common with
    a chance of at most `miss`. Draws without replacement, as here, vary less than these."""
    p, below, c = percent / 100, 0.0, 0
    while c < kept:
        below += comb(kept, c) * p**c * (1 - p) ** (kept - c)
        if below > miss:
            break
        c += 1
    return c


def sketches(docs: DataFrame, words_in_shingle: int, kept: int) -> DataFrame:
    """doc_id, n (size of the set), h1, h2 (128 bits of the set), sketch of every row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in batches:
            sizes, heads, sets = [], [], []
            for x in b.column(1):
                s = np.unique(shingles(words_hashed(x.as_py(), known), words_in_shingle).view(np.int64))
                sizes.append(len(s))
                heads.append(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64))
                sets.append(s[:kept])
            h = np.array(heads).reshape(-1, 2)
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            sketch = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *sets])))
            yield pa.record_batch([b.column(0), pa.array(sizes, pa.int64()), pa.array(h[:, 0]), pa.array(h[:, 1]), sketch], ["doc_id", "n", "h1", "h2", "sketch"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("t"))
    return rows.mapInArrow(run, "doc_id long, n long, h1 long, h2 long, sketch array<long>")


def full_sets(docs: DataFrame, ids: DataFrame, words_in_shingle: int) -> DataFrame:
    """u and s, the whole set of shingles, of the documents whose doc_id is among ids (u)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in batches:
            made = [np.unique(shingles(words_hashed(x.as_py(), known), words_in_shingle).view(np.int64)) for x in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(made, pa.list_(pa.int64()))], ["u", "s"])

    rows = docs.select(F.col("doc_id").cast("long").alias("u"), F.col("text").cast("binary").alias("t"))
    return rows.join(ids, "u", "left_semi").mapInArrow(run, "u long, s array<long>")


def similar(a: str, b: str, percent: int) -> Column:
    return F.expr(f"100 * size(array_intersect({a}, {b})) >= {percent} * (size({a}) + size({b}) - size(array_intersect({a}, {b})))")


def shared_values(held: DataFrame) -> DataFrame:
    """v and df of the values of held (u, v) that more than one row has."""
    return stored(held.groupBy("v").agg(F.count("*").alias("df")).filter("df > 1"), "shared")


def needed(percent: int, kept: int) -> str:
    """How many retained values a sketch of a set of size n must share with that of a similar one."""
    return f"if(100 * n < {percent * kept}, ({percent} * n + 99) div 100, {least_common(kept, percent)})"


def partnered(nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, kept: int) -> tuple[DataFrame, DataFrame]:
    """The nodes (u, n, sketch) that may have a partner, with `most` (their shingles that another one of them has), and
    the full sets (u, s), which `sets_of` gives for ids (u)."""
    held = nodes.select("u", F.explode("sketch").alias("v"))
    most = merged(held, shared_values(held), "v").groupBy("u").agg(F.count("*").alias("most"))
    may = stored(nodes.join(most, "u").filter(f"most >= {needed(percent, kept)}").drop("most"), "may")
    sets = stored(sets_of(may.select("u").distinct()), "sets")
    held = sets.select("u", F.explode("s").alias("v"))
    most = merged(held, shared_values(held), "v").groupBy("u").agg(F.count("*").alias("most"))
    return stored(may.join(most, "u").filter(f"100 * most >= {percent} * n"), "partnered"), sets


def fits(a: str, b: str, percent: int) -> str:
    """What sizes alone tell: whether two sets (structs with n and most) can be similar enough."""
    return f"100 * least({a}n, {b}n) >= {percent} * greatest({a}n, {b}n) and {100 + percent} * least({a}most, {b}most) >= {percent} * ({a}n + {b}n)"


def fits_busy(a: str, b: str, percent: int, fine: int = FINE) -> str:
    """fits() for sets that have only busy values in common: most counts these, in the sketches of sets beyond `fine`."""
    return f"if(greatest({a}n, {b}n) > {fine}, least({a}most, {b}most) >= {least_common(fine, percent)} and 100 * least({a}n, {b}n) >= {percent} * greatest({a}n, {b}n), {fits(a, b, percent)})"


class Overlaps:
    """The inverted lists of the sketches of nodes (u, n, sketch), and the pairs that they bring together. marks has the
    nodes that may have a partner: u, n, hot (busy values of the finer sketch), central."""

    def __init__(self, nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, kept: int, fine: int = FINE, busy: int = BUSY):
        self.percent, self.fine = percent, fine
        known, self.sets = partnered(nodes, sets_of, percent, kept)
        self.nodes = stored(known.select("u", "most").join(self.sets, "u").select("u", "most", F.size("s").cast("long").alias("n"), F.slice("s", 1, fine).alias("sketch")), "nodes")
        held = self.nodes.select("u", F.explode("sketch").alias("v"))
        of = merged(held, shared_values(held), "v").groupBy("u").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("of"), F.sum("df").alias("central"), F.count_if(F.col("df") > busy).alias("hot"))
        self.marks = stored(self.nodes.select("u", "n").join(of, "u").select("u", "n", "hot", "central"), "marks")
        # So many values may differ and one more; those that this sketch alone retains are among them.
        rows = self.nodes.drop("sketch").join(of, "u").withColumn("places", F.expr(f"size(of) - {needed(percent, fine)} + 1")).filter("places > 0")
        rows = rows.select("u", "n", "most", "hot", "central", F.explode(F.expr("slice(of, 1, cast(places as int))")).alias("x")).withColumn("busy", F.col("x.df") > busy)
        #: v, busy, u, n, most (values that another one of the list can share), central
        self.lists = stored(rows.select(F.col("x.v").alias("v"), "busy", "u", "n", F.when(F.col("busy"), F.col("hot")).otherwise(F.col("most")).alias("most"), "central"), "lists")

    def fit(self, a: str, b: str) -> str:
        """fits() in one list; in a busy one larger sets are held against one another by what their sketches share."""
        return f"if(busy, {fits_busy(a, b, self.percent, self.fine)}, {fits(a, b, self.percent)})"

    def stars(self) -> DataFrame:
        """Pairs (a, b) of each list's most central node and its other ones."""
        self.heads = stored(self.lists.groupBy("v").agg(F.max(F.struct("central", "u", "n", "most")).alias("h")).select("v", F.struct("h.u", "h.n", "h.most").alias("h")), "heads")
        met = merged(self.lists.withColumn("own", F.struct("u", "n", "most")), self.heads, "v").filter("u != h.u").filter(self.fit("own.", "h."))
        return met.select(F.least("u", "h.u").alias("a"), F.greatest("u", "h.u").alias("b")).distinct()

    def others(self, roots: DataFrame) -> DataFrame:
        """Pairs (a, b) that share a list and no component yet: one of them isn't in the component of the list's head."""
        of = roots.select(F.col("node").alias("u"), F.col("root").alias("c"))
        own = self.lists.join(of, "u", "left").withColumn("c", F.coalesce("c", "u"))
        head = self.heads.select("v", F.col("h.u").alias("u")).join(of, "u", "left").select("v", F.coalesce("c", "u").alias("hc"))
        bucket = lambda c: F.floor(F.log(c) / F.log(F.lit(RANGE)))
        low, high = F.expr(f"({self.percent} * n + 99) div 100"), F.expr(f"100 * n div {self.percent}")
        high = F.when(F.col("busy") & (high > self.fine), high).otherwise(F.least(high, F.expr(f"{100 + self.percent} * most div {self.percent} - n")))
        own = own.withColumns({"low": low, "high": high}).filter("low <= high")  # what sizes a partner may have
        placed = stored(own.join(head, "v").select("v", "busy", "low", "high", bucket(F.col("n")).alias("r"), F.struct("u", "n", "most", "c").alias("x"), (F.col("c") != F.col("hc")).alias("apart")), "placed")
        probes = placed.filter("apart")
        probes = probes.select("v", F.explode(F.sequence(bucket(F.col("low")), bucket(F.col("high")))).alias("r"), F.col("x").alias("y"))
        met = merged(probes, placed.drop("low", "high"), ["v", "r"]).filter("x.c != y.c and (not apart or y.u < x.u)").filter(self.fit("x.", "y."))
        return met.select(F.least("x.u", "y.u").alias("a"), F.greatest("x.u", "y.u").alias("b")).distinct()

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose union sketch has enough hashes in common."""
        end = lambda x: self.nodes.select(F.col("u").alias(x), F.col("sketch").alias(f"s{x}"))
        both = pairs.join(end("a"), "a").join(end("b"), "b").select("a", "b", F.array_intersect("sa", "sb").alias("i"), F.slice(F.array_sort(F.array_union("sa", "sb")), 1, self.fine).alias("w"))
        common = F.size(F.array_intersect("i", "w"))
        return both.filter(F.when(F.size("w") < self.fine, 100 * common >= self.percent * F.size("w")).otherwise(common >= least_common(self.fine, self.percent))).select("a", "b")


def near_duplicates(docs: DataFrame, percent: int = 85, words_in_shingle: int = 5, kept: int = KEPT, fine: int = FINE, busy: int = BUSY) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs (doc_id, text, whatever else).

    A document's set has its distinct word shingles; A-Z are lower-cased. With fewer words it has the whole sequence,
    without words nothing. Documents link if `percent` times the size of their union is at most 100 times that of
    their intersection. component_id is the smallest doc_id reachable; kept marks the documents that bear it. Sets of
    fewer than 0.85 * `kept` shingles lose no link; of the others a link goes amiss with a chance of MISS at most, twice
    that from 0.85 * `fine` on.

    A document without words is linked with nothing. Rows that share a doc_id are one document: what links with one
    of them links with all. A row without doc_id comes back with the component of the documents that have its very
    set (null if none has, and kept then); it adds no link. An empty table gives an empty result.
    """
    sig = stored(sketches(docs, words_in_shingle, kept), "sketches")
    nodes = stored(sig.filter("doc_id is not null and n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("u"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "nodes")
    lists = Overlaps(nodes, lambda ids: full_sets(docs, ids, words_in_shingle), percent, kept, fine, busy)

    def linked(pairs: DataFrame) -> DataFrame:
        close = stored(lists.estimated(pairs), "close")
        end = lambda x: lists.sets.select(F.col("u").alias(x), F.col("s").alias(f"s{x}"))
        return close.join(end("a"), "a").join(end("b"), "b").filter(similar("sa", "sb", percent)).select("a", "b")

    # Nodes of one doc_id with several sets link with the least of them.
    several = sig.filter("doc_id is not null and n > 0").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    several = stored(sig.join(several, "doc_id").join(nodes.select("h1", "h2", "u"), ["h1", "h2"]).select("doc_id", "u").distinct(), "several")
    same = several.join(several.groupBy("doc_id").agg(F.min("u").alias("b")), "doc_id").selectExpr("u as a", "b").filter("a != b")
    stars = stored(lists.stars(), "stars")
    edges = stored(linked(stars).unionByName(same), "edges")
    # The pairs are written before those that were tried go, as Spark would else move that below the test of sizes.
    rest = stored(lists.others(components(edges)), "others").join(stars, ["a", "b"], "left_anti")
    roots = components(edges.unionByName(stored(linked(rest), "edges")))
    classes = nodes.join(roots, nodes.u == roots.node, "left").select("h1", "h2", F.coalesce("root", "u").alias("root"))
    out = sig.drop("sketch").join(classes, ["h1", "h2"], "left")
    component = F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def op11_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP11_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), t AS (
  SELECT doc_id, unnest(words) AS w1, generate_subscripts(words, 1) AS i, len(words) AS many FROM w
), g AS (
  SELECT doc_id, concat_ws(' ', w1, lead(w1, 1) OVER d, lead(w1, 2) OVER d, lead(w1, 3) OVER d, lead(w1, 4) OVER d) AS shingle, i, many
  FROM t WINDOW d AS (PARTITION BY doc_id ORDER BY i) QUALIFY i <= greatest(many - 4, 1)
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, shingle FROM g
), n AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)
"""
