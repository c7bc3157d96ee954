"""Near copies by wide SimHash fingerprints and one-wildcard variants of their segments, decided by exact similarity.

Documents whose sets of word shingles can have no partner are told first, by counting retained values of bottom-k
sketches and then whole sets (minhash.Overlaps). The others get a fingerprint of four words of 64 bits over pairs of words,
cut into eight segments of 24 bits; each is indexed as it is and once for each of its bits with that bit blanked out.
Equal keys meet in one equality join; the other 64 bits, the sizes and at last the full sets decide. Of copies with
many edits in a large group most have too few common values in common to be similar: such a pair links only by a value
that is rare, so it is looked for in the short lists of these, and must pass the same test of fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowmart.llm.common import merged, stored
from flowmart.llm.minhash import KEPT, Overlaps, fits_busy, similar
from flowmart.llm.simhash import BLOCK, WordHashes, components, shingles, stir, words_hashed

#: The words of 64 bits of the wide fingerprint, and words of its shingles.
WIDE, CANDIDATE_WORDS = ("w0", "w1", "w2", "w3"), 2
#: Bits of a segment, in how many of the 64 checked bits candidates may differ, and members from which a component is large.
SEGMENT, CHECK_BITS, LARGE = 24, 18, 1_000


def wide_fingerprint(hashes: np.ndarray) -> list[int]:
    """Four words of 64 majority bits each, over hashes that are stirred anew for each of them."""
    out = []
    for j in range(len(WIDE)):
        ones = np.zeros(64, np.int64)
        for i in range(0, len(hashes), BLOCK):
            own = stir(hashes[i : i + BLOCK] + np.uint64(0x632BE59BD9B4E019 * (j + 1) % (1 << 64)))
            ones += np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
        out.append(int(np.packbits((ones * 2 > len(hashes)).astype(np.uint8), bitorder="little").view(np.int64)[0]))
    return out


def signed_texts(rows: DataFrame, words_in_shingle: int, kept: int = KEPT) -> DataFrame:
    """own, h (one for each set of word shingles), n (its size), w0 to w3 (the wide fingerprint) and sketch (the least
    `kept` of the set) of rows (own, t)."""
    made = StructType.fromDDL(f"h long, n long, {', '.join(f'{w} long' for w in WIDE)}, sketch array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in batches:
            numbers, sketches = [], []
            for x in b.column(1):
                words = words_hashed(x.as_py(), known)
                s = np.unique(shingles(words, words_in_shingle))
                numbers.append((int(np.uint64(xxhash.xxh64_intdigest(s.tobytes(), 1)).view(np.int64)), len(s), *wide_fingerprint(shingles(words, CANDIDATE_WORDS))))
                sketches.append(np.sort(s.view(np.int64))[:kept])
            columns = zip(*numbers, strict=True) if numbers else [[]] * (2 + len(WIDE))
            yield pa.record_batch([b.column(0), *(pa.array(c, pa.int64()) for c in columns), pa.array(sketches, pa.list_(pa.int64()))], ["own", *made.names])

    return rows.select("own", "t").mapInArrow(run, StructType([rows.schema["own"], *made.fields]))


def shingle_sets(rows: DataFrame, words_in_shingle: int) -> DataFrame:
    """h and s, the set of word shingles, of rows (doc_id, t)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in batches:
            made = [np.unique(shingles(words_hashed(x.as_py(), known), words_in_shingle)) for x in b.column(1)]
            own = [int(np.uint64(xxhash.xxh64_intdigest(x.tobytes(), 1)).view(np.int64)) for x in made]
            yield pa.record_batch([pa.array(own, pa.int64()), pa.array([x.view(np.int64) for x in made], pa.list_(pa.int64()))], ["h", "s"])

    return rows.mapInArrow(run, "h long, s array<long>")


def variants(nodes: DataFrame, keep: list[str]) -> DataFrame:
    """key, whole, side, check and the columns `keep` for each one-wildcard variant of each segment of the nodes. The
    48 low bits of a word are two segments; the rest of the four words is what pairs are checked by (64 bits)."""
    check = f"{' | '.join(f'shiftleft(shiftrightunsigned({w}, 48), {16 * i})' for i, w in enumerate(WIDE))} as check"
    rows = nodes.selectExpr(*keep, check, f"posexplode(array({', '.join(WIDE)})) as (j, w)").selectExpr(*keep, "check", "j", "w", f"explode(sequence(0, {2 * SEGMENT + 1})) as k")
    rows = rows.selectExpr(*keep, "check", f"j * 2 + k div {SEGMENT + 1} as seg", f"cast(k % {SEGMENT + 1} as int) as bit", f"shiftright(w, cast({SEGMENT} * (k div {SEGMENT + 1}) as int)) & {(1 << SEGMENT) - 1} as v")
    return rows.selectExpr(
        *keep,
        "check",
        f"bit = {SEGMENT} as whole",
        f"if(bit = {SEGMENT}, 2, shiftright(v, bit) & 1) as side",
        f"shiftleft(seg * {SEGMENT + 1} + bit, {SEGMENT}) | if(bit = {SEGMENT}, v, v & ~shiftleft(1L, bit)) as key",
    )


def nearby(nodes: DataFrame, percent: int, large: int = LARGE) -> DataFrame:
    """a, b: the pairs of nodes (h, w0 to w3, n, most, c, members) that share a variant, have no component c in common,
    fit by size and whose other bits differ in at most CHECK_BITS places.

    Nodes of components with more than `large` members don't meet one another under a key but where two such
    components share it, so that a large group costs its size and not the square of it.
    """
    rows = variants(nodes, ["h", "n", "most", "c", "members"])
    cold, hot = rows.filter(f"members <= {large}"), rows.filter(f"members > {large}")
    left = lambda df: df.filter("side != 1").selectExpr("key", "whole", "check as xa", "h as ha", "c as ca", "n as na", "most as ma")
    right = lambda df: df.filter("side != 0").selectExpr("key", "check as xb", "h as hb", "c as cb", "n as nb", "most as mb")
    found = merged(left(cold), right(cold), "key").filter("not whole or ha < hb")
    if nodes.filter(f"members > {large}").limit(1).count():
        found = found.unionByName(merged(left(cold), right(hot), "key")).unionByName(merged(left(hot).filter("not whole"), right(cold), "key"))
        crowds = stored(hot.select("key", "c").distinct(), "crowds")
        both = merged(crowds.selectExpr("key", "c as ca"), crowds.selectExpr("key", "c as cb"), "key").filter("ca != cb")
        found = found.unionByName(merged(merged(left(hot), both, ["key", "ca"]), right(hot), ["key", "cb"]).filter("not whole or ha < hb").select(found.columns))
    sizes = fits_busy("x.", "y.", percent).replace("x.n", "na").replace("y.n", "nb").replace("x.most", "ma").replace("y.most", "mb")
    found = found.filter(f"not coalesce(ca = cb, false) and bit_count(xa ^ xb) <= {CHECK_BITS} and {sizes}")
    return found.select(F.least("ha", "hb").alias("a"), F.greatest("ha", "hb").alias("b")).distinct()


def near_copies(docs: DataFrame, carry: tuple[str, ...] = (), percent: int = 80, words_in_shingle: int = 5, large: int = LARGE) -> DataFrame:
    """doc_id, the columns `carry`, component_id of every row of docs (doc_id, text, whatever else) that has a doc_id.

    A pair links if the sets of its word shingles have at least that Jaccard similarity. Candidates are texts with
    wide fingerprints (of pairs of words) of which one of eight segments differs in at most one bit. Texts with equal
    sets are one node. component_id is the smallest doc_id reachable. Texts without words are copies of one another.
    Rows that share a doc_id each take part with their own text. An empty table gives an empty result.

    Large groups must not make all their pairs. So of the nodes that share a variant each is first held against the
    most central of them, the one whose retained values most others have, and what links is one component. Then the
    pairs of nodes that share a variant and aren't in one component yet are candidates.
    """
    known = docs.filter("doc_id is not null")
    rows = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("t"))
    own = F.struct(F.col("doc_id").cast("long").alias("doc_id"), *carry)
    sig = stored(signed_texts(known.select(own.alias("own"), F.col("text").cast("binary").alias("t")), words_in_shingle), "fingerprints")
    nodes = stored(sig.groupBy("h").agg(F.min("own.doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("n", *WIDE, "sketch")]), "nodes")

    def sets_of(ids: DataFrame) -> DataFrame:
        ends = nodes.join(ids.withColumnRenamed("u", "h"), "h").select(F.col("rep").alias("doc_id"), "h")
        made = shingle_sets(rows.join(ends.select("doc_id").distinct(), "doc_id", "left_semi"), words_in_shingle)
        return made.join(ends.select("h"), "h", "left_semi").dropDuplicates(["h"]).withColumnRenamed("h", "u")

    lists = Overlaps(nodes.filter("n > 0").select(F.col("h").alias("u"), "n", "sketch"), sets_of, percent, KEPT)
    live = stored(nodes.select("h", *WIDE).join(lists.marks.withColumnsRenamed({"u": "h", "hot": "most"}), "h"), "live")

    def alike(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose fingerprints share a variant and differ in at most CHECK_BITS of the other bits."""
        end = lambda x: live.select(F.col("h").alias(x), F.struct(*WIDE).alias(f"w{x}"))
        near = " or ".join(f"bit_count(shiftrightunsigned(wa.{w} ^ wb.{w}, {at}) & {(1 << SEGMENT) - 1}) <= 1" for w in WIDE for at in (0, SEGMENT))
        apart = " + ".join(f"bit_count(shiftrightunsigned(wa.{w} ^ wb.{w}, 48))" for w in WIDE)
        return pairs.join(end("a"), "a").join(end("b"), "b").filter(f"({near}) and {apart} <= {CHECK_BITS}").select("a", "b")

    def linked(pairs: DataFrame) -> DataFrame:
        end = lambda x: lists.sets.select(F.col("u").alias(x), F.col("s").alias(f"s{x}"))
        return pairs.join(end("a"), "a").join(end("b"), "b").filter(similar("sa", "sb", percent)).select("a", "b")

    keys = stored(variants(live, ["h", "n", "most", "central"]).select("key", "central", F.struct("h", "n", "most", "check").alias("x")), "variants")
    heads = stored(keys.groupBy("key").agg(F.max(F.struct("central", "x")).alias("m"), F.count("*").alias("many")).filter("many > 1").select("key", F.col("m.x").alias("y")), "heads")
    met = merged(keys, heads, "key").filter(f"x.h != y.h and bit_count(x.check ^ y.check) <= {CHECK_BITS}").filter(fits_busy("x.", "y.", percent))
    met = met.select(F.least("x.h", "y.h").alias("a"), F.greatest("x.h", "y.h").alias("b"))
    stars = stored(met.unionByName(alike(stored(lists.stars(), "stars"))).distinct(), "stars")
    edges = stored(linked(stars), "edges")

    roots = components(edges)
    found = roots.select(F.col("node").alias("h"), F.col("root").alias("c"))
    of = stored(found.unionByName(found.selectExpr("c as h", "c").distinct()), "components")
    grouped = live.join(of.join(of.groupBy("c").agg(F.count("*").alias("members")), "c"), "h", "left").withColumn("members", F.coalesce("members", F.lit(1)))
    # The pairs are written before those that were tried go, as Spark would else move that below the tests.
    rest = stored(nearby(stored(grouped, "grouped"), percent, large).unionByName(alike(stored(lists.others(roots), "others"))).distinct(), "candidates").join(stars, ["a", "b"], "left_anti")
    roots = components(edges.unionByName(stored(linked(rest), "edges")))
    classed = sig.join(roots, sig.h == roots.node, "left").select("own.*", F.coalesce("root", "h").alias("_c"))
    return classed.join(classed.groupBy("_c").agg(F.min("doc_id").alias("component_id")), "_c").select("doc_id", *carry, "component_id")
