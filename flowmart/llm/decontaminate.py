"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders; what stands behind them is kept as slots. Windows of the templates
are hash-joined with the benchmark's. A window counts if each of its slots agrees with how the document mostly fills
that slot of the item, so a question that was given other numbers or names throughout is found, and chance matches of
bare templates aren't.

What is a name can't be told for sure, so a window comes in up to three forms: names are the capitalised words inside
sentences; they are all capitalised words, those that open a sentence, are in capitals or mixed case or a single
capital letter among them; there are none. A window of an item is matched if any of its forms is, and slots decide.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowmart.llm.common import map_texts, merged, stored, table

WINDOW, SIMILARITY = 5, 0.8
#: Most distinct template windows of the benchmark that are broadcast (8 bytes each) to sift the documents' windows
#: before the join. A larger benchmark meets all windows in the join.
SIFT = 4_000_000
TOKEN = re.compile(r"\d+(?:[.,:]\d+)*|[^\W\d_]+|[.!?\n]")
#: Words that are a unit where they follow a number.
UNITS = frozenset("mm cm m km in ft mi inch inches foot feet mile miles mg g kg t lb lbs oz ml l s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years c f k usd eur gbp dollar dollars euro euros cent cents percent mph kmh kw w v a hz khz mhz ghz kb mb gb tb".split())
WORD, NUMBER, CAPITAL, BREAK, UNIT, ODD, UNIT_CAPITAL, UNIT_ODD = range(8)
FORMS = 3
CACHE = 500_000
PART, WHOLE = ("doc_id", "item_id", "part"), -(1 << 63)
FACTORS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(64)], np.uint64)


class Canon(dict):
    """Token -> hash of its lower-cased form, with its kind in the lowest three bits; UNIT and the like are words that may be one."""

    def __missing__(self, token: str) -> int:
        low = token.lower()
        if token in ".!?\n":
            kind = BREAK
        elif token[0].isdigit():
            kind = NUMBER
        else:
            kind = WORD if token == low else CAPITAL if token[0].isupper() and token[1:].islower() else ODD
            if low in UNITS:
                kind = {WORD: UNIT, CAPITAL: UNIT_CAPITAL, ODD: UNIT_ODD}[kind]
        made = (xxhash.xxh64_intdigest(low.encode(), 1) >> 1 & ~7) | kind
        if len(self) < CACHE:
            self[token] = made
        return made


CANON = Canon()
PLACEHOLDER = {kind: np.uint64(xxhash.xxh64_intdigest(name, 2)) for kind, name in ((NUMBER, b"<number>"), (CAPITAL, b"<name>"), (UNIT, b"<unit>"))}


def templates(found: list[list[str]]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Of the tokens of all texts, one after another, without sentence ends: text number, place in the text's own
    tokens, and by form whether it is a slot, and the hash of the template's word."""
    size = np.array([len(x) for x in found], np.int64)
    of = np.repeat(np.arange(len(found)), size)
    place = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    made = np.fromiter(map(CANON.__getitem__, chain.from_iterable(found)), np.int64, len(of))
    kind = made & 7
    before = np.concatenate(([BREAK], kind[:-1])) if len(kind) else kind
    before = np.where(place == 0, BREAK, before)
    # A word that may be a unit is one after a number.
    kind = np.where((before == NUMBER) & np.isin(kind, (UNIT, UNIT_CAPITAL, UNIT_ODD)), UNIT, np.array([WORD, NUMBER, CAPITAL, BREAK, WORD, ODD, CAPITAL, ODD])[kind])
    keep = np.flatnonzero(kind != BREAK)
    kind, before, word = kind[keep], before[keep], made[keep].view(np.uint64) & ~np.uint64(7)
    for k in (NUMBER, UNIT):
        word[kind == k] = PLACEHOLDER[k]
    typed = (kind == NUMBER) | (kind == UNIT)
    names = [(kind == CAPITAL) & (before != BREAK), (kind == CAPITAL) | (kind == ODD), np.zeros(len(kind), bool)]
    return of[keep], place[keep], [typed | x for x in names], [np.where(x, PLACEHOLDER[CAPITAL], word) for x in names]


def windows(texts: list[bytes | None], size: int, sift: np.ndarray | None) -> list[tuple[np.ndarray, list[list[str]]]]:
    """For each text the hashes of the first form of its template windows and the slots of each."""
    return [(h[f == 0], [x for x, form in zip(s, f, strict=True) if not form]) for h, s, _, f in placed(texts, size, sift)]


def placed(texts: list[bytes | None], size: int, sift: np.ndarray | None) -> list[tuple[np.ndarray, list[list[str]], np.ndarray, np.ndarray]]:
    """For each text the hashes of its template windows, the slots of each, its place and form; with sift only the
    windows in it. A text of fewer tokens is one window; one without tokens has none. A form that is like an earlier
    one of the same window doesn't come."""
    found = [TOKEN.findall((t or b"").decode("utf-8", "replace")) for t in texts]
    of, place, slot, words = templates(found)
    tokens = np.bincount(of, minlength=len(texts))
    first = np.cumsum(tokens) - tokens
    width = np.minimum(size, tokens)
    every = np.flatnonzero(np.arange(len(of)) - first[of] <= (tokens - width)[of])
    parts = []
    for form in range(FORMS):
        starts = every
        for earlier in range(form):
            apart = np.concatenate(([0], np.cumsum(slot[form] != slot[earlier])))
            starts = starts[apart[starts + width[of[starts]]] > apart[starts]]
        n = width[of[starts]]
        hashes = n.astype(np.uint64)
        for j in range(size):
            more = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[form][np.minimum(starts + j, len(of) - 1)] * FACTORS[j] if len(starts) else hashes
            hashes = np.where(j < n, more, hashes)
        if sift is not None:
            hit = np.flatnonzero(sift[np.minimum(np.searchsorted(sift, hashes), len(sift) - 1)] == hashes) if len(sift) else np.zeros(0, int)
            starts, hashes, n = starts[hit], hashes[hit], n[hit]
        parts.append((starts, hashes, n, np.full(len(starts), form)))
    starts, hashes, n, forms = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((forms, starts))
    starts, hashes, n, forms = starts[order], hashes[order].view(np.int64), n[order], forms[order]
    masks = [x.tolist() for x in slot]
    slots = [[found[of[i]][place[i]].lower() for i in range(p, p + m) if masks[f][i]] for p, m, f in zip(starts.tolist(), n.tolist(), forms.tolist(), strict=True)]
    bounds = np.searchsorted(of[starts], np.arange(len(texts) + 1)).tolist()
    places = starts - first[of[starts]]
    return [(hashes[a:b], slots[a:b], places[a:b], forms[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


def template_windows(df: DataFrame, carry: list[str], size: int = WINDOW, sift: np.ndarray | None = None) -> DataFrame:
    """Columns `carry`, and wh (window hash), slots, at (its place), form, a row for each form of each template window of
    text."""
    shared = df.sparkSession.sparkContext.broadcast(sift)

    def run(texts: list[bytes | None]) -> list:
        made = placed(texts, size, shared.value)
        return [[[{"wh": w, "slots": s, "at": p, "form": f} for w, s, p, f in zip(x.tolist(), slots, at.tolist(), forms.tolist(), strict=True)] for x, slots, at, forms in made], [len(x) for x, *_ in made]]

    rows = map_texts(df, run, "w array<struct<wh:long,slots:array<string>,at:long,form:int>>, _many long", carry)
    return rows.filter("_many > 0").select(*carry, F.explode("w").alias("w")).select(*carry, "w.*")


def leaks(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, similarity: float = SIMILARITY, sift_rows: int = SIFT) -> DataFrame:
    """doc_id, item_id, matched, n_windows, share: the pairs where a document holds at least `similarity` of the distinct
    template windows of a benchmark item (item_id, text), counting the windows with consistent slots.

    That is tried on the whole document and on each part of it where the windows lie about as far from the document's
    start as from the item's, so that passages of one template with other fillings don't break each other. A window
    counts if one of its forms and fillings is consistent.

    A slot of an item is consistent where the document fills it as it does in most of the windows that have it (ties
    to the text that sorts first); of names that the document fills with one and the same text only that with the
    most windows is. Texts that are null or empty, and those without letters or digits, match nothing; an item of
    fewer than `size` tokens is one window. Rows with the same doc_id are one document, as are items with the same
    item_id. Rows without doc_id or item_id take no part. Further columns of either table don't matter. Empty tables
    give an empty result. A text is worked on whole in one task, with about 150 bytes a token there.

    A pair that holds the share of n windows has one of any n - ceil(similarity n) + 1 of them. So documents and items
    first meet under the item's rarest windows only, and a template that many documents hold isn't multiplied by all
    items that have it.
    """
    items = template_windows(benchmark.select("item_id", "text").filter("item_id is not null"), ["item_id"], size)
    items = stored(items.groupBy("item_id", "at", "form", "wh").agg(F.min("slots").alias("item_slots")), "items")
    own = items.filter("form = 0").groupBy("item_id", "wh").agg(F.min("at").alias("at")).select("item_id", "at")
    items = stored(items.join(own, ["item_id", "at"]).drop("form").withColumnRenamed("at", "item_at"), "items")
    sizes = own.groupBy("item_id").agg(F.count("*").alias("n_windows"), F.greatest(F.lit(4), F.floor((F.max("at") + size) / 4)).alias("step"))
    hashes = items.select("wh").distinct()
    small = hashes.limit(sift_rows + 1).count() <= sift_rows
    sift = np.sort(hashes.toArrow().column(0).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) if small else None
    rows = stored(template_windows(docs.select("doc_id", "text").filter("doc_id is not null"), ["doc_id"], size, sift).drop("form"), "windows")

    wanted = F.ceil(F.col("n_windows") * similarity - 1e-9)
    often = items.join(rows.groupBy("wh").agg(F.count("*").alias("n")), "wh", "left").groupBy("item_id", "item_at").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    rarest = often.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy("n", "item_at"))).join(sizes, "item_id")
    rarest = items.join(rarest.filter(F.col("rank") <= F.col("n_windows") - wanted + 1).select("item_id", "item_at"), ["item_id", "item_at"]).select("item_id", "wh").distinct()
    pairs = stored(rows.select("doc_id", "wh").distinct().join(stored(rarest, "rarest"), "wh").select("doc_id", "item_id").distinct(), "pairs")

    part = F.floor((F.col("at") - F.col("item_at")) / F.col("step"))
    met = rows.join(pairs, "doc_id").join(items, ["item_id", "wh"]).join(sizes, "item_id").withColumn("part", F.explode(F.array(F.lit(WHOLE), part, part - 1)))
    met = met.select("doc_id", "item_id", "part", "item_at", "slots", "item_slots").distinct()
    met = stored(met.withColumn("_row", F.monotonically_increasing_id()), "met")
    slot = met.select(*PART, "_row", F.explode(F.arrays_zip("item_slots", "slots")).alias("s")).select(*PART, "_row", "s.item_slots", "s.slots")
    usual = slot.groupBy(*PART, "item_slots", "slots").agg(F.count("*").alias("n"))
    usual = usual.groupBy(*PART, "item_slots").agg(F.min(F.struct((-F.col("n")).alias("n"), "slots")).alias("u")).select(*PART, "item_slots", "u.n", F.col("u.slots").alias("usual"))
    usual = stored(usual, "usual")
    name = ~F.col("item_slots").rlike(r"^\d") & ~F.col("item_slots").isin(*sorted(UNITS))
    first = usual.filter(name).groupBy(*PART, "usual").agg(F.min(F.struct("n", "item_slots"))["item_slots"].alias("owner"))
    usual = usual.join(first, [*PART, "usual"], "left").withColumn("usual", F.when(~name | (F.col("item_slots") == F.col("owner")), F.col("usual")))
    broken = merged(slot, usual.select(*PART, "item_slots", "usual"), [*PART, "item_slots"]).filter("not slots <=> usual").select("_row").distinct()
    kept = met.join(broken, "_row", "left_anti").groupBy(*PART).agg(F.count_distinct("item_at").alias("matched"))
    kept = kept.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"))
    out = kept.join(sizes, "item_id").withColumn("share", F.col("matched") / F.col("n_windows"))
    return out.filter(F.col("matched") >= wanted).select("doc_id", "item_id", "matched", "n_windows", "share")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """docs without the documents that leaks() finds. Rows without doc_id stay."""
    found = leaks(docs, benchmark, **how).select(F.col("doc_id").alias("_found")).distinct()
    return docs.join(found, docs.doc_id == found["_found"], "left_anti")


def op2_template_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
