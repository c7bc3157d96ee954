"""The corpus pipeline: language ID, line dedup, near-dedup, decontamination and mixing, one operator after another.

Every stage takes the columns that it works on and carries the row as it was under a name of its own, so further
columns of docs may have any names. An empty table gives an empty one. Null texts are empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.llm import decontaminate, langid, linededup, mixing, nearcopies
from flowmart.llm.common import crc_fold, stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, those of several languages too; lang is left as it is.

    The model learns from the rows with text and lang whose crc32(doc_id) mod 4 is not 2. What goes is `und`: texts
    that are null or hold no letter, and all texts if there is nothing to learn from. Repeated rows fare alike.
    """
    model = langid.fit(docs.filter(crc_fold(F.col("doc_id"), 4) != 2))
    told = langid.label_languages(docs.select(F.struct(*docs.columns).alias("own"), "text"), model, ["own"])
    return told.filter(F.col("lang_pred") != "und").select("own.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents less their repeated lines; n_chars follows the text.

    No row goes: a text of which nothing is left is empty. Rows that share a doc_id are one document, rows without
    doc_id together one below all others; of the documents that hold a repeated line the largest doc_id keeps it.
    """
    out = linededup.dedup_lines(docs.select(F.struct(*docs.columns).alias("own"), "doc_id", "text"))
    made = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[made.get(c, F.col("own")[c]).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) one document, with the smallest doc_id.

    Rows that share a doc_id are told apart by their texts: each goes or stays by its own group, and of a group's
    texts under that smallest doc_id the one with the least hash stays. Of repeated rows (doc_id and text) one stays,
    the least as JSON. Texts without words are copies of one another. Rows without doc_id stay.
    """
    hashed = [F.xxhash64(F.lit(i), F.col("text")) for i in (0, 1)]
    rows = docs.select("doc_id", "text", *[h.alias(f"t{i}") for i, h in enumerate(hashed)])
    found = stored(nearcopies.near_copies(rows, ("t0", "t1")), "copies")
    first = found.filter("doc_id = component_id").groupBy("doc_id").agg(F.min(F.struct("t0", "t1")).alias("kept"))
    gone = found.filter("doc_id != component_id").select("doc_id", "t0", "t1")
    gone = gone.unionByName(found.filter("doc_id = component_id").join(first, "doc_id").filter(F.struct("t0", "t1") != F.col("kept")).select("doc_id", "t0", "t1")).distinct()
    again = found.groupBy("doc_id", "t0", "t1").count().filter("count > 1").select("doc_id", "t0", "t1")
    marks = gone.selectExpr("*", "true as gone", "false as again").unionByName(again.selectExpr("*", "false as gone", "true as again"))
    marks = marks.groupBy("doc_id", "t0", "t1").agg(F.max("gone").alias("gone"), F.max("again").alias("again"))
    # One join by the keys that repeated rows are then grouped by, so that the texts are sent once. A row that isn't repeated is a group of its own.
    own = docs.select(F.struct(*docs.columns).alias("own"), F.col("doc_id").cast("long").alias("doc_id"), *[h.alias(f"t{i}") for i, h in enumerate(hashed)])
    left = own.join(marks, ["doc_id", "t0", "t1"], "left").filter("not coalesce(gone, false)").withColumn("again", F.coalesce("again", F.lit(False)))
    left = left.withColumn("row", F.when(F.col("again"), -1).otherwise(F.monotonically_increasing_id()))
    once = left.groupBy("doc_id", "t0", "t1", "row").agg(F.min_by("own", F.when(F.col("again"), F.to_json("own")).otherwise("")).alias("own"))
    return once.select("own.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without those that hold a benchmark item, or an item asked anew with other numbers and names.

    Rows that share a doc_id are one document. Null and empty texts and rows without doc_id stay.
    """
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says, with size and copy_no, where docs has no columns of those names.

    Rows that share a doc_id fare alike. Documents without words come as often as others, and take no words.
    """
    mixed = mixing.emitted(mixing.mix(docs.select(F.struct(*docs.columns).alias("own"), "doc_id", "text", "source")))
    return mixed.select("own.*", *[c for c in ("size", "copy_no") if c not in docs.columns])


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixture", mixture)]

#: The labels of the random field aren't expressible in SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written before the next one reads it; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
