"""The stages one after another, and that their decisions take effect."""

import itertools
import random
import re

from pyspark.sql import functions as F

import corpus_pipeline
from flowmart.llm import common, decontaminate, minhash, nearcopies, simhash
from tests.llm.test_operators import DE, EN, FR, LINE, QUESTION, prose

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages(spark, tmp_path):
    random.seed(1)
    rows = [(i, f"{prose(w, 70)}\n{LINE}", x, f"s{i % 3}", 1) for i, (w, x) in enumerate([(EN, "en"), (FR, "fr"), (DE, "de")] * 12)]
    rows += [(199, (copy := prose(FR, 50)), "fr", "s1", 1), (200, copy, "fr", "s1", 1), (201, None, "en", "s1", 1), (202, "12 ?", "en", None, 1), (203, f"{prose(EN, 30)} {QUESTION} {prose(EN, 30)}", "en", "s2", 1), (None, prose(DE, 60), "de", "s0", 1)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, QUESTION)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, ids = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path)).cache()
        if name != "mixture":
            assert docs.columns == COLUMNS.replace(" long", "").replace(" string", "").split(", ")
        ids[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "lines":
            assert docs.filter(F.col("text").contains(LINE)).count() == 1 and docs.filter("n_chars != char_length(text)").count() == 0
    every = {r[0] for r in rows}
    assert ids["language"] == ids["lines"] == every - {201, 202}
    assert ids["near_duplicates"] == every - {201, 202, 200}
    assert ids["decontamination"] == every - {201, 202, 200, 203}
    assert ids["mixture"] <= ids["decontamination"]
    out = corpus_pipeline.run(spark, str(tmp_path))
    key = ["doc_id", "copy_no"]
    assert sorted(map(str, out.select(key).collect())) == sorted(map(str, docs.select(key).collect()))
    left = out.dropDuplicates(["doc_id"])
    assert simhash.near_duplicates(left.filter("doc_id is not null")).filter("doc_id != component_id").count() == 0
    assert decontaminate.leaks(out, spark.read.parquet(f"{tmp_path}/benchmark.parquet")).count() == 0


def exploded_broadcasts(df):
    """The broadcasts of the plan that hold an explode below no shuffle, whose size Spark takes from before it."""
    lines, found = df._jdf.queryExecution().executedPlan().toString().splitlines(), []
    depth = [re.search(r"[A-Za-z]|$", x).start() for x in lines]
    for i, x in enumerate(lines):
        if "BroadcastExchange" in x:
            below = list(itertools.takewhile(lambda y: depth[y] > depth[i] and "Exchange hashpartitioning" not in lines[y], range(i + 1, len(lines))))
            found += [lines[y] for y in below if "Generate" in lines[y]]
    return found


def test_no_explode_is_broadcast(spark, monkeypatch):
    """On small tables, of which Spark broadcasts any other. What was broadcast held up to 200 rows for each of the table that it was sized by."""
    random.seed(3)
    plans = []
    for module in (decontaminate, minhash, nearcopies, simhash):
        monkeypatch.setattr(module, "stored", lambda df, label: plans.append(df) or common.stored(df, label))
    text = prose(EN, 300)
    docs = [(i, f"{prose(EN, 300)} {QUESTION}") for i in range(4)] + [(10 + i, " ".join([*text.split()[i:], "tail"])) for i in range(8)] + [(30 + i, f"{text} {prose(EN, 20 + i)}") for i in range(8)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    for made in (lambda: simhash.near_duplicates(docs), lambda: nearcopies.near_copies(docs, large=2), lambda: minhash.near_duplicates(docs), lambda: decontaminate.leaks(docs, items)):
        plans.clear()
        assert made().count() and len(plans) > 1
        plans.append(made())
        assert any("BroadcastExchange" in x._jdf.queryExecution().executedPlan().toString() for x in plans)
        assert [x for p in plans for x in exploded_broadcasts(p)] == []


def test_several_languages_stay(spark, tmp_path):
    rows = [(i, prose(w, 40), x, "s", 1) for i, (w, x) in enumerate([(EN, "en"), (FR, "fr"), (DE, "de")] * 12)]
    rows.append((100, f"{prose(EN, 40)} {prose(FR, 40)} {prose(DE, 40)}", "en", "s", 1))
    docs = spark.createDataFrame(rows, COLUMNS)
    assert corpus_pipeline.language(spark, docs, str(tmp_path)).filter("doc_id = 100").count() == 1


CLASHES = "score double, lang_pred string, _id long, _kept string, _lines int, _drop int, n_lines long, h int, t0 int, own string, size int, target int, taken int, copies int, rate int, source_size int, wh int, component_id int"


def test_clashing_names_and_repeats(spark, tmp_path):
    """Further columns come through every stage, rows that share a doc_id are told apart, of repeated rows one stays."""
    random.seed(2)
    copy, own = prose(EN, 60), prose(EN, 60)
    texts = [(i, f"{prose(w, 60)}\n{LINE}", x, f"s{i % 2}", 1) for i, (w, x) in enumerate([(EN, "en"), (FR, "fr")] * 8)]
    texts += [(50, copy, "en", "s0", 1), (51, copy, "en", "s0", 1), (51, own, "en", "s0", 1), (51, own, "en", "s0", 1), (52, prose(EN, 40_000), "en", "s1", 1), (53, "", "en", "s1", 1)]
    clash = (0.25, "x", 7, "k", 3, 4, 5, 6, 8, "o", 9, 10, 11, 12, 13, 14, 15, 16)
    docs = spark.createDataFrame([(*t, *clash) for t in texts], f"{COLUMNS}, {CLASHES}")
    spark.createDataFrame([(1, QUESTION)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/in")
    now = spark.read.parquet(f"{tmp_path}/in")
    names = now.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        rows = now.collect()
        assert now.columns == (names if name != "mixture" else [*names, "copy_no"]) and rows
        assert {tuple(r[5 : 5 + len(clash)]) for r in rows} == {clash}
        if name == "near_duplicates":
            assert sorted(r.text for r in rows if r.doc_id in (50, 51)) == sorted([copy, own])
        none = stage(spark, spark.createDataFrame([], docs.schema), str(tmp_path))
        assert none.count() == 0


def test_near_duplicates_send_texts_once(spark):
    """Among near copies and repeated rows. What the result's shuffles hold is little more than the texts; it was twice that before."""
    r = random.Random(5)
    words = lambda n: " ".join(f"{r.getrandbits(64):x}" for _ in range(n))
    docs = [(i, words(400), "en", f"s{i % 3}", 1) for i in range(300)]
    docs += [(i + 1000, f"{t} {words(4)}", "en", "s1", 1) for i, t, *_ in docs[:40]] + docs[50:60] + [(i, t, "fr", None, 2) for i, t, *_ in docs[55:65]] + [(1000, docs[0][1], "en", "s0", 1), (None, docs[1][1], "en", "s1", 1), (None, docs[1][1], "en", "s1", 1)]
    df, sc = spark.createDataFrame(docs, COLUMNS).repartition(3).cache(), spark.sparkContext
    df.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out = corpus_pipeline.near_duplicates(spark, df, "")
    sc.setJobGroup("texts_once", "")
    got = sorted((-1 if x.doc_id is None else x.doc_id, x.lang) for x in out.collect())
    sc.setLocalProperty("spark.jobGroup.id", None)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [(-1, "en"), (-1, "en"), *[(i, "en") for i in range(300)]]
    stages = {i for j in sc.statusTracker().getJobIdsForGroup("texts_once") for i in sc.statusTracker().getJobInfo(j).stageIds}
    sent = sum(sc._jsc.sc().statusStore().lastStageAttempt(i).shuffleWriteBytes() for i in stages)
    assert 0 < sent < 1.5 * sum(len(t) for _, t, *_ in docs)
