"""Each operator against a brute-force version, and on odd tables: nulls, empty and long texts, ties, repeated rows,
no rows, and extra columns whose names clash with the operator's own."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from flowmart.llm import collocations, decontaminate, interpolation, langid, linededup, minhash, mixing, nearcopies, permindex, quality, simhash, toxicity, urlfilter, whitening
from flowmart.llm.common import crc_fold, hashed_sample

rng = random.Random(4)
EN, FR, DE = "the of and to in is that it was for with", "le la de et les des un une que pour", "der die und das zu den von mit ist auf"
LONG = " ".join(rng.choice(EN.split()) for _ in range(30_000))
LINE = "This line is long enough to be looked at by the operator, is it not"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, h long, key string, part int, _row int"


def prose(words, n):
    return " ".join(rng.choice(words.split()) + rng.choice(["", "s", "en", "er"]) for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame([(*r, 5, 0.5, "x", 1, "k", 9, 7) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, f"{prose(w, 60)}\n{LINE}", x, f"s{i % 3}") for i, (w, x) in enumerate([(EN, "en"), (FR, "fr"), (DE, "de")] * 8)]
    rows += [(100, None, "en", "s0"), (101, "", None, None), (102, " \t\n ", "en", None), (103, "?! 12", "en", "s0"), (104, LONG, "en", "s1")]
    rows += [(None, rows[0][1], "en", "s0"), (None, None, None, None), (3, rows[3][1], "en", "s0"), (105, rows[0][1], "en", None), (106, rows[0][1] + " tail", "en", "s9")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, odd):
    return table(spark, odd).cache()


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


def crc(i, n):
    return zlib.crc32(b"" if i is None else str(i).encode()) % n


def test_fold(docs):
    for r in docs.select("doc_id", crc_fold(F.col("doc_id"), 4).alias("f")).collect():
        assert r.f == crc(r.doc_id, 4)


def test_sample_counts_texts_once(spark):
    rows = [(f"text {i}", "en") for i in range(100)] + [("hot", "en")] * 20_000 + [(f"texte {i}", "fr") for i in range(5)]
    drawn = hashed_sample(spark.createDataFrame(rows, "text string, lang string"), "lang", 50)
    assert sum(r.lang == "en" for r in drawn) >= 40 and sum(r.lang == "fr" for r in drawn) == 5 and len(set(drawn)) == len(drawn)


def test_language(docs, none):
    model = langid.fit(docs.filter(crc_fold(F.col("doc_id"), 4) != 2), fit_docs=50)
    out = langid.label_languages(docs, model, spans=True).collect()
    assert len(out) == docs.count() and set(out[0].asDict()) == {*docs.columns, "lang_pred", "score", "n_words", "spans"}
    for r in out:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0)
        elif r.lang and r.doc_id is not None and r.doc_id < 100 and r.doc_id != 3:
            assert r.lang_pred == r.lang and sum(s.words for s in r.spans) == r.n_words
        assert 0 <= r.score <= 1
    switched = model.label([(prose(FR, 40) + " " + prose(DE, 40)).encode()], True)[3][0]
    assert [s["lang"] for s in switched if s["words"] > 20] == ["fr", "de"]
    assert langid.label_languages(none, model).count() == 0
    assert {r.lang_pred for r in langid.label_languages(docs, langid.fit(none)).collect()} == {"und"}


def test_language_of_short_texts(spark):
    rows = [(prose(w, 5 + i % 16), x) for i in range(60) for w, x in ((EN, "en"), (FR, "fr"), (DE, "de"))]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    held = [(prose(w, 8).encode(), x) for _ in range(40) for w, x in ((EN, "en"), (FR, "fr"), (DE, "de"))]
    got, score, _ = model.label([t for t, _ in held])
    assert sum(g == x for g, (_, x) in zip(got, held, strict=True)) >= 110 and np.median(score) > 0.5


def test_forward_backward_is_exact(docs):
    model = langid.fit(docs, fit_docs=50)
    for text in (b"", b"the", prose(EN, 200).encode(), (prose(FR, 33) + " " + prose(DE, 97)).encode()):
        w = langid.Words([text])
        total, best = model.marginals(langid.Words([b"und zu", text, b""]))
        if not len(w.of):
            assert not total[1].any()
            continue
        e = model.scores(w).astype(float)
        e, t = np.exp(np.maximum(e - e.max(1, keepdims=True), -60)), np.exp(model.trans - model.trans.max())
        a, b, now = np.zeros_like(e), np.ones_like(e), np.full(e.shape[1], 1 / e.shape[1])
        for i in range(len(e)):
            now = now @ t * e[i]
            now = a[i] = now / now.sum()
        for i in range(len(e) - 2, -1, -1):
            b[i] = t @ (e[i + 1] * b[i + 1])
            b[i] /= b[i].sum()
        g = a * b / (a * b).sum(1, keepdims=True)
        assert np.allclose(g.sum(0), total[1], atol=1e-3)


def broadcast_joins(df):
    """How many joins of the plan broadcast a side, as it was planned and as it ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin")


def test_variants_are_not_broadcast(spark):
    """A table of a few bytes a row is sized as that after an explode, too; its variants were gathered in the driver."""
    reps = spark.range(2000).select(F.xxhash64("id").alias("fp"), F.col("id").alias("rep")).cache()
    assert reps.count() and broadcast_joins(reps.join(reps.withColumnRenamed("rep", "r2"), "fp")) > 0
    assert broadcast_joins(simhash.links(reps)) == 0


def brute_fp(text):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hs = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hs) * 2 > len(hs))


def test_simhash(spark, docs, none):
    out = simhash.near_duplicates(docs).collect()
    want = collections.Counter((r.doc_id, brute_fp(r.text)) for r in docs.collect())
    assert collections.Counter((r.doc_id, r.fp % (1 << 64)) for r in out) == want
    fps = [(i, f) for i, f in want if i is not None]
    root = {i: i for i, _ in fps}
    for _ in range(len(root)):
        for i, f in fps:
            for j, g in fps:
                if (f ^ g).bit_count() <= 2:
                    root[i] = root[j] = min(root[i], root[j])
    assert {(r.doc_id, r.component_id) for r in out if r.doc_id is not None} == set(root.items()) 
    assert simhash.near_duplicates(none).count() == 0


def test_links_and_components(spark):
    r = random.Random(7)
    seeds = [r.getrandbits(64) for _ in range(40)]
    fps = sorted({s ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for s in seeds for _ in range(12)} | {0, 1, 3, 7, 1 << 63})
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    reps = spark.createDataFrame([(signed(f), i) for i, f in enumerate(fps)], "fp long, rep long")
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if (fps[i] ^ fps[j]).bit_count() <= 2}
    got = simhash.links(reps)
    assert {tuple(x) for x in got.collect()} == want
    root = list(range(len(fps)))
    for _ in fps:
        for i, j in want:
            root[i] = root[j] = min(root[i], root[j])
    assert {tuple(x) for x in simhash.components(got).collect()} == {(i, x) for i, x in enumerate(root) if i != x}
    chain = spark.range(300).selectExpr("id as a", "id + 1 as b")
    assert simhash.components(chain).filter("root != 0").count() == 0


def candidates(x, y):
    """Whether two wide fingerprints share a variant and agree enough elsewhere, and in how many bits they don't."""
    diff = [(a ^ b) & (1 << 64) - 1 for a, b in zip(x, y, strict=True)]
    bits = sum((d >> 48).bit_count() for d in diff)
    return bits <= nearcopies.CHECK_BITS and any((d >> at & 0xFFFFFF).bit_count() <= 1 for d in diff for at in (0, 24)), bits


def test_near_copies(spark, none):
    r = random.Random(3)
    five = lambda t: {tuple(t.lower().split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))}
    texts = []
    for _ in range(12):
        words = [f"w{r.randrange(5000)}" for _ in range(150)]
        texts.append(" ".join(words))
        for n in (1, 2, 5, 12):
            other = list(words)
            for i in r.sample(range(150), n):
                other[i] = "changed"
            texts.append(" ".join(other))
    texts += [f"{'the same line again and once more ' * 60}{x}" for x in (" ".join(f"{y}{i}" for i in range(60)) for y in "abc")]
    texts += [texts[0].upper(), "one two", None, ""]
    pairs = [(i, j) for i, a in enumerate(texts) for j in range(i) if a and (b := texts[j]) for x in [five(a)] for y in [five(b)] if len(x & y) >= 0.8 * len(x | y)]
    assert len(pairs) > 30 and any((brute_fp(texts[i]) ^ brute_fp(texts[j])).bit_count() > 2 for i, j in pairs)
    wide = [nearcopies.wide_fingerprint(simhash.shingles(simhash.words_hashed((t or "").encode(), simhash.WordHashes()), 2)) for t in texts]
    near = [(i, j) for i, j in pairs if candidates(wide[i], wide[j])[0]] + [(len(texts) - 1, len(texts) - 2)]
    assert len(near) > 0.9 * len(pairs)
    root = list(range(len(texts)))
    for _ in texts:
        for i, j in near:
            root[i] = root[j] = min(root[i], root[j])
    rows = table(spark, [(i, t, "en", "s") for i, t in enumerate(texts)] + [(None, texts[0], "en", "s")])
    for large in (nearcopies.LARGE, 2):
        assert {tuple(x) for x in nearcopies.near_copies(rows, large=large).collect()} == set(enumerate(root))
    assert nearcopies.near_copies(none).count() == 0


def test_nearby_pairs(spark):
    """All pairs that share a variant and no component, whether components are large or not."""
    r = random.Random(8)
    seeds = [[r.getrandbits(64) for _ in range(4)] for _ in range(10)]
    fps = [[w ^ sum(1 << b for b in r.sample(range(64), r.choice((0, 1, 2, 6)))) for w in s] for s in seeds for _ in range(8)]
    comp = [r.choice((None, 1, 2, 3)) for _ in fps]
    size = collections.Counter(comp)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    nodes = spark.createDataFrame([(i, *map(signed, f), 9, 9, c, size[c] if c else 1) for i, (f, c) in enumerate(zip(fps, comp, strict=True))], "h long, w0 long, w1 long, w2 long, w3 long, n long, most long, c long, members long")
    pairs = [(i, j, *candidates(fps[i], fps[j])) for j in range(len(fps)) for i in range(j) if comp[i] is None or comp[i] != comp[j]]
    want = {(i, j) for i, j, met, _ in pairs if met}
    assert want
    for large in (1000, 10):
        got = [tuple(x) for x in nearcopies.nearby(nodes, 80, large).collect()]
        assert set(got) == want and len(got) == len(want)


def brute_lines(rows, min_chars=40, min_docs=5):
    key = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))
    lines = [((-1 if i is None else i), (t or "").split("\n")) for i, t in rows]
    holds = collections.defaultdict(set)
    for i, ls in lines:
        for x in ls:
            holds[key(x)].add(i)
    out = []
    for i, ls in lines:
        kept = [x for x in ls if len(key(x)) < min_chars or len(holds[key(x)]) < min_docs or max(holds[key(x)]) == i]
        out.append((i, len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return collections.Counter(out)


def test_lines(docs, none):
    out = linededup.dedup_lines(docs)
    assert out.columns == [*[c for c in docs.columns], "n_lines", "n_dropped"]
    got = collections.Counter((-1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in out.collect())
    assert got == brute_lines([(r.doc_id, r.text) for r in docs.collect()]) and sum(n * k[2] for k, n in got.items()) > 20
    assert linededup.dedup_lines(none).count() == 0


def test_columns_of_any_name_stay(docs):
    clash = docs.withColumns({c: F.concat(F.lit("x"), F.col("doc_id").cast("string")) for c in ("_id", "_lines", "_drop", "_kept", "own", "part")})
    part = F.when(F.col("doc_id") % 3 == 0, interpolation.HELD).otherwise(interpolation.KEPT)
    plain = lambda df: collections.Counter((r.doc_id, r.n_dropped, r.text) for r in df.collect())
    out = linededup.dedup_lines(clash)
    assert out.columns == [*clash.columns, "n_lines", "n_dropped"] and plain(out) == plain(linededup.dedup_lines(docs))
    scored = interpolation.log_score(clash, part)
    assert len(scored.columns) == len({*scored.columns, *clash.columns}) - 1
    for r in [*out.collect(), *scored.collect()]:
        want = None if r.doc_id is None else f"x{r.doc_id}"
        assert [r._id, r._lines, r._drop, r._kept, r.own, r.part] == [want] * 6


def test_line_runs_hold_each_key_once(spark):
    store = linededup.LineRuns(spark, fanout=2)
    fresh = [store.add(spark.createDataFrame([(h, h, 10 * n) for h in hs], "h1 long, h2 long, doc_id long")).count() for n, hs in enumerate([(1, 2), (2, 3), (1, 4), (5,), (5, 6)])]
    assert fresh == [2, 1, 1, 1, 1] and len(store.runs()) < 4
    assert {(r.h1, r.keeper) for r in store.keepers().collect()} == {(1, 0), (2, 0), (3, 10), (4, 20), (5, 30), (6, 40)}


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w, total, capped = {s: weights[i % 3] for i, s in enumerate(names)}, sum(sizes.values()), set()
    while True:
        rest = sum(w[s] for s in names if s not in capped)
        left = total - sum(most * sizes[s] for s in capped)
        t = {s: most * sizes[s] if s in capped else left * w[s] / rest for s in names}
        over = {s for s in names if s not in capped and t[s] > most * sizes[s] + 1e-9}
        if not over:
            return t
        capped |= over


def test_targets(spark):
    for sizes in ({"a": 10, "b": 1, "c": 500, "d": 3, None: 40}, {"a": 0, "b": 7}, {"a": 1, "b": 1000, "c": 1, "d": 1}, {"x": 5}):
        got = mixing.target_rates(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
        want = brute_targets(sizes)
        assert {r.source: pytest.approx(r.target) for r in got.collect()} == want
    assert mixing.target_rates(spark.createDataFrame([("a", 0)], "source string, source_size long")).first().rate == 0


def test_mix(spark, docs, none):
    out = mixing.mix(docs)
    rows = out.collect()
    again = {(r.doc_id, r.text, r.source, r.copies) for r in mixing.mix(docs.repartition(3)).collect()}
    assert len(rows) == docs.count() and {(r.doc_id, r.text, r.source, r.copies) for r in rows} == again
    size = lambda t: len((t or "").encode().split())
    sums = collections.Counter()
    for r in docs.collect():
        sums[r.source] += size(r.text)
    want = brute_targets(dict(sums))
    for r in rows:
        assert r.size == size(r.text) and r.source_size == sums[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.size * r.copies and math.floor(r.rate) <= r.copies <= math.floor(r.rate) + 1 and r.copies <= 3
    assert mixing.emitted(out).count() == sum(r.copies for r in rows)
    assert mixing.mix(none).count() == 0
    many = spark.range(3000).selectExpr("id as doc_id", "concat('w ', repeat('x ', cast(id % 50 as int))) as text", "concat('s', id % 7) as source")
    for r in mixing.mix(many).groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n")).collect():
        assert abs(r.n - r.t) < 0.15 * r.t


def test_urls(spark):
    urls = ["http://A.Example.com/en/12?x=1", "https://example.com/en/7", "http://m.example.com/en/71/a#b", "http://example.net/de/8", "http://x.net/de/1", "http://x.org/es/1",
            "http://x.org/fr", "no url", None, "", "http://", "http://com/en/", "ftp://badcom/en/", "http://h.com?q=/en/", "http://spam-farm.example.org/fr/1"]
    pages = spark.createDataFrame([(i, u, "h", "rule") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    more = [(f"http://{'spam' if i % 4 == 0 else 'good'}-{i}.example.com/a/{i}", int(i % 4 == 0)) for i in range(200)]
    out = {r.page_id: r for r in urlfilter.filter_urls(pages, labelled=spark.createDataFrame(more, "url string, label int")).collect()}
    rules = [out[i].rule for i in range(len(urls))]
    assert rules == ["com/en/", "example.com/en/7", "example.com/en/7", "example.net/de/8", "net/de/", "org/es/", None, None, None, None, None, "com/en/", None, None, None]
    assert [out[i].verdict for i in range(6)] == ["block", "allow", "allow", "block", "allow", "block"]
    assert (out[0].host, out[0].path) == ("a.example.com", "/en/12") and (out[7].host, out[7].path) == ("", "") == (out[8].host, out[8].path)
    assert (out[13].host, out[13].path) == ("h.com", "") and out[14].verdict == "block" and {r.verdict for r in out.values()} == {"allow", "block"}
    assert urlfilter.filter_urls(pages.limit(0)).count() == 0
    assert urlfilter.filter_urls(pages, rules=(), labelled=spark.createDataFrame([], "url string, label int")).filter("verdict = 'allow'").count() == len(urls)


QUESTION = "Early that day a train leaves Boston at 60 km per hour and after 3 hours it stops at the same Boston station again before noon on"


def test_leaks(spark, docs, none):
    texts = {1: QUESTION, 2: QUESTION.replace("Boston", "Paris").replace("60", "75"), 3: QUESTION.replace("same Boston", "same London").replace("60", "5"),
             4: "word " * 200 + QUESTION + " word" * 5000, 5: None, 6: "", 7: QUESTION[:40], 8: "60 3", 9: QUESTION.upper()}
    rows = table(spark, [(i, t, "en", "s") for i, t in [*texts.items(), (None, QUESTION), (1, QUESTION)]])
    items = spark.createDataFrame([(7, QUESTION), (8, None), (9, ""), (None, QUESTION), (10, "two words")], "item_id long, text string")
    for sift in (decontaminate.SIFT, 0):
        got = decontaminate.leaks(rows, items, sift_rows=sift).collect()
        assert {(r.doc_id, r.item_id) for r in got} == {(1, 7), (2, 7), (4, 7), (9, 7)}
    assert decontaminate.decontaminate(rows, items).count() == rows.count() - 5
    assert decontaminate.leaks(none, items).count() == 0 and decontaminate.leaks(rows, items.limit(0)).count() == 0


def test_leaks_beside_other_fillings(spark):
    ask = "At noon the baker {0} sells {1} loaves to the school and later {0} gives {2} rolls away so how many does the baker {0} still hold then"
    item = ask.format("Anna", 12, 7)
    docs = {1: f"At noon the baker Zed sells 5 loaves to the school. {'word ' * 40} {item}", 2: f"{ask.format('Ben', 3, 99)} {item} {ask.format('Carl', 88, 4)}",
            3: " ".join(ask.format(*x) for x in (("Ben", 3, 99), ("Carl", 88, 4), ("Dora", 5, 55))), 4: ask.format("Ben", 3, 99).replace("baker Ben still", "baker Eve still").replace("later Ben", "later Carl")}
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.leaks(rows, items).collect()} == {1, 2, 3}


def brute_leaks(docs, items, size=5, similarity=0.8):
    """Window by window, as leaks() describes it."""

    def forms(text):
        tokens, before = [], None
        for t in decontaminate.TOKEN.findall(text or ""):
            if t not in ".!?\n":
                title = len(t) > 1 and t[0].isupper() and t[1:].islower()
                kind = "n" if t[0].isdigit() else "u" if t.lower() in decontaminate.UNITS and before and before[0].isdigit() else "w"
                names = (title and before is not None and before not in ".!?\n", t != t.lower(), False) if kind == "w" else (False,) * 3
                tokens.append((t.lower(), kind, names))
            before = t
        k = min(size, len(tokens))
        for at in range(len(tokens) - k + 1 if k else 0):
            seen = []
            for f in range(3):
                w = [(x if not (kind != "w" or names[f]) else kind if kind != "w" else "name", kind != "w" or names[f], x) for x, kind, names in tokens[at : at + k]]
                made = (tuple(x for x, _, _ in w), tuple(slot for _, slot, _ in w)), tuple(x for _, slot, x in w if slot)
                if made[0][1] not in [m[0][1] for m in seen]:
                    seen.append(made)
                    yield at, f, *made

    found = set()
    for i, text in items:
        rows, first = list(forms(text)), {}
        for at, f, h, _ in rows:
            if f == 0:
                first.setdefault(h, at)
        n, step = len(first), max(4, (max(first.values(), default=0) + size) // 4)
        mine = [r for r in rows if r[0] in first.values()]
        for d, t in docs:
            met = collections.defaultdict(set)
            for at, _, h, slots in forms(t):
                for item_at, _, g, own in mine:
                    if g == h:
                        for part in (None, (at - item_at) // step, (at - item_at) // step - 1):
                            met[part].add((item_at, own, slots))
            for rows_ in met.values():
                fills = collections.Counter(p for _, own, slots in rows_ for p in zip(own, slots))
                usual = {}
                for (o, x), c in sorted(fills.items(), key=lambda p: (-p[1], p[0][1])):
                    usual.setdefault(o, (x, c))
                names = {o for o in usual if not o[0].isdigit() and o not in decontaminate.UNITS}
                owner = {}
                for o in sorted(names, key=lambda o: (-usual[o][1], o)):
                    owner.setdefault(usual[o][0], o)
                fine = {o: x for o, (x, _) in usual.items() if o not in names or owner[x] == o}
                if len({at for at, own, slots in rows_ if all(fine.get(o) == x for o, x in zip(own, slots))}) >= math.ceil(n * similarity - 1e-9):
                    found.add((d, i))
    return found


def test_leaks_against_brute_force(spark):
    """Openers, capitals, single letters, mixed case and two-word names; names swapped, merged and changed half-way."""
    tom = "Tom has 5 apples. Tom buys 3 more apples and gives 2 to Anna. How many apples does Tom have now?"
    xy = "If X is older than Y by 4 years and Y is 11 years old, how old will X be when Y turns 20?"
    two = "Each day Mary Lou McDonald drives from NASA to Fort Bragg in 35 min. Then Mary Lou McDonald walks 2 km back. How far does Mary Lou McDonald walk in 9 days?"
    items = [(1, tom), (2, xy), (3, two), (4, "4 km"), (5, "Why?"), (6, None), (7, tom.replace("apples", "pears"))]
    swap = lambda t, **how: " ".join("".join(how.get(x, x) for x in decontaminate.re.split(r"(\W)", w)) for w in t.split())
    docs = [swap(tom, Tom="Ben", **{"5": "9"}), tom.upper(), swap(xy, X="K", Y="Z", **{"4": "7"}), swap(two, Mary="Ann", Lou="Sue", McDonald="OHara", NASA="CERN", Fort="Lake"), swap(tom, Tom="Sue", Anna="Sue"),
            tom.replace("Tom buys", "Ben buys").replace("does Tom", "does Carl"), swap(xy, X="Y", Y="X"), xy.lower(), swap(tom, apples="plums"), "Filler words here. " * 30 + swap(two, **{"35": "80", "km": "miles"}) + " More words. " * 30,
            f"{tom} {swap(tom, Tom='Eve', Anna='Dan')}", "", None, "4 km", "9 miles away"]
    r = random.Random(9)
    for _ in range(25):
        w = r.choice((tom, xy, two)).split()
        for _ in range(r.randrange(4)):
            w[r.randrange(len(w))] = r.choice(["Tom", "tom", "Zoe", "77", "the", "Q", "UNO"])
        docs.append(" ".join(w))
    docs = list(enumerate(docs))
    want = brute_leaks(docs, items)
    assert {(0, 1), (1, 1), (2, 2), (3, 3), (9, 3), (10, 1)} <= want and (4, 1) not in want
    got = decontaminate.leaks(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, form int"), spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, wh int"))
    assert {(x.doc_id, x.item_id) for x in got.collect()} == want


def test_windows_by_hand():
    (hashes, slots), (none, _) = decontaminate.windows([b"Then 5 km. And 6 km and so on", b"..."], 3, None)
    assert len(none) == 0 and len(hashes) == 7 and len(set(hashes.tolist())) == 6 and ["5", "km"] in slots and ["6", "km"] in slots


def permutations_brute(x, ids, i, k):
    s = (x * x[i]).sum(1)
    s[ids == ids[i]] = -np.inf
    return [int(ids[j]) for j in np.lexsort((ids, -s))[:k] if s[j] > -np.inf]


def test_neighbours(spark):
    g = np.random.default_rng(1)
    x = g.standard_normal((400, 16)) * g.uniform(0.5, 2, (400, 1))
    x[200:230] = x[10]
    rows = [(i, [float(v) for v in r], 0, 1.0) for i, r in enumerate(x.astype(np.float32))]
    odd = [(900, None, 0, 0.0), (901, [0.0] * 16, 0, 0.0), (902, [None] + [1.0] * 15, 0, 0.0), (903, [float("nan")] * 16, 0, 0.0), (904, [1.0], 0, 0.0), (None, rows[0][1], 0, 0.0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, rank int, score double")
    x, ids = x.astype(np.float32).astype(float), np.arange(400)
    got = collections.defaultdict(list)
    for r in permindex.nearest(df, F.col("vec_id") % 20 == 0, block=150, query_block=8).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r)
    assert set(got) == set(range(0, 400, 20)) and all([r.rank for r in v] == list(range(1, 21)) for v in got.values())
    found = sum(len({r.vec_id for r in got[i]} & set(permutations_brute(x, ids, i, 20))) for i in got)
    assert found >= 0.9 * 20 * len(got)
    assert all(r.score == (x[r.vec_id] * x[i]).sum() for i, v in got.items() for r in v)
    exact = permindex.nearest(df, F.col("vec_id") == 200, rerank=1.0).orderBy("rank").collect()
    assert [r.vec_id for r in exact] == permutations_brute(x, ids, 200, 20)
    assert permindex.nearest(df.filter("vec_id < 5"), F.col("vec_id") == 0).count() == 4
    assert permindex.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def rated(spark):
    rows, marks = [], []
    for i in range(240):
        bad, junk = i % 3 == 0, i % 4 == 0
        text = " ".join(rng.choice(["scumbag", "vileness"]) if bad and rng.random() < 0.1 else prose(EN + " lamp tree stone river", 1) for _ in range(80)) + (" scumbag" if bad else "")
        rows.append((i, " | ".join(text.upper().split()) if junk else text, "en", "s"))
        marks.append((i, int(not junk), int(bad)))
    return table(spark, rows).cache(), labels(spark, [*marks, (None, 1, 1), (5000, 0, 1), (0, None, None)])


def test_toxicity(spark, docs, none, rated):
    model = toxicity.fit(rated[0], rated[1].filter(crc_fold(F.col("doc_id"), 5) != 0))
    out = toxicity.score_toxicity(rated[0], model, passages=True).collect()
    right = sum(r.predicted == int(r.doc_id % 3 == 0) for r in out)
    assert right >= 0.95 * len(out)
    found = [bool(r.passages) for r in out if r.doc_id % 3 == 0]
    assert sum(found) >= 0.7 * len(found) and not any(r.passages for r in out if r.doc_id % 3)
    odd = toxicity.score_toxicity(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd) and not any(r.predicted for r in odd if not r.text)
    assert toxicity.score_toxicity(none, model).count() == 0
    assert {r.predicted for r in toxicity.score_toxicity(docs, toxicity.fit(docs, labels(spark, []))).collect()} == {0}


def brute_segments(s):
    """The best segment, the shortest of equals, then the same on either side of it."""
    best = None
    for i in range(len(s)):
        for j in range(i + 1, len(s) + 1):
            t = sum(s[i:j])
            if t > 0 and (best is None or t > best[2] + 1e-9):
                best = (i, j, t)
    if not best:
        return []
    left, right = brute_segments(s[: best[0]]), brute_segments(s[best[1] :])
    return left + [best] + [(i + best[1], j + best[1], t) for i, j, t in right]


def test_segments():
    r = random.Random(5)
    for _ in range(200):
        s = [r.choice([-3, -1, 1, 2, 4]) + r.random() for _ in range(r.randint(0, 20))]
        got = toxicity.maximal_segments(np.array(s))
        assert [(i, j) for i, j, _ in got] == [(i, j) for i, j, _ in brute_segments(s)]


def test_quality(spark, docs, none, rated):
    model = quality.fit(rated[0], rated[1].filter(crc_fold(F.col("doc_id"), 5) != 0))
    out = quality.score_quality(rated[0], model).collect()
    assert sum(r.predicted == int(r.doc_id % 4 != 0) for r in out) >= 0.95 * len(out)
    texts = [r.text.encode() for r in rated[0].limit(20).collect()]
    near = quality.unit(quality.unit(quality.term_counts(texts) * model.idf) @ model.axes) @ model.vectors.T
    for row, got in zip(near, model.score(texts, block=7), strict=True):
        top = sorted(range(len(row)), key=lambda j: -row[j])[: quality.NEIGHBOURS]
        w = [max(row[j], 1e-3) ** quality.POWER * model.votes[j] for j in top]
        assert got == pytest.approx(sum(a * model.labels[j] for a, j in zip(w, top, strict=True)) / sum(w), abs=0.05)
    odd = quality.score_quality(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert quality.score_quality(none, model).count() == 0
    assert {r.score for r in quality.score_quality(docs, quality.fit(docs, labels(spark, []))).collect()} == {0.0}


def test_interpolation(spark, docs, none):
    part = F.when(crc_fold(F.col("doc_id"), 7) == 2, interpolation.OTHER).when(F.col("doc_id") % 5 == 0, interpolation.HELD).otherwise(interpolation.KEPT)
    out = interpolation.log_score(docs, part).collect()
    toks = lambda t: [*(t or "").encode().lower().split(), b"\n"]
    counts = collections.Counter(w for r in docs.collect() if crc(r.doc_id, 7) != 2 for w in toks(r.text))
    n, v = sum(counts.values()), len(counts)
    want = collections.Counter()
    for r in docs.collect():
        t = toks(r.text)
        want[r.doc_id, len(t), sum(counts[w] > 0 for w in t), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), 6)] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    own = [r for r in out if r.doc_id is not None and r.doc_id < 100]
    assert sum(r.score for r in own) > sum(r.base_score for r in own)
    assert interpolation.log_score(none, part).count() == 0


@pytest.mark.parametrize("fan", [4096, 3])
def test_interpolation_brute(spark, docs, monkeypatch, fan):
    """Over blocks of a few tokens and ranges of a few hashes, the scores are those of all words' and pairs' counts, and the estimates add up to 1."""
    part = F.when(F.col("doc_id") % 5 == 0, interpolation.HELD).otherwise(interpolation.KEPT)
    rows = docs.collect()
    toks = lambda t: [*(t or "").encode().lower().split(), b"\n"]
    pairs = collections.Counter(p for r in rows for w in [toks(r.text)] for p in zip([b"\n", *w], w, strict=False))
    words = collections.Counter(w for r in rows for w in toks(r.text))
    n, v = sum(words.values()), len(words)
    monkeypatch.setattr(interpolation, "BLOCK", 50)
    monkeypatch.setattr(interpolation, "RANGE", 20)
    monkeypatch.setattr(interpolation, "FAN", fan)
    model = interpolation.fit(docs, ["doc_id"], part)
    assert (model.n, model.distinct) == (n, v) and model.blocks.count() > 3

    def estimate(a, b):
        x = model.weights[words[a].bit_length()]
        return x[0] * pairs[a, b] / words[a] + x[1] * words[b] / n + x[2] / (v + 1)

    score = lambda t: round(sum(math.log10(estimate(a, b)) for a, b in zip([b"\n", *toks(t)], toks(t), strict=False)), 6)
    got = collections.Counter((r.doc_id, round(r.score, 6)) for r in interpolation.log_score(docs, part).collect())
    assert got == collections.Counter((r.doc_id, score(r.text)) for r in rows)
    for a in sorted(words)[:5]:
        assert sum(estimate(a, b) for b in words) + model.weights[words[a].bit_length(), 2] / (v + 1) == pytest.approx(1, abs=1e-6)


def test_interpolation_learns_weights():
    """With pairs that always hold, the weight goes to them; with pairs never seen, to the words."""
    sure, never = interpolation.log_cells(np.array([3, 4]), np.array([1.0, 0.0]), np.array([0.01, 0.25])).tolist()
    weights = interpolation.learn([(sure, 1000), (never, 1000)], 1e-4)
    assert weights[3, 0] > 0.95 and weights[4, 1] > 0.95 and np.allclose(weights.sum(1), 1)
