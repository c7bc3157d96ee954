"""MinHash near-dedup, whitening and collocations against brute force, on odd tables, and as registered queries."""

import collections
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowmart.llm import collocations, minhash, whitening
from flowmart.llm.queries import QUERIES

SMALLEST = "/root/testdata/sf0.001"


def five(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_groups(rows, percent=85):
    root = {i: i for i, _ in rows}
    sets = [(i, five(t)) for i, t in rows]
    links = [(i, j) for (i, a), (j, b) in itertools.combinations(sets, 2) if i == j or a and b and 100 * len(a & b) >= percent * len(a | b)]
    for _ in rows:
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])
    return root


def edited(r, words, n):
    out = list(words)
    for _ in range(n):
        i = r.randrange(len(out))
        out[i : i + r.choice((0, 1))] = [f"x{r.randrange(10**6)}"]
    return " ".join(out)


@pytest.mark.parametrize(("kept", "fine", "busy"), [(128, 1024, 32), (16, 64, 3)])
def test_minhash_against_all_pairs(spark, kept, fine, busy):
    """Families of copies with more and fewer edits, a passage that half of all share, repeats, odd rows."""
    r = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(50))
    texts = []
    for size in (6, 20, 90, 300):
        base = [f"w{r.randrange(3000)}" for _ in range(size)]
        texts += [" ".join(base), *(edited(r, base, n) for n in (0, 0, 1, 1, 2, 2, 3, 5, 8, 13))]
    texts += [f"{passage} {' '.join(f'q{i}-{j}' for j in range(5 + 3 * (i % 9)))}" for i in range(30)]
    texts += [texts[0].upper(), texts[13] + " \t\n", "one two", "ONE  two", "two one", None, "", " \n", "x " * 30_000, "y " * 30_000]
    rows = list(enumerate(texts)) + [(3, texts[40]), (5, texts[5])]
    want = brute_groups(rows)
    df = spark.createDataFrame([(i, t, 1, "k", 2) for i, t in rows] + [(None, texts[20], 1, "k", 2), (None, "nobody else", 1, "k", 2), (None, None, 1, "k", 2)], "doc_id long, text string, n int, sketch string, u int")
    out = minhash.near_duplicates(df, kept=kept, fine=fine, busy=busy).collect()
    assert collections.Counter((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in out if x.doc_id is not None) == collections.Counter((i, len(five(t)), want[i], want[i] == i) for i, t in rows)
    assert sorted((x.n_shingles, x.component_id, x.kept) for x in out if x.doc_id is None and x.component_id is not None) == [(len(five(texts[20])), want[20], False)]
    assert sorted(x.kept for x in out if x.doc_id is None) == [False, True, True]
    assert minhash.near_duplicates(df.filter("false")).count() == 0


def test_least_common():
    assert minhash.least_common(128, 100) == 128 and minhash.least_common(10, 85, 0.0) == 0
    r, c = np.random.default_rng(1), minhash.least_common(128, 85, 1e-3)
    drawn = r.binomial(128, 0.85, 200_000)
    assert (drawn < c).mean() <= 1.5e-3 and (drawn < c + 2).mean() > 1e-3


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40])
def test_eigenvectors(n):
    r = np.random.default_rng(n)
    a = r.standard_normal((n, n))
    for m in (a @ a.T, np.diag(r.integers(0, 3, n)).astype(float), np.ones((n, n)), np.zeros((n, n)), a @ np.diag(10.0 ** r.integers(-6, 6, n)) @ a.T, np.eye(n) * 1e-200):
        e, v = whitening.leading_components(m, 16)
        top = max(np.abs(m).max(), 1e-300)
        assert np.allclose(e / top, np.linalg.eigvalsh(m)[::-1][:16] / top, atol=1e-13 * n)
        assert np.allclose(v @ v.T, np.eye(len(v)), atol=1e-12) and np.allclose((m @ v.T - v.T * e) / top, 0, atol=1e-13 * n)


def test_whitening(spark):
    r = np.random.default_rng(3)
    vectors = [[float(np.float32(x)) for x in row] for row in r.standard_normal((200, 20)) * np.linspace(1, 3, 20)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(7, vectors[9]), (None, vectors[10]), (300, None), (301, []), (302, [1.0, None] + [0.0] * 18), (303, [float("nan")] * 20), (304, [float("inf")] * 20), (305, [1e300] * 20)]
    rows += [(400, [1.0, 2.0]), (401, [2.0, 2.0]), (402, [1.0, 2.0]), (500, [5.0] * 3)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, component int, x int")
    out = whitening.whiten(df).collect()
    x = np.floor(64 * np.array(vectors)).astype(int) + 1_000_000
    n, s = len(x), x.sum(0)
    mean = s / n
    v = (x - mean).T @ (x - mean) / n
    e, c = np.linalg.eigh(v)
    e, c = e[::-1][:16], c[:, ::-1][:, :16]
    white = (x - mean) @ c / np.sqrt(e)
    got = collections.defaultdict(dict)
    for g in out:
        got[g.vec_id if g.vec_id is None or g.vec_id != 7 or g.deviation == ((n * x[7] - s) ** 2).sum() else 9007][g.component] = g
    assert sum(g.vec_id not in (400, 401, 402, 500) for g in out) == 202 * 16 and not {300, 301, 302, 303, 304, 305, 500} & {g.vec_id for g in out}
    signs = {k: np.sign(got[0][k + 1].whitened * white[0, k]) for k in range(16)}
    for i in range(n):
        for k in range(16):
            g = got[i][k + 1]
            assert (g.n, g.deviation) == (n, ((n * x[i] - s) ** 2).sum()) and g.whitened * signs[k] == pytest.approx(white[i, k], abs=1e-8)
            assert g.explained == pytest.approx(e[k] / np.trace(v), rel=1e-9) and g.identity_error < 1e-9
    two = sorted((g.vec_id, g.component, g.n, g.deviation, g.explained) for g in out if g.vec_id in (400, 401, 402))
    assert two == [(i, 1, 2, 64**2, 1.0) for i in (400, 401, 402)]
    assert whitening.whiten(df.filter("false")).count() == 0
    with pytest.raises(ValueError, match="dimensions"):
        whitening.whiten(spark.createDataFrame([(1, [0.0] * 5_000)], "vec_id long, embedding array<double>"))


def test_deviations_beyond_a_long(spark):
    rows = [(0, [0.0, 1.0]), (1, [1e9, 1.0]), (2, [2e16, 3.0])]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=1).collect()
    x = [[64 * int(c) + 1_000_000 for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x, strict=True)]
    exact = [sum((3 * c - t) ** 2 for c, t in zip(v, s, strict=True)) for v in x]
    assert sorted((g.vec_id, g.deviation) for g in out) == [(i, d if d < 1 << 63 else None) for i, d in enumerate(exact)]


def brute_phrases(rows, least, inside=80, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        n[lang] += 0
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", "".join(c.lower() if c.isascii() else c for c in text or "")):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    longest = collections.Counter()
    for (lang, w), a in cands.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                longest[lang, w[i : i + k]] = max(longest[lang, w[i : i + k]], a)
    made = collections.defaultdict(list)
    for (lang, w), a in cands.items():
        cut = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        if 100 * longest[lang, w] < inside * a:
            made[lang].append((-cut[0], -a, " ".join(w).encode(), f[lang, w[: cut[1]]], f[lang, w[cut[1] :]]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, all_ in made.items() for i, (s, a, p, left, right) in enumerate(sorted(all_)[:top]))


@pytest.mark.parametrize("block", [1_000_000, 40])
def test_collocations_against_counting(spark, monkeypatch, block):
    """Blocks that cut texts, ends of pieces, blanks of all kinds, zero bytes, accents, languages, repeats, odd rows."""
    monkeypatch.setattr(collocations.blocks, "__defaults__", (block,))
    r = random.Random(5)
    words = ["a", "B", "cé", "ÉD", "d\x00", "ee-f", "g", " ", "日本"]
    text = lambda n: "".join(r.choice(words) + r.choice([" ", " ", " ", "\t ", "  ", ", ", ".", "\n", " ! "]) for _ in range(n))
    rows = [(r.choice(["en", "fr", None, "und"]), text(r.randrange(60))) for _ in range(80)]
    rows += [("en", None), ("en", ""), ("de", "a b"), ("en", "... ,,"), ("fr", "a b " * 3000), *[("en", "x y z w")] * 9]
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], "lang string, text string, f int, score int")
    for least, top in ((5, 2000), (3, 7)):
        got = sorted(tuple(x) for x in collocations.collocations(df, least, top=top).collect())
        assert got == brute_phrases(rows, least, top=top) and got
    assert collocations.collocations(df.filter("false")).count() == 0 and collocations.collocations(df.filter("text is null")).count() == 0


def test_colliding_fingerprints_stay_apart(spark, monkeypatch):
    """Where all phrases of one length have one of seven fingerprints, the counts are the same."""
    plain = collocations.Block.prints
    monkeypatch.setattr(collocations.Block, "prints", lambda self, first, words, seeds: plain(self, first, words, seeds) % np.uint64(7))
    r = random.Random(6)
    rows = [("en", " ".join(r.choice("abcdefgh") for _ in range(30))) for _ in range(20)]
    batch = collocations.pa.record_batch([collocations.pa.array([x[0] for x in rows]), collocations.pa.array([x[1].encode() for x in rows])], ["lang", "t"])
    for block, _, seeds in collocations.blocks(batch):
        for n in (1, 2, 3):
            first = block.runs(n)
            found = collections.Counter()
            prints = block.prints(first, n, seeds)
            while len(first):
                _, head, of = np.unique(prints, return_index=True, return_inverse=True)
                a, size = block.start[first], block.stop[first + n - 1] - block.start[first]
                same = size == size[head][of]
                same[same] = collocations.same_bytes(block.data, a[same], a[head][of][same], size[same], 10)
                found.update({block.data[a[h] : a[h] + size[h]].tobytes(): int((of[same] == i).sum()) for i, h in enumerate(head)})
                first, prints = first[~same], prints[~same]
            assert found == collections.Counter(" ".join(t.split()[i : i + n]).encode() for _, t in rows for i in range(30 - n + 1))


def test_contracts_of_the_new_queries(spark):
    want = {
        "op11_minhash_near_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
        "op12_embedding_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
        "op13_phrase_collocations": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    }
    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    for name, columns in want.items():
        out = QUERIES[name](spark, SMALLEST)
        assert ", ".join(f"{c} {t}" for c, t in out.dtypes) == columns
        if name.startswith("op11"):
            assert out.count() == docs.count() and out.join(docs, "doc_id").count() == docs.count() and out.filter(F.expr("kept != (doc_id = component_id)")).count() == 0
