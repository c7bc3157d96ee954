"""Language ID by a linear-chain conditional random field over the words of a text.

Features of a word are the n-grams of its bytes with the blanks at its ends (so affixes too), its first and last
three bytes, and its entry in a lexicon of the commonest words of each language. The weights of features and
transitions are learned by gradient steps on the log-likelihood, from forward-backward. Forward-backward over a whole
text goes in blocks of words: the blocks' transfer matrices first, then the messages from block to block, then the
words within each block. That is exact for any length, and runs as array operations over all blocks of a batch.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.llm.common import crc_fold, hashed_sample, map_texts, table

#: Most labelled documents of each language that the model is fitted on.
FIT_DOCS = 400
#: Of each of those, at most this many windows of WINDOW words (the last one shorter), spread evenly over the text.
FIT_WINDOWS, WINDOW = 12, 32
LEXICON = 256
BLOCK = 32
#: Bytes of text that are worked on together; the arrays over them take about 120 bytes for each.
TEXT_BYTES = 500_000
TRI, BI, AFFIX = 1 << 17, 1 << 16, 1 << 16
ADDED = "lang_pred string, score double, n_words long"
IS_LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
ASCII_LETTER = re.compile(rb"[A-Za-z]")
POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, np.uint64))


class Words:
    """The words of a batch of texts as arrays: feature numbers of all letters, affixes and whole words."""

    def __init__(self, texts: list[bytes | None]):
        low = [(t or b"").decode("utf-8", "replace").lower().encode() for t in texts]
        raw = np.frombuffer(b" " + b" ".join(low) + b"    ", np.uint8)
        letter = IS_LETTER[raw]
        b = np.where(letter, raw, 32).astype(np.uint32)
        edge = np.diff(letter.astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
        offsets = np.cumsum([1] + [len(x) + 1 for x in low])
        self.of = np.searchsorted(offsets, self.start, "right") - 1
        self.n_docs = len(texts)
        at = np.flatnonzero(letter)
        self.size = self.end - self.start
        self.first = np.concatenate(([0], np.cumsum(self.size)[:-1])) if len(self.size) else self.size
        p, c, n = b[at - 1], b[at], b[at + 1]
        self.tri = (p * np.uint32(0x9E3779B1) + c * np.uint32(0x85EBCA6B) + n * np.uint32(0xC2B2AE35)) >> np.uint32(15)
        self.bi = c << np.uint32(8) | n
        s, e, size = self.start, self.end, self.size
        three = lambda x, y, z: (x * np.uint32(0x9E3779B1) + y * np.uint32(0x85EBCA6B) + z * np.uint32(0xC2B2AE35)) >> np.uint32(16)
        self.prefix = three(b[s], np.where(size > 1, b[s + 1], 32).astype(np.uint32), np.where(size > 2, b[s + 2], 32).astype(np.uint32))
        self.suffix = three(b[e - 1], np.where(size > 1, b[e - 2], 32).astype(np.uint32), np.where(size > 2, b[e - 3], 32).astype(np.uint32))
        place = np.arange(len(at)) - np.repeat(self.first, size)
        self.word = np.add.reduceat(b[at].astype(np.uint64) * POWERS[place % len(POWERS)], self.first) if len(s) else np.zeros(0, np.uint64)


class Crf:
    """Weights: tri, bi, prefix, suffix, lexicon (the last row: not in it), each a row for a feature and a column for a language."""

    def __init__(self, langs: list[str], lexicon: np.ndarray):
        k = len(langs)
        self.langs, self.lexicon = langs, lexicon
        self.tri, self.bi, self.prefix, self.suffix = (np.zeros((n, k), np.float32) for n in (TRI, BI, AFFIX, AFFIX))
        self.lex = np.zeros((len(lexicon) + 1, k), np.float32)
        self.trans = np.eye(k) * 2

    def lex_row(self, word: np.ndarray) -> np.ndarray:
        i = np.searchsorted(self.lexicon, word)
        return np.where(self.lexicon[np.minimum(i, len(self.lexicon) - 1)] == word, i, len(self.lexicon)) if len(self.lexicon) else np.zeros(len(word), int)

    def scores(self, w: Words) -> np.ndarray:
        letters = self.tri[w.tri]
        letters += self.bi[w.bi]
        out = np.add.reduceat(letters, w.first, axis=0)
        return out + self.prefix[w.prefix] + self.suffix[w.suffix] + self.lex[self.lex_row(w.word)]

    def step(self, w: Words, grad: np.ndarray, trans: np.ndarray, sums: dict, rate: float) -> None:
        """An adaptive gradient step: each weight by its gradient over the root of its summed squares."""
        letters = np.repeat(grad, w.size, axis=0)
        for name, index, g in (("tri", w.tri, letters), ("bi", w.bi, letters), ("prefix", w.prefix, grad), ("suffix", w.suffix, grad), ("lex", self.lex_row(w.word), grad)):
            weights = getattr(self, name)
            total = np.stack([np.bincount(index, g[:, k], len(weights)) for k in range(g.shape[1])], axis=1)
            sums[name] = sums.get(name, 1e-3) + total**2
            weights += (rate * total / np.sqrt(sums[name])).astype(np.float32)
        sums["trans"] = sums.get("trans", 1e-3) + trans**2
        self.trans += rate * trans / np.sqrt(sums["trans"])

    def fit(self, texts: list[list[bytes]], golds: list[np.ndarray], epochs: int = 4, batch: int = 256) -> None:
        """texts: windows as lists of at most WINDOW words; golds: the language of each word. Shorter windows are
        padded, and places behind their last word take no part."""
        k, sums = len(self.langs), {}
        for epoch in range(epochs):
            for i in range(0, len(texts), batch):
                w = Words([b" ".join(x) for x in texts[i : i + batch]])
                size = np.array([len(x) for x in golds[i : i + batch]])
                there = np.arange(WINDOW) < size[:, None]
                gold, e = np.zeros((2, len(size), WINDOW, k))
                gold[there] = np.eye(k)[np.concatenate(golds[i : i + batch])]
                e[there] = self.scores(w)
                e = np.exp(e - e.max(axis=2, keepdims=True))
                t = np.exp(self.trans - self.trans.max())
                alpha, beta, z = np.empty_like(e), np.ones_like(e), np.empty(e.shape[:2])
                for j in range(WINDOW):
                    a = (alpha[:, j - 1] if j else np.full((len(size), k), 1 / k)) @ t * e[:, j]
                    z[:, j] = a.sum(1)
                    alpha[:, j] = a / z[:, j, None]
                for j in range(WINDOW - 2, -1, -1):
                    beta[:, j] = np.where(there[:, j + 1, None], (e[:, j + 1] * beta[:, j + 1]) @ t.T / z[:, j + 1, None], 1)
                gamma = alpha * beta
                gamma /= gamma.sum(2, keepdims=True)
                pair = np.einsum("nja,ab,njb->ab", alpha[:, :-1], t, (e * beta / z[:, :, None] * there[:, :, None])[:, 1:])
                self.step(w, (gold - gamma)[there], np.einsum("nja,njb->ab", gold[:, :-1], gold[:, 1:]) - pair, sums, 0.3 / (1 + epoch))

    def marginals(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """For each text the summed marginals of its words, and for each word its likeliest language."""
        k, n = len(self.langs), len(w.of)
        total, best = np.zeros((w.n_docs, k)), np.zeros(n, np.int16)
        if not n:
            return total, best
        e = self.scores(w)
        e = np.exp(np.maximum(e - e.max(axis=1, keepdims=True), -60))
        t = np.exp(self.trans - self.trans.max()).astype(np.float32)
        words = np.bincount(w.of, minlength=w.n_docs)
        begin = np.concatenate(([0], np.cumsum(words)[:-1]))
        blocks = -(-words // BLOCK)
        doc = np.repeat(np.arange(w.n_docs), blocks)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        at = begin[doc] + nth * BLOCK
        length = np.minimum(BLOCK, words[doc] - nth * BLOCK)
        order = np.argsort(-length, kind="stable")  # longest first: at each place the blocks that reach it stand in front
        at, length, doc, nth = at[order], length[order], doc[order], nth[order]
        reach = [int(np.searchsorted(-length, -j)) for j in range(BLOCK)]
        whole = np.tile(np.eye(k, dtype=np.float32), (len(at), 1, 1))
        for j, c in enumerate(reach):
            m = (whole[:c].reshape(-1, k) @ t).reshape(c, k, k) * e[at[:c] + j][:, None, :]
            whole[:c] = m / m.max(axis=(1, 2), keepdims=True)
        place = np.empty((w.n_docs, int(blocks.max())), np.int64)
        place[doc, nth] = np.arange(len(at))
        into, out = np.empty((len(at), k), np.float32), np.ones((len(at), k), np.float32)
        long_first = np.argsort(-blocks, kind="stable")
        a = np.full((w.n_docs, k), 1 / k, np.float32)
        for j in range(int(blocks.max())):
            live = long_first[: int(np.searchsorted(-blocks[long_first], -j))]
            x = place[live, j]
            into[x] = a[live]
            m = np.einsum("na,nab->nb", a[live], whole[x])
            a[live] = m / m.sum(1, keepdims=True)
        b = np.ones((w.n_docs, k), np.float32)
        for j in range(int(blocks.max()) - 1, -1, -1):
            live = long_first[: int(np.searchsorted(-blocks[long_first], -j))]
            x = place[live, j]
            out[x] = b[live]
            m = np.einsum("nab,nb->na", whole[x], b[live])
            b[live] = m / m.sum(1, keepdims=True)
        alpha = np.empty((BLOCK, len(at), k), np.float32)
        a = into
        for j, c in enumerate(reach):
            m = (a[:c] @ t) * e[at[:c] + j]
            a[:c] = alpha[j, :c] = m / m.sum(1, keepdims=True)
        share = np.zeros((len(at), k))
        b = out
        for j in range(BLOCK - 1, -1, -1):
            c = reach[j]
            g = alpha[j, :c] * b[:c]
            g /= g.sum(1, keepdims=True)
            share[:c] += g
            best[at[:c] + j] = g.argmax(1)
            m = (e[at[:c] + j] * b[:c]) @ t.T
            b[:c] = m / m.sum(1, keepdims=True)
        for i in range(k):
            total[:, i] = np.bincount(doc, share[:, i], w.n_docs)
        return total, best

    def label(self, texts: list[bytes | None], spans: bool = False) -> list:
        has = [t is not None and bool(ASCII_LETTER.search(t) or any(c.isalpha() for c in t.decode("utf-8", "replace"))) for t in texts]
        w = Words(texts)
        if not self.langs:
            return [["und"] * len(texts), [0.0] * len(texts), [0] * len(texts)] + [[[] for _ in texts]] * spans
        total, best = self.marginals(w)
        words = np.bincount(w.of, minlength=len(texts))
        top = total.argmax(1)
        score = np.clip(total[np.arange(len(texts)), top] / np.maximum(words, 1), 0, 1)
        made = [[self.langs[i] if h else "und" for i, h in zip(top, has, strict=True)], np.where(has, score, 0.0), np.where(has, words, 0)]
        if spans:
            cut = np.flatnonzero((np.diff(w.of, prepend=-1) != 0) | (np.diff(best, prepend=-1) != 0))
            runs: list[list] = [[] for _ in texts]
            for i, n in zip(cut.tolist(), np.diff(cut, append=len(best)).tolist(), strict=True):
                runs[w.of[i]].append({"lang": self.langs[best[i]], "words": n})
            made.append([r if h else [] for r, h in zip(runs, has, strict=True)])
        return made


def words_of(text: str) -> list[bytes]:
    low = text.lower().encode()
    return bytes(b if ok else 32 for b, ok in zip(low, IS_LETTER[np.frombuffer(low, np.uint8)], strict=True)).split()


def fit(labelled: DataFrame, fit_docs: int = FIT_DOCS, seed: int = 3) -> Crf:
    """The model of labelled (text, lang). A quarter of the windows are followed to the half by words of another
    language, so that the transitions learn that a text can switch."""
    drawn = hashed_sample(labelled, "lang", fit_docs, seed)
    langs = sorted({r.lang for r in drawn})
    rng, pool, counts = np.random.default_rng(seed), {x: [] for x in langs}, {x: {} for x in langs}
    for r in drawn:
        words = words_of(r.text)
        for x in words:
            counts[r.lang][x] = counts[r.lang].get(x, 0) + 1
        many = -(-len(words) // WINDOW)
        pool[r.lang] += [words[i * WINDOW : (i + 1) * WINDOW] for i in sorted(set(np.linspace(0, many - 1, min(many, FIT_WINDOWS)).astype(int).tolist()))]
    common = sorted({x for c in counts.values() for x in sorted(c, key=lambda x: (-c[x], x))[:LEXICON]})
    model = Crf(langs, np.unique(Words([b" ".join(common)]).word) if common else np.zeros(0, np.uint64))
    texts, golds = [], []
    for i, x in enumerate(langs):
        for words in pool[x]:
            y = [i] * len(words)
            other = langs[rng.integers(len(langs))]
            if other != x and pool[other] and len(words) > 1 and rng.random() < 0.25:
                at = int(rng.integers(1, len(words)))
                rest = pool[other][rng.integers(len(pool[other]))][at:]
                words, y = words[:at] + rest, y[:at] + [langs.index(other)] * len(rest)
            texts.append(words)
            golds.append(np.array(y))
    order = rng.permutation(len(texts))
    model.fit([texts[i] for i in order], [golds[i] for i in order])
    return model


def label_languages(docs: DataFrame, model: Crf, carry: list[str] | None = None, spans: bool = False) -> DataFrame:
    """Columns `carry` of docs (all, if None) and lang_pred, score, n_words; with spans also the runs of words of one
    language, in order.

    score is the mean marginal of lang_pred over all words of the whole text. A text that is null or has no letter is
    `und` with score 0; so is every text if the model was fitted on no rows. Ties go to the language that sorts
    first. Columns with the added names are replaced; rows stay as they are, repeated ones too.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = ADDED + (", spans array<struct<lang:string,words:long>>" if spans else "")
    own = [c for c in (carry if carry is not None else docs.columns) if c not in ("lang_pred", "score", "n_words", *["spans"] * spans)]
    return map_texts(docs, lambda texts: shared.value.label(texts, spans), added, own, block_bytes=TEXT_BYTES)


def op1_crf_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_fold(F.col("doc_id"), 4) == 2
    model = fit(docs.filter(~held_out))
    return label_languages(docs, model, ["doc_id"]).withColumn("held_out", held_out)
