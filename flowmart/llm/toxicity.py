"""Toxicity by maximum-scoring segments.

A token scores the log-odds of toxic against clean labelled documents, under a Dirichlet prior in proportion to its
count over all documents. A token that has no score of its own has that of its longest beginning that has one, so a
family of insults is known by its stem. A linear-time scan finds every maximal segment of a text's scores; a segment's score is
calibrated by the extreme-value law of the best segment in a clean text of that length, and the significant ones
are summed into the text's score.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.llm.common import crc_fold, labelled_sample, map_texts, table

#: Most labelled documents of each label that the scores and the calibration are fitted on.
FIT_DOCS = 2_000
#: Tokens and beginnings score with at least so many toxic documents in that sample, so large log-odds and z-score, at most
#: VOCABULARY of them; all others score -DRIFT.
LEAST_DOCS, LEAST_ODDS, LEAST_Z, VOCABULARY = 4, 1.0, 3.0, 20_000
#: Lengths in bytes of a beginning, and most words of which a task remembers the score.
STEMS, CACHE = range(10, 3, -1), 500_000
PRIOR = 0.1
DRIFT = 0.15
SIGNIFICANT = 0.01
LETTERS = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def tokens(text: bytes | None) -> list[bytes]:
    """Runs of letters, A-Z lower-cased."""
    return (text or b"").translate(LETTERS).split()


def units(word: bytes) -> list[bytes]:
    """The word, and its beginnings marked by a ^, longest first."""
    return [word, *(b"^" + word[:n] for n in STEMS if n <= len(word))]


class Scorer(dict):
    """Scores of words, looked up as they come."""

    def __init__(self, scores: dict[bytes, float]):
        super().__init__()
        self.scores = scores

    def __missing__(self, word: bytes) -> float:
        s = next((self.scores[u] for u in units(word) if u in self.scores), -DRIFT)
        if len(self) < CACHE:
            self[word] = s
        return s


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, score) of a sequence, in order, in linear time.

    Only the runs of positive scores can begin or end one, so the scan goes over those. A candidate holds the sums
    before it and up to its end; one whose end is the highest yet swallows those back to the last that begins lower.
    """
    up = np.flatnonzero(scores > 0)
    if not len(up):
        return []
    total = np.concatenate(([0.0], np.cumsum(scores)))
    cut = np.flatnonzero(np.diff(up) > 1)
    begins, ends = up[np.concatenate(([0], cut + 1))], up[np.concatenate((cut, [len(up) - 1]))] + 1
    held: list[tuple[int, int, float, float, int]] = []  # begin, end, sum before, sum at end, the last candidate that begins lower
    for b, e, low, high in zip(begins.tolist(), ends.tolist(), total[begins].tolist(), total[ends].tolist(), strict=True):
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= low:
                j = held[j][4]
            if j < 0 or held[j][3] >= high:
                held.append((b, e, low, high, j))
                break
            b, low = held[j][0], held[j][2]
            del held[j:]
    return [(b, e, high - low) for b, e, low, high, _ in held]


class Segments:
    """Token scores, the law of a clean text's best segment (rate lam, constant log_k) and the weights of the text's score."""

    def __init__(self, scores: dict[bytes, float]):
        self.scores, self.lam, self.log_k, self.weights, self.scorer = scores, 1.0, 0.0, np.zeros(3), None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"scorer": None}

    def of(self, words: list[bytes]) -> np.ndarray:
        self.scorer = self.scorer or Scorer(self.scores)
        return np.fromiter(map(self.scorer.__getitem__, words), float, len(words))

    def segments(self, text: bytes | None) -> tuple[int, list[tuple[int, int, float]]]:
        words = tokens(text)
        return len(words), maximal_segments(self.of(words))

    def excess(self, n: int, score: float) -> float:
        """Log of how much rarer a segment of that score is than one expected by chance in n clean tokens."""
        return self.lam * score - self.log_k - float(np.log(max(n, 1)))

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> list[float]:
        """1, the calibrated best segment, and the sum over the significant ones. Having no segment isn't rarer than chance
        in a text of any length."""
        over = [self.excess(n, s) for _, _, s in found]
        best = max(over, default=min(self.excess(n, 0.0), 0.0))
        return [1.0, min(max(best, -15.0), 15.0), float(np.log1p(sum(x for x in over if -np.expm1(-np.exp(-x)) < SIGNIFICANT)))]

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.weights, -30, 30)))

    def calibrate(self, texts: list[bytes], toxic: np.ndarray, share: float) -> None:
        """Fits lam (the root of the mean of exp(lam * score) over clean tokens), log_k (from the mean of the best
        clean segments) and, by Newton steps, the logistic weights; share is that of toxic among all labelled rows."""
        clean: Counter = Counter()
        for t, y in zip(texts, toxic, strict=True):
            if not y:
                clean.update(self.of(tokens(t)).tolist())
        s, p = np.array(list(clean)), np.array(list(clean.values()), float)
        if len(s) and s.max() > 0 and (p @ s) < 0:
            low, high = 1e-3, 1.0
            mean = lambda x: float(p @ np.exp(np.clip(x * s, -50, 50)) / p.sum())
            while mean(high) < 1 and high < 50:
                high *= 2
            for _ in range(60):
                mid = (low + high) / 2
                low, high = (mid, high) if mean(mid) < 1 else (low, mid)
            self.lam = high
        found = [self.segments(t) for t in texts]
        best = [self.lam * max((x[2] for x in f), default=0.0) - np.log(max(n, 1)) for (n, f), y in zip(found, toxic, strict=True) if not y]
        self.log_k = float(np.mean(best)) - 0.5772 if best else 0.0
        x = np.array([self.evidence(n, f) for n, f in found])
        y = toxic.astype(float)
        w = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
        ridge = np.array([1e-3, 1e-1, 1e-1])

        def loss(v: np.ndarray) -> float:
            return float((w * np.logaddexp(0, np.where(y == 1, -1, 1) * (x @ v))).sum() + (ridge * v * v).sum() / 2)

        v = np.zeros(3)
        for _ in range(50):
            q = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
            move = np.linalg.solve((x * (w * q * (1 - q))[:, None]).T @ x + np.diag(ridge), x.T @ (w * (y - q)) - ridge * v)
            while loss(v + move) > loss(v) and np.abs(move).max() > 1e-9:
                move /= 2
            v = v + move
        self.weights = v


def count_units(docs: DataFrame, wanted: set[bytes]) -> dict[bytes, int]:
    """How often each wanted token or beginning stands in all texts, and under b"" how many tokens there are."""
    names = sorted(wanted)
    shared = docs.sparkSession.sparkContext.broadcast({w: i + 1 for i, w in enumerate(names)})

    def run(texts: list[bytes | None]) -> list:
        number, counts, words = shared.value, Counter(), Counter()
        for t in texts:
            words.update(tokens(t))
        for w, n in words.items():
            counts[0] += n
            for u in units(w):
                if u in number:
                    counts[number[u]] += n
        rest = [[]] * (len(texts) - 1)
        return [[list(counts), *rest], [list(counts.values()), *rest]]

    per_block = map_texts(docs, run, "unit array<int>, n array<long>", [])
    sums = per_block.select(F.explode(F.arrays_zip("unit", "n")).alias("x")).groupBy("x.unit").agg(F.sum("x.n").alias("n"))
    got = {r.unit: r.n for r in sums.collect()}
    return {b"": got.get(0, 0)} | {w: got.get(i + 1, 0) for i, w in enumerate(names)}


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, seed: int = 5) -> Segments:
    """labels: (doc_id, toxic). With labels of one kind only every text has the same score."""
    rows, there = labelled_sample(docs, labels, "toxic", fit_docs, seed)
    texts, toxic = [r.text.encode() for r in rows], np.array([r.y for r in rows], int)
    share = there.get(1, 0) / max(sum(there.values()), 1)
    words, counts, in_docs = (Counter(), Counter()), (Counter(), Counter()), Counter()
    for t, y in zip(texts, toxic.tolist(), strict=True):
        own = Counter(tokens(t))
        words[y].update(own)
        if y:
            in_docs.update({u for w in own for u in units(w)})
    for c, found in zip(counts, words, strict=True):
        for w, n in found.items():
            for u in units(w):
                if in_docs[u] >= LEAST_DOCS:
                    c[u] += n
    n0, n1 = (sum(c.values()) for c in words)
    odd = {u: (n / max(n1, 1)) / ((counts[0][u] + 0.5) / max(n0, 1)) for u, n in counts[1].items()}
    wanted = set(sorted((u for u in odd if odd[u] > 1.5), key=lambda u: (-odd[u] * counts[1][u] ** 0.5, u))[:VOCABULARY])
    model = Segments({})
    model.weights = np.array([np.log((share + 1e-6) / (1 - share + 1e-6)), 0.0, 0.0])
    if not wanted or len(set(toxic.tolist())) < 2:
        return model
    corpus = count_units(docs, wanted)
    a0 = PRIOR * (n0 + n1)
    for w in wanted:
        a = a0 * (corpus[w] + 0.5) / (corpus[b""] + 1)
        y0, y1 = counts[0][w] + a, counts[1][w] + a
        odds = np.log(y1 / (n1 + a0 - y1)) - np.log(y0 / (n0 + a0 - y0))
        if odds >= LEAST_ODDS and odds / np.sqrt(1 / y0 + 1 / y1) >= LEAST_Z:
            model.scores[w] = round(float(odds) - DRIFT, 3)
    model.calibrate(texts, toxic, share)
    return model


def score_toxicity(docs: DataFrame, model: Segments, carry: list[str] | None = None, passages: bool = False) -> DataFrame:
    """Columns `carry` of docs (all, if None) and score (0 to 1) and predicted; with passages also the significant
    segments (first token, tokens, score), in order.

    Null and empty texts have no segment and score as a clean text of no length. Repeated rows score alike. Columns
    with the added names are replaced. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[bytes | None]) -> list:
        m = shared.value
        found = [m.segments(t) for t in texts]
        score = m.score(np.array([m.evidence(n, f) for n, f in found]).reshape(-1, 3))
        made = [score, (score >= 0.5).astype(np.int32)]
        if passages:
            made.append([[{"first": b, "tokens": e - b, "score": s} for b, e, s in f if -np.expm1(-np.exp(-m.excess(n, s))) < SIGNIFICANT] for n, f in found])
        return made

    added = "score double, predicted int" + (", passages array<struct<first:long,tokens:long,score:double>>" if passages else "")
    own = [c for c in (carry if carry is not None else docs.columns) if c not in ("score", "predicted", *["passages"] * passages)]
    return map_texts(docs, run, added, own)


def op4_toxicity_segments(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_fold(F.col("doc_id"), 5) == 0
    model = fit(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return score_toxicity(docs, model, ["doc_id"]).withColumn("held_out", held_out)
