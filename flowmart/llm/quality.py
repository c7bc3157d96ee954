"""Quality by nearest-neighbour voting among latent-semantic vectors.

Terms are the hashed three-byte sequences of a text, and the repetition of its words. Damped counts, weighted by
inverse document frequency, and the share of words that repeat the one before, are projected onto the leading singular vectors of the labelled sample. The labelled vectors are few by that sample's
bound and are broadcast; every document's cosines with all of them are computed exactly, a block at a time, and the
nearest vote with weights that grow with their similarity.
"""

from __future__ import annotations

from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.llm.common import crc_fold, labelled_sample, map_texts, table

#: Most labelled documents of each label.
FIT_DOCS = 1_500
TERMS, RANK, NEIGHBOURS, POWER = 1 << 13, 48, 25, 6
#: Weight of the share of repeated words beside the weighted term counts, whose norm is about as large for a usual text.
REPEATS = 60.0
THRESHOLD = 0.3


def term_counts(texts: list[bytes | None]) -> np.ndarray:
    """A row for each text: its damped term counts, and in the last place its weighted share of repeated words."""
    out = np.zeros((len(texts), TERMS + 1), np.float32)
    for i, t in enumerate(texts):
        b = np.frombuffer(b" " + (t or b"") + b" ", np.uint8).astype(np.uint32)
        terms = (b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(19)
        out[i, :TERMS] = np.bincount(terms, minlength=TERMS)
    np.log1p(out, out=out)
    for i, t in enumerate(texts):
        words = (t or b"").split()
        out[i, TERMS] = REPEATS * max(sum(map(eq, words, words[1:])) - 2, 0) / (len(words) + 10)  # a few come by chance
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


class Neighbours:
    def __init__(self, texts: list[bytes], labels: np.ndarray, share: float):
        """share: of label 1 among all labelled rows; votes are weighted so that the drawn labels count in that ratio."""
        self.labels, self.share = labels.astype(np.float32), share
        if len(set(labels.tolist())) < 2:
            return
        counts = term_counts(texts)
        self.idf = np.log((1 + len(texts)) / (1 + (counts > 0).sum(0))).astype(np.float32) + 0.1
        self.idf[TERMS] = 1.0
        rows = unit(counts * self.idf)
        rank = min(RANK, len(texts))
        rng = np.random.default_rng(0)
        basis = np.linalg.qr(rows @ rng.standard_normal((TERMS + 1, rank + 16), dtype=np.float32))[0]
        for _ in range(4):  # subspace iteration for the leading singular vectors
            basis = np.linalg.qr(rows @ (rows.T @ basis))[0]
        self.axes = np.linalg.svd(basis.T @ rows, full_matrices=False)[2][:rank].T.astype(np.float32)
        self.vectors = unit(rows @ self.axes)
        self.votes = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean())).astype(np.float32)

    def score(self, texts: list[bytes | None], block: int = 256) -> np.ndarray:
        if len(set(self.labels.tolist())) < 2:
            return np.full(len(texts), self.share)
        out = []
        for i in range(0, len(texts), block):
            rows = term_counts(texts[i : i + block])
            rows *= self.idf
            near = unit(rows @ self.axes) @ self.vectors.T
            k = min(NEIGHBOURS, near.shape[1])
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            w = np.maximum(np.take_along_axis(near, top, 1), 1e-3) ** POWER * self.votes[top]
            out.append((w * self.labels[top]).sum(1) / w.sum(1))
        return np.clip(np.concatenate(out).astype(float), 0, 1) if out else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, seed: int = 9) -> Neighbours:
    """labels: (doc_id, quality). With labels of one kind only, or none, every text has the share of label 1 as its score."""
    rows, there = labelled_sample(docs, labels, "quality", fit_docs, seed)
    return Neighbours([r.text.encode() for r in rows], np.array([r.y for r in rows], int), there.get(1, 0) / max(sum(there.values()), 1))


def score_quality(docs: DataFrame, model: Neighbours, carry: list[str] | None = None) -> DataFrame:
    """Columns `carry` of docs (all, if None) and score (0 to 1) and predicted (1 from a score of 0.3).

    Null texts score as empty ones; repeated rows score alike. Columns with the added names are replaced. An empty
    table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[bytes | None]) -> list:
        score = shared.value.score(texts)
        return [score, (score >= THRESHOLD).astype(np.int32)]

    own = [c for c in (carry if carry is not None else docs.columns) if c not in ("score", "predicted")]
    return map_texts(docs, run, "score double, predicted int", own)


def op10_quality_neighbours(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_fold(F.col("doc_id"), 5) == 0
    model = fit(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return score_quality(docs, model, ["doc_id"]).withColumn("held_out", held_out)
