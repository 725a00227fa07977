"""Bounded samples of labelled documents, and what turns neighbours' labels into scores."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireloom.llm.text import kept, sampled_share, text_bytes

#: Labelled documents of each class that a classifier keeps, about: a bound on what is fitted, collected, broadcast.
EXAMPLES = 2048


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learnable: Column, examples: int = EXAMPLES
) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label, text as bytes) of about `examples` documents of each class, and the size of each class.

    Rows without an id or a label teach nothing; an id with several labels counts as its highest, one with several rows
    as one of their texts, that of the least hash, so that rows are as bounded as ids. The sample follows a
    fixed random order of the ids; its ids, at most a small multiple of `examples`, are broadcast to the documents.
    """
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & learnable)
    rows = rows.groupBy("doc_id").agg(F.max(label).cast("int").alias("label")).filter(F.col("label").isin(0, 1))
    sizes = {row["label"]: row["n"] for row in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = F.when(F.col("label") == 1, sizes.get(1, 0)).otherwise(sizes.get(0, 0))
    ids = rows.filter(sampled_share(examples)(size))
    chosen = docs.select("doc_id", text_bytes()).join(F.broadcast(ids), "doc_id")
    first = F.min_by("text", F.when(F.col("text").isNotNull(), F.struct(F.xxhash64("text"), F.col("text"))))
    chosen = chosen.groupBy("doc_id", "label").agg(first.alias("text"))
    return kept(chosen.select("doc_id", "label", "text")), sizes


@dataclass
class Votes:
    """Labels of examples, the weight of each so that classes count as in all labelled rows, and a calibration."""

    labels: np.ndarray
    weights: np.ndarray
    base: float
    knots: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, labels: np.ndarray, sizes: dict[int, int]) -> Votes:
        weights = np.ones(len(labels))
        for label in (0, 1):
            here = labels == label
            weights[here] = sizes.get(label, 0) / max(1, here.sum())
        total = sum(sizes.values())
        base = sizes.get(1, 0) / total if total else 0.0
        return cls(labels.astype(float), weights / max(weights.mean(), 1e-9) if len(weights) else weights, base, np.zeros(0), np.zeros(0))

    def raw(self, near: np.ndarray, similar: np.ndarray) -> np.ndarray:
        """Weighted mean of the neighbours' labels; the more distant they are, the nearer to the base rate."""
        weight = similar * self.weights[near]
        return ((weight * self.labels[near]).sum(1) + 0.05 * self.base) / (weight.sum(1) + 0.05)

    def calibrate(self, raw: np.ndarray) -> None:
        """Isotonic regression of the examples' labels on their own votes, each left out of its own neighbours."""
        order = np.argsort(raw, kind="stable")
        blocks: list[list[float]] = []  # weight, mean, highest vote
        for at in order:
            blocks.append([self.weights[at], self.labels[at], raw[at]])
            while len(blocks) > 1 and (blocks[-2][1] >= blocks[-1][1] or blocks[-2][2] == blocks[-1][2]):
                w, m, top = blocks.pop()
                before = blocks[-1]
                before[:] = [before[0] + w, (before[0] * before[1] + w * m) / (before[0] + w), top]
        self.knots = np.array([b[2] for b in blocks])
        self.values = np.array([(b[0] * b[1] + self.base) / (b[0] + 1) for b in blocks])

    def scores(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.knots, self.values) if len(self.knots) else np.full(len(raw), self.base)
