"""Quality by nearest-neighbour voting in a latent-semantic space.

A bounded labelled sample gives the terms, their weights and, by singular value decomposition, a space of few
dimensions. The sample's vectors are broadcast; each document is compared with all of them by blocked matrix products
(exact cosines), and the nearest vote by similarity.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wireloom.llm.labelled import EXAMPLES, Votes, labelled_sample
from wireloom.llm.text import map_rows, shipped, text_bytes

#: Terms kept, by document frequency; dimensions of the space; neighbours that vote; documents of a product.
TERMS, DIMENSIONS, NEIGHBOURS, BLOCK = 2048, 64, 15, 512

#: Weight of terms about form (shapes of words, repetition) next to words.
FORM = 3.0


def _shapes() -> bytes:
    """Byte map to kinds: lower-case and non-ASCII letters x, upper-case X, digits 9; others stay."""
    return bytes(
        ord("X") if 0x41 <= c <= 0x5A else ord("x") if 0x61 <= c <= 0x7A or c >= 0x80 else ord("9") if 0x30 <= c <= 0x39 else c
        for c in range(256)
    )


SHAPES = _shapes()
RUNS = re.compile(rb"(.)\1+", re.S)


def shape_of(chunk: bytes) -> bytes:
    """The kinds of a chunk's characters, runs as one: `THE,!!` is `X,!`."""
    return b"#" + RUNS.sub(rb"\1", chunk.translate(SHAPES))


def document_terms(text: bytes | None, memo: dict[bytes, tuple[bytes, bytes]]) -> dict[bytes, int]:
    """Counts of a text's terms: words in lower case, shapes, and how much of it repeats. Null counts as empty."""
    chunks = text.split() if text else []
    counts: dict[bytes, int] = {}
    seen: dict[bytes, int] = {}
    for chunk in chunks:
        seen[chunk] = seen.get(chunk, 0) + 1
    for chunk, n in seen.items():
        found = memo.get(chunk)
        if found is None:
            found = memo[chunk] = (shape_of(chunk), chunk.lower())
        for term in found:
            counts[term] = counts.get(term, 0) + n
    again = sum(a == b for a, b in zip(chunks, chunks[1:]))
    total = max(1, len(chunks))
    lines = [line for line in (text or b"").split(b"\n") if line.strip()]
    for name, share in (
        (b"@distinct", len(seen) / total), (b"@again", again / total), (b"@lines", len(set(lines)) / max(1, len(lines)))
    ):
        counts[b"%s%d" % (name, round(10 * share))] = 1
    counts[b"@length%d" % len(chunks).bit_length()] = 1
    return counts


@dataclass
class Space:
    terms: dict[bytes, int]
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    votes: Votes

    def weighted(self, text: bytes | None, memo: dict) -> tuple[np.ndarray, np.ndarray]:
        counts = {self.terms[t]: n for t, n in document_terms(text, memo).items() if t in self.terms}
        at = np.fromiter(counts, np.int64, len(counts))
        weights = (1 + np.log(np.fromiter(counts.values(), float, len(counts)))) * self.idf[at]
        length = np.sqrt((weights * weights).sum())
        return at, weights / length if length else weights

    def project(self, texts: list[bytes | None], memo: dict) -> np.ndarray:
        """Unit vectors in the space; a text without a known term is zero."""
        out = np.zeros((len(texts), self.axes.shape[1]), np.float32)
        for row, text in enumerate(texts):
            at, weights = self.weighted(text, memo)
            out[row] = weights @ self.axes[at]
        return unit_rows(out)

    def nearest(self, rows: np.ndarray, but: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        cosines = rows @ self.vectors.T
        if but is not None:
            cosines[np.arange(len(rows)), but] = -1
        k = min(NEIGHBOURS, cosines.shape[1])
        near = np.argpartition(-cosines, k - 1, 1)[:, :k]
        similar = np.maximum(np.take_along_axis(cosines, near, 1), 0)
        return near, similar**4


def fit(docs: DataFrame, labels: DataFrame, learnable, label: str = "quality", examples: int = EXAMPLES) -> Space:
    """Learn from at most about `examples` whole labelled texts of each class. What the driver decomposes is bounded by
    that and by TERMS. Without labelled rows every score is 0."""
    sample, sizes = labelled_sample(docs, labels, label, learnable, examples)

    def counter():
        def count(columns: dict) -> dict:
            found: dict[bytes, int] = {}
            for text in columns["text"]:
                for term in document_terms(text, {}):
                    found[term] = found.get(term, 0) + 1
            return {"term": list(found), "n": list(found.values())}

        return count

    counted = map_rows(sample, "term binary, n bigint", counter).groupBy("term").agg(F.sum("n").alias("n"))
    chosen = counted.filter("n >= 5").orderBy(F.desc("n"), "term").limit(TERMS).collect()
    n = max(1, sample.count())
    terms = {bytes(row["term"]): number for number, row in enumerate(chosen)}
    idf = np.array([np.log(1 + n / row["n"]) for row in chosen])
    idf *= np.array([FORM if t[:1] in b"#@" else 1.0 for t in terms])
    none = Votes.of(np.zeros(0, int), sizes)
    space = Space(terms, idf, np.zeros((len(terms), 1), np.float32), np.zeros((0, 1), np.float32), none)
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def coder():
        known, memo = shared.value, {}

        def code(columns: dict) -> dict:
            coded = [known.weighted(text, memo) for text in columns["text"]]
            out = {k: columns[k] for k in ("doc_id", "label")}
            return out | {"terms": [at.tolist() for at, _ in coded], "weights": [w.tolist() for _, w in coded]}

        return code

    # Of an example no more than its weights comes to the driver, whatever its length.
    coded = map_rows(sample, "doc_id bigint, label int, terms array<int>, weights array<float>", coder)
    rows = coded.orderBy("doc_id").collect()
    if not rows or not terms:
        return space
    matrix = np.zeros((len(rows), len(terms)), np.float32)
    for vector, row in zip(matrix, rows):
        vector[row["terms"]] = row["weights"]
    space.axes = principal_axes(matrix, DIMENSIONS)
    space.vectors = unit_rows(matrix @ space.axes)
    space.votes = votes = Votes.of(np.array([row["label"] for row in rows], int), sizes)
    blocks = [np.arange(f, min(f + BLOCK, len(rows))) for f in range(0, len(rows), BLOCK)]
    votes.calibrate(np.concatenate([votes.raw(*space.nearest(space.vectors[b], b)) for b in blocks]))
    return space


def unit_rows(rows: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(lengths > 0, lengths, 1)


def principal_axes(matrix: np.ndarray, dimensions: int) -> np.ndarray:
    """Right singular vectors of the largest singular values, by subspace iteration from a fixed random start."""
    dimensions = min(dimensions, *matrix.shape)
    basis = np.random.default_rng(0).standard_normal((matrix.shape[1], min(dimensions + 16, matrix.shape[1])))
    basis = basis.astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    _, _, rotation = np.linalg.svd(matrix @ basis, full_matrices=False)
    return (basis @ rotation.T)[:, :dimensions].astype(np.float32)


def score(docs: DataFrame, space: Space, threshold: float = 0.7) -> DataFrame:
    """Documents with score (0 to 1) and predicted (1 from `threshold` on).

    Whole texts, one narrow pass in blocks of documents. Null and empty texts are scored by the terms that say so.
    Columns of these names are replaced, others stay; equal texts get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(space)
    stay = [F.col(f"`{name}`") for name in docs.columns if name not in ("score", "predicted")]
    rows = docs.select(F.struct(*stay).alias("document"), text_bytes())
    schema = StructType([rows.schema["document"]]).add("score", "double").add("predicted", "integer")
    arrow = to_arrow_schema(schema)

    def loop(batches):
        known = shared.value
        memo: dict[bytes, tuple[bytes, bytes]] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                if len(memo) > 500_000:
                    memo.clear()
                scores = np.full(batch.num_rows, known.votes.base)
                if len(known.vectors):
                    rows = known.project([x.as_py() for x in batch.column("text")], memo)
                    scores = known.votes.scores(known.votes.raw(*known.nearest(rows)))
                scores = np.clip(scores, 0, 1)
                out = [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([batch.column("document"), *out], schema=arrow)

    return shipped(rows).mapInArrow(loop, schema).select("document.*", "score", "predicted")
