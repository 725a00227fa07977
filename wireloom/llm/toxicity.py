"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Examples are kept in blocks of similar ones. A block has the postings of its terms and the highest weight of each; the
sum over a text's terms bounds the cosine of every example in it, and a block whose bound does not reach the k-th
neighbour found so far is skipped. Neighbours vote by similarity, and votes are calibrated to probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wireloom.llm.labelled import EXAMPLES, Votes, labelled_sample
from wireloom.llm.text import map_rows, shipped, spaced_words, text_bytes

#: Terms of the index: those whose frequency differs most between the classes, at least by so many standard errors.
TERMS, LEAST_Z = 512, 6.0

#: Neighbours that vote; examples of a block.
NEIGHBOURS, BLOCK = 15, 64

#: A term is a word or the first bytes of a longer one. All words without an index term count as one term more, so that
#: a text's length and how often it has a term matter to the cosine.
PREFIXES = (4, 5, 6)
REST = b"*"


def terms_of_word(word: bytes) -> list[bytes]:
    return [b"=" + word, *(word[:n] for n in PREFIXES if len(word) > n)]


@dataclass
class Index:
    """Blocks of examples: (numbers of the block's terms, weights by term and example)."""

    terms: dict[bytes, int]
    idf: np.ndarray
    ids: list
    blocks: list[tuple[np.ndarray, np.ndarray]]
    highest: np.ndarray
    votes: Votes

    def vectors(self, texts: list[bytes | None], memo: dict[bytes, tuple[int, ...]]) -> np.ndarray:
        """TF-IDF rows of unit length over the index's terms; texts without one of them are zero."""
        out = np.zeros((len(texts), len(self.idf)), np.float32)
        for row, text in enumerate(texts):
            counts: dict[int, int] = {}
            for word in spaced_words(text).split():
                found = memo.get(word)
                if found is None:
                    found = tuple(self.terms[t] for t in terms_of_word(word) if t in self.terms)
                    found = memo[word] = found or (self.terms[REST],)
                for term in found:
                    counts[term] = counts.get(term, 0) + 1
            if counts:
                at = np.fromiter(counts, np.int64)
                weights = (1 + np.log(np.fromiter(counts.values(), float))) * self.idf[at]
                out[row, at] = weights / np.sqrt((weights * weights).sum())
        return out

    def nearest(self, rows: np.ndarray, but: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of each row's nearest examples, none left out; `but` has the number a row skips.

        Ties go to the example found first; places without a neighbour have cosine 0.
        """
        near = np.zeros((len(rows), NEIGHBOURS), np.int64)
        best = np.zeros((len(rows), NEIGHBOURS), np.float32)
        if not self.blocks:
            return near, best
        bounds = rows @ self.highest
        for number in np.argsort(-bounds.sum(0), kind="stable"):
            open_rows = np.flatnonzero(bounds[:, number] > best[:, -1])
            if not len(open_rows):
                continue
            terms, weights = self.blocks[number]
            cosines = rows[np.ix_(open_rows, terms)] @ weights
            first = number * BLOCK
            if but is not None:
                own = but[open_rows] - first
                inside = np.flatnonzero((own >= 0) & (own < cosines.shape[1]))
                cosines[inside, own[inside]] = 0
            both = np.concatenate((best[open_rows], cosines), 1)
            numbers = np.broadcast_to(np.arange(first, first + cosines.shape[1]), cosines.shape)
            numbers = np.concatenate((near[open_rows], numbers), 1)
            order = np.argsort(-both, 1, kind="stable")[:, :NEIGHBOURS]
            best[open_rows] = np.take_along_axis(both, order, 1)
            near[open_rows] = np.take_along_axis(numbers, order, 1)
        return near, best


def fit(docs: DataFrame, labels: DataFrame, learnable, label: str = "toxic", examples: int = EXAMPLES) -> Index:
    """Learn from at most about `examples` whole labelled texts of each class; what reaches the driver is bounded by
    it and by TERMS. Without labelled rows the index is empty and every score is 0."""
    sample, sizes = labelled_sample(docs, labels, label, learnable, examples)

    def counter():
        def count(columns: dict) -> dict:
            found: dict[tuple[bytes, int], int] = {}
            for text, y in zip(columns["text"], columns["label"]):
                for term in {t for word in set(spaced_words(text).split()) for t in terms_of_word(word)}:
                    found[term, y] = found.get((term, y), 0) + 1
            return {"term": [t for t, _ in found], "label": [y for _, y in found], "n": list(found.values())}

        return count

    n = {row["label"]: row["n"] for row in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = max(1, n.get(0, 0)), max(1, n.get(1, 0))
    counted = map_rows(sample, "term binary, label int, n bigint", counter).groupBy("term")
    both = counted.agg(*[F.sum(F.when(F.col("label") == y, F.col("n")).otherwise(0)).alias(f"n{y}") for y in (0, 1)])
    p, all_of = (F.col("n0") + F.col("n1")) / F.lit(n0 + n1), F.col("n0") + F.col("n1")
    z = F.abs(F.col("n1") / n1 - F.col("n0") / n0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)) * (1 / n0 + 1 / n1))
    both = both.filter(all_of >= 5).withColumn("z", z).filter(F.col("z") >= LEAST_Z)
    chosen = both.orderBy(F.desc("z"), "term").limit(TERMS).collect()
    terms = {bytes(row["term"]): number for number, row in enumerate(chosen)} | {REST: len(chosen)}
    idf = [np.log(1 + (n0 + n1) / (row["n0"] + row["n1"])) for row in chosen]
    idf = np.array([*idf, np.log(2)], np.float32)

    index = Index(terms, idf, [], [], np.zeros((len(terms), 0), np.float32), Votes.of(np.zeros(0, int), {}))
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def coder():
        known = shared.value

        def code(columns: dict) -> dict:
            vectors = known.vectors(columns["text"], {})
            held = [np.flatnonzero(v) for v in vectors]
            weights = [v[at].tolist() for v, at in zip(vectors, held)]
            return {k: columns[k] for k in ("doc_id", "label")} | {"terms": [at.tolist() for at in held], "weights": weights}

        return code

    # Of an example no more than its weights comes to the driver, whatever its length.
    coded = map_rows(sample, "doc_id bigint, label int, terms array<int>, weights array<float>", coder)
    rows = coded.orderBy("doc_id").collect()
    if not rows:
        return index
    vectors = np.zeros((len(rows), len(terms)), np.float32)
    for vector, row in zip(vectors, rows):
        vector[row["terms"]] = row["weights"]
    order = np.lexsort((np.arange(len(rows)), vectors.argmax(1), vectors.max(1) == 0))
    vectors, rows = vectors[order], [rows[at] for at in order]
    index.ids = [row["doc_id"] for row in rows]
    for first in range(0, len(rows), BLOCK):
        part = vectors[first : first + BLOCK]
        held = np.flatnonzero(part.any(0))
        index.blocks.append((held, np.ascontiguousarray(part[:, held].T)))
    index.highest = np.stack([vectors[f : f + BLOCK].max(0) for f in range(0, len(rows), BLOCK)], 1)
    index.votes = Votes.of(np.array([row["label"] for row in rows]), sizes)
    index.votes.calibrate(index.votes.raw(*index.nearest(vectors, np.arange(len(rows)))))
    return index


ADDED = "score double, predicted int, neighbours array<struct<doc_id:bigint,cosine:double,label:int>>, evidence array<string>"


def score(docs: DataFrame, index: Index, evidence: int = 3) -> DataFrame:
    """Documents with score (0 to 1), predicted (1 from 0.5 on), and the evidence: the nearest examples with their
    cosine and label, and the text's heaviest index terms.

    Whole texts, one narrow pass. Null and empty texts, and those without words have no neighbours and get
    the score calibrated for that. Columns of these names are replaced, others stay; equal texts get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)
    added = StructType.fromDDL(ADDED)
    stay = [F.col(f"`{name}`") for name in docs.columns if name not in added.names]
    rows = docs.select(F.struct(*stay).alias("document"), text_bytes())
    schema = StructType([rows.schema["document"], *added])
    arrow = to_arrow_schema(schema)

    def loop(batches):
        known = shared.value
        names = [t.decode("utf-8", "replace") for t in known.terms]
        memo: dict[bytes, tuple[int, ...]] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                if len(memo) > 500_000:
                    memo.clear()
                vectors = known.vectors([x.as_py() for x in batch.column("text")], memo)
                near, similar = known.nearest(vectors)
                scores = known.votes.scores(known.votes.raw(near, similar)) if known.ids else np.full(len(vectors), known.votes.base)
                scores = np.clip(scores, 0, 1)
                heavy = np.argsort(-vectors, 1)[:, :evidence] if known.terms else np.zeros((len(vectors), 0), int)
                shown = [
                    [{"doc_id": known.ids[n], "cosine": float(s), "label": int(known.votes.labels[n])} for n, s in zip(ns[:evidence], ss) if s > 0]
                    for ns, ss in zip(near, similar)
                ]
                words = [[names[t] for t in ts if v[t] > 0 and known.terms[REST] != t] for ts, v in zip(heavy, vectors)]
                out = (scores, (scores >= 0.5).astype(np.int32), shown, words)
                arrays = [pa.array(x, arrow.field(k + 1).type) for k, x in enumerate(out)]
                yield pa.RecordBatch.from_arrays([batch.column("document"), *arrays], schema=arrow)

    return shipped(rows).mapInArrow(loop, schema).select("document.*", *added.names)
