"""Ranked lexical search over bit-sliced Bloom signatures.

A document's signature has bits for its terms, and for each of several frequencies that a term reaches. Signatures of a
block of documents are kept by slices: one bit of all its documents after the other. ANDing the slices of a term gives
the documents that may hold it, never too few. Sums of such bitmaps, weighted by what a term adds to the score at that
frequency and the document's length, bound every document's score from above. Documents whose bound does not reach what
the last of the wanted ones is known to score are excluded; all others are scored exactly on their whole texts.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wireloom.llm.text import map_rows, mixed, shipped, spaced_words, text_bytes, written
from wireloom.operators.order import first_of_groups

#: Term frequencies that have bits of their own.
LEVELS = (1, 2, 3, 4, 5, 6, 8, 12, 16, 24, 32, 64, 128, 512)

#: Bits of a signature for each of its terms and levels, bits that each sets, and the most bits of a signature. One of
#: more terms than fit is fuller, so that its bounds are looser; its scores are as exact.
BITS, HASHES, MOST_BITS = 12, 5, 1 << 20

#: Documents of a block, and bytes of its slices.
BLOCK, BLOCK_BYTES = 2048, 4 << 20

#: Results of an item, and documents of the highest bounds that are scored first, to know what its results reach.
RESULTS, SEEDS = 10, 40

#: Terms of the items that are searched for at a time; those looked up in a block at a time.
PART_TERMS, LOOKED_UP = 200_000, 4096

#: Place of rows without an id: behind all others.
NO_ID = (1 << 63) - 1

INDEX = "bits int, ids array<bigint>, sizes array<bigint>, slices binary"


class Hashes(dict):
    """64-bit hashes of terms; those seen last are remembered."""

    def __missing__(self, term: bytes) -> int:
        if len(self) >= 1 << 20:
            self.clear()
        found = self[term] = int.from_bytes(hashlib.blake2b(term, digest_size=8).digest(), "little")
        return found


def _of_level(hashes: np.ndarray, level: int) -> np.ndarray:
    return mixed(hashes + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


def _positions(keys: np.ndarray, bits: int) -> np.ndarray:
    """Bits that each key sets in a signature, a row a key."""
    first, step = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    return ((first[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) % np.uint64(bits)).astype(np.int64)


def _keys(counts: Counter, hashes: Hashes) -> np.ndarray:
    terms = np.fromiter(map(hashes.__getitem__, counts), np.uint64, len(counts))
    times = np.fromiter(counts.values(), np.int64, len(counts))
    keys = []
    for level, least in enumerate(LEVELS):
        reach = times >= least
        if not reach.any():
            break
        keys.append(_of_level(terms[reach], level))
    return np.concatenate(keys)


def _bits_for(keys: int) -> int:
    """Signature sizes are in steps of a square root of two, so that a block's documents have about as many keys."""
    step = math.ceil(2 * math.log2(max(keys, 16)))
    return min(MOST_BITS, math.ceil(BITS * 2 ** (step / 2)))


def _block(bits: int, held: list[tuple[int, int, np.ndarray]]) -> dict:
    flags = np.zeros((bits, -(-len(held) // 8) * 8), bool)
    for column, (_, _, keys) in enumerate(held):
        flags[_positions(keys, bits), column] = True
    return {"bits": bits, "ids": [h[0] for h in held], "sizes": [h[1] for h in held], "slices": np.packbits(flags, axis=1).tobytes()}


def build_index(docs: DataFrame) -> DataFrame:
    """The blocks of all documents that have a term: signature bits, ids, numbers of terms, slices.

    Documents of about as many terms share a block. One narrow pass; a task holds one open block of each size. Rows
    without an id are kept under NO_ID.
    """
    arrow = to_arrow_schema(StructType.fromDDL(INDEX))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"), text_bytes())

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, open_blocks = Hashes(), {}

        def made(bits: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_block(bits, open_blocks.pop(bits))], schema=arrow)

        with np.errstate(over="ignore"):
            for batch in batches:
                for number, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                    words = spaced_words(text.as_py()).split()
                    if not words:
                        continue
                    keys = _keys(Counter(words), hashes)
                    bits = _bits_for(len(keys))
                    held = open_blocks.setdefault(bits, [])
                    held.append((number, len(words), keys))
                    if len(held) == BLOCK or len(held) * bits >= 8 * BLOCK_BYTES:
                        yield made(bits)
            for bits in list(open_blocks):
                yield made(bits)

    return written(shipped(rows).mapInArrow(loop, INDEX), "signatures")


@dataclass
class Chunk:
    """Terms that are looked up together, by hash, and for each item the numbers and weights of those it has of them.

    `ends` tells whether the next chunk has no more terms of an item.
    """

    hashes: np.ndarray
    items: list[tuple[int, np.ndarray, np.ndarray, bool]]


@dataclass
class Search:
    """A part of the items, with what scoring needs to know of the corpus."""

    n_docs: int
    n_terms: int
    weights: dict[bytes, int] = field(default_factory=dict)
    items: list[Counter] = field(default_factory=list)
    chunks: list[Chunk] = field(default_factory=list)

    def spread(self, sizes: np.ndarray) -> np.ndarray:
        """m of documents of these sizes, in whole numbers."""
        most = int(sizes.max(initial=0))
        if 75 * most * self.n_docs < 1 << 63:
            return 25 + 75 * sizes * self.n_docs // self.n_terms
        return np.array([25 + 75 * int(n) * self.n_docs // self.n_terms for n in sizes], np.int64)

    def score(self, item: int, counts: Counter, size: int) -> int:
        m = int(self.spread(np.array([size]))[0])
        total = 0
        for term, times in self.items[item].items():
            tf = counts.get(term, 0)
            if tf:
                total += times * self.weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
        return total

    def bounds(self, bits: int, sizes: np.ndarray, slices: bytes) -> Iterator[tuple[int, np.ndarray]]:
        """(item, bounds of the scores of a block's documents). Sums are whole numbers below 2^53, so doubles are exact."""
        planes = np.frombuffer(slices, np.uint8).reshape(bits, -1)
        m = self.spread(sizes)
        # What a term adds at most if its frequency is below the next level; behind the last level it adds up to a million.
        reach = [1_000_000_000 * (above - 1) // (1000 * (above - 1) + 8 * m) for above in LEVELS[1:]] + [np.full(len(m), 1_000_000)]
        sums = 0.0
        for chunk in self.chunks:
            adds = np.zeros((len(chunk.hashes), len(sizes)))
            terms = np.arange(len(chunk.hashes))
            for level in range(len(LEVELS)):
                places = _positions(_of_level(chunk.hashes[terms], level), bits)
                found = np.bitwise_and.reduce(planes[places], axis=1)
                if level:
                    found &= before
                some = found.any(1)
                terms, before = terms[some], found[some]
                if not len(terms):
                    break
                more = reach[level] - (reach[level - 1] if level else 0)
                adds[terms] += np.unpackbits(before, axis=1, count=len(sizes)) * more
            for item, at, weights, ends in chunk.items:
                sums = sums + weights @ adds[at]
                if ends:
                    yield item, sums
                    sums = 0.0


def _item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the terms of all texts of an id, repeats included."""

    def splitter():
        return lambda columns: {"item_id": columns["item_id"], "terms": [spaced_words(text).split() for text in columns["text"]]}

    typed = StructType([items.select("item_id").schema[0], *StructType.fromDDL("terms array<binary>")])
    rows = map_rows(items.select("item_id", text_bytes()), typed, splitter)
    return written(rows.groupBy("item_id").agg(F.flatten(F.collect_list("terms")).alias("terms")), "items")


def document_frequencies(docs: DataFrame, terms: set[bytes]) -> dict[bytes, int]:
    """How many documents hold each term; one number a term comes to the driver."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def counter():
        known = shared.value

        def count(columns: dict) -> dict:
            found: Counter = Counter()
            for text in columns["text"]:
                found.update(known.intersection(spaced_words(text).split()))
            return {"term": list(found), "n": list(found.values())}

        return count

    rows = map_rows(docs.select(text_bytes()), "term binary, n bigint", counter, step=4096)
    return {bytes(row["term"]): row["n"] for row in rows.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def _prepared(docs: DataFrame, index: DataFrame, items: list[Counter]) -> Search:
    totals = index.select(F.size("ids").alias("n"), F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("terms"))
    n_docs, n_terms = totals.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    terms = sorted({term for item in items for term in item})
    frequency = document_frequencies(docs, set(terms)) if terms else {}
    weight = lambda df: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    search = Search(n_docs, n_terms, {term: weight(frequency.get(term, 0)) for term in terms}, items)
    hashes, number, members = Hashes(), {}, []

    def close() -> None:
        if members:
            search.chunks.append(Chunk(np.fromiter(map(hashes.__getitem__, number), np.uint64, len(number)), members.copy()))
        number.clear()
        members.clear()

    for place, item in enumerate(items):
        held = list(item)
        for first in range(0, len(held), LOOKED_UP):
            some = held[first : first + LOOKED_UP]
            if len(number) + len(some) > LOOKED_UP:
                close()
            at = np.array([number.setdefault(term, len(number)) for term in some], np.int64)
            weights = np.array([item[term] * search.weights[term] for term in some], float)
            members.append((place, at, weights, first + LOOKED_UP >= len(held)))
    close()
    return search


def _bounded(index: DataFrame, search, reached: dict[int, tuple[int, int]] | None) -> DataFrame:
    """(item, id, bound) of documents that may score. Without `reached` those of the SEEDS highest bounds of each item in
    each task; with it all whose bound is above what is reached, or equal to it with no larger id."""
    schema = "item int, id bigint, bound bigint"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def rows(item: int, ids: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
        columns = [np.full(len(ids), item, np.int32), ids, bounds.astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, best = search.value, {}
        with np.errstate(over="ignore"):
            for batch in batches:
                for block in batch.to_pylist():
                    ids, sizes = np.array(block["ids"], np.int64), np.array(block["sizes"], np.int64)
                    for item, bounds in known.bounds(block["bits"], sizes, block["slices"]):
                        if reached is not None:
                            score, last = reached.get(item, (0, -1))
                            hit = np.flatnonzero((bounds > score) | ((bounds == score) & (ids <= last) & (score > 0)))
                            if len(hit):
                                yield rows(item, ids[hit], bounds[hit])
                            continue
                        hit = np.flatnonzero(bounds > 0)
                        if len(hit):
                            old = best.get(item, (np.zeros(0, np.int64), np.zeros(0)))
                            both, sums = np.concatenate((old[0], ids[hit])), np.concatenate((old[1], bounds[hit]))
                            top = np.lexsort((both, -sums))[:SEEDS]
                            best[item] = both[top], sums[top]
            for item, (ids, bounds) in best.items():
                yield rows(item, ids, bounds)

    return shipped(index).mapInArrow(loop, schema)


def _scored(docs: DataFrame, candidates: DataFrame, search) -> DataFrame:
    """(item, doc_id, score) of the candidates that score, by their whole texts."""
    wanted = candidates.groupBy("id").agg(F.collect_set("item").alias("items"))
    wanted = written(wanted, "candidates")
    keyed = docs.select("doc_id", text_bytes(), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"))

    def scorer():
        known = search.value

        def score(columns: dict) -> dict:
            out: dict[str, list] = {"item": [], "doc_id": [], "score": []}
            for number, text, items in zip(columns["doc_id"], columns["text"], columns["items"]):
                words = spaced_words(text).split()
                counts = Counter(words)
                for item in items:
                    points = known.score(item, counts, len(words))
                    if points > 0:
                        for name, value in zip(out, (item, number, points)):
                            out[name].append(value)
            return out

        return score

    rows = keyed.join(wanted, "id").select("doc_id", "text", "items")
    return map_rows(rows, "item int, doc_id bigint, score bigint", scorer)


def _order() -> tuple:
    return F.desc("score"), F.asc_nulls_last("doc_id")


def search(docs: DataFrame, items: DataFrame, index: DataFrame | None = None, results: int = RESULTS) -> DataFrame:
    """item_id, rank, doc_id, score: the documents of the highest scores above 0 of each item, ties by ascending doc_id.

    Rows of one item_id, null among them, are one item with the terms of all of them; items without a term, or whose
    terms no document holds, have no rows. Documents that share an id are scored each on its own; those without one
    come last in ties. Null and empty texts have no terms. Empty tables give no rows. Only the named columns of the
    inputs are used. Items are searched for in parts of at most PART_TERMS terms (or one item), one after the other,
    so broadcasts are bounded; an index may be given to be used again.
    """
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    index = build_index(docs) if index is None else index
    terms = _item_terms(items)
    total = terms.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    parts = max(1, -(-total // PART_TERMS))
    found = []
    for part in range(parts):
        mine = terms.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).orderBy("item_id").collect()
        named = spark.createDataFrame([(n, row["item_id"]) for n, row in enumerate(mine)], StructType([*StructType.fromDDL("item int"), terms.schema["item_id"]]))
        prepared = _prepared(docs, index, [Counter(map(bytes, row["terms"])) for row in mine])
        shared = spark.sparkContext.broadcast(prepared)
        seeds = first_of_groups(_bounded(index, shared, None), max(SEEDS, results), ["item"], F.desc("bound"), F.col("id"))
        seeded = first_of_groups(_scored(docs, seeds, shared), results, ["item"], *_order())
        last = seeded.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct("score", "doc_id"), F.struct("score", -F.coalesce("doc_id", F.lit(NO_ID)))).alias("last"))
        reached = {
            row["item"]: (row["last"]["score"], NO_ID if row["last"]["doc_id"] is None else row["last"]["doc_id"])
            for row in last.filter(F.col("n") >= results).collect()
        }
        best = first_of_groups(_scored(docs, _bounded(index, shared, reached), shared), results, ["item"], *_order())
        rank = F.row_number().over(Window.partitionBy("item").orderBy(*_order())).alias("rank")
        best = best.join(F.broadcast(named), "item").select("item_id", rank, "doc_id", "score")
        found.append(written(best, "found"))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows
