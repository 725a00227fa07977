"""Removal of repeated strings of 100 bytes, over all documents, by prefix-free parsing.

A rolling hash chooses triggers, so that every string of LENGTH bytes has exactly one, given by its bytes alone. Starts
that share a trigger are a phrase; its context, the bytes of all its strings, is an entry of the dictionary. Equal
strings lie in phrases of equal triggers, so the corpus is compared in three levels, each on what the one before left:
trigger strings (most occur once and end it), contexts (a context seen earlier is repeated as a whole), and single
strings of phrases whose trigger has several contexts. Each level is one exchange of fingerprints by their range.
Documents travel in blocks, and a block sends each fingerprint once, so no passage, however common, weighs on one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

from wireloom.llm.packing import packed, squeezed, squeezed_text, steps, unpacked, unsqueezed, walks
from wireloom.llm.text import RangeHash, kept, mixed, shipped, text_bytes

#: Bytes of a string; bytes a trigger's rolling hash reads; starts of strings that a trigger is chosen among.
LENGTH, ROLLING, REACH = 100, 8, 60

#: Bytes of text in a block, about (a longer text is a block of its own), and bytes that are parsed at a time.
BLOCK_BYTES, PARSED = 12 << 20, 1 << 20

#: Bytes of text for each range of fingerprints.
RANGE_BYTES = 16 << 20


def rolling_hashes(data: np.ndarray) -> np.ndarray:
    """32-bit hash of the ROLLING bytes from each position; positions too near the end have none."""
    count = max(len(data) - ROLLING + 1, 0)
    words = np.zeros(count, np.uint64)
    for place in range(ROLLING):
        words = (words << np.uint64(8)) | data[place : place + count]
    return mixed(words) >> np.uint64(32)


def triggers(hashes: np.ndarray, reach: int = REACH) -> np.ndarray:
    """For each position with `reach` hashes from it on, the position of the smallest of them, the leftmost of ties."""
    count = len(hashes) - reach + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    keys = (hashes << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    blocks = np.full(-(-len(keys) // reach) * reach, np.uint64(2**64 - 1))
    blocks[: len(keys)] = keys
    blocks = blocks.reshape(-1, reach)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:count], ahead[reach - 1 : reach - 1 + count])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


class Parse:
    """The phrases of a block of texts: text number, first start, number of starts, fingerprints of trigger string and
    context. Texts are parsed in stretches that overlap by a string, so a phrase may be cut in two; that changes its
    context, not its strings, and strings decide."""

    def __init__(self, texts: list[bytes], hasher: RangeHash) -> None:
        self.texts, self.hasher = texts, hasher
        found: list[tuple[np.ndarray, ...]] = []
        pieces: list[tuple[int, int, bytes]] = []
        size = 0
        for number, text in enumerate(texts):
            for begin in range(0, len(text) - LENGTH + 1, PARSED):
                pieces.append((number, begin, text[begin : begin + PARSED + LENGTH - 1]))
                size += len(pieces[-1][2])
                if size >= PARSED:
                    found.append(self._parsed(pieces))
                    pieces, size = [], 0
        if pieces:
            found.append(self._parsed(pieces))
        none = tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
        self.owner, self.low, self.count, self.keys, self.contexts = map(np.concatenate, zip(none, *found))

    def _parsed(self, pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
        lengths = np.array([len(text) for _, _, text in pieces], np.int64)
        begins = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(text for _, _, text in pieces), np.uint8)
        starts = lengths - LENGTH + 1
        at = np.repeat(begins - (np.cumsum(starts) - starts), starts) + np.arange(starts.sum())
        owner = np.repeat(np.arange(len(pieces)), starts)
        anchor = triggers(rolling_hashes(data))[at]
        new = np.ones(len(at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(at)))
        low, owner, anchor = at[first], owner[first], anchor[first]
        sums = self.hasher.prefixes(data)
        keys = self.hasher.ranges(sums, anchor, anchor + (LENGTH - REACH + 1)) >> np.uint64(16)
        contexts = self.hasher.ranges(sums, low, low + count - 1 + LENGTH)
        number, begin = (np.array(x, np.int64) for x in zip(*((n, b) for n, b, _ in pieces)))
        return number[owner], low - begins[owner] + begin[owner], count, keys, contexts

    def strings(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, start and fingerprint of every string of the chosen phrases."""
        out = []
        for at in range(0, len(chosen), 1 << 13):
            part = chosen[at : at + (1 << 13)]
            owner, low, count = self.owner[part], self.low[part], self.count[part]
            contexts = [self.texts[o][s : s + n - 1 + LENGTH] for o, s, n in zip(owner.tolist(), low.tolist(), count.tolist())]
            sums = self.hasher.prefixes(np.frombuffer(b"".join(contexts), np.uint8))
            begins = np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1)
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            first = np.repeat(begins, count) + within
            hashes = self.hasher.ranges(sums, first, first + LENGTH)
            out.append((np.repeat(owner, count), np.repeat(low, count) + within, hashes))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return tuple(map(np.concatenate, zip(*out)))


class Entries:
    """The distinct fingerprints of a block in order, with how often each occurs and the least document id of each."""

    def __init__(self, hashes: np.ndarray, owner: np.ndarray, ids: np.ndarray) -> None:
        self.hashes, self.where, self.counts = np.unique(hashes, return_inverse=True, return_counts=True)
        self.ids = ids[owner]
        self.least = np.full(len(self.hashes), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.where, self.ids)

    def repeated(self, earlier: np.ndarray, owner: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Of each occurrence: whether one comes before it. `earlier`: whether another block has a smaller id."""
        out = earlier[self.where] | (self.ids > self.least[self.where])
        order = np.lexsort((start, owner, self.where))
        again = np.zeros(len(order), bool)
        again[1:] = (self.where[order][1:] == self.where[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        out[order] |= again
        return out


def _range_of(hashes: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    return (((hashes >> np.uint64(bits - 32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


SENT = "range int, block bigint, hashes binary, counts binary, ids binary"
REPLY = "block bigint, level int, range int, totals binary, earlier binary"


def _sent(block: int, entries: Entries, bits: int, ranges: int) -> Iterator[dict]:
    """An entry row for each range that the block has fingerprints in; ids are shifted to be non-negative."""
    place = _range_of(entries.hashes, bits, ranges)
    for at in np.split(np.arange(len(place)), np.flatnonzero(np.diff(place)) + 1):
        if len(at):
            ids = entries.least[at].astype(np.uint64) ^ np.uint64(1 << 63)
            hashes = steps(entries.hashes[at], np.array([len(at)]))
            yield {
                "range": int(place[at[0]]), "block": block, "hashes": packed(hashes),
                "counts": packed(entries.counts[at]), "ids": squeezed(ids.byteswap().view(np.uint8).reshape(-1, 8).T.tobytes()),
            }


def _merge(level: int) -> Callable[[pa.Table], pa.Table]:
    """All entries of a range: totals over the blocks, and for each whether another block has a smaller id."""

    arrow = to_arrow_schema(StructType.fromDDL(REPLY))

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        hashes, counts, ids = [], [], []
        for row in rows:
            own = unpacked(row["hashes"])
            hashes.append(walks(own, np.array([len(own)])))
            counts.append(unpacked(row["counts"]).astype(np.int64))
            planes = np.frombuffer(unsqueezed(row["ids"]), np.uint8).reshape(8, -1)
            ids.append(np.ascontiguousarray(planes.T).view(">u8").ravel().astype(np.uint64))
        lengths = [len(h) for h in hashes]
        codes, where = np.unique(np.concatenate(hashes), return_inverse=True)
        counts, ids = np.concatenate(counts), np.concatenate(ids)
        totals = np.bincount(where, weights=counts, minlength=len(codes)).astype(np.int64)
        least = np.full(len(codes), np.uint64(2**64 - 1))
        np.minimum.at(least, where, ids)
        totals, earlier = totals[where], least[where] < ids
        cuts = np.cumsum(lengths)[:-1]
        return pa.Table.from_pydict(
            {
                "block": [row["block"] for row in rows], "level": [level] * len(rows), "range": [row["range"] for row in rows],
                "totals": [packed(x) for x in np.split(totals, cuts)],
                "earlier": [squeezed(np.packbits(x).tobytes()) + len(x).to_bytes(4, "big") for x in np.split(earlier, cuts)],
            },
            schema=arrow,
        )

    return merge


class Level:
    """Replies to a block's entries of one level, in the order of its fingerprints."""

    def __init__(self, rows: list[dict]) -> None:
        rows = sorted(rows, key=lambda row: row["range"])
        flags = [
            np.unpackbits(np.frombuffer(unsqueezed(row["earlier"][:-4]), np.uint8), count=int.from_bytes(row["earlier"][-4:], "big"))
            for row in rows
        ]
        self.totals = np.concatenate([unpacked(row["totals"]) for row in rows] or [np.zeros(0, np.uint64)]).astype(np.int64)
        self.earlier = np.concatenate(flags or [np.zeros(0, np.uint8)]).astype(bool)


class Work:
    """A block, parsed, as far as the replies go."""

    def __init__(self, row: dict, replies: list[dict], hasher: RangeHash) -> None:
        data, at = unsqueezed(row["texts"]), 0
        self.texts = []
        for length in unpacked(row["lengths"]).tolist():
            self.texts.append(data[at : at + length])
            at += length
        self.ids = np.frombuffer(unsqueezed(row["ids"]), np.int64)
        self.parse = parse = Parse(self.texts, hasher)
        levels = [Level([x for x in replies if x["level"] == n]) for n in (1, 2, 3)]
        self.first = Entries(parse.keys, parse.owner, self.ids)
        if not replies:
            return
        # Phrases whose trigger string occurs again somewhere.
        key_total = levels[0].totals[self.first.where]
        self.again = np.flatnonzero(key_total > 1)
        owner, low = parse.owner[self.again], parse.low[self.again]
        self.second = Entries(parse.contexts[self.again], owner, self.ids)
        if not len(levels[1].totals):
            return
        self.whole = self.second.repeated(levels[1].earlier, owner, low)
        # The first of a context, where its trigger string has other contexts too: its strings are looked at one by one.
        several = key_total[self.again] > levels[1].totals[self.second.where]
        self.owners, self.starts, hashes = parse.strings(self.again[~self.whole & several])
        self.third = Entries(hashes, self.owners, self.ids)
        self.single = self.third.repeated(levels[2].earlier, self.owners, self.starts) if len(levels[2].totals) else None

    def spans(self) -> list[list[tuple[int, int]]]:
        """Repeated bytes of each text, as maximal runs."""
        out: list[list[tuple[int, int]]] = [[] for _ in self.texts]
        if not hasattr(self, "whole"):
            return out
        parse, rows = self.parse, self.again[self.whole]
        found = [(parse.owner[rows], parse.low[rows], parse.low[rows] + parse.count[rows] - 1 + LENGTH)]
        if self.single is not None:
            found.append((self.owners[self.single], self.starts[self.single], self.starts[self.single] + LENGTH))
        owner, start, end = map(np.concatenate, zip(*found))
        order = np.lexsort((start, owner))
        for o, s, e in zip(owner[order].tolist(), start[order].tolist(), end[order].tolist()):
            mine = out[o]
            if mine and s <= mine[-1][1]:
                mine[-1] = (mine[-1][0], max(mine[-1][1], e))
            else:
                mine.append((s, e))
        return out


def find_repeats(docs: DataFrame) -> DataFrame:
    """Documents, without their text, with n_bytes, n_removed, n_spans, spans (start and end byte of each maximal run of
    repeated bytes) and kept (the other bytes).

    A byte is repeated if a string of LENGTH bytes over it also starts earlier: in a document of a smaller id, or in
    the same one. Null texts are empty, and texts under LENGTH bytes keep everything. Rows that share an id, or have
    none, are not earlier than one another; rows without an id come first. An empty table gives no rows. Columns of
    the added names are replaced, others stay. Fingerprints have 64 bits and are taken as the strings: of n of them
    about n * n / 2^65 pairs are expected to agree by chance.
    """
    added = ("n_bytes", "n_removed", "n_spans", "spans", "kept")
    stay = [F.col(f"`{name}`") for name in docs.columns if name not in (*added, "text")]
    rows = docs.select(F.struct(*stay).alias("document"), F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("id"), text_bytes())
    document = rows.schema["document"].dataType
    schema = StructType().add("documents", ArrayType(document)).add("ids", "binary").add("lengths", "binary").add("texts", "binary")
    arrow = to_arrow_schema(schema)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents, ids, texts = [], [], []

        def block() -> pa.RecordBatch:
            data = {
                "documents": documents, "ids": squeezed(np.array(ids, np.int64).tobytes()),
                "lengths": packed(np.array([len(t) for t in texts])), "texts": squeezed_text(b"".join(texts)),
            }
            return pa.RecordBatch.from_pylist([data], schema=arrow)

        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                for row, number, text in zip(part.column("document").to_pylist(), part.column("id").to_pylist(), part.column("text")):
                    documents.append(row)
                    ids.append(number)
                    texts.append(text.as_py() or b"")
                    size += len(texts[-1])
                    if size >= BLOCK_BYTES:
                        yield block()
                        documents, ids, texts, size = [], [], [], 0
        if documents:
            yield block()

    held = kept(shipped(rows).mapInArrow(blocks, schema).withColumn("block", F.monotonically_increasing_id()))
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    ranges = int(min(1 << 16, max(8, total // RANGE_BYTES)))
    sent_arrow = to_arrow_schema(StructType.fromDDL(SENT))

    def entries(level: int):
        def of_table(left: pa.Table, right: pa.Table | None = None) -> pa.Table:
            out: list[dict] = []
            for row in left.to_pylist():
                with np.errstate(over="ignore"):
                    work = Work(row, right.to_pylist() if right is not None else [], RangeHash())
                    own = getattr(work, ("first", "second", "third")[level - 1], None)
                    if own is not None:
                        out.extend(_sent(row["block"], own, 48 if level == 1 else 64, ranges))
            return pa.Table.from_pylist(out, schema=sent_arrow)

        return of_table

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield from entries(1)(pa.Table.from_batches([batch.slice(at, 1)])).to_batches()

    replies = None
    for level in (1, 2, 3):
        if replies is None:
            sent = held.drop("documents").mapInArrow(of_batches, SENT)
        else:
            sent = held.drop("documents").groupBy("block").cogroup(replies.groupBy("of_block")).applyInArrow(entries(level), SENT)
        answer = kept(sent.groupBy("range").applyInArrow(_merge(level), REPLY).withColumnRenamed("block", "of_block"))
        replies = answer if replies is None else replies.unionByName(answer)

    result = StructType().add("document", document).add("n_bytes", "long")
    result = result.add("spans", StructType.fromDDL("a array<struct<start:bigint,end:bigint>>")["a"].dataType).add("kept", "binary")
    result_arrow = to_arrow_schema(result)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[dict] = []
        for row in left.to_pylist():
            with np.errstate(over="ignore"):
                work = Work(row, right.to_pylist(), RangeHash())
            for own, text, spans in zip(row["documents"], work.texts, work.spans()):
                left_over, at = [], 0
                for start, end in spans:
                    left_over.append(text[at:start])
                    at = end
                out.append({
                    "document": own, "n_bytes": len(text), "spans": [{"start": s, "end": e} for s, e in spans],
                    "kept": b"".join([*left_over, text[at:]]),
                })
        return pa.Table.from_pylist(out, schema=result_arrow)

    found = held.groupBy("block").cogroup(replies.groupBy("of_block")).applyInArrow(cut, result)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        *[F.col("document")[name].alias(name) for name in document.names], "n_bytes", removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), "spans", "kept",
    )
