"""Token counts without token ids: pieces are counted once for each distinct pre-token.

Documents are cut into blocks. A block keeps, packed, how often each of its documents has each of its pre-tokens, and
gives out each pre-token once. Spark brings equal pre-tokens of all blocks together, counts the pieces of each once with
the tokenizer, and joins the counts to the blocks, where a document's tokens are the sum of counts times frequencies.
"""

from __future__ import annotations

import json
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, StructType

from wireloom.llm.packing import packed, squeezed, steps, stretch_sums, unpacked, unsqueezed, walks
from wireloom.llm.text import kept, shipped, text_bytes

#: Bytes of text in a block, about. A longer text is a block of its own.
BLOCK_BYTES = 16 << 20

#: Fixed value: the published pre-token pattern of byte-level BPE vocabularies.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A blank with white space or nothing after it: there a text can't be cut at blanks.
UNEVEN = r" (?=\s|$)"


class PreTokens:
    """Cuts texts into chunks, and chunks into pre-tokens. Blanks begin pre-tokens, so what lies between two blanks can
    be cut alone, with the blank before it, and each chunk of a block is cut once.

    A chunk is named by its text without that blank. Pieces without a blank before them have one put in front of
    their name, which no other chunk's name begins with.
    """

    def __init__(self, special: list[str]) -> None:
        self.pattern, self.uneven, self.special = regex.compile(PRE_TOKEN), re.compile(UNEVEN), special
        self.cut = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def chunks(self, text: str) -> tuple[Counter, int]:
        """Names of chunks with their counts, and the number of special strings, each of which is one token."""
        parts, specials = [text], 0
        if self.cut and any(name in text for name in self.special):
            parts = self.cut.split(text)
            specials = len(parts) - 1
        counts: Counter = Counter()
        for part in parts:
            if self.uneven.search(part):
                counts.update([" " + found for found in self.pattern.findall(part)])
            elif part:
                first, *rest = part.split(" ")
                counts.update(rest)
                if first:
                    counts[" " + first] += 1
        return counts, specials

    def of_chunk(self, name: str) -> list[str]:
        whole = name[1:] if name[0] == " " else " " + name
        return [whole] if name.isalpha() else self.pattern.findall(whole)


def _numbers(data: bytes) -> np.ndarray:
    return unpacked(data).astype(np.int64)


class Block:
    """Frequencies of the chunks of some documents, in numbers of the block."""

    def __init__(self) -> None:
        self.documents: list[dict] = []
        self.chunks: dict[str, int] = {}
        self.lengths, self.places, self.counts, self.specials = array("I"), array("I"), array("I"), array("I")
        self.size = 0

    def add(self, document: dict, text: bytes | None, cutter: PreTokens) -> None:
        counts, specials = cutter.chunks(text.decode("utf-8", "replace") if text else "")
        self.documents.append(document)
        self.lengths.append(len(counts))
        numbers = self.chunks
        for chunk in counts:
            self.places.append(numbers.setdefault(chunk, len(numbers)))
        self.counts.extend(counts.values())
        self.specials.append(specials)
        self.size += len(text or b"")

    def row(self, cutter: PreTokens) -> dict:
        """Frequent chunks get small numbers and a document's numbers rise, so that they pack well."""
        numbers: dict[str, int] = {}
        in_chunk, places = array("I"), array("I")
        lengths, chunks = np.array(self.lengths, np.int64), np.array(self.places, np.int64)
        often = np.argsort(-np.bincount(chunks, minlength=len(self.chunks)), kind="stable")
        names = list(self.chunks)
        for chunk in often.tolist():
            found = cutter.of_chunk(names[chunk])
            in_chunk.append(len(found))
            places.extend(numbers.setdefault(name, len(numbers)) for name in found)
        rank = np.empty(len(often), np.int64)
        rank[often] = np.arange(len(often))
        chunks = rank[chunks]
        order = np.lexsort((chunks, np.repeat(np.arange(len(lengths)), lengths)))
        counts = np.array(self.counts, np.int64)[order]
        parts = (lengths, steps(chunks[order], lengths), counts, np.array(self.specials), np.array(in_chunk), np.array(places))
        coded = [name.encode() for name in numbers]
        return {
            "documents": self.documents,
            "parts": [packed(p) for p in parts],
            "names": [packed(np.array([len(c) for c in coded])), squeezed(b"".join(coded))],
        }


def special_strings(tokenizer: str) -> list[str]:
    with open(tokenizer, encoding="utf-8") as file:
        return [token["content"] for token in json.load(file).get("added_tokens", ())]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """Documents, without their text, with n_bytes, n_tokens and over_limit (n_tokens > limit).

    `tokenizer` is the path of a byte-level BPE file that every executor has. Null texts are empty and have no tokens;
    special strings inside a text are one token each. Rows that repeat are each counted; an empty table gives no
    rows. Columns of the added names are replaced, others stay.
    """
    added = ("n_bytes", "n_tokens", "over_limit")
    stay = [F.col(f"`{name}`") for name in docs.columns if name not in (*added, "text")]
    rows = docs.select(F.struct(*stay).alias("document"), text_bytes())
    document = rows.schema["document"].dataType
    special = special_strings(tokenizer)
    inner = StructType([*document.fields]).add("n_bytes", "long")
    binaries = ArrayType(BinaryType())
    block_schema = StructType().add("documents", ArrayType(inner)).add("parts", binaries).add("names", binaries)
    arrow = to_arrow_schema(block_schema)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, block = PreTokens(special), Block()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                for row, text in zip(part.column("document").to_pylist(), part.column("text")):
                    text = text.as_py()
                    block.add(row | {"n_bytes": len(text or b"")}, text, cutter)
                    if block.size >= BLOCK_BYTES:
                        yield pa.RecordBatch.from_pylist([block.row(cutter)], schema=arrow)
                        block = Block()
        if block.documents:
            yield pa.RecordBatch.from_pylist([block.row(cutter)], schema=arrow)

    held = kept(shipped(rows).mapInArrow(blocks, block_schema).withColumn("block", F.monotonically_increasing_id()))
    named = held.select("block", "names").mapInArrow(_names, "name string, of_block bigint, place int")
    # A name comes once from each block, so names meet in one place at small cost, and each is counted once there.
    counter = _piece_counter(tokenizer)
    counted = named.repartition("name").sortWithinPartitions("name").mapInArrow(
        counter, "of_block bigint, places binary, pieces binary"
    )

    result = StructType().add("document", inner).add("n_tokens", "long")
    result_arrow = to_arrow_schema(result)

    def total(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return result_arrow.empty_table()
        row = left.slice(0, 1).to_pylist()[0]
        lengths, rises, freqs, specials, in_chunk, chunk_places = (_numbers(x) for x in row["parts"])
        by_name = np.zeros(int(chunk_places.max(initial=-1)) + 1, np.int64)
        for places, pieces in zip(right.column("places"), right.column("pieces")):
            places = _numbers(places.as_py())
            by_name[walks(places, np.array([len(places)]))] = _numbers(pieces.as_py())
        by_chunk = stretch_sums(by_name[chunk_places], in_chunk)
        tokens = stretch_sums(by_chunk[walks(rises, lengths)] * freqs, lengths) + specials
        return pa.Table.from_pydict({"document": row["documents"], "n_tokens": tokens}, schema=result_arrow)

    by_block = held.select("block", "documents", "parts").groupBy("block").cogroup(counted.groupBy("of_block"))
    out = by_block.applyInArrow(total, result)
    return out.select(
        *[F.col("document")[name].alias(name) for name in inner.names], "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ends = np.cumsum(_numbers(row["names"][0]))
            data = unsqueezed(row["names"][1])
            for at in range(0, len(ends), 8192):
                part = ends[at : at + 8192].tolist()
                starts = [int(ends[at - 1]) if at else 0, *part[:-1]]
                names = [data[a:b].decode() for a, b in zip(starts, part)]
                places = np.arange(at, at + len(names), dtype=np.int32)
                yield pa.RecordBatch.from_pydict(
                    {"name": names, "of_block": np.full(len(names), row["block"], np.int64), "place": places}
                )


def _piece_counter(tokenizer: str):
    """Names in order, with block and place, to the pieces of each name, packed by block."""

    def counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(tokenizer)
        last, pieces = None, 0
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            names = batch.column("name").to_pylist()
            new = [name for name, before in zip(names, [last, *names]) if name != before]
            # One encoding of all new names; each token says which name it is of.
            whose = model.encode(new, is_pretokenized=True, add_special_tokens=False).word_ids if new else []
            found = iter(np.bincount(np.array(whose, np.int64), minlength=len(new)).tolist())
            counts = np.empty(len(names), np.int64)
            for place, name in enumerate(names):
                if name != last:
                    last, pieces = name, next(found)
                counts[place] = pieces
            out.append((batch.column("of_block").to_numpy(), batch.column("place").to_numpy(), counts))
            if len(out) >= 64:
                yield from _by_block(out)
                out = []
        if out:
            yield from _by_block(out)

    return counter


def _by_block(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    blocks, places, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((places, blocks))
    blocks, places, counts = blocks[order].astype(np.int64), places[order].astype(np.int64), counts[order]
    for at in np.split(np.arange(len(blocks)), np.flatnonzero(np.diff(blocks)) + 1):
        rises = steps(places[at], np.array([len(at)]))
        yield pa.RecordBatch.from_pydict(
            {"of_block": blocks[at[:1]], "places": [packed(rises)], "pieces": [packed(counts[at])]}
        )
