"""Benchmark decontamination: windows of benchmark words are looked up in training texts, and hits are removed.

The benchmark's windows are made by Spark and go to the executors as a hash set with a bitmap in front. Its size is
bounded: a benchmark beyond the bound is dealt into parts, and the documents pass them one after the other, with a table
between, so that one part's set is held at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wireloom.llm.text import RangeHash, WORD_TABLE, map_rows, shipped, spaced_words, text_bytes, window_hashes, written

#: Consecutive words of a window; items of fewer words are one window.
WINDOW = 10

#: Benchmark words in one broadcast part.
PART_WORDS = 2_000_000

#: What is found in a text: its words, the first and last number of hit words, the items that hit.
FOUND = "n_words:bigint,_spans:array<struct<first:int,last:int>>,_items:array<string>"


class Windows:
    """Hash set of windows: fingerprint to (words, numbers of the items that hold them). Items are numbered by id, so rows
    that share one count as one item."""

    def __init__(self, windows: Iterable[tuple[bytes, int, list[str]]]) -> None:
        hasher, numbers = RangeHash(), {}
        self.found: dict[int, dict[int, list[tuple[bytes, list[int]]]]] = {}
        with np.errstate(over="ignore"):
            for words, length, names in windows:
                (h,) = window_hashes(hasher, words, length)[0].tolist()
                held = [numbers.setdefault(name, len(numbers)) for name in names]
                self.found.setdefault(length, {}).setdefault(h, []).append((words, held))
        self.names = list(numbers)
        most = max((len(by_hash) for by_hash in self.found.values()), default=1)
        self.bits = max(16, min(26, (256 * most).bit_length()))
        self.maps = {}
        for length, by_hash in self.found.items():
            self.maps[length] = np.zeros(1 << self.bits, bool)
            self.maps[length][np.fromiter(by_hash, np.uint64) >> np.uint64(64 - self.bits)] = True

    def look_up(self, hasher: RangeHash, text: bytes | None) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit words of a text as (first, last) word numbers, in order and merged, and the items with a window in it.

        Each hit is verified word by word against the window.
        """
        words, spans, items = spaced_words(text), [], set()
        for length, by_hash in self.found.items():
            hashes, starts, ends = window_hashes(hasher, words, length)
            likely = np.flatnonzero(self.maps[length][hashes >> np.uint64(64 - self.bits)])
            for place, h in zip(likely.tolist(), hashes[likely].tolist()):
                for window, held in by_hash.get(h, ()):
                    if words[starts[place] : ends[place]] == window:
                        items.update(held)
                        spans.append((place, place + length - 1))
        return merged(spans), items


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def windows_of(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(words, length, items): the different windows of all items and the ids of those that hold each, as text.

    An item without an id counts under the empty name; rows of one id are one item; texts without words have none.
    """

    def cutter():
        def cut(columns: dict) -> dict:
            out: dict[str, list] = {"words": [], "length": [], "item": []}
            for item, text in zip(columns["item"], columns["text"]):
                words = spaced_words(text).split()
                length = min(size, len(words))
                windows = {b" ".join(words[at : at + length]) for at in range(len(words) - length + 1)} if words else set()
                out["words"] += windows
                out["length"] += [length] * len(windows)
                out["item"] += [item] * len(windows)
            return out

        return cut

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), text_bytes())
    rows = map_rows(items, "words binary, length int, item string", cutter)
    return rows.groupBy("words", "length").agg(F.collect_set("item").alias("items"))


def benchmark_parts(benchmark: DataFrame, size: int = WINDOW, part_words: int = PART_WORDS) -> Iterator[Windows]:
    """The benchmark's windows in parts of about `part_words` words each, one at a time; a part, and no more, comes to the
    driver. A window that many items share is in one part with all of them."""
    windows = written(windows_of(benchmark, size), "windows")
    # A word begins about one window, so windows count like words.
    parts = max(1, -(-windows.count() // part_words))
    for part in range(parts):
        mine = windows if parts == 1 else windows.filter(F.pmod(F.xxhash64("words"), F.lit(parts)) == part)
        yield Windows((bytes(row["words"]), row["length"], sorted(row["items"])) for row in mine.collect())


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_words: int = PART_WORDS) -> DataFrame:
    """Documents with `n_words`, `_spans` (hit words, first and last number) and `_items` (items with a window there).

    Columns that the documents have already under these names are replaced. Null and empty texts have no words and
    no hits; items without words have no window; an item without an id counts under the empty name. Rows that
    repeat are each looked at. Narrow: no shuffle, whatever a passage's frequency. Rows of one item_id are one item.
    """
    context = docs.sparkSession.sparkContext
    stay = [F.col(f"`{name}`") for name in docs.columns if name not in ("n_words", "_spans", "_items")]
    rows = docs.select(F.struct(*stay).alias("document"), F.expr(f"cast(null as struct<{FOUND}>)").alias("hits"))
    before = None
    for part in benchmark_parts(benchmark, window, part_words):
        if before is not None:
            rows = written(rows, "hits")
            before.destroy()
        before = context.broadcast(part)
        rows = shipped(rows).mapInArrow(_scan(before, rows.schema), rows.schema)
    found = F.col("hits").withField("_items", F.array_distinct("hits._items"))
    return rows.withColumn("hits", found).select("document.*", "hits.*")


def _scan(shared, schema: StructType):
    arrow = to_arrow_schema(schema)

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, hasher = shared.value, RangeHash()
        with np.errstate(over="ignore"):
            for whole in batches:
                for at in range(0, whole.num_rows, 512):
                    batch, out = whole.slice(at, 512), []
                    texts = pc.struct_field(batch.column("document"), "text").cast(pa.binary())
                    for text, before in zip(texts, batch.column("hits").to_pylist()):
                        text, before = text.as_py(), before or {"_spans": [], "_items": []}
                        spans, items = windows.look_up(hasher, text)
                        spans = merged([*((x["first"], x["last"]) for x in before["_spans"]), *spans])
                        words = spaced_words(text)
                        out.append({
                            "n_words": words.count(b" ") + 1 if words else 0,
                            "_spans": [{"first": first, "last": last} for first, last in spans],
                            "_items": [*before["_items"], *(windows.names[i] for i in sorted(items))],
                        })
                    hits = pa.array(out, arrow.field("hits").type)
                    yield pa.RecordBatch.from_arrays([batch.column("document"), hits], schema=arrow)

    return loop


def hit_digest(hits: DataFrame) -> DataFrame:
    """n_hit, n_items, items_sha256 and contaminated of documents with hits, next to doc_id and n_words."""
    names = F.array_sort("_items")
    n_hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, x: n + x["last"] - x["first"] + 1)
    return hits.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, **rules) -> DataFrame:
    """The documents without a hit, with their own columns."""
    rows = find_hits(docs.select(F.struct("*").alias("_document"), "text"), benchmark, **rules)
    return rows.filter(F.size("_spans") == 0).select("_document.*")


def cut_spans(docs: DataFrame, benchmark: DataFrame, **rules) -> DataFrame:
    """All documents with the hit words taken out of `text`, from the first byte of a run of hit words to its last.

    Texts without hits, null and empty ones stay as they are; n_chars, where there is one, follows.
    """
    rows = find_hits(docs.select(F.struct("*").alias("_document"), "text"), benchmark, **rules)

    def cutter():
        def cut(columns: dict) -> dict:
            out = []
            for text, spans in zip(columns["text"], columns["_spans"]):
                raw = text.encode() if text else b""
                if text and spans:
                    word = np.frombuffer(raw.translate(WORD_TABLE), np.uint8) != 32
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], word.astype(np.int8), [0]))))
                    starts, ends = edges[::2], edges[1::2]
                    kept, at = [], 0
                    for span in spans:
                        kept.append(raw[at : starts[span["first"]]])
                        at = ends[span["last"]]
                    text = b"".join([*kept, raw[at:]]).decode()
                out.append(text)
            return columns | {"text": out}

        return cut

    schema = rows.drop("n_words", "_items").schema
    cut = map_rows(rows.drop("n_words", "_items"), schema, cutter)
    document = F.col("_document").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        document = document.withField("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(document.alias("_document")).select("_document.*")
