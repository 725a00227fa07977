"""What the text operators share: words as bytes, fingerprints of word windows, and Arrow loops."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wireloom.plans.staging import new_folder, staging_folder

#: White space of the word rules, as a Java character class and as single characters.
SPACES = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\f\r"


def _word_table() -> bytes:
    """Byte map: A-Z to a-z, digits, letters and all bytes of non-ASCII characters stay, the rest is a space."""
    table = bytearray(b" " * 256)
    for code in range(256):
        if 0x30 <= code <= 0x39 or 0x61 <= code <= 0x7A or code >= 0x80:
            table[code] = code
        elif 0x41 <= code <= 0x5A:
            table[code] = code + 32
    return bytes(table)


WORD_TABLE = _word_table()


def spaced_words(text: bytes | None) -> bytes:
    """The lower-cased words of a text, one blank between them; null has none."""
    return b" ".join(text.translate(WORD_TABLE).split()) if text else b""


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class RangeHash:
    """64-bit fingerprints of any byte range of a text, after one pass over its bytes.

    Polynomials over random byte values modulo 2^64; the base is odd, so it has an inverse and ranges of any
    place compare.
    """

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self) -> None:
        with np.errstate(over="ignore"):
            self.values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, length: int) -> None:
        size = max(length, 2 * len(self.powers))
        inverse = pow(self.BASE, -1, 1 << 64)
        for name, base in (("powers", self.BASE), ("inverses", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        if len(data) + 1 > len(self.powers):
            self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
        return sums

    def ranges(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))


def word_bounds(words: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of spaced words, and where each word starts and ends."""
    data = np.frombuffer(words, np.uint8)
    if not len(data):
        return data, np.zeros(0, np.int64), np.zeros(0, np.int64)
    gaps = np.flatnonzero(data == 32)
    return data, np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(data)]))


def window_hashes(hasher: RangeHash, words: bytes, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints of all windows of `size` words, with the start and end bytes of each."""
    data, starts, ends = word_bounds(words)
    if len(starts) < size:
        return np.zeros(0, np.uint64), starts[:0], ends[:0]
    first, last = starts[: len(starts) - size + 1], ends[size - 1 :]
    return hasher.ranges(hasher.prefixes(data), first, last), first, last


def shipped(frame: DataFrame) -> DataFrame:
    """The frame; executors get this package with the session's Python files, so they need not have it installed."""
    context, package = frame.sparkSession.sparkContext, Path(__file__).parents[1]
    name = f"{package.name}.zip"
    if not any(file.endswith(name) for file in context._python_includes):
        path = Path(tempfile.mkdtemp()) / name
        with zipfile.ZipFile(path, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(str(path))
    return frame


def map_rows(
    frame: DataFrame, schema: str | StructType, rows: Callable[[], Callable[[dict], dict]], step: int = 512
) -> DataFrame:
    """mapInArrow over short slices: `rows()` is called once in each task and gives a function from column lists
    to column lists, so that no more than `step` texts are Python objects at a time."""
    arrow = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = rows()
        with np.errstate(over="ignore"):
            for batch in batches:
                for at in range(0, batch.num_rows, step):
                    out = made(batch.slice(at, step).to_pydict())
                    yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return shipped(frame).mapInArrow(loop, schema)


def kept(frame: DataFrame) -> DataFrame:
    """The frame, computed once and kept under spark.checkpoint.dir, where lost executors don't take it along."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(staging_folder(frame.sparkSession))
    return frame.checkpoint()


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: like kept(), but Spark knows how large it is and plans joins by it."""
    path = new_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_bytes(column: str = "text") -> Column:
    return F.col(column).cast("binary")


def crc_of_id(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def held_out(modulus: int, remainder: int, column: str = "doc_id") -> Column:
    """Rows nothing is learned from: the remainder of crc32 of the id, and rows without an id."""
    return F.coalesce(F.pmod(crc_of_id(column), F.lit(modulus)) == remainder, F.lit(True))


def n_words(column: str = "text") -> Column:
    """Number of runs of anything but white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(f"[^{SPACES}]+")), F.lit(0)).cast("long")


def sampled_share(bound: int) -> Callable[[Column], Column]:
    """A row's place in a fixed random order, 0 to 1, below bound / (rows): keeps about `bound` rows of a group."""
    return lambda rows: F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30)) < F.lit(
        float(bound) * (1 << 30)
    ) / F.greatest(rows, F.lit(1))
