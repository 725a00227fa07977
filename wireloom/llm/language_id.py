"""Language identification by language-bitmask n-gram filters.

The frequent n-grams of each language go into one Bloom filter whose positions hold a bit for every language (the bit
slices of as many filters). The masks at an n-gram's positions, and-ed, name all languages that hold it. The bits are
counted over a text's n-grams, each language's count is corrected for its filter's false positives, and the highest
decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wireloom.llm.text import kept, map_rows, mixed, sampled_share, shipped, text_bytes

#: Bytes of an n-gram, blanks at word borders included.
GRAM = 5

#: Documents of a language that are learned from, about; the most frequent n-grams kept of each; hash functions.
DOCUMENTS, GRAMS, HASHES = 1000, 20_000, 3

#: Undetermined: null, and texts without a letter.
UNKNOWN = "und"


def _letters() -> bytes:
    """Byte map of lower-cased text: letters and non-ASCII bytes stay, the rest is a blank."""
    return bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else 32 for c in range(256))


LETTERS = _letters()


def grams_of(text: bytes | None) -> np.ndarray:
    """N-grams of a text as numbers; words are in blanks, and texts without a letter have none."""
    whole = text.decode("utf-8", "replace").lower() if text else ""
    if not any(map(str.isalpha, whole)):
        return np.zeros(0, np.uint64)
    data = np.frombuffer(b" " + b" ".join(whole.encode().translate(LETTERS).split()) + b"   ", np.uint8)
    count = len(data) - GRAM + 1
    grams = np.zeros(count, np.uint64)
    for place in range(GRAM):
        grams = (grams << np.uint64(8)) | data[place : place + count]
    return grams


@dataclass
class Filters:
    """Masks by position: row p has one bit a language, in as many 64-bit words as needed."""

    languages: list[str]
    masks: np.ndarray
    false_rate: np.ndarray

    @classmethod
    def of(cls, grams: dict[str, list[int]]) -> Filters:
        languages = sorted(grams)
        most = max((len(g) for g in grams.values()), default=1)
        size = 1 << max(10, (16 * most - 1).bit_length())
        masks = np.zeros((size, max(1, -(-len(languages) // 64))), np.uint64)
        for number, language in enumerate(languages):
            bit = np.uint64(1 << number % 64)
            for at in cls.places(np.array(grams[language], np.uint64), size):
                masks[at, number // 64] |= bit
        filled = [
            float(np.mean((masks[:, n // 64] >> np.uint64(n % 64)) & np.uint64(1))) for n in range(len(languages))
        ]
        return cls(languages, masks, np.array(filled) ** HASHES)

    @staticmethod
    def places(grams: np.ndarray, size: int) -> list[np.ndarray]:
        first = mixed(grams)
        second = mixed(first) | np.uint64(1)
        return [((first + np.uint64(k) * second) & np.uint64(size - 1)).astype(np.int64) for k in range(HASHES)]

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """N-grams each language holds, less those expected of its filter by chance."""
        hit = None
        for at in self.places(grams, len(self.masks)):
            hit = self.masks[at] if hit is None else hit & self.masks[at]
        held = [np.count_nonzero(hit[:, n // 64] & np.uint64(1 << n % 64)) for n in range(len(self.languages))]
        return np.maximum(0.0, (np.array(held, float) - len(grams) * self.false_rate) / (1 - self.false_rate))

    def decide(self, text: bytes | None) -> tuple[str, float, float]:
        """Language, its share of all languages' counts, and the share of the n-grams it holds.

        A tie goes to the first language by name; so does a text of which no language holds anything, with score 0.
        """
        grams = grams_of(text)
        if not len(grams) or not self.languages:
            return UNKNOWN, 0.0, 0.0
        counts = self.counts(grams)
        best = int(np.argmax(counts))
        total = counts.sum()
        return self.languages[best], float(counts[best] / total) if total else 0.0, min(1.0, float(counts[best]) / len(grams))


def fit(labelled: DataFrame, documents: int = DOCUMENTS, grams: int = GRAMS) -> Filters:
    """Learn from rows of doc_id, text, lang. About `documents` whole texts of each language are read, chosen by a
    fixed random order of their ids; null languages and texts teach nothing. The n-grams that come to the driver are
    at most `grams` a language. A table without rows gives filters without a language."""
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {row["lang"]: row["n"] for row in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Filters.of({})
    size = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])[F.col("lang")]
    chosen = labelled.filter(sampled_share(documents)(size))

    def counter():
        def count(columns: dict) -> dict:
            out: dict[str, list] = {"lang": [], "gram": [], "n": []}
            by_lang: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(columns["text"], columns["lang"]):
                by_lang.setdefault(lang, []).append(grams_of(text))
            for lang, parts in by_lang.items():
                found, n = np.unique(np.concatenate(parts), return_counts=True)
                out["lang"] += [lang] * len(found)
                out["gram"] += found.astype(np.int64).tolist()
                out["n"] += n.tolist()
            return out

        return count

    counted = map_rows(chosen.select("lang", text_bytes()), "lang string, gram bigint, n bigint", counter, 2048)
    counted = kept(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).filter("n > 1"))
    # The count from which a language's n-grams number no more than `grams`: read off a histogram, so no language's
    # n-grams meet in one task.
    least: dict[str, int] = {}
    by_count: dict[str, list[tuple[int, int]]] = {}
    for row in counted.groupBy("lang", "n").agg(F.count(F.lit(1)).alias("of")).collect():
        by_count.setdefault(row["lang"], []).append((row["n"], row["of"]))
    for lang, sizes in by_count.items():
        left = grams
        for n, of in sorted(sizes, reverse=True):
            left -= of
            if left < 0 and lang in least:
                break
            least[lang] = n
    found: dict[str, list[int]] = {lang: [] for lang in least}
    if least:
        floor = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])
        for row in counted.filter(F.col("n") >= floor[F.col("lang")]).collect():
            found[row["lang"]].append(row["gram"])
    return Filters.of(found)


def recognised(docs: DataFrame, filters: Filters, coverage: float = 0.1) -> DataFrame:
    """The documents, with their own columns, whose language holds at least a tenth of their n-grams. Texts without
    a letter and texts in no learned language go."""
    rows = identify(docs.select(F.struct("*").alias("_document"), "text"), filters)
    return rows.filter((F.col("lang_pred") != UNKNOWN) & (F.col("coverage") >= coverage)).select("_document.*")


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """Documents with lang_pred, score (the language's share of all counts) and coverage (of the text's n-grams).

    Whole texts, one narrow pass. Null texts and those without a letter are `und` with score 0. Columns of these
    names are replaced, others stay; rows that repeat get the same answer.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    stay = [F.col(f"`{name}`") for name in docs.columns if name not in ("lang_pred", "score", "coverage")]
    rows = docs.select(F.struct(*stay).alias("document"), text_bytes())
    schema = StructType([rows.schema["document"]]).add("lang_pred", "string").add("score", "double").add("coverage", "double")
    arrow = to_arrow_schema(schema)

    def loop(batches):
        known = shared.value
        with np.errstate(over="ignore"):
            for whole in batches:
                for at in range(0, whole.num_rows, 512):
                    batch = whole.slice(at, 512)
                    found = [known.decide(text.as_py()) for text in batch.column("text")]
                    answers = [pa.array([x[k] for x in found], arrow.field(k + 1).type) for k in range(3)]
                    yield pa.RecordBatch.from_arrays([batch.column("document"), *answers], schema=arrow)

    return shipped(rows).mapInArrow(loop, schema).select("document.*", "lang_pred", "score", "coverage")
