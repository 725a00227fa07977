"""Importance resampling towards a target distribution, by bit-sliced aggregation.

A text is a bag of hashed word runs. How much likelier a bucket is in the target than in the corpus is its gain, and a
text's weight is the mean gain of its features. The counts of a text's buckets are kept as bit planes over all buckets, and so
are the gains, in two's complement: counts times gains are ANDs of planes, counted bits and sums of powers of two, and
so exact. Texts are drawn by weight and Gumbel noise, the highest first, which is sampling without replacement.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from wireloom.llm.text import map_rows, spaced_words, text_bytes, written
from wireloom.operators.order import numbered

#: Buckets, and the words of the longest run that is a feature.
BUCKETS, LONGEST = 10_000, 1

#: Bytes of a plane: whole 64-bit numbers.
PLANE = -(-BUCKETS // 64) * 8

#: Features whose bucket a task remembers.
REMEMBERED = 1 << 20

ADDED = ("n_features", "weight")


class Buckets(dict):
    """Buckets of features; those seen last are remembered."""

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % BUCKETS
        return found


def features_of(text: bytes | None, longest: int = LONGEST) -> list[bytes]:
    """All runs of 1 to `longest` consecutive words, repeats included."""
    words = spaced_words(text).split()
    runs = list(words)
    for size in range(2, longest + 1):
        runs += [b" ".join(words[at : at + size]) for at in range(len(words) - size + 1)]
    return runs


def bucket_counts(texts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(bucket, n): the features of all texts by bucket. A slice of texts gives one row for each of its buckets."""

    def counter():
        buckets = Buckets()

        def count(columns: dict) -> dict:
            total = np.zeros(BUCKETS, np.int64)
            for text in columns["text"]:
                runs = features_of(text, longest)
                total += np.bincount(np.fromiter(map(buckets.__getitem__, runs), np.int64, len(runs)), minlength=BUCKETS)
            held = np.flatnonzero(total)
            return {"bucket": held.astype(np.int32), "n": total[held]}

        return count

    found = map_rows(texts.select(text_bytes()), "bucket int, n bigint", counter, step=4096)
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = LONGEST) -> list[int]:
    """The gain of each bucket: floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))), in doubles.

    s and S count a bucket's and all features of docs, t and T those of the target. Tables without features count 0.
    What comes to the driver is a number a bucket.
    """
    both = bucket_counts(docs, longest).withColumn("t", F.lit(0).cast("bigint")).withColumnRenamed("n", "s")
    both = both.unionByName(bucket_counts(target, longest).select("bucket", F.lit(0).cast("bigint").alias("s"), F.col("n").alias("t")))
    sums = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    sums = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(sums, "bucket", "left")
    s, t = (F.coalesce(name, F.lit(0)).cast("double") for name in ("s", "t"))
    every = Window.partitionBy()
    ratio = (t + 1) * (F.sum(s).over(every) + BUCKETS) / ((s + 1) * (F.sum(t).over(every) + BUCKETS))
    rows = sums.select("bucket", F.floor(F.log(ratio) * 1000).alias("gain")).collect()
    return [row["gain"] for row in sorted(rows, key=lambda row: row["bucket"])]


def _planes(rows: int, keys: np.ndarray) -> np.ndarray:
    """Bits at the keys (row * buckets + bucket), a row of 64-bit numbers for each row."""
    flags = np.zeros((rows, PLANE * 8), bool)
    flags[keys // BUCKETS, keys % BUCKETS] = True
    return np.packbits(flags, axis=1).view(np.uint64)


def gain_planes(gain: list[int]) -> tuple[np.ndarray, list[int]]:
    """Two's complement planes of the gains, and the value of each: powers of two, the last one negative."""
    values = np.array(gain, np.int64)
    width = 1 + max(int(np.abs(values).max()).bit_length(), 1)
    planes = np.concatenate([_planes(1, np.flatnonzero((values >> bit) & 1)) for bit in range(width)])
    return planes, [1 << bit for bit in range(width - 1)] + [-(1 << (width - 1))]


def gain_sums(found: list[np.ndarray], planes: np.ndarray, values: list[int]) -> np.ndarray:
    """The sum of gains over each text's buckets, repeats counted: `found` has the buckets of each text's features."""
    sizes = [len(buckets) for buckets in found]
    keys = np.repeat(np.arange(len(found)) * BUCKETS, sizes) + (np.concatenate(found) if found else 0)
    sums = np.zeros(len(found), np.int64)
    keys, counts = np.unique(keys.astype(np.int64), return_counts=True)
    for bit in range(int(counts.max()).bit_length() if len(counts) else 0):
        held = keys[(counts >> bit) & 1 == 1]
        texts, number = np.unique(held // BUCKETS, return_inverse=True)
        mine = _planes(len(texts), number * BUCKETS + held % BUCKETS)
        for plane, value in zip(planes, values):
            sums[texts] += np.bitwise_count(mine & plane).sum(1, dtype=np.int64) * (value << bit)
    return sums


def weigh(docs: DataFrame, gain: list[int], longest: int = LONGEST) -> DataFrame:
    """Rows of docs, in place of `text` with n_words, n_features and weight, the floored mean of gains over the features.

    One narrow pass over whole texts; 256 of them are bit planes at a time. Null and empty texts, and those without a
    word, have no features and weight 0; equal texts have equal weights; no rows give none. Columns called
    n_words, n_features and weight are replaced, others stay.
    """
    names = ("n_words", *ADDED)
    shared = docs.sparkSession.sparkContext.broadcast(gain_planes(gain))
    stay = [F.col(f"`{name}`") for name in docs.columns if name not in (*names, "text")]
    rows = docs.select(F.struct(*stay).alias("document"), text_bytes())
    schema = StructType([rows.schema["document"], *[StructField(name, LongType()) for name in names]])

    def weigher():
        planes, values = shared.value
        buckets = Buckets()

        def weights(columns: dict) -> dict:
            n_words, found = [], []
            for text in columns["text"]:
                runs = features_of(text, longest)
                n_words.append(len(features_of(text, 1)) if longest > 1 else len(runs))
                found.append(np.fromiter(map(buckets.__getitem__, runs), np.int64, len(runs)))
            sizes = [len(buckets) for buckets in found]
            weight = gain_sums(found, planes, values) // np.maximum(1, sizes)
            return {"document": columns["document"], "n_words": n_words, "n_features": sizes, "weight": weight}

        return weights

    return map_rows(rows, schema, weigher, step=256).select("document.*", *names)


def draw(rows: DataFrame, percent: int = 10, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """Weighed rows with `score` and, for those drawn, `rank`: 1, 2, 3 ... from the highest score on; others have null.

    floor(percent * N / 100) of the N rows of at least `least_words` words are drawn, ties by ascending doc_id, rows
    without one last. The noise is a function of doc_id, so rows of one id differ by their weights only; a missing id
    counts as an empty one. Scores are whole numbers; their counts, a row a score, give the score that is
    drawn last, so only rows from there on are sorted. Columns called score and rank are replaced.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000)
    rows = written(rows.drop("score", "rank").withColumn("score", (F.col("weight") + noise).cast("long")), "weighed")
    enough = F.col("n_words") >= least_words
    scores = rows.filter(enough).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    wanted = scores.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] * percent // 100
    from_highest = Window.orderBy(F.desc("score"))
    reached = scores.withColumn("upto", F.sum("n").over(from_highest)).filter(F.col("upto") >= wanted)
    last = reached.agg(F.max("score")).first()[0]
    inside = F.coalesce(enough & (F.col("score") >= F.lit(last)), F.lit(False)) if wanted else F.lit(False)
    ranked = numbered(rows.filter(inside), F.desc("score"), F.asc_nulls_last("doc_id"), name="rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    others = rows.filter(~inside).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(others.select(*ranked.columns))


def resample(docs: DataFrame, target: DataFrame, longest: int = LONGEST, **rules) -> DataFrame:
    """`weigh` and `draw` of docs towards the distribution of the target's texts."""
    return draw(weigh(docs, gains(docs, target, longest), longest), **rules)
