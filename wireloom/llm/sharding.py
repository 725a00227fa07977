"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly, and equal texts stay together.

Groups of equal texts are the items. Those that matter to a shard's balance are placed one by one; all others are dealt
by hash into a fixed number of bundles, which are placed like groups. So the number of items has a bound whatever the
number of documents, and their placement, largest first, each where the dot product of its loads with the shards'
residual capacities is highest, is a small computation.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wireloom.llm.text import kept, n_words

#: A group is an item of its own if it holds this share of a shard's bytes, tokens or rows; so there are at most
#: 3 * shards / LARGE of them. The others share BUNDLES items.
LARGE, BUNDLES = 1 / 1024, 8192

#: A group beyond this share of a shard is split, as it could not be balanced whole, into parts of PART of a shard.
SPLIT, PART = 1.0, 1 / 64

#: How much bytes, tokens and rows count in the dot product.
WEIGHTS = (8.0, 1.0, 1.0)

#: Stretches of a shard whose rows are numbered apart.
STRETCHES = 1024


def document_loads(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, the text's size (UTF-8 bytes and one), words, crc32 and digest; null texts are like empty ones."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id", *more, (F.octet_length(raw) + 1).cast("long").alias("size"), n_words().alias("tokens"),
        F.crc32(raw).alias("text_crc32"), F.unhex(F.md5(raw)).alias("digest"),
    )


def place(loads: np.ndarray, shards: int, weights: tuple[float, ...] = WEIGHTS) -> np.ndarray:
    """Shard of each item: largest first, where loads times residual capacities, both as shares, is highest."""
    capacity = np.maximum(loads.sum(0) / shards, 1e-9)
    shares = loads / capacity
    residual = np.ones((shards, loads.shape[1]))
    out = np.zeros(len(loads), np.int64)
    factor = np.array(weights)
    for item in np.argsort(-(shares * factor).sum(1), kind="stable"):
        best = int(np.argmax(residual @ (shares[item] * factor)))
        out[item] = best
        residual[best] -= shares[item]
    return out


def levelled(sizes: np.ndarray, found: np.ndarray, shards: int, rounds: int = 512, close: float = 1e-4) -> np.ndarray:
    """The placement, with items moved or exchanged between the fullest and the emptiest shard while that brings their
    bytes together: few large items leave more between shards than the dot product sees."""
    found = found.copy()
    for _ in range(rounds):
        totals = np.bincount(found, sizes, shards)
        full, empty = int(totals.argmax()), int(totals.argmin())
        gap = totals[full] - totals[empty]
        if gap <= close * totals.mean():
            break
        here, there = np.flatnonzero(found == full), np.flatnonzero(found == empty)
        there = there[np.argsort(sizes[there], kind="stable")]
        others = np.concatenate(([0.0], sizes[there]))  # nothing, or an item that comes back
        at = np.searchsorted(others, sizes[here] - gap / 2)
        choices = np.stack([np.clip(at - 1, 0, len(others) - 1), np.clip(at, 0, len(others) - 1)])
        left = np.abs(gap - 2 * (sizes[here] - others[choices]))
        side, item = np.unravel_index(left.argmin(), left.shape)
        if left[side, item] >= gap:
            break
        back = choices[side, item]
        found[here[item]] = empty
        if back:
            found[there[back - 1]] = full
    return found


def _bundle() -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(BUNDLES)).cast("int")


def _part(parts: Column) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit("part")), parts).cast("int")


def assign(loads: DataFrame, shards: int = 16) -> DataFrame:
    """Rows of document_loads with `shard`, 0 to shards - 1.

    Equal texts share a shard unless they alone exceed one; then they are split by doc_id. Null and empty texts are
    equal. Repeated rows count each. The placement's items, at most 3 * shards * (1 / LARGE + 1 / PART) + BUNDLES,
    pass through the driver and are broadcast; documents are not. An empty table gives no rows.
    """
    groups = kept(loads.groupBy("digest").agg(*[F.sum(n).alias(n) for n in ("size", "tokens")], F.count(F.lit(1)).alias("rows")))
    names = ("size", "tokens", "rows")
    totals = groups.agg(*[F.sum(n).alias(n) for n in names]).first()
    if not totals["rows"]:
        return loads.withColumn("shard", F.lit(0))
    share = F.greatest(*[F.col(n) * float(shards) / max(1, totals[n]) for n in names])
    large = groups.withColumn("share", share).filter(F.col("share") >= LARGE)
    parts = F.when(F.col("share") > SPLIT, F.ceil(F.col("share") / PART)).otherwise(1).cast("int")
    large = kept(large.select("digest", parts.alias("parts"), *names))

    whole = large.filter("parts = 1").select("digest", F.lit(0).alias("part"), F.lit(0).alias("bundle"), *names)
    wide = large.filter("parts > 1").select("digest", "parts")
    split = loads.join(F.broadcast(wide), "digest").groupBy("digest", _part(F.col("parts")).alias("part"))
    split = split.agg(F.lit(0).alias("bundle"), F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    small = groups.withColumn("share", share).filter(F.col("share") < LARGE).groupBy(_bundle().alias("bundle"))
    small = small.agg(*[F.sum(n).alias(n) for n in names]).select(F.lit(None).cast("binary").alias("digest"), F.lit(0).alias("part"), "bundle", *names)
    items = whole.unionByName(split).unionByName(small).orderBy("digest", "part", "bundle").collect()

    sizes = np.array([[row[n] for n in names] for row in items], float)
    found = levelled(sizes[:, 0], place(sizes, shards), shards)
    rows = [(row["digest"], row["part"], row["bundle"], int(s)) for row, s in zip(items, found)]
    placed = loads.sparkSession.createDataFrame(rows, "digest binary, part int, bundle int, shard int")
    of_group = placed.filter("digest is not null").select("digest", "part", F.col("shard").alias("own"))
    of_bundle = placed.filter("digest is null").select("bundle", F.col("shard").alias("shared"))
    out = loads.join(F.broadcast(large.select("digest", "parts")), "digest", "left")
    out = out.withColumn("part", F.coalesce(_part(F.col("parts")), F.lit(0))).withColumn("bundle", _bundle())
    out = out.join(F.broadcast(of_group), ["digest", "part"], "left").join(F.broadcast(of_bundle), "bundle", "left")
    return out.withColumn("shard", F.coalesce("own", "shared")).select(*loads.columns, "shard")


def with_slots(rows: DataFrame) -> DataFrame:
    """Rows of `assign` with `slot`, gapless from 0 in each shard.

    Rows are numbered in stretches of a shard, dealt by hash of id and text; stretches are lined up by their counts.
    """
    rows = rows.withColumn("stretch", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(STRETCHES)).cast("int"))
    counts = rows.groupBy("shard", "stretch").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "stretch").orderBy("doc_id", "digest")
    numbered = rows.withColumn("number", F.row_number().over(within) - 1).join(starts, ["shard", "stretch"])
    return numbered.withColumn("slot", F.col("start") + F.col("number")).drop("stretch", "start", "number")


def shard_manifest(docs: DataFrame, shards: int = 16, *more: str) -> DataFrame:
    """doc_id, `more` columns, size, text_crc32, shard and slot of every document; texts stay where they are."""
    loads = kept(document_loads(docs, *more))
    return with_slots(kept(assign(loads, shards))).select("doc_id", *more, "size", "tokens", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = 16) -> None:
    """Write the documents, all columns, to one folder a shard; only bounded placement tables are broadcast."""
    loads = document_loads(docs.select("doc_id", "text", F.struct("*").alias("_document")), "_document")
    placed = assign(loads, shards).select("_document.*", F.col("shard").alias("_shard"))
    placed.repartition("_shard", F.pmod(F.xxhash64("doc_id"), F.lit(64))).write.partitionBy("_shard").parquet(path)
