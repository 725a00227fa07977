"""Near duplicates as a similarity join: MinHash bands, then exact Jaccard similarity of word shingles.

Signatures are cut into bands of one fixed depth, the longest at which pairs of the least similarity asked for meet in some
band with the target recall; texts that agree in a band are candidates. There are no tries, and no prefix is shortened by
what the data hold. Candidates are held as components, never as pairs: equal bands chain texts together, and all links
lie within a component. There every pair is verified exactly, in blocks, and only counts and a spanning forest leave a
block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireloom.llm.components import components
from wireloom.llm.text import RangeHash, kept, map_rows, spaced_words, text_bytes, window_hashes

#: Words of a shingle, least similarity, trees, longest prefix in signature values, and the recall wanted at the least.
SHINGLE, SIMILARITY, TREES, DEPTH, RECALL = 5, 0.8, 16, 8, 0.999

#: Texts of a block.
BLOCK = 256

#: Columns of the intersection matrix that are worked on at a time.
COLUMNS = 4096


def prefix_length(similarity: float = SIMILARITY, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which pairs of this similarity share one in some tree with the recall asked for."""
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(words: bytes, hasher: RangeHash, size: int = SHINGLE) -> np.ndarray:
    """Sorted fingerprints of the distinct shingles; texts of fewer words, but not none, are one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes, _, _ = window_hashes(hasher, words, min(size, words.count(b" ") + 1))
    return np.unique(hashes)


class MinHash:
    """Smallest values of a set under `trees` times `depth` random functions, as one number for each tree's prefix."""

    def __init__(self, trees: int, depth: int) -> None:
        draw = np.random.default_rng(20)
        self.shape, self.most = (trees, depth), np.uint64(2**64 - 1)
        self.factors = draw.integers(0, 2**63, trees * depth, np.uint64) * np.uint64(2) + np.uint64(1)
        self.offsets = draw.integers(0, 2**63, trees * depth, np.uint64)

    def prefixes(self, found: np.ndarray) -> list[int]:
        least = np.full(len(self.factors), self.most)
        for at in range(0, len(found), 2048):
            values = found[at : at + 2048, None] * self.factors + self.offsets
            np.minimum(least, values.min(0), out=least)
        out = np.arange(1, self.shape[0] + 1, dtype=np.uint64)
        for column in least.reshape(self.shape).T:
            out = (out ^ (column >> np.uint64(7))) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out.view(np.int64).tolist()


def signatures(docs: DataFrame, shingle: int = SHINGLE, **forest) -> DataFrame:
    """doc_id, digest of the words, and the prefix number of each tree. Texts without words have neither."""
    trees = forest.get("trees", TREES)
    depth = prefix_length(**forest)

    def signer():
        hasher, least = RangeHash(), MinHash(trees, depth)

        def sign(columns: dict) -> dict:
            words = [spaced_words(text) for text in columns["text"]]
            return {
                "doc_id": columns["doc_id"],
                "digest": [hashlib.blake2b(w, digest_size=16).digest() if w else None for w in words],
                "trees": [least.prefixes(shingles(w, hasher, shingle)) if w else None for w in words],
            }

        return sign

    rows = docs.select("doc_id", text_bytes())
    return map_rows(rows, "doc_id bigint, digest binary, trees array<bigint>", signer)


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, **forest) -> DataFrame:
    """doc_id, class_id (the smallest doc_id that links lead to), n_links (documents of at least this similarity).

    All rows of docs are returned. Texts of equal words are one class from the start: they count as links of each other
    and are never paired. Texts without words, and null texts, link to nothing and are classes of their own; rows
    without a doc_id have a null class and no links; rows that share a doc_id are one document. An empty table gives
    no rows. Similarity is that of the sets of shingles; a link between different texts is missed only if no tree
    holds it, with a probability of at most 1 - recall at the least similarity and far less above.
    """
    signed = kept(signatures(docs, shingle, similarity=similarity, **forest))
    known = signed.filter("doc_id is not null and digest is not null")
    classes = known.groupBy("digest", "trees").agg(F.min("doc_id").alias("node"), F.count_distinct("doc_id").alias("copies"))
    classes = kept(classes)

    rows = classes.select(F.explode("trees").alias("prefix"), "node")
    shared = rows.groupBy("prefix").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    chained = rows.join(shared, "prefix").select(F.col("node").alias("a"), F.col("first").alias("b"))
    candidates = kept(components(chained))
    verified = kept(_verified(docs, classes, candidates, similarity, shingle))

    linked = verified.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    found = classes.select("digest", "node", "copies").join(linked, "node", "left")
    found = found.join(joined, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    out = signed.select("doc_id", "digest").join(found, "digest", "left")
    has_id = F.col("doc_id").isNotNull()
    return out.select(
        "doc_id", F.when(has_id, F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(has_id, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
    )


def _verified(docs: DataFrame, classes: DataFrame, candidates: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """(node, root, links): for each node and block, the documents linked to it there, and a smaller node it leads to.

    Components up to a block's size share groups with others; larger ones are cut into blocks, and each pair of blocks
    is a group. Groups have a bound; a row goes to as many as its component has blocks.
    """
    sizes = candidates.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    total = candidates.count()
    dealt = candidates.join(sizes, "component").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    bundle = F.pmod(F.xxhash64("component"), F.lit(max(1, total // BLOCK))).cast("long")
    alone = F.col("blocks") > 1
    dealt = dealt.select(
        "node", "component", "own", F.when(alone, F.col("component")).otherwise(bundle).alias("bundle"),
        F.when(alone, F.least("own", "other")).otherwise(-1).alias("low"), F.greatest("own", "other").alias("high"),
    )
    copies = classes.groupBy("node").agg(F.sum("copies").alias("copies"))
    texts = docs.select(F.col("doc_id").alias("node"), text_bytes()).join(candidates.select("node"), "node")
    texts = texts.join(copies, "node")

    def shingler():
        hasher = RangeHash()

        def cut(columns: dict) -> dict:
            found = [shingles(spaced_words(text), hasher, shingle).tobytes() for text in columns["text"]]
            return {"node": columns["node"], "copies": columns["copies"], "shingles": found}

        return cut

    cut = map_rows(texts, "node bigint, copies bigint, shingles binary", shingler)
    grouped = cut.join(dealt, "node").groupBy("bundle", "low", "high")
    schema = "node bigint, root bigint, links bigint"

    def verify(group: pa.Table) -> pa.Table:
        nodes, first = np.unique(group.column("node").to_numpy(), return_index=True)
        group = group.take(pa.array(first))
        parts = group.column("component").to_numpy()
        sides = group.column("own").to_numpy()
        cross = group.column("low")[0].as_py() not in (-1, group.column("high")[0].as_py())
        copies = group.column("copies").to_numpy()
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in group.column("shingles")]
        roots, links = nodes.copy(), np.zeros(len(nodes), np.int64)
        order = np.argsort(parts, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(parts[order])) + 1):
            near = similar_pairs([sets[i] for i in at], similarity)
            if cross:
                near &= sides[at][:, None] != sides[at][None, :]
            links[at] = near @ copies[at]
            roots[at] = smallest_linked(nodes[at], near)
        return pa.table({"node": nodes, "root": roots, "links": links})

    return grouped.applyInArrow(verify, schema)


def similar_pairs(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Matrix of the pairs, but for the diagonal, whose exact Jaccard similarity reaches the least."""
    lengths = np.array([len(s) for s in sets], float)
    codes, where = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), lengths.astype(int))
    often = np.bincount(where, minlength=len(codes)) > 1
    column = np.cumsum(often) - 1
    keep = often[where]
    owner, column = owner[keep], column[where[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(often.sum()), COLUMNS):
        a, b = np.searchsorted(column, (low, low + COLUMNS))
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        common += part @ part.T
    near = common >= similarity * (lengths[:, None] + lengths[None, :] - common) - 1e-6
    np.fill_diagonal(near, False)
    return near


def smallest_linked(nodes: np.ndarray, near: np.ndarray) -> np.ndarray:
    """The smallest node that links of a block lead to, from each node."""
    least = nodes.copy()
    while True:
        step = np.where(near, least[None, :], np.iinfo(np.int64).max).min(1)
        step = np.minimum(least, step)
        if (step == least).all():
            return least
        least = step


def first_of_each(docs: DataFrame, **rules) -> DataFrame:
    """One document of each class, with its own columns: that of the smallest doc_id, null last, then of the least hash.

    Rows are joined under numbers of their own, so rows that share an id, or have none, are near copies only by their
    texts. Rows without words all stay.
    """
    # The numbers depend on how the rows come, so they are kept.
    rows = kept(docs.select(F.struct("*").alias("_document"), F.monotonically_increasing_id().alias("_row")))
    text = F.col("_document.text")
    found = near_duplicates(rows.select(F.col("_row").alias("doc_id"), text.alias("text")), **rules)
    order = F.struct(F.col("_document.doc_id").isNull(), F.col("_document.doc_id"), F.xxhash64(text), F.col("_row"))
    placed = rows.select("_row", order.alias("_order"))
    classes = found.select(F.col("doc_id").alias("_row"), "class_id")
    firsts = placed.join(classes, "_row").groupBy("class_id").agg(F.min("_order").alias("_order"))
    return rows.join(firsts.select("_order._row"), "_row").select("_document.*")
