"""Operators without SQL against second versions in plain Python, on the small documents."""

import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wireloom.llm import language_id, quality_classifier, sharding

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {row["doc_id"]: row["text"] for row in docs.collect()}


def grams(text):
    """Runs of five bytes of a text's lower-cased letters, words in blanks."""
    if not any(unicodedata.category(c)[0] == "L" for c in text or ""):
        return []
    data = text.lower().encode()
    words = "".join(chr(b) if 97 <= b <= 122 or b >= 128 else " " for b in data).split(" ")
    line = " " + " ".join(word for word in words if word) + "   "
    return [line[at : at + 5] for at in range(len(line) - 4)]


def test_language_filters_against_sets(docs, texts):
    """The languages that the filters name, and their counts, are those of exact sets of the same n-grams."""
    learn = docs
    by_lang = defaultdict(lambda: defaultdict(int))
    for row in learn.filter("lang is not null").collect():
        for gram in grams(row["text"]):
            by_lang[row["lang"]][gram] += 1
    sets = {lang: {g for g, n in found.items() if n > 1} for lang, found in by_lang.items()}
    number = lambda gram: int.from_bytes(gram.encode("latin-1"), "big")
    filters = language_id.Filters.of({lang: [number(g) for g in found] for lang, found in sets.items()})
    alike, decided = 0, 0
    for text in texts.values():
        own = grams(text)
        found = language_id.grams_of((text or "").encode())
        assert found.tolist() == [number(g) for g in own]
        answer = filters.decide((text or "").encode())
        exact = {lang: sum(g in held for g in own) for lang, held in sets.items()}
        if not own:
            assert answer == ("und", 0.0, 0.0)
            continue
        with np.errstate(over="ignore"):
            counts = dict(zip(filters.languages, filters.counts(found)))
        assert all(abs(counts[lang] - n) <= 3 + 0.02 * len(own) for lang, n in exact.items())
        if max(exact.values()):
            decided += 1
            alike += answer[0] == min(exact, key=lambda lang: (-exact[lang], lang))
    assert decided > 150 and alike >= 0.99 * decided


def test_quality_neighbours_against_all_cosines(spark, docs, texts):
    """Of every document the nearest examples by cosines in doubles, and the score that their votes give."""
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    space = quality_classifier.fit(docs, labels, F.lit(True))
    scores = {row["doc_id"]: row["score"] for row in quality_classifier.score(docs, space).collect()}
    vectors = space.vectors.astype(float)
    clear = 0
    for doc_id, text in texts.items():
        (own,) = space.project([None if text is None else text.encode()], {}).astype(float)
        cosines = [float(np.dot(own, other)) for other in vectors]
        order = sorted(range(len(cosines)), key=lambda n: -cosines[n])
        k = min(quality_classifier.NEIGHBOURS, len(order))
        # Where the border between neighbours and others is a tie, either side is right.
        if len(order) > k and cosines[order[k - 1]] - cosines[order[k]] < 1e-6:
            continue
        clear += 1
        votes = [max(cosines[n], 0) ** 4 * space.votes.weights[n] for n in order[:k]]
        named = sum(v * space.votes.labels[n] for v, n in zip(votes, order))
        raw = (named + 0.05 * space.votes.base) / (sum(votes) + 0.05)
        expected = float(np.interp(raw, space.votes.knots, space.votes.values))
        assert scores[doc_id] == pytest.approx(min(1, max(0, expected)), abs=2e-3)
    assert clear > 100


def packed_by_hand(loads, shards, weights):
    """Largest first, each where loads times what is left, weighted, is highest."""
    full = [max(sum(load[d] for load in loads) / shards, 1e-9) for d in range(3)]
    share = [[load[d] / full[d] for d in range(3)] for load in loads]
    left = [[1.0] * 3 for _ in range(shards)]
    out = [None] * len(loads)
    for item in sorted(range(len(loads)), key=lambda i: -sum(s * w for s, w in zip(share[i], weights))):
        worth = [sum(r * s * w for r, s, w in zip(rest, share[item], weights)) for rest in left]
        best = max(range(shards), key=lambda s: worth[s])
        out[item] = best
        left[best] = [r - s for r, s in zip(left[best], share[item])]
    return out


def test_placement_against_a_plain_one(docs, texts):
    draw = np.random.default_rng(5)
    loads = draw.integers(1, 1 << 20, (300, 3)).astype(float)
    assert sharding.place(loads, 16).tolist() == packed_by_hand(loads.tolist(), 16, sharding.WEIGHTS)
    # And of the whole table: every row once, sizes and checksums, equal texts together, slots gapless.
    rows = sharding.shard_manifest(docs, 16).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    shards, slots = defaultdict(set), defaultdict(list)
    for row in rows:
        data = (texts[row["doc_id"]] or "").encode()
        assert (row["size"], row["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        shards[data].add(row["shard"])
        slots[row["shard"]].append(row["slot"])
    assert all(sorted(found) == list(range(len(found))) for found in slots.values()) and set(slots) <= set(range(16))
    share = sum(r["size"] for r in rows) / 16
    held = defaultdict(int)
    for row in rows:
        held[texts[row["doc_id"]] or ""] += row["size"]
    assert all(len(found) == 1 for data, found in shards.items() if held[data.decode()] < share * 0.5)
