"""The text operators against brute force on the small documents, and on rows at the edge."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from wireloom.llm import (
    decontamination, jaccard_join, labelled, language_id, mixing, quality_classifier, quality_rules, sharding, suffix_dedup,
    token_counts, toxicity,
)
from wireloom.llm.components import components
from wireloom.llm.queries import ORACLE_SQL, QUERIES
from wireloom.llm.text import held_out

FOLDER = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
RUN = re.compile("[^\x20\x09-\x0d]+")
LONG = "the quick brown fox jumps over a lazy dog near that old mill " * 3000

#: Null and empty texts, null ids, repeated rows, ties, a very long text, columns of clashing names.
EDGES = [
    (1, None, "en", "a"), (2, "", "en", None), (3, "  \n\t ", None, "a"), (4, "one", "en", "b"), (4, "one", "en", "b"),
    (5, "one", "fr", None), (None, "one two three", "en", "b"), (None, None, None, None), (6, LONG, "en", "a"),
    (7, "12345 !!", "de", "c"), (8, "aaaaaaaa" * 60, "en", "a"), (9, "aaaaaaaa" * 60, "en", "a"),
    (10, "a <|endoftext|> b  \n c  d's 12² éè", "fr", "\U0001f600"), (11, "x\x00y   z ", "fr", ""),
]
CLASHING = "score n_words size _document _hits block shard copies rank node range level gram"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {row["doc_id"]: row["text"] for row in docs.collect()}


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet(f"{FOLDER}/benchmark.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


@pytest.fixture(scope="module")
def edges(spark):
    frame = spark.createDataFrame(EDGES, "doc_id bigint, text string, lang string, source string")
    return frame.withColumns({name: F.lit(f"own {name}") for name in CLASHING.split()})


@pytest.fixture(scope="module")
def empty(edges):
    return edges.filter("false")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def hits_of(text, windows):
    words, hit, items = WORD.findall(lowered(text)), set(), set()
    for size in {len(w) for w in windows}:
        for at in range(len(words) - size + 1):
            found = windows.get(tuple(words[at : at + size]))
            if found:
                hit.update(range(at, at + size))
                items |= found
    return len(words), len(hit), sorted(map(str, items))


def windows_of(items):
    windows = defaultdict(set)
    for item, text in items:
        words = WORD.findall(lowered(text))
        size = min(10, len(words))
        for at in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[at : at + size])].add(item)
    return windows


def test_decontamination(docs, benchmark, edges, empty, spark):
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    windows = windows_of(items)
    for part_words in (decontamination.PART_WORDS, 100):
        found = decontamination.hit_digest(decontamination.find_hits(docs, benchmark, part_words=part_words)).collect()
        by_id = {r["doc_id"]: r for r in found}
        for row in docs.collect():
            n, hit, ids = hits_of(row["text"], windows)
            got = by_id[row["doc_id"]]
            digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
            assert (got["n_words"], got["n_hit"], got["n_items"], got["items_sha256"]) == (n, hit, len(ids), digest)
    assert any(r["contaminated"] for r in found)
    short = spark.createDataFrame([(1, "One"), (2, None), (None, "two THREE"), (3, "?!")], "item_id int, text string")
    rows = decontamination.hit_digest(decontamination.find_hits(edges, short)).collect()
    assert len(rows) == len(EDGES)
    assert sorted(r["n_items"] for r in rows) == [0] * 10 + [1, 1, 1, 2]
    kept = decontamination.clean_documents(edges, short)
    assert kept.columns == edges.columns and kept.count() == 10
    cut = {r["doc_id"]: r["text"] for r in decontamination.cut_spans(edges, short).collect()}
    assert cut[4] == "" and cut[5] == "" and cut[6] == LONG and cut[1] is None
    assert decontamination.find_hits(empty, short).count() == 0
    assert decontamination.hit_digest(decontamination.find_hits(edges, short.filter("false"))).filter("contaminated").count() == 0


def test_decontamination_counts_an_item_once(docs, benchmark):
    """Rows of one item_id are one item, whole or in parts."""
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    shifted = benchmark.withColumn("item_id", F.lit(7)).unionByName(benchmark.filter("item_id % 2 = 0"))
    windows = windows_of([(7, text) for _, text in items] + [i for i in items if i[0] % 2 == 0])
    for part_words in (decontamination.PART_WORDS, 100):
        rows = decontamination.hit_digest(decontamination.find_hits(docs, shifted, part_words=part_words)).collect()
        texts = {r["doc_id"]: r["text"] for r in docs.collect()}
        for r in rows:
            n, hit, ids = hits_of(texts[r["doc_id"]], windows)
            assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, hit, len(ids))
            assert r["items_sha256"] == hashlib.sha256(",".join(ids).encode()).hexdigest()
    assert max(r["n_items"] for r in rows) >= 2


def test_language_id(docs, edges, empty):
    filters = language_id.fit(docs.filter(~held_out(5, 0)))
    assert filters.languages == sorted({r["lang"] for r in docs.select("lang").collect()})
    rows = language_id.identify(docs, filters).filter(held_out(5, 0)).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.9 * len(rows)
    # Filters return every language that holds an n-gram, and few others.
    sets = {lang: set(language_id.grams_of(text.encode()).tolist()) for lang, text in (("a", "hallo welt"), ("b", "hallo monde"))}
    exact = language_id.Filters.of({k: list(v) for k, v in sets.items()})
    held = exact.counts(language_id.grams_of(b"hallo"))
    assert held[0] == pytest.approx(held[1], abs=0.1) and held[0] > 2
    out = language_id.identify(edges, filters)
    assert out.columns == [c for c in edges.columns if c != "score"] + ["lang_pred", "score", "coverage"]
    found = [(r["text"], r["lang_pred"], r["score"]) for r in out.collect()]
    for text, lang, score in found:
        assert (lang == "und") == (not any(c.isalpha() for c in text or "")) and 0 <= score <= 1
    assert language_id.recognised(edges, filters).columns == edges.columns
    assert language_id.identify(empty, filters).count() == 0
    assert language_id.fit(empty).decide(b"text") == ("und", 0.0, 0.0)


def links_of(texts):
    sets = {}
    for number, text in texts.items():
        words = WORD.findall(lowered(text))
        size = min(5, len(words))
        sets[number] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
    links, parent = Counter(), {n: n for n in sets}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                    links.update((a, b))
                    x, y = sorted((top(a), top(b)))
                    parent[y] = x
    return {n: (top(n), links[n]) for n in sets}


def near_copies(n, size=120):
    base = [f"w{(i * 7919) % 1000}" for i in range(size)]
    return {1000 + k: " ".join(base[: k % size] + [f"edit{k}"] + base[k % size + 1 :]) for k in range(n)}


@pytest.mark.parametrize("block", [256, 7])
def test_jaccard_join(spark, docs, texts, edges, empty, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "COLUMNS", 64)
    texts = {n: t for n, t in texts.items() if len(t) < 4000} | near_copies(40)
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    found = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.near_duplicates(frame).collect()}
    assert found == links_of(texts)
    if block == 256:
        out = [tuple(r) for r in jaccard_join.near_duplicates(edges.select("doc_id", "text")).collect()]
        assert len(out) == len(EDGES)
        assert {r for r in out if r[0] in (4, 5, 8, 9)} == {(4, 4, 1), (5, 4, 1), (8, 8, 1), (9, 8, 1)}
        assert {r[1:] for r in out if r[0] is None} == {(None, 0)} and (1, 1, 0) in out and (2, 2, 0) in out
        kept = jaccard_join.first_of_each(edges)
        ids = Counter(r["doc_id"] for r in kept.collect())
        assert kept.columns == edges.columns and ids == Counter([1, 2, 3, 4, 6, 7, 8, 10, 11, None, None])
        assert jaccard_join.near_duplicates(empty).count() == 0


def test_first_of_each_goes_by_text(spark):
    one, two, three = (" ".join(f"{word}{n}" for n in range(40)) for word in ("red", "green", "blue"))
    rows = [(7, one), (7, two), (None, two), (None, three), (None, three), (8, one), (9, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = [(r["doc_id"], r["text"]) for r in jaccard_join.first_of_each(docs).collect()]
    assert Counter(kept) == Counter([(7, one), (7, two), (None, three), (9, ""), (None, None)])


def test_prefixes_shorten_until_the_recall():
    assert jaccard_join.prefix_length(0.8, 16, 8, 0.999) == 4
    assert jaccard_join.prefix_length(0.99, 16, 8, 0.9) == 8
    assert jaccard_join.prefix_length(0.2, 4, 8, 0.9999) == 1


def test_components(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(200, 200), (301, 300)]
    found = {tuple(r) for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    expected = {(i, 0) for i in range(61)} | {(i, 100) for i in range(100, 160)} | {(300, 300), (301, 300)}
    assert found == expected
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def walk_of(rows, target):
    """Which documents of one source get one more copy, in plain Python: (class, place) pairs."""
    size = sum(r["size"] for r in rows)
    p, taken, ends = target / size - target // size, set(), {}
    budget, rest, edges = 0.0, size, {}
    classes = defaultdict(list)
    for r in rows:
        if r["size"]:
            classes[r["class"]].append(r)
    for digit in range(mixing.DIGITS):
        unit = mixing.BASE ** (mixing.DIGITS - 1 - digit)
        rest, edges = size, {}
        for number in sorted(classes, reverse=True):
            members = [r for r in classes[number] if digit == 0 or r["place"] // (unit * mixing.BASE) == ends.get(number)]
            if not members:
                continue
            words = sum(r["size"] for r in members)
            budget += 0 if digit else p * words
            rest -= words
            bins = defaultdict(list)
            for r in members:
                bins[r["place"] // unit].append(r)
            ends.pop(number, None)
            for at in sorted(bins):
                here = sum(r["size"] for r in bins[at])
                if here > budget:
                    single = digit == 0 and len(bins[at]) == 1 and budget > 0
                    over, can_take, can_leave = here - budget, here - budget <= p * rest, budget <= (1 - p) * rest
                    if can_take and can_leave:
                        single = single and bins[at][0]["draw"] * here < budget
                    elif not can_take:
                        single = single and not can_leave and over - p * rest < budget - (1 - p) * rest
                    if single:
                        budget -= here
                        taken |= {(number, r["place"]) for r in bins[at]}
                        ends[number] = at + 1
                    else:
                        ends[number], edges[number] = at, (here, bins[at])
                    break
                budget -= here
                taken |= {(number, r["place"]) for r in bins[at]}
    near = min(((abs(w - budget), n) for n, (w, _) in edges.items()), default=(budget, 0))
    if near[0] < budget:
        taken |= {(near[1], r["place"]) for r in edges[near[1]][1]}
    return taken


def test_mixing_against_a_walk_in_plain_python(spark, docs):
    rows = [(n, f"s{n % 7}", "w " * (1 + n * n * 7919 % (5_000 if n % 50 == 0 else 300))) for n in range(1_500)]
    rows += [(9_000 + n, "one", "w " * size) for n, size in enumerate([90_000, 300, 300, 300, 20, 20, 20, 1, 1])]
    made = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    for table in (made, docs):
        sizes = mixing.document_sizes(table)
        plan = mixing.mix_plan(sizes)
        draw = F.shiftrightunsigned(F.xxhash64("source", -mixing._stratum(), F.lit("edge")), 12) / float(1 << 52)
        asked = mixing._with_plan(sizes, plan).filter("size > 0")
        asked = asked.withColumns({"class": mixing._stratum(), "place": mixing._place(), "draw": draw}).collect()
        copies = {r["doc_id"]: r["copies"] for r in mixing.mix(sizes, plan).collect()}
        by_source = defaultdict(list)
        for r in asked:
            by_source[r["source"]].append(r)
        more = 0
        for rows_of in by_source.values():
            taken = walk_of(rows_of, rows_of[0]["target"])
            assert all(copies[r["doc_id"]] - r["copies"] == ((r["class"], r["place"]) in taken) for r in rows_of)
            more += len(taken)
        assert more > 100


def test_mixing_plans_stay_small(spark, docs):
    """As many jobs whatever the table, and an estimate of the plan's size that does not grow by rounds."""
    sizes = mixing.document_sizes(docs)
    spark.sparkContext.setJobGroup("mixing", "count the jobs")
    plan = mixing.mix_plan(sizes)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("mixing")
    assert len(jobs) <= 40
    size = plan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert int(size) < 1 << 24


def test_mixing(docs, edges, empty, spark):
    rows = mixing.document_sizes(docs)
    out = mixing.mix(rows, mixing.mix_plan(rows)).collect()
    assert len(out) == docs.count()
    sizes, taken, target, most = Counter(), Counter(), {}, 0
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
        most = max(most, r["size"])
    weights = {s: (1, 2, 3)[k % 3] for k, s in enumerate(sorted(sizes))}
    left, open_, expected = sum(sizes.values()), set(sizes), {}
    while open_:
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 3 * sizes[s]]
        expected |= {s: share[s] for s in open_} if not full else {s: 3 * sizes[s] for s in full}
        left -= sum(3 * sizes[s] for s in full)
        open_ = open_ - set(full) if full else set()
    assert target == pytest.approx(expected)
    assert sum(abs(taken[s] - target[s]) for s in sizes) < 0.01 * sum(sizes.values())
    again = mixing.mix(rows, mixing.mix_plan(rows)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the join of plans that are too large to broadcast
    try:
        assert sorted(map(str, mixing.mix(rows, mixing.mix_plan(rows)).collect())) == sorted(map(str, out))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert all(copies[r["doc_id"]] == r["copies"] for r in out)
    odd = mixing.document_sizes(edges)
    out = mixing.mix(odd, mixing.mix_plan(odd)).collect()
    assert len(out) == len(EDGES) and {r["source"] for r in out} == {"a", "b", "c", "", "\U0001f600", None}
    assert {r["size"] for r in out if r["doc_id"] in (1, 2, 3)} == {0}
    assert mixing.mixed_documents(edges).columns == edges.columns
    none = mixing.document_sizes(empty)
    assert mixing.mix(none, mixing.mix_plan(none)).count() == 0


def test_mixing_skips_what_does_not_fit(spark):
    rows = [(100 * k + n, f"s{k:02}", "w " * (99 if n else 9_900 - k)) for k in range(24) for n in range(101 - k % 2)]
    rows += [(9_000, "s00", "w " * 40), (9_000, "s00", "w " * 60)]  # an id of two rows
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    sizes = mixing.document_sizes(docs)
    out = mixing.mix(sizes, mixing.mix_plan(sizes)).collect()
    taken, target = Counter(), {}
    for r in out:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 99 for s in target)  # one of the short texts
    twice = [r["copies"] for r in out if r["doc_id"] == 9_000]
    assert len(twice) == 2 and len(set(twice)) == 1
    copies = Counter((r["doc_id"], r["source"]) for r in mixing.mixed_documents(docs).collect())
    expected = Counter()
    for r in out:
        expected[r["doc_id"], r["source"]] += r["copies"]
    assert copies == +expected


def measures_of(text):
    words = RUN.findall(text or "")
    grams, covered = Counter(zip(words, words[1:], words[2:])), set()
    for at in range(len(words) - 2):
        if grams[tuple(words[at : at + 3])] > 1:
            covered |= {at, at + 1, at + 2}
    lines = [line for line in (text or "").split("\n") if RUN.search(line)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_rules(docs, edges, empty):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = quality_rules.ledger(docs)
    for r in rows.collect():
        assert tuple(r[n] for n in names) == measures_of(r["text"])
    odd = quality_rules.ledger(edges)
    for r in odd.collect():
        assert tuple(r[n] for n in names) == measures_of(r["text"])
    assert odd.columns == [c for c in edges.columns if c != "n_words"] + list(quality_rules.MEASURES)
    assert quality_rules.ledger(empty).count() == 0
    bits = [r["failed_rules"] for r in rows.collect()]
    for r in quality_rules.ablations(rows).collect():
        mask, bit = quality_rules.mask_of(r["policy"]), 1 << list(quality_rules.RULES).index(r["rule"])
        assert r["kept"] == sum(b & mask == 0 for b in bits) and r["failed"] == sum(b & bit != 0 for b in bits)
        assert r["failed_alone"] == sum(b & mask == bit for b in bits) and r["documents"] == len(bits)


def test_toxicity(spark, edges, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    index = toxicity.fit(docs, labels, ~held_out(5, 0))
    # Block-max search finds the neighbours that all products give.
    texts = [r["text"].encode() for r in docs.limit(300).collect()]
    rows, examples = index.vectors(texts, {}), {}
    for number, (terms, weights) in enumerate(index.blocks):
        for k in range(weights.shape[1]):
            vector = examples[number * toxicity.BLOCK + k] = [0.0] * len(index.idf)
            for term, weight in zip(terms, weights[:, k]):
                vector[term] = weight
    full = rows @ np.array([examples[k] for k in range(len(examples))], np.float32).T
    _, cosines = index.nearest(rows)
    assert np.allclose(cosines, -np.sort(-full, 1)[:, : toxicity.NEIGHBOURS], atol=1e-5)
    out = toxicity.score(docs.join(labels, "doc_id"), index).filter(held_out(5, 0)).collect()
    assert sum(r["predicted"] == r["toxic"] for r in out) >= 0.9 * len(out)
    odd = toxicity.score(edges, index).collect()
    assert len(odd) == len(EDGES) and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.score(empty, index).count() == 0
    blank = toxicity.fit(docs, labels.filter("false"), ~held_out(5, 0))
    assert {r["score"] for r in toxicity.score(edges, blank).collect()} == {0.0}


def test_labelled_sample_has_a_row_an_id(spark):
    rows = [(1, f"text {n}") for n in range(300)] + [(2, None), (2, "two"), (3, None), (4, "four")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 1)], "doc_id bigint, toxic int")
    sample, sizes = labelled.labelled_sample(docs, labels, "toxic", F.lit(True))
    found = {r["doc_id"]: r["text"] for r in sample.collect()}
    assert sample.count() == 4 and sizes == {0: 2, 1: 2}
    assert found[1].startswith(b"text ") and (found[2], found[3], found[4]) == (b"two", None, b"four")
    again, _ = labelled.labelled_sample(docs.repartition(3), labels, "toxic", F.lit(True))
    assert {r["doc_id"]: r["text"] for r in again.collect()} == found


def test_quality_classifier(spark, edges, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    space = quality_classifier.fit(docs, labels, ~held_out(4, 2))
    out = quality_classifier.score(docs.join(labels, "doc_id"), space).filter(held_out(4, 2)).collect()
    assert sum(r["predicted"] == r["quality"] for r in out) >= 0.9 * len(out)
    odd = quality_classifier.score(edges, space).collect()
    assert len(odd) == len(EDGES) and all(0 <= r["score"] <= 1 for r in odd)
    assert quality_classifier.score(empty, space).count() == 0
    blank = quality_classifier.fit(docs, labels.filter("false"), ~held_out(4, 2))
    assert {r["score"] for r in quality_classifier.score(edges, blank).collect()} == {0.0}


def test_sharding(spark, docs, edges, empty):
    rows = sharding.shard_manifest(docs, 16, "source").collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    by_shard, of_text = defaultdict(list), defaultdict(set)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        by_shard[r["shard"]].append(r)
        of_text[raw].add(r["shard"])
    assert all(len(s) == 1 for s in of_text.values()) and len(rows) == docs.count()
    for held in by_shard.values():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))
    loads = [sum(r["size"] for r in held) for held in by_shard.values()]
    assert len(loads) == 16 and max(loads) - min(loads) <= max(r["size"] for r in rows)
    hot = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 6000, "same text " * 20).otherwise(F.col("id").cast("string")).alias("text"))
    spread = sharding.shard_manifest(hot, 16).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    sizes = [r["n"] for r in spread]
    assert len(sizes) == 16 and max(sizes) < 1.1 * min(sizes)  # a group beyond a shard is split
    odd = sharding.shard_manifest(edges, 4).collect()
    assert len(odd) == len(EDGES) and {r["size"] for r in odd if r["doc_id"] in (1, 2)} == {1}
    assert sharding.shard_manifest(empty, 4).count() == 0


def test_written_shards(docs, tmp_path, spark):
    sharding.write_shards(docs, f"{tmp_path}/shards", 4)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.drop("_shard").exceptAll(docs).count() == 0 and back.count() == docs.count()


@pytest.mark.parametrize("block", [1 << 24, 5000])
def test_token_counts(docs, edges, empty, block, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK_BYTES", block)
    model = Tokenizer.from_file(TOKENIZER)
    for frame in (docs, edges):
        out = token_counts.count_tokens(frame, TOKENIZER).collect()
        got = Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out)
        expected = Counter()
        for r in frame.collect():
            text = r["text"] or ""
            n = len(model.encode(text, add_special_tokens=False))
            expected[r["doc_id"], len(text.encode()), n, n > 1024] += 1
        assert got == expected
    assert token_counts.count_tokens(empty, TOKENIZER).count() == 0


def repeats_of(texts):
    seen, out = {}, {}
    for number in sorted(texts):
        raw = texts[number]
        marks = bytearray(len(raw))
        for at in range(len(raw) - 99):
            if raw[at : at + 100] in seen:
                marks[at : at + 100] = b"\1" * 100
            seen[raw[at : at + 100]] = True
        spans = sum(1 for k, m in enumerate(marks) if m and (not k or not marks[k - 1]))
        out[number] = len(raw), sum(marks), spans, bytes(c for c, m in zip(raw, marks) if not m)
    return out


@pytest.mark.parametrize("block", [1 << 24, 3000])
def test_suffix_dedup(spark, texts, edges, empty, block, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix_dedup, "PARSED", 700)
    monkeypatch.setattr(suffix_dedup, "RANGE_BYTES", 20_000)
    passage = " ".join(f"p{(k * 31) % 97}" for k in range(60))
    more = {5000 + k: f"{k}" * (k + 3) + passage + f" tail {k * k}" for k in range(20)}
    more |= {6000: "ab" * 500, 6001: "b" + "ab" * 120, 6002: "é" * 200, 6003: None, 6004: "", 6005: "x" * 99}
    more |= near_copies(12)
    rows = list((texts | more).items())
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    expected = repeats_of({n: (t or "").encode() for n, t in rows})
    out = suffix_dedup.find_repeats(frame).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out} == expected
    if block > 3000:
        odd = suffix_dedup.find_repeats(edges.withColumn("text", F.substring("text", 1, 3000))).collect()
        assert len(odd) == len(EDGES)
        assert {r["n_removed"] for r in odd if r["doc_id"] == 9} == {480}
        assert {r["n_removed"] for r in odd if r["doc_id"] in (4, 5, None)} == {0}
        assert suffix_dedup.find_repeats(empty).count() == 0


def test_pipeline_stages(spark, docs, texts, benchmark, edges, empty):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "n-gram Jaccard join", "benchmark decontamination", "mixing", "sharding"]
    one, two, three, four, five = (f for _, f in corpus_pipeline.STAGES)
    ids = lambda frame: sorted(r["doc_id"] for r in frame.select("doc_id").collect())
    assert ids(one(spark, docs, FOLDER)) == ids(docs)  # nothing clean is rejected
    assert ids(two(spark, docs, FOLDER)) == sorted(n for n, (first, _) in links_of(texts).items() if n == first)
    windows = windows_of([(r["item_id"], r["text"]) for r in benchmark.collect()])
    assert ids(three(spark, docs, FOLDER)) == sorted(n for n, t in texts.items() if not hits_of(t, windows)[1])
    for stage in (one, two, three, four):
        assert stage(spark, docs, FOLDER).columns == docs.columns
        assert stage(spark, empty, FOLDER).count() == 0
        stage(spark, edges, FOLDER).collect()
    out = corpus_pipeline.run(spark, FOLDER).collect()
    assert set(ids(spark.createDataFrame(out))) <= set(texts) and len({r["shard"] for r in out}) == 16


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = con.execute(ORACLE_SQL[name])
    columns = sorted(c[0] for c in result.description)
    frame = QUERIES[name](spark, FOLDER)
    assert sorted(frame.columns) == columns
    expected = Counter(tuple(row) for row in con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall())
    assert Counter(tuple(row) for row in frame.select(*columns).collect()) == expected


def test_registered():
    names = set(driver.queries())
    assert {f"op{n}" for n in range(1, 11)} == {name.split("_")[0] for name in QUERIES} and set(QUERIES) <= names
    assert "pipeline" in names and set(ORACLE_SQL) <= set(driver.oracle_sql())
