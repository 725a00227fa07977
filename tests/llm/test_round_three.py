"""Importance resampling, secret scans and lexical search against brute force, and on rows at the edge."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import EDGES, FOLDER, LONG, WORD, benchmark, docs, edges, empty, lowered  # noqa: F401

from wireloom.llm import importance_resampling, lexical_search, secret_scan
from wireloom.llm.automata import infer
from wireloom.llm.queries import QUERIES


def resampled(rows, target, longest=1):
    """{doc_id: (n_features, weight, score)} and the ranks, in plain Python."""

    def features(text):
        words = WORD.findall(lowered(text))
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(run.encode()) % 10_000 for run in runs]

    found = [(number, *features(text)) for number, text in rows]
    s, t = Counter(b for _, _, bs in found for b in bs), Counter(b for text in target for b in features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))
    out, drawable = {}, []
    for number, n_words, buckets in found:
        weight = sum(map(gain, buckets)) // len(buckets) if buckets else 0
        h = int(hashlib.sha256(f"2024:{'' if number is None else number}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[number] = (len(buckets), weight, score)
        if n_words >= 20:
            drawable.append((-score, number is None, number))
    drawable.sort()
    return out, {n: k for k, (_, _, n) in enumerate(drawable[: 10 * len(drawable) // 100], 1)}


@pytest.mark.parametrize("longest", [1, 2])
def test_importance_resampling(spark, docs, benchmark, longest):  # noqa: F811
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected, ranks = resampled(texts, [r["text"] for r in benchmark.collect()], longest)
    if longest == 1:
        rows = QUERIES["op13_importance_resampling"](spark, FOLDER).collect()
    else:
        rows = importance_resampling.resample(docs, benchmark, longest=2).collect()
    assert len(rows) == len(texts) and ranks
    for r in rows:
        assert (r["n_features"], r["weight"], r["score"]) == expected[r["doc_id"]]
        assert r["rank"] == ranks.get(r["doc_id"])


def test_bit_planes_are_exact():
    chance = np.random.default_rng(3)
    gain = chance.integers(-30_000, 30_000, importance_resampling.BUCKETS).tolist()
    found = [chance.integers(0, 10_000, n) for n in (0, 1, 5_000)] + [np.full(70_000, 9_999), np.zeros(3, int)]
    planes, values = importance_resampling.gain_planes(gain)
    sums = importance_resampling.gain_sums(found, planes, values)
    assert sums.tolist() == [sum(gain[b] for b in buckets) for buckets in found]
    assert importance_resampling.gain_sums([], planes, values).tolist() == []
    planes, values = importance_resampling.gain_planes([0] * 10_000)
    assert importance_resampling.gain_sums(found, planes, values).tolist() == [0] * 5


def test_importance_resampling_edges(edges, empty, benchmark):  # noqa: F811
    rows = importance_resampling.resample(edges, benchmark, percent=50)
    own = [c for c in edges.columns if c not in ("text", "n_words", "n_features", "weight", "score", "rank")]
    assert rows.columns == [*own, "n_words", "n_features", "weight", "score", "rank"]
    out = rows.collect()
    assert len(out) == len(EDGES) and {r["size"] for r in out} == {"own size"}
    assert {(r["n_features"], r["weight"]) for r in out if r["doc_id"] in (1, 2, 3)} == {(0, 0)}
    assert [r["doc_id"] for r in out if r["rank"] is not None] == []  # half of the one row of 20 words is none
    ranked = importance_resampling.resample(edges, benchmark, percent=100, least_words=0).collect()
    order = sorted(ranked, key=lambda r: (-r["score"], r["doc_id"] is None, r["doc_id"] or 0))
    assert sorted(r["rank"] for r in ranked) == list(range(1, len(EDGES) + 1))
    assert [(r["score"], r["doc_id"]) for r in order] == [(r["score"], r["doc_id"]) for r in sorted(ranked, key=lambda r: r["rank"])]
    assert importance_resampling.resample(empty, benchmark).count() == 0
    assert importance_resampling.resample(edges, benchmark.filter("false")).count() == len(EDGES)


def base_of(text):
    """The spans of the base patterns, as the rules state them."""
    text, found = text or "", []
    letters = "".join
    either = letters(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "(password|passwd|secret|token|api_?key)")
    pattern = either + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for place, (kind, rule, least) in enumerate((("assign", pattern, 8), ("access", "AKIA[A-Z0-9]+", 16), ("hex", "[0-9a-f]+", 32))):
        for m in re.finditer(rule, text):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                found.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return [name for _, _, name in sorted(found)]


ODD = [
    "token=secret: abcdefgh12", 'PassWord" : \'aaaaaaaa', "é api_key=12345678 apikey = 1234567", "AKIAAKIA0123456 AKIAAKIA01234567",
    "0123456789abcdef0123456789abcdeF0123456789abcdef0123456789abcdef", "secret=token=abcdefghi", "toKen=abcdefghij",
    "\U0001f600 passwd:abc_def/ghi+= x",
]


def test_secret_patterns(spark, docs):  # noqa: F811
    made = spark.createDataFrame(list(enumerate(ODD, 10**6)), "doc_id bigint, text string")
    table = docs.select("doc_id", "text").unionByName(made)
    rows = secret_scan.digest(secret_scan.find_secrets(table, secret_scan.fit(table))).collect()
    texts, kinds = dict(table.collect()), Counter()
    for r in rows:
        base = base_of(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        counts = Counter(name.split(":")[0] for name in base)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(counts[k] for k in ("assign", "access", "hex"))
        shown = [s for s in r["spans"].split(",") if s]
        assert [s for s in shown if "_like" not in s] == base
        starts = [int(s.split(":")[1]) for s in shown]
        assert starts == sorted(starts)
        kinds += counts
    assert min(kinds[k] for k in ("assign", "access", "hex")) > 0
    query = {r["doc_id"]: r for r in QUERIES["op12_secret_scan"](spark, FOLDER).collect()}
    assert len(query) == docs.count()
    assert all(r["base_sha256"] == query[r["doc_id"]]["base_sha256"] for r in rows if r["doc_id"] in query)


def test_secrets_by_format(spark, docs):  # noqa: F811
    chance = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    key = lambda: "sk_live_" + "".join(chance.choices(letters, k=24))
    access = lambda: "AKIA" + "".join(chance.choices(letters[:26] + letters[52:], k=16))
    labelled = [(10**6 + n, f"The token = '{key()}', and {access()} as well.") for n in range(300)]
    bare = [(2 * 10**6 + n, f"Then {key()} é, or {key()}.") for n in range(100)]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(labelled + bare, "doc_id bigint, text string"))
    formats = secret_scan.fit(table)
    found = secret_scan.find_secrets(table, formats)
    rows = {r["doc_id"]: r for r in found.collect()}
    hit = [s for n, _ in bare for s in rows[n]["secrets"] if s["kind"] == "assign_like"]
    assert len(hit) >= 190 and all(s["odds"] > 0 and s["end"] - s["start"] == 32 for s in hit)
    # Ordinary words, numbers and addresses are left alone.
    added = [s for n, r in rows.items() if n < 10**6 for s in r["secrets"] if s["kind"].endswith("_like")]
    assert len(added) <= 1
    masked = {r["doc_id"]: r["text"] for r in secret_scan.redacted(found).filter("doc_id >= 2000000").collect()}
    assert sum(text == "Then [secret] é, or [secret]." for text in masked.values()) >= 90


def test_automata():
    chance = random.Random(2)
    strings = ["AB" + "".join(chance.choices("01", k=chance.randint(1, 12))) for _ in range(2_000)]
    automaton = infer(strings)
    assert automaton.follows.shape[0] <= 6  # A, B, and a loop
    like = automaton.likelihoods(["AB0101", "AB1111", "0101AB", "AB01x1", "", "AB" + "01" * 500])
    assert like[0] == pytest.approx(like[1], abs=0.5) and like[2] < like[0] - 10 and like[3] < like[0] - 5
    assert like[4] < like[0] and np.isfinite(like).all()
    again = infer(list(reversed(strings)))
    assert (again.follows == automaton.follows).all() and (again.logs == automaton.logs).all()
    # Shares of every state, its end included, add up to one.
    assert np.exp(automaton.logs).sum(1) == pytest.approx(1)
    even = infer([]).likelihoods(["abc", "xyz", "a"])
    assert even[0] == pytest.approx(even[1]) and even[2] > even[0]
    assert infer([]).likelihoods([]).tolist() == []


def test_secret_scan_edges(spark, edges, empty):  # noqa: F811
    formats = secret_scan.fit(edges)
    out = secret_scan.find_secrets(edges, formats)
    assert out.columns == [*edges.columns, "secrets"] and out.count() == len(EDGES)
    assert all(not r["secrets"] for r in out.collect() if r["doc_id"] in (1, 2, 3, 4, 5))
    clashing = edges.withColumn("secrets", F.lit("own"))
    assert secret_scan.find_secrets(clashing, formats).columns == [*edges.columns, "secrets"]
    assert secret_scan.find_secrets(empty, formats).count() == 0
    assert secret_scan.fit(empty).verdicts(["abcdefgh"]) == [None]
    twice = secret_scan.redacted(secret_scan.find_secrets(spark.createDataFrame([(1, "x token=" + "0a" * 20 + " y"), (2, None)], "doc_id int, text string"), formats))
    assert [r["text"] for r in twice.orderBy("doc_id").collect()] == ["x [secret] y", None]


def searched(docs, items, results=10):
    """{(item_id, rank): (doc_id, score)} over rows of (id, text), in plain Python."""
    found = [(number, Counter(WORD.findall(lowered(text)))) for number, text in docs]
    found = [(number, counts, sum(counts.values())) for number, counts in found if counts]
    big_n, big_l = len(found), sum(n for _, _, n in found)
    df = Counter(term for _, counts, _ in found for term in counts)
    terms, out = {}, {}
    for item, text in items:
        terms.setdefault(item, Counter()).update(WORD.findall(lowered(text)))
    for item, wanted in terms.items():
        scores = []
        for number, counts, n in found:
            m, score = 100 - 75 + 75 * n * big_n // big_l, 0
            for term, times in wanted.items():
                tf = counts.get(term, 0)
                w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[term] + 1)))
                score += times * w * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score:
                scores.append((-score, number is None, number))
        for rank, (score, _, number) in enumerate(sorted(scores)[:results], 1):
            out[item, rank] = (number, -score)
    return out


def test_lexical_search(spark, docs, benchmark, monkeypatch):  # noqa: F811
    texts, items = [(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in benchmark.collect()]
    expected = searched(texts, items)
    rows = QUERIES["op11_lexical_search"](spark, FOLDER).collect()
    assert {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in rows} == expected and len(rows) == len(expected)
    # In parts, with chunks of a few terms, from an index made before, with other numbers of results.
    monkeypatch.setattr(lexical_search, "PART_TERMS", 300)
    monkeypatch.setattr(lexical_search, "LOOKED_UP", 7)
    index = lexical_search.build_index(docs)
    rows = lexical_search.search(docs, benchmark.limit(12), index, results=3).collect()
    assert {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in rows} == searched(texts, items[:12], 3)


def test_bounds_hold_and_exclude(docs, benchmark):  # noqa: F811
    """No bound is below the score, and few documents are left to score."""
    index = lexical_search.build_index(docs)
    items = [Counter(WORD.findall(lowered(r["text"]))) for r in benchmark.limit(8).collect()]
    items = [Counter({t.encode(): n for t, n in item.items()}) for item in items]
    search = lexical_search._prepared(docs, index, items)
    counts = {r["doc_id"]: Counter(w.encode() for w in WORD.findall(lowered(r["text"]))) for r in docs.collect()}
    tight = []
    for block in index.collect():
        ids, sizes = np.array(block["ids"]), np.array(block["sizes"])
        for item, bounds in search.bounds(block["bits"], sizes, bytes(block["slices"])):
            for number, size, bound in zip(ids, sizes, bounds):
                score = search.score(item, counts[number], int(size))
                assert score <= bound and size == sum(counts[number].values())
                tight.append(bound <= 1.05 * score + 1)
    assert len(tight) == 8 * len(counts) and np.mean(tight) > 0.7


def test_lexical_search_edges(spark, edges, empty):  # noqa: F811
    items = [(1, "ONE two"), (2, None), (3, "!"), (None, "fox"), (None, "jumps"), (4, "nowhere"), (5, "aaaaaaaa " * 3), (6, "x " * 40 + LONG)]
    table = spark.createDataFrame(items, "item_id int, text string").withColumn("doc_id", F.lit("own"))
    texts = [(r["doc_id"], r["text"]) for r in edges.collect()]
    rows = lexical_search.search(edges, table).collect()
    expected = searched(texts, items)
    assert {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in rows} == expected and len(rows) == len(expected)
    assert None in {r["doc_id"] for r in rows}
    assert lexical_search.search(empty, table).count() == 0
    assert lexical_search.search(edges, table.filter("false")).count() == 0


def test_lexical_search_among_copies(spark):
    """Copies tie at the last result: the ids decide, and bounds above the scores do not add links."""
    rows = [(n, "alpha beta gamma delta") for n in range(300, 0, -1)] + [(1000 + n, f"alpha w{n} " + "beta " * (n % 40)) for n in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")  # noqa: F811
    items = [(1, "alpha beta"), (2, "gamma"), (3, "w7 beta")]
    found = lexical_search.search(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in found} == searched(rows, items)
