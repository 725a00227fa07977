"""Secrets in texts: fixed patterns, and what looks like the credentials that they find, by inferred grammars.

The values that the patterns find are labelled credentials, and give a probabilistic automaton for each kind. Runs of
token characters outside of them are ordinary text; they give an automaton for each shape, so that numbers and
addresses, which are rare next to words, have one of their own. A run is a secret if the odds of a kind, by likelihood
and by how often labelled values and runs of its shape occur, are better than even.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from wireloom.llm.automata import ALPHABET, Automaton, infer
from wireloom.llm.text import kept, map_rows
from wireloom.operators.order import first_of_groups

#: The kinds, their patterns, and the least length of a value.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile("AKIA[A-Z0-9]{12,}")
HEX = re.compile("[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex")
LEAST_ASSIGNED = 8

#: Runs that are scored, without the full stops and hyphens around them.
RUN, LEAST_RUN = re.compile("[A-Za-z0-9+/_.=-]{8,}"), 8

#: Examples of each kind and of the ordinary runs of each shape that automata are inferred from, and the longest of them.
EXAMPLES, LONGEST_EXAMPLE = 1024, 256

#: A run's shape: which of small letters, capitals, digits and other characters it has.
_CLASSES = str.maketrans({c: "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "-" for c in ALPHABET})

#: Runs whose verdict a task remembers.
REMEMBERED = 200_000

SPANS = "array<struct<kind:string,start:int,end:int,odds:double>>"


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the patterns' matches, leftmost and not overlapping within a kind.

    A span is the whole match; an assignment's value is what is assigned. A run of too few characters is no match, and
    what a dropped assignment covers is not looked at again.
    """
    found = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        found = [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text)]
    return found + [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]


def runs_outside(text: str, spans: list[tuple[str, int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """(start, end, run) of the candidates: runs that no span of the patterns touches."""
    ends = sorted((start, end) for _, start, end, _ in spans)
    at = 0
    for m in RUN.finditer(text):
        start, end = m.span()
        while at < len(ends) and ends[at][1] <= start:
            at += 1
        if at < len(ends) and ends[at][0] < end:
            continue
        run = m[0]
        if run[0] in ".-" or run[-1] in ".-":
            start, run = start + len(run) - len(run.lstrip(".-")), run.strip(".-")
            if len(run) < LEAST_RUN:
                continue
        yield start, start + len(run), run


def shape_of(run: str) -> str:
    return "".join(sorted(set(run.translate(_CLASSES))))


def _place(value: str) -> int:
    """A value's place in a fixed random order."""
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "replace"), digest_size=8).digest(), "big") >> 1


@dataclass
class Formats:
    """The automata of kinds of credentials and of shapes of ordinary runs, and how often each occurs, as logs of shares."""

    kinds: dict[str, Automaton] = field(default_factory=dict)
    shapes: dict[str, Automaton] = field(default_factory=dict)
    shares: dict[str, float] = field(default_factory=dict)
    rare: float = 0.0

    def verdicts(self, runs: list[str]) -> list[tuple[str, float] | None]:
        """The likeliest kind of each run and the log of its odds, or None where ordinary text is likelier.

        A shape that was not seen has the share of one run, and all strings of it are equally likely.
        """
        if not self.kinds or not runs:
            return [None] * len(runs)
        shapes = np.array([shape_of(run) for run in runs])
        plain = np.empty(len(runs))
        for shape in set(shapes):
            at = np.flatnonzero(shapes == shape)
            automaton = self.shapes.get(shape) or infer([])
            plain[at] = automaton.likelihoods([runs[n] for n in at]) + self.shares.get(shape, self.rare)
        odds = np.stack([automaton.likelihoods(runs) + self.shares[kind] for kind, automaton in self.kinds.items()]) - plain
        names = list(self.kinds)
        best = odds.argmax(0)
        return [(f"{names[k]}_like", float(odds[k, n])) if odds[k, n] > 0 else None for n, k in enumerate(best)]


def fit(docs: DataFrame, examples: int = EXAMPLES) -> Formats:
    """Infer the automata from about `examples` different values of each kind and as many ordinary runs of each shape.

    They are the first ones in a fixed random order over all documents, of at most LONGEST_EXAMPLE characters; a task
    gives out no more than that, and how many there are, with repeats. Without values of a kind it has no
    automaton, and without any no run is a secret.
    """

    def sampler():
        def sample(columns: dict) -> dict:
            seen: Counter = Counter()
            for text in columns["text"]:
                spans = base_spans(text or "")
                seen.update((kind, value) for kind, _, _, value in spans)
                seen.update(("", run) for _, _, run in runs_outside(text or "", spans))
            counts: Counter = Counter()
            values: dict[str, dict[str, int]] = {}
            for (kind, value), n in seen.items():
                kind = kind or shape_of(value)
                counts[kind] += n
                if len(value) <= LONGEST_EXAMPLE:
                    values.setdefault(kind, {})[value] = _place(value)
            rows = [(kind, None, None, n) for kind, n in counts.items()]
            for kind, held in values.items():
                rows += [(kind, v, at, None) for v, at in sorted(held.items(), key=lambda x: x[1])[:examples]]
            kinds, texts, places, ns = zip(*rows) if rows else ((), (), (), ())
            return {"kind": kinds, "value": texts, "place": places, "n": ns}

        return sample

    rows = kept(map_rows(docs.select("text"), "kind string, value string, place bigint, n bigint", sampler, step=4096))
    counts = dict(rows.filter("n IS NOT NULL").groupBy("kind").agg(F.sum("n")).collect())
    distinct = rows.filter("value IS NOT NULL").select("kind", "value", "place").distinct()
    chosen: dict[str, list[str]] = {}
    for row in first_of_groups(distinct, examples, ["kind"], F.col("place"), F.col("value")).collect():
        chosen.setdefault(row["kind"], []).append(row["value"])
    labelled = {kind: chosen[kind] for kind in KINDS if kind in chosen}
    kinds = {kind: infer(chosen.pop(kind)) for kind in KINDS if chosen.get(kind)}
    everything = max(1, sum(counts.values()))
    for shape, runs in chosen.items():
        chosen[shape] = [run for run, hidden in zip(runs, unlabelled(runs, counts, kinds, labelled, shape)) if not hidden]
        counts[shape] = counts[shape] * len(chosen[shape]) / len(runs)
    shares = {kind: math.log(n / everything) for kind, n in counts.items() if n}
    return Formats(kinds, {shape: infer(runs) for shape, runs in chosen.items() if runs}, shares, -math.log(everything))


def unlabelled(runs: list[str], counts: dict, kinds: dict[str, Automaton], labelled: dict[str, list[str]], shape: str) -> np.ndarray:
    """Which runs of a shape are credentials that no pattern finds, so that ordinary text is not learned from them.

    That is told by a kind's values: a run is no shorter or longer than they, and no less likely by character than all but
    a hundredth of them. Where such runs occur more often than the kind's values they are taken for ordinary text.
    """
    hidden = np.zeros(len(runs), bool)
    sizes = np.array([len(run) for run in runs])
    for kind, automaton in kinds.items():
        values = labelled[kind]
        lengths = np.array([len(value) for value in values])
        least = np.quantile(automaton.likelihoods(values) / (lengths + 1), 0.01)
        alike = (automaton.likelihoods(runs) / (sizes + 1) >= least) & (sizes >= lengths.min()) & (sizes <= lengths.max())
        if alike.mean() * counts[shape] <= counts[kind]:
            hidden |= alike
    return hidden


def find_secrets(docs: DataFrame, formats: Formats) -> DataFrame:
    """Documents with `secrets`: kind, start, end (code points, end exclusive) and log-odds of each span, by start, then
    kind: those of the patterns (odds null), then `<kind>_like` of what the automata add, which touch no pattern's span.

    Whole texts, one narrow pass; every run is scored. Null and empty texts have none; equal texts have equal spans; no
    rows give none. A column called `secrets` is replaced, others stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(formats)
    stay = [F.col(f"`{name}`") for name in docs.columns if name != "secrets"]
    rows = docs.select(F.struct(*stay).alias("document"), "text")
    schema = StructType([rows.schema["document"], StructField("secrets", StructType.fromDDL(f"x {SPANS}")["x"].dataType)])
    order = {kind: place for place, kind in enumerate([*KINDS, *[f"{kind}_like" for kind in KINDS]])}

    def finder():
        known, memo = shared.value, {}

        def find(columns: dict) -> dict:
            spans = [base_spans(text or "") for text in columns["text"]]
            runs = [list(runs_outside(text or "", found)) for text, found in zip(columns["text"], spans)]
            if len(memo) > REMEMBERED:
                memo.clear()
            new = list({run for found in runs for _, _, run in found if run not in memo})
            memo.update(zip(new, known.verdicts(new)))
            out = []
            for base, more in zip(spans, runs):
                secrets = [(kind, start, end, None) for kind, start, end, _ in base]
                for start, end, run in more:
                    if memo[run]:
                        secrets.append((memo[run][0], start, end, memo[run][1]))
                secrets.sort(key=lambda s: (s[1], order[s[0]]))
                out.append([dict(zip(("kind", "start", "end", "odds"), s)) for s in secrets])
            return {"document": columns["document"], "secrets": out}

        return find

    return map_rows(rows, schema, finder).select("document.*", "secrets")


def redacted(rows: DataFrame, mask: str = "[secret]") -> DataFrame:
    """Rows of find_secrets with every covered stretch of `text` replaced by the mask; overlapping spans are one."""
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("end"))
    piece = lambda at, to: F.substring(F.col("text"), at + 1, F.greatest(to - at, F.lit(0)))

    def step(done: Column, span: Column) -> Column:
        new = F.when(span["start"] >= done["end"], F.concat(piece(done["end"], span["start"]), F.lit(mask))).otherwise("")
        return F.struct(F.concat(done["text"], new).alias("text"), F.greatest(done["end"], span["end"]).alias("end"))

    whole = lambda done: F.concat(done["text"], piece(done["end"], F.length("text")))
    return rows.withColumn("text", F.aggregate("secrets", start, step, whole))


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def digest(rows: DataFrame) -> DataFrame:
    """n_assign, n_access, n_hex, base_sha256, spans and n_added of rows of find_secrets."""
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("secrets", lambda s: s["kind"].isin(*KINDS))
    n = [F.size(F.filter("secrets", _is(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    added = (F.size("secrets") - F.size(base)).cast("long")
    return rows.select(
        "doc_id", *n, F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"), shown(F.col("secrets")).alias("spans"), added.alias("n_added")
    )
