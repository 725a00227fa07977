"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

A source's target over its size is the number of copies expected of each of its documents. Its whole part is
certain; its fraction is the inclusion probability p of one more copy. All documents are in one ranking by random odds
over inclusion odds, (u / (1 - u)) / (p / (1 - p)), in which those of different sources have different probabilities.
Sources, and in them classes of documents of like size, are strata: each takes its lowest ranks up to its words, so that
every source comes near its target. What a stratum of long documents lacks or takes too much goes to the next
shorter ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wireloom.llm.text import kept, n_words, written

#: Ranks are numbers of so many digits of so many values. Words are summed by digit, so what a stratum gives to the
#: plan is bounded, and the jobs of a plan are as many whatever the tables.
DIGITS, BASE = 3, 1024


def _uniform(seed: int) -> Column:
    """Random number of a document in (0, 1): a function of its id, or of its text if it has none, so that reruns agree."""
    text = F.when(F.col("doc_id").isNull(), F.col("text"))
    bits = F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), F.lit(seed), text), 12)
    return (bits.cast("double") + 0.5) / float(1 << 52)


def document_sizes(docs: DataFrame, seed: int = 17) -> DataFrame:
    """doc_id, source, size in words and the random number of each document; null text has size 0."""
    return docs.select("doc_id", "source", n_words().alias("size"), _uniform(seed).alias("u"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """source, source_size, target: sources by code point, null last, weigh `weights` in turn.

    Targets share the sum of all sizes by weight. A source stops at `most` times its size, and what it cannot take
    goes to the others by weight. That is one level L with target = min(most * size, L * weight): sources fill up in
    the order of most * size / weight, so the level follows from running sums. One row a source in one task.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    ranked = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    )
    # The level if all sources before this one are full. The first that does not fill up sets it.
    levels = ranked.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
    final = F.min_by(F.when(F.col("open"), F.col("level")), F.when(F.col("open"), F.col("cap") / F.col("weight")))
    target = F.least(F.col("cap"), F.coalesce(final.over(everything) * F.col("weight"), F.col("cap")))
    return levels.select("source", "source_size", target.alias("target"))


def _odds(p: Column) -> Column:
    return p / (F.lit(1.0) - p)


def _place() -> Column:
    """A document's place in the ranking, as digits: its rank r as r / (1 + r), which runs from 0 to 1."""
    rank = _odds(F.col("u")) / _odds(F.greatest(F.col("p"), F.lit(1e-12)))
    return F.floor(rank / (rank + 1) * float(BASE**DIGITS)).cast("long")


def _stratum() -> Column:
    """Documents of 2^k up to 2^(k + 1) words are of one class."""
    return F.floor(F.log2("size")).cast("int")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), 0)


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their source's plan. The plan is a written table, so Spark knows its size and broadcasts it if it is
    small; else it deals rows by source and splits what one source has too much."""
    plan = plan.withColumnRenamed("source", "plan_source")
    return rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")


def mix_plan(sizes: DataFrame, **rules) -> DataFrame:
    """A row a source: target, certain copies, p, and for each class of sizes the cut in the ranking below which documents
    get one more copy.

    Classes are walked from long to short documents. The words of a class are p times its size and what is left over
    from longer ones; its lowest ranks are taken while they fit. Digits of the ranking are decided one after the other,
    the later ones only where the cut fell. A single document at the cut that does not fit is taken with the probability
    that makes its chance p, if shorter ones can make up for either; else as is nearer to the target. In the end the
    document at a cut that brings the source nearest to its target is taken. So chances differ from p only by what
    longer documents of the source leave over.
    """
    targets = source_targets(sizes, **rules)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + 1e-12)
    plan = targets.withColumn("copies", whole).withColumn("p", F.greatest(ratio - whole, F.lit(0.0)))
    plan = written(plan.withColumn("budget", F.lit(0.0)).withColumn("cuts", F.lit(None).cast("map<int,bigint>")), "mix-plan")
    for digit in range(DIGITS):
        rows = _with_plan(sizes.filter("size > 0"), plan.filter("p > 0").select("source", "p", "cuts"))
        rows = rows.select("source", "size", _stratum().alias("class"), _place().alias("place"), "cuts")
        plan = written(_next_digit(plan, rows, digit), f"mix-plan-{digit}")
    return plan.drop("budget")


def _next_digit(plan: DataFrame, rows: DataFrame, digit: int) -> DataFrame:
    """The plan with cuts that are exact to one more digit, and the words that its sources lack then."""
    unit = BASE ** (DIGITS - 1 - digit)
    if digit:
        cut = F.element_at("cuts", F.col("class"))
        rows = rows.filter((F.col("place") >= cut) & (F.col("place") < cut + unit * BASE))
    bins = rows.groupBy("source", "class", F.floor(F.col("place") / unit).cast("long").alias("bin"))
    bins = bins.agg(F.sum("size").cast("double").alias("words"), F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("source", "class").orderBy("bin")
    bins = bins.withColumn("upto", F.sum("words").over(running))
    classes = bins.groupBy("source", "class").agg(
        F.sum("words").alias("total"), F.sort_array(F.collect_list(F.struct("bin", "words", "n", "upto"))).alias("bins")
    )
    strata = classes.groupBy("source").agg(
        F.sum("total").alias("everything"),
        F.sort_array(F.collect_list(F.struct((-F.col("class")).alias("order"), "total", "bins"))).alias("strata"),
    )
    plan = plan.join(strata.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    none = F.array().cast("array<struct<class:int,cut:bigint,edge:double>>")
    start = F.struct(F.col("budget").alias("budget"), F.coalesce("everything", F.lit(0.0)).alias("rest"), none.alias("cuts"))
    strata = F.coalesce("strata", F.array().cast(strata.schema["strata"].dataType))
    plan = plan.withColumn("walk", F.aggregate(strata, start, lambda seen, one: _walk(seen, one, digit, unit)))
    lacking, cuts = F.col("walk")["budget"], F.col("walk")["cuts"]
    if digit == DIGITS - 1:
        gap = lambda cut: F.abs(cut["edge"] - lacking)
        ends = F.transform(F.filter(cuts, lambda cut: gap(cut) < lacking), lambda cut: F.struct(gap(cut), cut["class"].alias("class")))
        fill = F.array_min(ends)["class"]
        cuts = F.transform(cuts, lambda cut: cut.withField("cut", cut["cut"] + F.coalesce((cut["class"] == fill).cast("long"), F.lit(0))))
    found = F.map_from_entries(F.transform(cuts, lambda cut: F.struct(cut["class"], cut["cut"])))
    if digit:
        found = F.map_zip_with(F.coalesce("cuts", found), found, lambda _, old, new: F.coalesce(new, old))
    return plan.withColumn("budget", lacking).withColumn("cuts", found).drop("everything", "strata", "walk")


def _walk(seen: Column, stratum: Column, digit: int, unit: int) -> Column:
    """The words still lacking, and the cuts, after one more class of a source's documents."""
    budget = seen["budget"] + (F.col("p") * stratum["total"] if not digit else F.lit(0.0))
    rest = seen["rest"] - stratum["total"]

    def decide(b: Column) -> Column:
        return _let(F.get(F.filter(stratum["bins"], lambda x: x["upto"] > b), 0), lambda edge: close(b, edge))

    def close(b: Column, edge: Column) -> Column:
        lacking = b - F.coalesce(edge["upto"] - edge["words"], stratum["total"])
        take = F.lit(False)
        if not digit:
            over, p = edge["words"] - lacking, F.col("p")
            taken_ok, left_ok = over <= p * rest, lacking <= (1 - p) * rest
            draw = F.shiftrightunsigned(F.xxhash64(F.col("source"), stratum["order"], F.lit("edge")), 12) / float(1 << 52)
            nearer = over - p * rest < lacking - (1 - p) * rest
            single = F.when(taken_ok & left_ok, draw * edge["words"] < lacking).otherwise(taken_ok | (~left_ok & nearer))
            take = F.coalesce((edge["n"] == 1) & (lacking > 0) & single, F.lit(False))
        cut = F.coalesce((edge["bin"] + take.cast("long")) * unit, _end(stratum, digit, unit))
        words = F.when(~take, edge["words"])
        found = F.struct((-stratum["order"]).alias("class"), cut.alias("cut"), words.alias("edge"))
        return F.struct(
            (lacking - F.when(take, edge["words"]).otherwise(F.lit(0.0))).alias("budget"),
            rest.alias("rest"), F.concat(seen["cuts"], F.array(found)).alias("cuts"),
        )

    return _let(budget, decide)


def _end(stratum: Column, digit: int, unit: int) -> Column:
    """The cut behind all bins of a class: behind the whole ranking, or behind the bin that the digit before left open."""
    if not digit:
        return F.lit(BASE**DIGITS).cast("long")
    first = F.floor(F.get(stratum["bins"], 0)["bin"] / BASE)
    return ((first + 1) * BASE * unit).cast("long")


def _copies() -> Column:
    cut = F.when((F.col("p") > 0) & (F.col("size") > 0), F.element_at("cuts", _stratum()))
    return (F.col("copies") + F.coalesce((_place() < cut).cast("int"), F.lit(0))).cast("int")


def mix(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for the rows of document_sizes.

    Documents without a source form a source of their own, the last one. Null and empty texts have size 0 and are
    taken in the certain copies only. Rows that share an id share a rank, and their fate if they are of one class of
    sizes; rows without an id are ranked by their text. An empty table gives no rows. No document gets more than `most` copies.
    """
    return _with_plan(sizes, plan).select(
        "doc_id", "source", "size", "source_size", "target", _copies().alias("copies"),
        (_copies() * F.col("size")).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, **rules) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken.

    No text is shuffled while the plan, a row a source, is small enough to be broadcast.
    """
    plan = mix_plan(kept(document_sizes(docs)), **rules)
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("document")
    rows = docs.select("doc_id", "source", n_words().alias("size"), _uniform(17).alias("u"), whole)
    repeats = F.explode(F.array_repeat(F.lit(1), _copies()))
    return _with_plan(rows, plan).select("document", repeats).select("document.*")
