"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once. The ledger keeps what was measured and one bit for each rule that failed; policies are
versioned masks over those bits, and ablations are counts over them, so neither reads a text again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireloom.llm.text import SPACE_CHARS

#: The symbols counted by the base rules.
SYMBOLS = "#*$%&|<>"

#: Rules in the order of their bits: what fails a document.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "short_or_long_words": "word_chars < 2 * n_words or word_chars > 20 * n_words",
    "shouting": "2 * n_upper > word_chars",
}

#: Policies by version: the rules that remove a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "duplicate_lines"),
    "v2": tuple(RULES),
}


def mask_of(policy: str) -> int:
    return sum(1 << place for place, rule in enumerate(RULES) if rule in POLICIES[policy])


def _grams(words: Column) -> Column:
    """Fingerprints of all windows of three words."""
    places = F.sequence(F.lit(0), F.size(words) - 3)
    grams = F.transform(places, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) >= 3, grams).otherwise(F.array().cast("array<bigint>"))


def _covered(places: Column) -> Column:
    """How many words the windows of three words at these places, in order, cover."""
    return F.aggregate(
        places,
        F.struct(F.lit(0).alias("words"), F.lit(-3).alias("last")),
        lambda seen, i: F.struct((seen["words"] + F.least(F.lit(3), i - seen["last"])).alias("words"), i.alias("last")),
        lambda seen: seen["words"].cast("long"),
    )


#: Columns the ledger adds; columns of these names in the input are replaced.
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "failed_rules"
)


def ledger(docs: DataFrame) -> DataFrame:
    """Documents with what was measured and `failed_rules`, the bits of the rules that failed. One narrow pass.

    Null and empty texts have no words and no lines; they fail `few_words` alone. Lines without a word do not count
    as lines. A table without rows gives none. Columns named like a measure are replaced, others stay.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    one_kind = F.translate(text, SPACE_CHARS, " " * len(SPACE_CHARS))
    words = F.array_remove(F.split(one_kind, " "), "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, SPACE_CHARS, "")) > 0)
    stay = [F.col(f"`{name}`") for name in docs.columns if name not in MEASURES]
    rows = docs.select(F.struct(*stay).alias("document"), "text").withColumn("_words", words).withColumn("_lines", lines).withColumn("_grams", _grams(F.col("_words")))
    # Windows sorted by fingerprint together with their place: equal neighbours are repeats.
    placed = F.sort_array(F.transform(F.col("_grams"), lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    repeated = F.size(F.array_distinct("_grams")) < F.size("_grams")
    rows = rows.withColumn("_placed", F.when(repeated, placed))
    near = lambda x, i, by: F.coalesce(F.get(F.col("_placed"), i + by)["g"] == x["g"], F.lit(False))
    repeats = F.filter(F.col("_placed"), lambda x, i: near(x, i, -1) | near(x, i, 1))
    places = F.sort_array(F.transform(repeats, lambda x: x["i"]))
    measured = {
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.translate(text, SPACE_CHARS, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(_covered(places), F.lit(0)).cast("long"),
        "n_upper": F.regexp_count(text, F.lit("[A-Z]")).cast("long"),
    }
    rows = rows.withColumns(measured).drop("_words", "_lines", "_grams", "_placed")
    bits = [F.when(F.expr(rule), F.lit(1 << place)).otherwise(F.lit(0)) for place, rule in enumerate(RULES.values())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return rows.withColumn("failed_rules", failed).select("document.*", *MEASURES)


def apply_policy(rows: DataFrame, policy: str) -> DataFrame:
    """Ledger rows with `kept`: none of the policy's rules failed."""
    return rows.withColumn("kept", F.col("failed_rules").bitwiseAND(F.lit(mask_of(policy))) == 0)


def ablations(rows: DataFrame) -> DataFrame:
    """For each policy and rule of it: documents, those kept, those the rule fails, and those it alone removes.

    One aggregation over the ledger's bits, combined before the shuffle; a row for each policy and rule.
    """
    counts, wanted = [], [(policy, rule) for policy in POLICIES for rule in POLICIES[policy]]
    for policy, rule in wanted:
        failed, bit = F.col("failed_rules").bitwiseAND(F.lit(mask_of(policy))), 1 << list(RULES).index(rule)
        counts.append(
            F.struct(
                F.lit(policy).alias("policy"), F.lit(rule).alias("rule"), F.count(F.lit(1)).alias("documents"),
                F.count_if(failed == 0).alias("kept"), F.count_if(failed.bitwiseAND(F.lit(bit)) != 0).alias("failed"),
                F.count_if(failed == bit).alias("failed_alone"),
            )
        )
    return rows.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))
