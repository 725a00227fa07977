"""Which bodies of an exchange are its request and its response.

Bodies carry no direction. With one body only, the last request end tells: a body no later
than it is the request. From the second body on request ends play no part; a body *falls* if
it is earlier than the one before it. Let the *kept* body be the one in front of the last
body that continued its predecessor's direction (the second body counts as continuing). After
a rise the last body is the response and the kept one the request; after a fall it is the
other way round.

So a run of bodies is described by its count, first, second and last body, the last direction
and the kept body, however long it is, and two neighbouring runs can be joined. Long
exchanges are therefore summed up in pieces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wireloom.schema import BODY_CHAIN


def no_chain() -> Column:
    return F.lit(None).cast(BODY_CHAIN)


def chain_of(bodies: Column) -> Column:
    """Chain of an array of ``(ts, text)`` structs in arrival order; null for no bodies."""
    n = F.size(bodies)
    last = n - 1

    def at(index) -> Column:
        return F.get(bodies, index if isinstance(index, Column) else F.lit(index))

    def falls(index: Column) -> Column:
        return at(index)["ts"] < at(index - 1)["ts"]

    followed = F.filter(F.sequence(F.lit(1), n - 2), lambda i: falls(i) == falls(i + 1))
    kept = F.when(n > 2, at(F.get(followed, F.size(followed) - 1))["text"])
    return F.when(
        n > 0,
        F.struct(
            n.alias("n"),
            at(0)["ts"].alias("first_ts"),
            at(0)["text"].alias("first_text"),
            at(1)["ts"].alias("second_ts"),
            at(last)["ts"].alias("last_ts"),
            at(last)["text"].alias("last_text"),
            F.when(n > 1, falls(last)).alias("last_down"),
            kept.alias("kept_text"),
        ),
    ).cast(BODY_CHAIN)


def join_chains(left: Column, right: Column) -> Column:
    """Chain of two neighbouring runs, ``left`` the earlier one; either may be null."""
    seam_down = right["first_ts"] < left["last_ts"]
    second_down = right["second_ts"] < right["first_ts"]  # null for a single body
    kept = F.coalesce(
        right["kept_text"],
        F.when(seam_down == second_down, right["first_text"]),
        F.when(left["last_down"] == seam_down, left["last_text"]),
        left["kept_text"],
    )
    joined = F.struct(
        (left["n"] + right["n"]).alias("n"),
        left["first_ts"].alias("first_ts"),
        left["first_text"].alias("first_text"),
        F.coalesce(left["second_ts"], right["first_ts"]).alias("second_ts"),
        right["last_ts"].alias("last_ts"),
        right["last_text"].alias("last_text"),
        F.when(right["n"] > 1, right["last_down"]).otherwise(seam_down).alias("last_down"),
        kept.alias("kept_text"),
    )
    return (
        F.when(left.isNull(), right).when(right.isNull(), left).otherwise(joined)
    ).cast(BODY_CHAIN)


def request_body(chain: Column, request_end: Column) -> Column:
    kept = F.coalesce(chain["kept_text"], chain["first_text"])
    return (
        F.when((chain["n"] == 1) & (chain["last_ts"] <= request_end), chain["last_text"])
        .when((chain["n"] > 1) & chain["last_down"], chain["last_text"])
        .when(chain["n"] > 1, kept)
    )


def response_body(chain: Column, request_end: Column) -> Column:
    kept = F.coalesce(chain["kept_text"], chain["first_text"])
    before_end = F.coalesce(chain["last_ts"] <= request_end, F.lit(False))
    return (
        F.when((chain["n"] == 1) & ~before_end, chain["last_text"])
        .when((chain["n"] > 1) & chain["last_down"], kept)
        .when(chain["n"] > 1, chain["last_text"])
    )
