"""Assembly: the lines of one request key become one event.

Lines are summed up in *pieces* of ``2**PIECE_BITS`` offsets of a key, pieces in stretches of as
many pieces, and stretches in one *exchange* row per key (schema ``EXCHANGE``); ``to_events``
cuts the payloads out of it. Exchange rows of the same key can be joined again
(``join_exchanges``), which carries an exchange over from one batch to the next.

Lines count in the order ``(topic, partition, offset)``.

Scale. There is one plan for keys of any size. A broken client that logs under one constant key
may own a third of the log; so the lines are shuffled by key and stretch, where groups are
bounded by their offsets, and summed up in place; only one row for each key and stretch is
shuffled by key. Other log text is kept in pieces until an event is given out: as rows of its
own where exchanges go on from batch to batch, so that open exchanges do not grow with it. A log of
hundreds of megabytes is one value of a row all the same; ``assemble`` can put its text together apart,
where as few copies of it are held at a time as Spark allows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from wireloom.functions.text import (
    client_of,
    client_profile_of,
    duration_of,
    header_value,
    method_of,
    server_of,
    server_profile_of,
    status_of,
    url_of,
)
from wireloom.operators import lines as L
from wireloom.operators.bodies import (
    chain_of,
    join_chains,
    no_chain,
    request_body,
    response_body,
)
from wireloom.schema import EVENTS, EXCHANGE, TEXTS

# Fixed value: what stands between two texts of a joined log.
LOG_SEPARATOR = " ; "

HEADER_LINES = {
    "event_id_line": L.EVENT_ID,
    "event_type_line": L.EVENT_TYPE,
    "event_code_line": L.EVENT_CODE,
    "event_platform_line": L.EVENT_PLATFORM,
    "event_sequence_line": L.EVENT_SEQUENCE,
    "server_profile_line": L.SERVER_PROFILE,
}

# Kinds of lines; the place in the list, from 1, is a kind's number in a shuffle.
KINDS = [
    L.REQUEST_START,
    *HEADER_LINES.values(),
    L.BODY,
    L.REQUEST_END,
    L.RESPONSE_START,
    L.RESPONSE_END,
    L.OTHER,
]

# Columns of which the last known value counts.
LAST_WINS = [
    "start",
    "caller_thread",
    *HEADER_LINES,
    "request_end_ts",
    "response",
    "end_ts",
]


PIECE_BITS = 10

# Most bytes of a joined log: what one value of a row can hold.
MOST_LOG_BYTES = 2_000_000_000

# From so many bytes on the text of a key in one stretch goes a way of its own (``_log_apart``).
LONG_TEXT_BYTES = 1 << 16

# What a row is there: a whole event, an event whose log is apart, or a stretch of such a log.
WHOLE, WITHOUT_LOG, LOG = 0, 1, 2

# Over so many bytes of a log the heap is collected before its text is put together.
TIDY_BYTES = 1 << 26

# Tasks among which events with a log of their own are dealt. Up to 200 a shuffle writes rows as they come, without a copy.
LONG_LOG_TASKS = 100

# One whole event in so many is dealt with them, so that other rows come first where a long log is written.
COMPANY = 100


@dataclass(frozen=True)
class Summed:
    """What is known of some exchanges: rows of schema ``EXCHANGE`` and of schema ``TEXTS``."""

    exchanges: DataFrame
    texts: DataFrame

    @classmethod
    def nothing(cls, spark: SparkSession) -> Summed:
        # Only by its limit is a frame without rows known to be empty before it runs; then joins with it fall away.
        return cls(*[spark.createDataFrame([], schema).limit(0) for schema in (EXCHANGE, TEXTS)])


PLACE = ["request_key", "topic", "partition"]

# What tells stretches apart, and, of records without a key, pieces (``alone``); in the order in which they are sorted.
STRETCH = ["sorted_by", "deal", *PLACE, "stretch", "alone"]


def sum_pieces(lines: DataFrame, *views: Column, in_order: bool = False) -> DataFrame:
    """One row per key and piece of classified lines, with the piece's ``other_log``.

    With ``views``, conditions on the lines, there is one for each view that has lines in the piece: the lines are
    shuffled and gathered once for all, and the column ``view`` has the number of the view, from 0.
    Parsed records that still have a ``reason`` may be among the lines. Those that are no line
    have no key; their pieces have them in ``malformed``. ``first_offset`` and ``last_offset`` tell what was read.
    With ``in_order`` the lines are sorted for all groups of a stretch at once, which pays where sorted groups are taken
    as they come (``staging.sorted_groups``); the pieces then have the columns of STRETCH.
    """
    kind, keyed = F.col("kind"), F.col("request_key").isNotNull()
    record = [F.lit(None).cast("string").alias(name) for name in ("value", "reason")]
    if "reason" in lines.columns:
        record = [F.col("value"), F.col("reason")]
    # Only what counts is shuffled; what the lines of a key have in common comes first, which compresses better.
    near = lines.select(
        *PLACE,
        *record,
        F.when(kind.isin(L.REQUEST_START, L.OTHER), F.col("thread_name")).alias("thread"),
        "offset",
        F.when(keyed, F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind).cast("byte")).alias("kind"),
        F.col("log_ts").alias("ts"),
        F.when(kind == L.OTHER, F.coalesce("content", F.lit("")))
        .when(keyed & ~kind.isin(L.REQUEST_END, L.RESPONSE_END), F.col("content")).alias("text"),
        *[F.coalesce(view, F.lit(False)).alias(f"in_{number}") for number, view in enumerate(views)],
    )
    # One number names the place of a row: rows that are dealt by it and the key stay where they are in all groups that
    # hold both, whatever the optimizer knows of the other columns.
    stretch, piece = F.shiftright("offset", 2 * PIECE_BITS), F.shiftright("offset", PIECE_BITS)
    deal = F.xxhash64("topic", "partition", stretch)
    near = near.repartition("request_key", deal).withColumns({"deal": deal, "stretch": stretch, "piece": piece})
    if in_order:
        alone = F.when(F.col("request_key").isNull(), F.col("piece"))
        # A topic known to be constant would leave the order, and sorted lines would not be seen to be sorted by the group.
        near = L.computed_once(near.withColumnRenamed("topic", "of"), "topic", F.col("of")).drop("of")
        near = near.withColumns({"sorted_by": F.xxhash64("request_key", "deal"), "alone": alone})
        return _sum_up(near.sortWithinPartitions(*STRETCH, "piece"), [*STRETCH, "piece"], len(views))
    return _sum_up(near, ["deal", *PLACE, "stretch", "piece"], len(views))


def sum_batch(lines: DataFrame, batch: int = 0) -> DataFrame:
    """All that a batch needs to know of its records, summed up in one pass: two shuffles, no table between them.

    One exchange row per request key, which carries its ``texts`` (as ``summarise`` gives them) and in ``ends`` the first
    and last offset of each stretch. Records that are no line have no key: they stay in rows of one piece each, told by
    ``unkeyed``, with the records in ``malformed``; so no row gathers all that is broken in a log.
    """
    pieces = sum_pieces(lines, in_order=True)
    end = F.struct("topic", "partition", F.col("first_offset").alias("first"), F.col("last_offset").alias("last"))
    bad = F.when(F.size("malformed") > 0, F.col("malformed"))
    pieces = _with_text_arrays(pieces, batch).withColumns({"ends": F.array(end), "malformed": bad})
    more = ("texts", "ends", "malformed")
    # They are in this order already; to say so again costs no sort, and lets Spark see that no sort is needed.
    stretches = _join_pieces(pieces.sortWithinPartitions(*STRETCH), STRETCH, ["piece"], *more)
    ends = F.col("ends")
    whole = F.struct("topic", "partition", F.array_min(ends["first"]).alias("first"), F.array_max(ends["last"]).alias("last"))
    unkeyed = F.when(F.col("request_key").isNull(), F.struct("topic", "partition", "alone"))
    stretches = stretches.withColumns({"ends": F.array(whole), "unkeyed": unkeyed})
    # Rows are dealt and sorted by key here, in place of being gathered on both sides of the shuffle.
    group = ["sorted_by", "request_key", "unkeyed"]
    dealt = stretches.repartition("request_key", "unkeyed").withColumn("sorted_by", F.xxhash64("request_key", "unkeyed"))
    rows = _join_pieces(dealt.sortWithinPartitions(*group), group, ["topic", "partition", "stretch"], *more)
    return rows.drop("sorted_by")


def exchanges_of(rows: DataFrame) -> Summed:
    """The exchanges among the rows of ``sum_batch``, which carry their texts, and the texts as rows."""
    exchanges = rows.filter(F.col("request_key").isNotNull()).select(*EXCHANGE.fieldNames(), "texts")
    return Summed(exchanges, text_rows(exchanges))


def malformed_of(rows: DataFrame) -> DataFrame:
    """The records among the rows of ``sum_batch`` that are no lines, each with the reason."""
    bad = rows.filter(F.col("unkeyed").isNotNull()).select("unkeyed", F.explode("malformed").alias("bad"))
    return bad.select("unkeyed.topic", "unkeyed.partition", "bad.*")


def places_of(rows: DataFrame) -> DataFrame:
    """First and last offset of each topic partition in the rows of ``sum_batch``, and how many of its records are no lines."""
    # Only rows without a key have malformed records, and they are of one piece.
    ends = rows.select(F.explode("ends").alias("end"), F.coalesce(F.array_size("malformed"), F.lit(0)).alias("bad"))
    return ends.groupBy(F.col("end.topic").alias("topic"), F.col("end.partition").alias("partition")).agg(
        F.min("end.first").alias("first"), F.max("end.last").alias("last"), F.sum("bad").alias("malformed")
    )


def _by_key(pieces: DataFrame, *more: str) -> DataFrame:
    view = [name for name in pieces.columns if name == "view"]
    stretches = _join_pieces(pieces, ["deal", *PLACE, "stretch", *view], ["piece"], *more)
    return _join_pieces(stretches, ["request_key", *view], ["topic", "partition", "stretch"], *more)


def _with_texts(pieces: DataFrame, batch: int = 0) -> DataFrame:
    """Exchange rows of pieces, with the texts of each in ``texts``."""
    return _by_key(_with_text_arrays(pieces.filter(F.col("request_key").isNotNull()), batch), "texts")


def _with_text_arrays(pieces: DataFrame, batch: int) -> DataFrame:
    """Pieces with their text in ``texts``, an array to be joined with others."""
    text = F.when(F.col("other_log").isNotNull(), F.array(_text()))
    return pieces.withColumn("batch", F.lit(batch).cast("long")).withColumn("texts", text)


def summarise(lines: DataFrame, batch: int = 0) -> Summed:
    """Exchange rows, one per request key, and text rows of classified lines.

    The exchange rows carry their texts in a column more, ``texts``, so that ``to_events`` need not look for them.
    """
    pieces = sum_pieces(lines)
    texts = pieces.filter(F.col("request_key").isNotNull() & F.col("other_log").isNotNull())
    texts = texts.withColumn("batch", F.lit(batch).cast("long"))
    return Summed(_with_texts(pieces, batch), texts.select(*TEXTS.fieldNames()))


def summarise_views(lines: DataFrame, *views: Column) -> DataFrame:
    """The exchange rows that ``summarise`` gives for the lines of each view, conditions on the lines; ``view`` numbers them.

    The lines are read, shuffled and gathered once, however many views there are.
    """
    return _with_texts(sum_pieces(lines, *views))


def _grouped(rows: DataFrame, group: list[str]) -> GroupedData:
    """``groupBy`` by these columns, with a hash of them in front.

    Spark gathers lists of many groups by sorting the rows by the columns of the group. The hash nearly always decides
    that from its first eight bytes; without it most rows are alike there (one ``deal``, keys of one prefix), and
    all columns are compared. Rows that are dealt by some of the columns stay where they are.
    """
    if group[0] == "sorted_by":
        return rows.groupBy(*group)
    return rows.withColumn("sorted_by", F.xxhash64(*group)).groupBy("sorted_by", *group)


def _sum_up(lines: DataFrame, group: list[str], views: int = 0) -> DataFrame:
    """One row per group of the lines of ``sum_pieces``; a group must be of bounded size.

    The lines of a group are gathered once, and what counts is looked up among them, last line first.
    """
    line = F.struct("offset", "kind", "ts", "text", "thread", *[f"in_{number}" for number in range(views)])
    bad = F.struct("offset", "value", "reason")
    total = _grouped(lines, group).agg(
        F.collect_list(F.when(F.col("kind").isNotNull(), line)).alias("lines"),
        F.collect_list(F.when(F.col("reason").isNotNull(), bad)).alias("malformed"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )
    names = [*group, "malformed", "first_offset", "last_offset"]
    total = total.select(*names, F.sort_array("lines", asc=False).alias("lines"))
    if views:
        seen = F.array(*[_seen(number) for number in range(views)])
        total = total.select(*names, F.inline(F.filter(seen, lambda view: F.size(view["lines"]) > 0)))
        names = [*names, "view"]
    found = {kind: F.nullif(_position(kind), F.lit(0)) for kind in KINDS}
    places = [place.cast("int").alias(f"at_{kind}") for kind, place in found.items()]
    total = total.select(*names, "lines", *places)

    def at(kind: str) -> Column:
        return F.get("lines", F.col(f"at_{kind}") - 1)

    def timed(kind: str) -> Column:
        return F.when(F.col(f"at_{kind}").isNotNull(), F.struct(at(kind)["ts"].alias("ts"), at(kind)["text"].alias("content")))

    def all_of(kind: str) -> Column:
        code = F.lit(KINDS.index(kind) + 1).cast("byte")
        found = F.reverse(F.filter("lines", lambda line: line["kind"] == code))
        return F.when(F.col(f"at_{kind}").isNotNull(), found)

    named = F.least(f"at_{L.REQUEST_START}", f"at_{L.OTHER}")
    return total.select(
        *names,
        F.get("lines", F.size("lines") - 1)["ts"].alias("first_ts"),
        timed(L.REQUEST_START).alias("start"),
        F.get("lines", named - 1)["thread"].alias("caller_thread"),
        *[at(header)["text"].alias(name) for name, header in HEADER_LINES.items()],
        at(L.REQUEST_END)["ts"].alias("request_end_ts"),
        timed(L.RESPONSE_START).alias("response"),
        at(L.RESPONSE_END)["ts"].alias("end_ts"),
        all_of(L.BODY).alias("bodies"),
        _joined_text(all_of(L.OTHER)).alias("other_log"),
    ).withColumn("bodies", chain_of(F.col("bodies")))


def _seen(view: int) -> Column:
    """A view with its lines among ``lines``."""
    return F.struct(F.lit(view).alias("view"), F.filter("lines", lambda line: line[f"in_{view}"]).alias("lines"))


def _position(kind: str) -> Column:
    """Place of the first line of a kind in ``lines``, from 1; 0 if there is none."""
    return F.array_position(F.col("lines")["kind"], F.lit(KINDS.index(kind) + 1).cast("byte"))


def _joined_text(texts: Column) -> Column:
    # concat_ws makes a text of the right size at once, where array_join lets it grow; transform would copy every part.
    joined = F.concat_ws(LOG_SEPARATOR, texts["text"])
    return F.when(F.size(texts) > 0, joined)


def _join_pieces(pieces: DataFrame, group: list[str], order: list[str], *more: str) -> DataFrame:
    """Joins exchange rows of one group, in the order of the piece columns ``order``.

    Most groups have one row, which is taken as it is. ``more`` names columns of arrays to put together.
    """
    names = [*order, "first_ts", *LAST_WINS, "bodies", *more]
    gathered = pieces.groupBy(*group).agg(F.collect_list(F.struct(*names)).alias("rows"))
    # The order comes first in a row, and no two rows of a group are equal in it.
    gathered = gathered.withColumn("rows", F.sort_array("rows"))
    rows, alone = F.col("rows"), F.size("rows") == 1

    def last(name: str) -> Column:
        known = F.array_compact(rows[name])
        return F.get(known, F.size(known) - 1)

    def all_of(name: str) -> Column:
        return F.flatten(F.array_compact(rows[name]))

    def one(name: str, several: Column) -> Column:
        return F.when(alone, F.get("rows", F.lit(0))[name]).otherwise(several).alias(name)

    return gathered.select(
        *group,
        one("first_ts", F.get("rows", F.lit(0))["first_ts"]),
        *[one(name, last(name)) for name in LAST_WINS],
        one("bodies", F.aggregate(F.array_compact(rows["bodies"]), no_chain(), join_chains)),
        *[one(name, all_of(name)) for name in more],
    )


def joined_logs(texts: DataFrame) -> DataFrame:
    """``request_key`` and ``other_log``, the whole text of each key in order.

    A text that no row can hold fails, with the key in the message; nothing is cut.
    """
    return _gathered(texts).select("request_key", _whole_log().alias("other_log"))


def text_rows(exchanges: DataFrame) -> DataFrame:
    """Rows of schema ``TEXTS`` from exchange rows that carry their ``texts``."""
    rows = exchanges.select("request_key", F.inline("texts"))
    return rows.withColumnRenamed("text", "other_log").select(*TEXTS.fieldNames())


def carrying(exchanges: DataFrame, texts: DataFrame) -> DataFrame:
    """Exchange rows with the text rows of their keys in ``texts``, added to those that they carry already."""
    if "texts" not in exchanges.columns:
        return exchanges.join(_gathered(texts), "request_key", "left")
    more = _gathered(texts).withColumnRenamed("texts", "more_texts")
    known = F.flatten(F.array_compact(F.array("texts", "more_texts")))
    return exchanges.join(more, "request_key", "left").withColumn("texts", known).drop("more_texts")


def _gathered(texts: DataFrame) -> DataFrame:
    return texts.groupBy("request_key").agg(F.collect_list(_text()).alias("texts"))


def _text() -> Column:
    return F.struct("batch", "topic", "partition", "piece", F.col("other_log").alias("text"))


def _log_bytes(texts: Column) -> Column:
    """Bytes of a log put together from ``texts``, a separator behind each counted."""
    return F.aggregate(
        texts,
        F.lit(0).cast("long"),
        lambda n, t: n + F.octet_length(t["text"]) + len(LOG_SEPARATOR),
    )


def _whole_log(texts: Column | None = None, tidy: bool = False) -> Column:
    """The text of ``texts``, an array of pieces in any order.

    A very long text needs some hundred megabytes in one stretch of the heap, several times. With ``tidy`` the heap is
    collected before, so that what is done with does not lie between; that is for few rows only.
    """
    texts = F.col("texts") if texts is None else texts
    message = F.concat(F.lit("the other log is too long for a row, request key "), "request_key")
    size = _log_bytes(texts)
    whole = F.when(size > MOST_LOG_BYTES, F.raise_error(message))
    if tidy:
        collected = F.reflect(F.lit("java.lang.System"), F.lit("gc")).isNotNull()
        whole = whole.when((size > TIDY_BYTES) & collected & (F.size(texts) == 0), None)
    return whole.otherwise(_joined_text(F.sort_array(texts)))


def join_exchanges(earlier: DataFrame, later: DataFrame, *keep: str) -> DataFrame:
    """All exchange rows of two sets, those of one key joined; ``later`` continues ``earlier``.

    Adds ``known`` (the key is in ``earlier``) and ``seen`` (it is in ``later``). This is a full
    join, written as a left join and the rest: as open exchanges are few, Spark can broadcast
    them and leave the later rows where they are, which it cannot do in a full join. Only keys
    are shuffled to find the rest. ``keep`` names columns of ``later`` to carry along; they are null in the rest.
    """
    a, b = earlier.alias("a"), later.alias("b")
    joined = b.join(a, F.col("a.request_key") == F.col("b.request_key"), "left")
    continued = joined.select(
        F.col("b.request_key"),
        F.coalesce("a.first_ts", "b.first_ts").alias("first_ts"),
        *[F.coalesce(f"b.{name}", f"a.{name}").alias(name) for name in LAST_WINS],
        join_chains(F.col("a.bodies"), F.col("b.bodies")).alias("bodies"),
        *[F.col(f"b.{name}") for name in keep],
        F.col("a.request_key").isNotNull().alias("known"),
        F.lit(True).alias("seen"),
    )
    rest = earlier.join(later.select("request_key"), "request_key", "left_anti").select(
        *EXCHANGE.fieldNames(),
        *[F.lit(None).cast(later.schema[name].dataType).alias(name) for name in keep],
        F.lit(True).alias("known"),
        F.lit(False).alias("seen"),
    )
    return continued.unionByName(rest)


def to_events(exchanges: DataFrame, texts: DataFrame | None, *keep: str) -> DataFrame:
    """Events of exchange rows and text rows; ``keep`` names further columns to carry along.

    Exchange rows that carry their ``texts`` (``summarise``) are not joined with the text rows.
    """
    if "texts" in exchanges.columns:
        return _to_events(exchanges.withColumn("other_log", _whole_log()), *keep)
    return _to_events(exchanges.join(joined_logs(texts), "request_key", "left"), *keep)


def _to_events(exchanges: DataFrame, *keep: str) -> DataFrame:
    """Events of exchange rows that have their ``other_log``."""
    start, response, bodies = F.col("start"), F.col("response"), F.col("bodies")
    request_end, thread = F.col("request_end_ts"), F.col("caller_thread")
    url = url_of(start["content"])
    columns = {
        "request_key": F.col("request_key"),
        "start_time": start["ts"],
        "event_time": F.coalesce(start["ts"], F.col("first_ts")),
        "method": method_of(start["content"]),
        "url": url,
        "server": server_of(url),
        "server_profile": server_profile_of(F.col("server_profile_line")),
        "event_id": header_value(F.col("event_id_line")),
        "event_type": header_value(F.col("event_type_line")),
        "event_code": header_value(F.col("event_code_line")),
        "event_platform": header_value(F.col("event_platform_line")),
        "event_sequence": header_value(F.col("event_sequence_line")),
        "request_body": request_body(bodies, request_end),
        "request_end_time": request_end,
        "response_body": response_body(bodies, request_end),
        "http_status": status_of(response["content"]),
        "duration_ms": F.coalesce(duration_of(response["content"]), F.lit(0)),
        "end_time": F.col("end_ts"),
        "other_log": F.col("other_log"),
        "client": client_of(thread),
        "client_profile": client_profile_of(thread),
        "response_start_time": response["ts"],
    }
    return exchanges.select(
        *[columns[name].alias(name) for name in EVENTS.fieldNames()], *keep
    )


def _log_apart(stretches: DataFrame) -> DataFrame:
    """Exchange rows of stretches that carry their ``texts``; where these are long, they are in rows of their own.

    ``of`` tells rows of text (LOG) apart; ``parts`` has what rows there are.
    """
    size = F.coalesce(_log_bytes(F.col("texts")), F.lit(0))
    pieces, cut = F.size("texts"), F.greatest(F.ceil(size / LONG_TEXT_BYTES).cast("int"), F.lit(1))
    # The cuts of a long text have as many pieces each, from a first one on; an event counts as the cut 0.
    step = F.greatest(F.floor(pieces / cut).cast("int"), F.lit(1))
    cuts = F.when(size >= LONG_TEXT_BYTES, F.concat(F.array(F.lit(0)), F.sequence(F.lit(1), pieces, step))).otherwise(F.array(F.lit(0)))
    rows = stretches.select("*", (size >= LONG_TEXT_BYTES).alias("long"), step.alias("step"), F.explode(cuts).alias("cut"))
    is_log = F.col("cut") > 0
    # A cut is one text, in the place of its first piece: many small ones would take more room than their text.
    taken = F.slice("texts", F.col("cut"), F.col("step"))
    first = F.get(taken, F.lit(0))
    text = F.struct(*[first[name].alias(name) for name in ("batch", "topic", "partition", "piece")], _joined_text(taken).alias("text"))
    part = F.when(is_log, F.lit(LOG)).when(F.col("long"), F.lit(WITHOUT_LOG)).otherwise(F.lit(WHOLE))
    known = ["first_ts", *LAST_WINS, "bodies"]
    return rows.select(
        "request_key",
        F.when(is_log, F.struct("topic", "partition", "stretch", "cut")).alias("of"),
        "topic",
        "partition",
        "stretch",
        *[F.when(~is_log, F.col(name)).alias(name) for name in known],
        F.when(is_log, F.array(text)).when(~F.col("long"), F.col("texts")).alias("texts"),
        F.array(part).alias("parts"),
    )


def _with_logs(rows: DataFrame) -> DataFrame:
    """Events of a table of events and of texts apart, as ``assemble`` writes it.

    The text of a log is held as few times as can be. It is gathered, joined and put into its row in one step of the plan,
    without being sorted with other rows, and shuffled once more as a whole row, so that what it was made of is gone where it
    is written. A writer that keeps the least and the greatest value of a column (Parquet) has two copies of the first one;
    so short rows are dealt with the long ones and come first.
    """
    names = [name for name in rows.columns if name not in ("part", "texts")]
    is_event = F.col("part") == WITHOUT_LOG
    event = [
        _whole_log(F.flatten(F.collect_list("texts")), tidy=True).alias(name)
        if name == "other_log"
        else F.first(F.when(is_event, F.col(name)), ignorenulls=True).alias(name)
        for name in names
        if name != "request_key"
    ]
    long = rows.filter(F.col("part") != WHOLE).groupBy("request_key").agg(*event).select(*names)
    # Another hash than Spark's own of the key, or it finds that the rows are dealt already.
    place = F.xxhash64("request_key")
    along, whole = F.pmod(place, F.lit(COMPANY)) == 0, F.col("part") == WHOLE
    dealt = rows.filter(whole & along).select(*names).union(long).repartition(LONG_LOG_TASKS, place)
    return rows.filter(whole & ~along).select(*names).union(dealt)


def assemble(
    lines: DataFrame, path: str | None = None, shown: Callable[[DataFrame], DataFrame] = lambda events: events
) -> DataFrame:
    """Events of classified lines, one row per request key; the lines are read once.

    With ``path`` the events are made now and put into a table there, with the texts of long logs beside them; what is returned
    reads that table. That takes more time and far less memory where a log has hundreds of megabytes. ``shown`` is what becomes of the
    columns of an event; done afterwards it would take copies of such a log. It must leave ``request_key`` and ``other_log``.
    """
    pieces = sum_pieces(lines)
    if path is None:
        return shown(_to_events(_with_texts(pieces).withColumn("other_log", _whole_log())))
    known = _with_text_arrays(pieces.filter(F.col("request_key").isNotNull()), 0)
    stretches = _join_pieces(known, ["deal", *PLACE, "stretch"], ["piece"], "texts")
    exchanges = _join_pieces(_log_apart(stretches), ["request_key", "of"], ["topic", "partition", "stretch"], "texts", "parts")
    whole = F.array_max("parts") == WHOLE
    exchanges = exchanges.withColumns({"part": F.array_max("parts"), "other_log": F.when(whole, _whole_log())})
    rows = shown(_to_events(exchanges, "part", F.when(~whole, F.col("texts")).alias("texts")))
    rows.write.parquet(path)
    return _with_logs(rows.sparkSession.read.schema(rows.schema).parquet(path))
