"""Cutting the payload out of the content of a log line.

Log text is untrusted: every function gives null for a part that is not there, and none of
them can fail a task under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a header value is stripped of every character up to and including the space.
HEADER_BLANKS = "".join(chr(code) for code in range(0x21))


def word(content: Column, index: int) -> Column:
    """Word ``index`` (0-based) of a text with words separated by single spaces."""
    return F.get(F.split(content, " ", index + 2), F.lit(index))


def method_of(request_line: Column) -> Column:
    return word(request_line, 1)


def url_of(request_line: Column) -> Column:
    return word(request_line, 2)


def server_of(url: Column) -> Column:
    """Host and port: what lies between ``//`` and the next ``/``; null without ``//``."""
    return F.substring_index(F.get(F.split(url, "//"), F.lit(1)), "/", 1)


def status_of(response_line: Column) -> Column:
    return word(response_line, 2)


def duration_of(response_line: Column) -> Column:
    """Milliseconds of a response line that ends in ``(47ms)``."""
    last = F.substring_index(response_line, " ", -1)
    return F.regexp_extract(last, "^[^m]([+-]?[0-9]+)m", 1).try_cast("int")


def header_value(header_line: Column) -> Column:
    """Text between the first and the second colon, stripped of blanks."""
    pieces = F.split(F.rtrim(header_line, F.lit(":")), ":", 3)
    return F.btrim(F.get(pieces, F.lit(1)), F.lit(HEADER_BLANKS))


def _behind_first_colon(text: Column) -> Column:
    behind = F.substring(text, F.instr(text, ":") + F.lit(1), F.length(text))
    return F.replace(behind, F.lit(":"), F.lit(""))


def server_profile_of(header_line: Column) -> Column:
    """Everything behind the first colon, further colons removed, blanks kept."""
    return _behind_first_colon(header_line)


def pool_name(thread: Column) -> Column:
    """Middle of a dashed thread name: without its first two pieces and its last one.

    Null if client and profile cannot be read from the name: without a colon behind its first
    character, or with nothing but colons in the middle.
    """
    pieces = F.split(F.rtrim(thread, F.lit("-")), "-")
    pool = F.array_join(
        F.slice(pieces, F.lit(3), F.greatest(F.size(pieces) - 3, F.lit(0))), "-"
    )
    return F.when((F.instr(thread, ":") > 1) & ~pool.rlike("^:+$"), pool)


def client_of(thread: Column, pool: Column | None = None) -> Column:
    """Calling client of a pool thread; other threads stand for themselves.

    ``pool`` is the ``pool_name`` of the thread, if that is at hand already.
    """
    pool = pool_name(thread) if pool is None else pool
    return F.coalesce(F.substring_index(pool, ":", 1), thread)


def client_profile_of(thread: Column, pool: Column | None = None) -> Column:
    """Profile and port of a pool thread, joined; empty for other threads."""
    pool = pool_name(thread) if pool is None else pool
    profile = F.when(F.instr(pool, ":") > 0, _behind_first_colon(pool))
    return F.coalesce(profile, F.when(thread.isNotNull(), ""))
