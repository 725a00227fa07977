"""The registered queries once more, as SQL for DuckDB over the same tables.

They say what the result is, not how Spark gets there: times and payloads are cut with regular
expressions, bodies are told apart by the request end, and batches are conditions on lines.
"""

from __future__ import annotations

from wireloom.plans.queries import (
    BACKLOG_BYTES,
    IMPORT_MS,
    MIDDLE_DAY,
    NOTE_KEYS,
    ODD_CONTENTS,
    PARTNER,
    SLICE_DAYS,
)
from wireloom.sources.admission import FINENESS

_OWN_KEY = "'req-' || event_id"
_SHARED_KEY = "CASE WHEN event_id % 3 = 0 THEN 'shared' ELSE 'req-' || event_id END"


def _records(key: str = _OWN_KEY) -> str:
    return f"""
rec AS (
  SELECT 'applog' AS topic, CAST(event_id % 3 AS INTEGER) AS part, event_id * 16 + j AS off,
    strftime(ts + to_milliseconds(d), '%Y-%m-%d %H:%M:%S,%g')
    || ' hystrix-grp-svc' || (user_id % 5) || ':dev:808' || (user_id % 3) || '-' || (event_id % 7)
    || ' ' || {key} || ' DEBUG c.f.Client ' ||
    CASE j
      WHEN 0 THEN '---> ' || CASE WHEN event_id % 4 = 0 THEN 'GET' ELSE 'POST' END
        || ' http://host-' || event_type || '/v2/' || user_id || ' HTTP/1.1'
      WHEN 1 THEN 'x-event-id: E' || event_id
      WHEN 2 THEN 'X-Event-Type: ' || event_type
      WHEN 3 THEN 'x-event-code: C' || (event_id % 5)
      WHEN 4 THEN 'x-event-platform: P' || (user_id % 3)
      WHEN 5 THEN 'X-Event-Sequence: ' || event_id
      WHEN 6 THEN props
      WHEN 7 THEN '---> END HTTP (10-byte body)'
      WHEN 8 THEN '<--- HTTP/1.1 ' || CASE WHEN event_type = 'error' THEN '500' ELSE '200' END
        || ' OK (' || CAST(floor("value") AS BIGINT) || 'ms)'
      WHEN 9 THEN 'x-application-context: svc:dev:8080'
      WHEN 10 THEN 'Accept: application/json'
      WHEN 11 THEN '{{"ok": ' || event_id || '}}'
      ELSE '<--- END HTTP (12-byte body)' END AS line
  FROM (SELECT *, CASE WHEN j < 8 THEN j ELSE j + CAST(floor("value") AS BIGINT) END AS d
        FROM (SELECT *, unnest(range(0, 13)) AS j FROM events))
  WHERE NOT (j = 12 AND event_id % 10 IN (3, 7))
    AND NOT (j = 0 AND event_id % 10 IN (5, 7))
    AND NOT (j = 6 AND event_id % 4 = 0)
)"""


_CUT = r"""
cut AS (
  SELECT topic, part, off, line,
    regexp_extract(line, '^([^ ]* [^ ]*) ', 1) AS stamp,
    regexp_extract(line, '^[^ ]* [^ ]* ([^ ]*) ', 1) AS thread_name,
    regexp_extract(line, '^[^ ]* [^ ]* [^ ]* ([^ ]*)', 1) AS request_key,
    regexp_extract(line, '^([^ ]* ){6}(.*)$', 2) AS content
  FROM rec
),
lines AS (
  SELECT topic, part, off, thread_name, request_key, content, part * 1000000000000 + off AS seq,
    epoch_ms(strptime(replace(stamp, ',', '.'), '%Y-%m-%d %H:%M:%S.%g')) - 28800000 AS log_ms,
    CASE WHEN regexp_matches(content, '^--->') AND
              NOT regexp_matches(content, '^---> (END|RETRYING)') THEN 'request_start'
      WHEN regexp_matches(content, '^(x-event-id|X-Event-Id).*:') THEN 'event_id'
      WHEN regexp_matches(content, '^(x-event-type|X-Event-Type).*:') THEN 'event_type'
      WHEN regexp_matches(content, '^(x-event-code|X-Event-Code).*:') THEN 'event_code'
      WHEN regexp_matches(content, '^(x-event-platform|X-Event-Platform).*:') THEN 'event_platform'
      WHEN regexp_matches(content, '^(x-event-sequence|X-Event-Sequence).*:') THEN 'event_sequence'
      WHEN regexp_matches(content, '\{|<xml>') THEN 'body'
      WHEN regexp_matches(content, '^---> END') THEN 'request_end'
      WHEN regexp_matches(content, '^(x-application-context|X-Application-Context).*:')
        THEN 'server_profile'
      WHEN regexp_matches(content, '^<--- END') THEN 'response_end'
      WHEN regexp_matches(content, '^<---') THEN 'response_start'
      ELSE 'other' END AS kind
  FROM cut
)"""

_PAYLOADS = r"""
payloads AS (
  SELECT *,
    CASE WHEN kind = 'request_start' THEN split_part(content, ' ', 2) END AS method,
    CASE WHEN kind = 'request_start' THEN split_part(content, ' ', 3) END AS url,
    CASE WHEN kind IN ('request_start', 'other')
      THEN regexp_extract(thread_name, '^[^-]*-[^-]*-([^:]*):', 1) END AS client,
    CASE WHEN kind IN ('request_start', 'other')
      THEN replace(regexp_extract(thread_name, '^[^:]*:(.*)-[^-]*$', 1), ':', '')
      END AS client_profile,
    CASE WHEN kind LIKE 'event_%' AND regexp_matches(content, ':.*[^:]')
      THEN trim(split_part(content, ':', 2)) END AS header_value,
    CASE WHEN kind = 'body' THEN content END AS body,
    CASE WHEN kind = 'response_start'
      THEN CAST(regexp_extract(content, '\(([0-9]+)ms\)$', 1) AS INTEGER) END AS duration_ms,
    CASE WHEN kind = 'response_start' THEN split_part(content, ' ', 3) END AS http_status,
    CASE WHEN kind = 'server_profile'
      THEN replace(regexp_extract(content, '^[^:]*:(.*)$', 1), ':', '') END AS server_profile,
    CASE WHEN kind = 'other' THEN content END AS other_log
  FROM lines
)"""

_HEADERS = ["event_id", "event_type", "event_code", "event_platform", "event_sequence"]


def _fold(name: str, where: str = "TRUE") -> str:
    """Events of the lines that satisfy a condition, bodies left out."""
    headers = ",\n    ".join(
        f"arg_max(header_value, seq) FILTER (kind = '{h}') AS {h}" for h in _HEADERS
    )
    return f"""
{name}_folded AS (
  SELECT request_key,
    arg_max(log_ms, seq) FILTER (kind = 'request_start') AS start_ms,
    arg_min(log_ms, seq) AS first_ms,
    arg_max(method, seq) AS method, arg_max(url, seq) AS url,
    arg_max(server_profile, seq) AS server_profile,
    {headers},
    arg_max(log_ms, seq) FILTER (kind = 'request_end') AS request_end_ms,
    arg_max(http_status, seq) AS http_status,
    CAST(coalesce(arg_max(duration_ms, seq), 0) AS INTEGER) AS duration_ms,
    arg_max(log_ms, seq) FILTER (kind = 'response_end') AS end_ms,
    string_agg(other_log, ' ; ' ORDER BY seq) AS other_log,
    arg_max(client, seq) AS client, arg_max(client_profile, seq) AS client_profile,
    arg_max(log_ms, seq) FILTER (kind = 'response_start') AS response_start_ms
  FROM payloads WHERE {where} GROUP BY request_key
)"""


def _events(name: str = "ev", where: str = "TRUE") -> str:
    """Events with one body at most on either side of the request end."""
    return (
        _fold(name, where)
        + f""",
{name}_bodies AS (
  SELECT p.request_key,
    max(p.body) FILTER (p.log_ms <= e.request_end_ms) AS request_body,
    max(p.body) FILTER (p.log_ms > e.request_end_ms OR e.request_end_ms IS NULL) AS response_body
  FROM payloads p JOIN {name}_folded e USING (request_key)
  WHERE p.kind = 'body' AND ({where}) GROUP BY p.request_key
),
{name} AS (
  SELECT e.* EXCLUDE (first_ms), coalesce(start_ms, first_ms) AS event_ms,
    nullif(regexp_extract(url, '//([^/]*)', 1), '') AS server, request_body, response_body
  FROM {name}_folded e LEFT JOIN {name}_bodies USING (request_key)
)"""
    )


def _chained_events() -> str:
    """Events of any number of bodies."""
    return (
        _fold("ev")
        + """,
runs AS (
  SELECT request_key, seq, log_ms, body,
    row_number() OVER w AS n, count(*) OVER (PARTITION BY request_key) AS n_all,
    log_ms < lag(log_ms) OVER w AS down, lead(log_ms) OVER w < log_ms AS next_down
  FROM payloads WHERE kind = 'body' WINDOW w AS (PARTITION BY request_key ORDER BY seq)
),
ends AS (
  SELECT request_key, max(n_all) AS n_all, arg_max(body, seq) AS last_body,
    arg_max(log_ms, seq) AS last_ms, bool_or(down) FILTER (n = n_all) AS last_down,
    arg_max(body, seq) FILTER (n < n_all AND (n = 1 OR down = next_down)) AS kept
  FROM runs GROUP BY request_key
),
ev AS (
  SELECT e.* EXCLUDE (first_ms), coalesce(start_ms, first_ms) AS event_ms,
    nullif(regexp_extract(url, '//([^/]*)', 1), '') AS server,
    CASE WHEN n_all = 1 THEN CASE WHEN last_ms <= request_end_ms THEN last_body END
      WHEN last_down THEN last_body ELSE kept END AS request_body,
    CASE WHEN n_all = 1 THEN CASE WHEN last_ms <= request_end_ms THEN NULL ELSE last_body END
      WHEN last_down THEN kept ELSE last_body END AS response_body
  FROM ev_folded e LEFT JOIN ends USING (request_key)
)"""
    )


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_LOG = (_records(), _CUT, _PAYLOADS)
_DAY = "strftime(make_timestamp(({ms} + 28800000) * 1000), '%Y-%m-%d')"
_REQUESTS = "off % 16 < 8"
_EARLY = f"{_DAY.format(ms='log_ms')} < '{MIDDLE_DAY}'"
_EVENT_DAY = _DAY.format(ms="event_ms")

_POINTS = "CAST(floor(greatest(c_acctbal, 0) * 2) AS BIGINT)"
_TIER = "CASE WHEN {p} >= 10000 THEN {p} * 10 ELSE {p} * 5 END"

_PARTNER_ROWS = f"""
partner AS (
  SELECT 'card' || c_custkey AS partner_member_card, c_name AS user_name,
    'm' || c_custkey AS partner_member_id, '138' || c_custkey AS mobile_phone,
    CASE WHEN c_custkey % 17 <> 0 THEN {_POINTS} + d END AS partner_point,
    'chg' || d AS partner_change, c_custkey * 2 + d AS seq, c_custkey
  FROM (SELECT *, unnest([0, 1]) AS d FROM customer)
  WHERE c_custkey % 3 <> 0 AND (d = 0 OR c_custkey % 25 = 1)
)"""


def _new_rows(member: str = "partner_member_id", where: str = "TRUE") -> str:
    return f"""
fresh AS (
  SELECT {member} AS id, '{PARTNER}' AS partner_code, CAST({IMPORT_MS} AS BIGINT) AS generation_ms,
    partner_member_card, user_name, {member} AS partner_member_id, mobile_phone,
    coalesce(partner_point, 0) AS partner_point,
    {_TIER.format(p="coalesce(partner_point, 0)")} AS point, partner_change,
    '' AS idcard_no, '' AS "unionId", CAST(0 AS BIGINT) AS convert_status, seq
  FROM partner WHERE {where}
)"""


def _old_rows(member: str = "'m' || c_custkey") -> str:
    return f"""
standing AS (
  SELECT 'm' || c_custkey AS id, 'old' AS partner_code,
    CAST(1577836800000 AS BIGINT) AS generation_ms,
    'ocard' || c_custkey AS partner_member_card, c_name AS user_name,
    {member} AS partner_member_id, '139' || c_custkey AS mobile_phone,
    {_POINTS} AS partner_point, {_POINTS} * 3 AS point, 'old' AS partner_change,
    'ID' || c_custkey AS idcard_no, 'U' || c_custkey AS "unionId",
    CAST(c_custkey % 4 AS BIGINT) AS convert_status, c_custkey AS seq
  FROM customer WHERE c_custkey % 2 = 0
)"""


_FIRST_ROWS = """
firsts AS (SELECT * FROM fresh QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) = 1)"""


def _merged(new: str = "fresh") -> str:
    return f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY partner_member_id ORDER BY src, seq) AS place
  FROM (SELECT *, 0 AS src FROM {new} UNION ALL SELECT *, 1 AS src FROM standing)
),
merged AS (
  SELECT CASE WHEN b.place IS NULL THEN a.id ELSE a.partner_member_id END AS id, a.partner_code,
    CASE WHEN b.place IS NULL THEN a.generation_ms ELSE {IMPORT_MS} END AS generation_ms,
    a.partner_member_card, a.user_name, a.partner_member_id, a.mobile_phone, a.partner_point,
    CASE WHEN b.place IS NULL THEN a.point ELSE {_TIER.format(p="a.partner_point")} END AS point,
    a.partner_change,
    CASE WHEN b.place IS NULL THEN a.idcard_no ELSE b.idcard_no END AS idcard_no,
    CASE WHEN b.place IS NULL THEN a."unionId" ELSE b."unionId" END AS "unionId",
    CASE WHEN b.place IS NULL THEN a.convert_status ELSE b.convert_status END AS convert_status,
    b.place IS NOT NULL AS merged
  FROM (SELECT * FROM ranked WHERE place = 1) a
  LEFT JOIN (SELECT * FROM ranked WHERE place = 2) b
    ON a.partner_member_id = b.partner_member_id
)"""


_SHARED_MEMBER = "CASE WHEN c_custkey % 3 = 1 THEN 'shared' ELSE 'm' || c_custkey END"


def oracle_sql() -> dict[str, str]:
    line_columns = (
        "log_ms, thread_name, request_key, content, topic, part AS \"partition\","
        ' off AS "offset"'
    )
    attached = (
        _with(
            *_LOG,
            _events("early", _REQUESTS),
            _events("late", f"NOT ({_REQUESTS})"),
            _events("whole"),
        )
        + f""",
attached AS (
  SELECT late.* FROM late JOIN early USING (request_key) WHERE early.start_ms IS NOT NULL
),
clock AS (SELECT min(event_ms) AS ms FROM attached),
outcome AS (
  SELECT *, 'fragment' AS status FROM attached
  UNION ALL BY NAME
  SELECT whole.*, CASE WHEN end_ms IS NOT NULL THEN 'complete' ELSE 'timeout' END AS status
  FROM whole, clock
  WHERE start_ms IS NOT NULL AND (end_ms IS NOT NULL OR (clock.ms - start_ms) // 60000 > 15)
)
SELECT *, {_EVENT_DAY} AS event_day FROM outcome"""
    )
    expired = (
        _with(
            *_LOG,
            _events("early", _EARLY),
            _events("late", f"NOT ({_EARLY})"),
            _events("whole"),
        )
        + f""",
open AS (SELECT request_key FROM early WHERE start_ms IS NOT NULL AND end_ms IS NULL),
clock AS (
  SELECT coalesce(
    (SELECT min(start_ms) FROM late WHERE end_ms IS NOT NULL),
    (SELECT min(event_ms) FROM late JOIN open USING (request_key) WHERE start_ms IS NULL)) AS ms
)
SELECT whole.*, 'timeout' AS status, {_EVENT_DAY} AS event_day
FROM whole JOIN open USING (request_key), clock
WHERE end_ms IS NULL AND (clock.ms - start_ms) // 60000 > 15"""
    )
    upserted = (
        _with(*_LOG, _events())
        + f" SELECT *, 'complete' AS status, {_EVENT_DAY} AS event_day FROM ev"
    )
    dropped = (
        _with(*_LOG, _events("early", _EARLY), _events("late", f"NOT ({_EARLY})"))
        + f""",
open AS (SELECT request_key FROM early WHERE start_ms IS NOT NULL AND end_ms IS NULL),
stray AS (
  SELECT * FROM early WHERE start_ms IS NULL
  UNION ALL BY NAME
  SELECT * FROM late WHERE start_ms IS NULL AND request_key NOT IN (SELECT request_key FROM open)
)
SELECT *, 'dropped' AS status, {_EVENT_DAY} AS event_day FROM stray"""
    )
    odd = " ".join(
        f"WHEN {number} THEN " + (f"' DEBUG c.f.Client {content}'" if content else "''")
        for number, content in enumerate(ODD_CONTENTS)
    )
    odd_records = f"""
odd AS (
  SELECT topic, part, off,
    regexp_extract(line, '^[^ ]* [^ ]* [^ ]* [^ ]*') || CASE off % 16 {odd} END AS line FROM rec
)"""
    malformed = """ SELECT topic, part AS "partition", off AS "offset",
  CASE WHEN off % 11 = 0 THEN left(line, 23) ELSE replace(line, ',', ';') END AS "value",
  CASE WHEN off % 11 = 0 THEN 'too few words' ELSE 'bad time' END AS reason
FROM rec WHERE off % 11 = 0 OR off % 13 = 0"""
    fragment_columns = """ SELECT request_key, kind, log_ms, topic, part AS "partition", off AS "offset",
  method, url, client, client_profile, header_value, body, duration_ms, http_status,
  server_profile, other_log FROM payloads"""
    first, second = SLICE_DAYS
    in_batches = (
        _with(*_LOG, _events())
        + f""",
places AS (
  SELECT request_key, left(line, 10) AS day FROM rec JOIN lines USING (topic, part, off)
),
spans AS (
  SELECT request_key, min((day >= '{first}')::INT + (day >= '{second}')::INT) AS opened,
    max((day >= '{first}')::INT + (day >= '{second}')::INT) AS closed
  FROM places GROUP BY request_key
),
clocks AS (
  SELECT closed AS slice, min(start_ms) AS ms FROM ev JOIN spans USING (request_key)
  WHERE end_ms IS NOT NULL AND opened = closed GROUP BY closed
)
SELECT ev.*, CASE WHEN end_ms IS NULL THEN 'timeout' ELSE 'complete' END AS status,
  {_EVENT_DAY} AS event_day
FROM ev JOIN spans USING (request_key)
WHERE start_ms IS NOT NULL AND (end_ms IS NOT NULL OR EXISTS (
  FROM clocks WHERE slice > opened AND (clocks.ms - start_ms) // 60000 > 15))"""
    )
    imported = _with(
        _PARTNER_ROWS,
        _new_rows(where="c_custkey % 29 <> 0 AND c_custkey % 31 <> 0"),
        _old_rows(),
        _merged(),
    )
    return {
        "log_lines": _with(_records(), _CUT) + f" SELECT {line_columns} FROM lines",
        "malformed_lines": _with(_records()) + malformed,
        "batch_malformed": _with(_records()) + malformed,
        "folded_malformed": _with(_records()) + malformed,
        "backlog_ranges": _with(_records())
        + f""",
sized AS (SELECT topic, (part = 0)::INT AS p, off, strlen(line) + 1 AS b FROM rec),
spans AS (SELECT topic, p, min(off) AS low, max(off) AS high, sum(b)::BIGINT AS held FROM sized GROUP BY topic, p),
n AS (SELECT (sum(held)::BIGINT + {BACKLOG_BYTES - 1}) // {BACKLOG_BYTES} AS n FROM spans),
wide AS (SELECT spans.*, n, (high - low + {FINENESS} * n) // ({FINENESS} * n) AS width FROM spans, n),
stretches AS (
  SELECT topic, p, (off - low) // width AS s, sum(b)::BIGINT AS b, count(*) AS c, any_value(low) AS low,
    any_value(high) AS high, any_value(held) AS held, any_value(width) AS width, any_value(n) AS n
  FROM sized JOIN wide USING (topic, p) GROUP BY ALL
),
cut AS (
  SELECT *, ((2 * sum(b) OVER (PARTITION BY topic, p ORDER BY s) - b) * n // (2 * held))::BIGINT AS batch FROM stretches
)
SELECT topic, p AS "partition", batch, min(low + s * width)::BIGINT AS from_offset,
  least(max(low + (s + 1) * width), max(high) + 1)::BIGINT AS until_offset, sum(b)::BIGINT AS bytes,
  sum(c)::BIGINT AS n_records
FROM cut GROUP BY topic, p, batch""",
        "thread_client": _with(_records(), _CUT)
        + r""", names AS (
  SELECT DISTINCT CASE part WHEN 0 THEN thread_name WHEN 1 THEN replace(thread_name, ':', '-')
    ELSE replace(thread_name, '-svc', '-x-svc') END AS thread_name FROM lines
)
SELECT thread_name,
  CASE WHEN contains(thread_name, ':')
    THEN regexp_extract(thread_name, '^[^-]*-[^-]*-([^:]*):', 1) ELSE thread_name END AS client,
  CASE WHEN contains(thread_name, ':')
    THEN replace(regexp_extract(thread_name, '^[^:]*:(.*)-[^-]*$', 1), ':', '')
    ELSE '' END AS client_profile
FROM names""",
        "fragments": _with(*_LOG) + fragment_columns,
        "odd_fragments": _with(
            _records(), odd_records, _CUT.replace("FROM rec", "FROM odd"), _PAYLOADS
        )
        + fragment_columns,
        "fragment_counts": _with(_records(), _CUT)
        + " SELECT kind, count(*) AS n FROM lines GROUP BY kind",
        "request_start_server": _with(*_LOG)
        + """ SELECT request_key, method, url, regexp_extract(url, '//([^/]*)', 1) AS server
FROM payloads WHERE kind = 'request_start'""",
        "assembled_events": _with(*_LOG, _events()) + " SELECT * FROM ev",
        "assembled_shared_keys": _with(
            _records(_SHARED_KEY), _CUT, _PAYLOADS, _chained_events()
        )
        + " SELECT * FROM ev",
        "event_bodies": _with(*_LOG, _events())
        + " SELECT request_key, request_body, response_body FROM ev",
        "completeness": _with(*_LOG, _events())
        + """ SELECT request_key,
  CASE WHEN start_ms IS NULL THEN CASE WHEN end_ms IS NULL THEN 'neither' ELSE 'end_only' END
    WHEN end_ms IS NULL THEN 'open' ELSE 'complete' END AS completeness FROM ev""",
        "events_by_start": _with(*_LOG, _events())
        + """ SELECT request_key, row_number() OVER (ORDER BY start_ms, request_key) AS place, start_ms, (start_ms - (
    SELECT min(start_ms) FROM ev WHERE end_ms IS NOT NULL)) // 60000 AS minutes
FROM ev WHERE start_ms IS NOT NULL ORDER BY start_ms, request_key""",
        "daily_events": _with(*_LOG, _events())
        + f""" SELECT {_EVENT_DAY} AS event_day, count(*) AS n_events,
  count(*) FILTER (start_ms IS NOT NULL AND end_ms IS NOT NULL) AS n_complete,
  min(event_ms) AS first_ms, max(event_ms) AS last_ms FROM ev GROUP BY 1""",
        "attached_fragments": attached,
        "expired_events": expired,
        "upserted_events": upserted,
        "upserted_days": upserted,
        "compacted_events": upserted,
        "dropped_fragments": dropped,
        "long_logs": f"""SELECT 'user-' || (user_id % {NOTE_KEYS}) AS request_key, 'complete' AS status,
  string_agg('note ' || event_id, ' ; ' ORDER BY event_id % 3, event_id) AS other_log
FROM events GROUP BY 1""",
        "last_written_events": _with(*_LOG, _events())
        + f""" SELECT request_key, {_EVENT_DAY} AS event_day, 'complete' AS status,
  CAST(1 AS BIGINT) AS batch_id FROM ev""",
        "streamed_events": in_batches,
        "streamed_batches": in_batches,
        "resumed_events": _with(*_LOG, _events())
        + f""",
clock AS (
  SELECT min(log_ms) AS ms FROM lines JOIN ev USING (request_key) WHERE start_ms IS NOT NULL AND lines.off % 16 >= 8
)
SELECT ev.*, CASE WHEN end_ms IS NULL THEN 'timeout' ELSE 'complete' END AS status, {_EVENT_DAY} AS event_day, 1::BIGINT AS n_writes
FROM ev, clock WHERE start_ms IS NOT NULL AND (end_ms IS NOT NULL OR (clock.ms - start_ms) // 60000 > 15)""",
        "member_rows": _with(_PARTNER_ROWS, _new_rows()) + " SELECT * FROM fresh",
        "member_points": _with(_PARTNER_ROWS)
        + f""" SELECT partner_member_card, seq, partner_point,
  {_TIER.format(p="coalesce(partner_point, 0)")} AS point FROM partner""",
        "member_merge": _with(_PARTNER_ROWS, _new_rows(), _old_rows(), _merged())
        + " SELECT * FROM merged",
        "member_merge_first_rows": _with(
            _PARTNER_ROWS, _new_rows(), _FIRST_ROWS, _old_rows(), _merged("firsts")
        )
        + " SELECT * FROM merged",
        "member_merge_shared_id": _with(
            _PARTNER_ROWS, _new_rows(_SHARED_MEMBER), _old_rows(_SHARED_MEMBER), _merged()
        )
        + " SELECT * FROM merged",
        "member_rejects": _with(_PARTNER_ROWS)
        + """ SELECT partner_member_card, partner_change,
  CASE WHEN c_custkey % 31 = 0 THEN 'does not fit the schema' ELSE 'no member id' END AS reason
FROM partner WHERE c_custkey % 29 = 0 OR c_custkey % 31 = 0""",
        "member_import": imported + " SELECT * EXCLUDE (merged) FROM merged",
        "member_import_versions": imported + " SELECT * EXCLUDE (merged) FROM merged",
        # All members of the files are in the table at the second import, so each of them is merged again.
        "import_history": imported
        + """, counts AS (
  SELECT (SELECT count(*) FROM partner) AS rows_read,
    (SELECT count(*) FROM partner WHERE c_custkey % 29 = 0 OR c_custkey % 31 = 0) AS rows_rejected,
    (SELECT count(*) FROM standing) AS old_1, (SELECT count(*) FROM merged) AS written,
    (SELECT count(*) FROM merged WHERE merged) AS merged_1,
    (SELECT count(DISTINCT partner_member_id) FROM fresh) AS merged_2
)
SELECT 'P1' AS partner_code, n AS table_version, rows_read, rows_rejected,
  CASE n WHEN 2 THEN old_1 ELSE written END AS old_rows, written AS rows_written,
  CASE n WHEN 2 THEN merged_1 ELSE merged_2 END AS rows_merged
FROM counts, (VALUES (2::BIGINT), (3::BIGINT)) AS imports(n)""",
    }
