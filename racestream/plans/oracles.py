"""The same results in DuckDB SQL, computed from ``events`` without any of the Spark code."""

from __future__ import annotations

from racestream.plans import defects

_EVENTS = """
ev AS (SELECT event_id, event_type, value, CAST(user_id % 20 + 1 AS INT) AS driver_number,
  CAST(json_extract_string(props, '$.k') AS INT) AS k,
  TIMESTAMP '2023-05-28 13:00:00' + to_milliseconds(CAST(floor(
    (epoch_ms(ts) - epoch_ms((SELECT min(ts) FROM events))) / 1000.0) AS BIGINT)) AS t
  FROM events),
dated AS (SELECT *, strftime(t, '%Y-%m-%dT%H:%M:%S.%g+00:00') AS date FROM ev)"""

_POSITIONS = """
positions AS (SELECT event_id AS seq, 9161 AS session_key, driver_number, k % 20 + 1 AS position, t, date
  FROM dated WHERE event_type IN ('click', 'signup'))"""

_LAPS = """
laps AS (SELECT event_id AS seq, 9161 AS session_key, driver_number, k % 78 + 1 AS lap_number,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS lap_duration, t, date AS date_start,
  event_id % 10 = 0 AS is_pit_out_lap FROM dated WHERE event_type = 'view')"""

_PITS = """
pits AS (SELECT event_id AS seq, 9161 AS session_key, driver_number, k % 78 + 1 AS lap_number,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS pit_duration, t, date
  FROM dated WHERE event_type = 'purchase')"""

_RACE_CONTROL = """
race_control AS (SELECT event_id AS seq, 9161 AS session_key,
  CASE k % 12 WHEN 0 THEN 'RED FLAG' WHEN 1 THEN 'SAFETY CAR DEPLOYED' WHEN 2 THEN 'Virtual Safety Car ending'
    WHEN 3 THEN 'DRS DISABLED' WHEN 4 THEN 'DRS ENABLED' WHEN 5 THEN NULL ELSE 'INCIDENT NOTED' END AS message,
  CASE k % 3 WHEN 0 THEN 'Flag' WHEN 1 THEN 'SafetyCar' ELSE 'Other' END AS category,
  CASE k % 11 WHEN 0 THEN 'GREEN' WHEN 1 THEN 'yellow' WHEN 2 THEN 'DOUBLE YELLOW' WHEN 3 THEN 'RED'
    WHEN 4 THEN 'CHEQUERED' WHEN 5 THEN 'BLUE' WHEN 6 THEN 'CLEAR' ELSE NULL END AS flag,
  t, date, CASE WHEN k % 2 = 0 THEN driver_number END AS driver_number
  FROM dated WHERE event_type = 'error')"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join((_EVENTS, *ctes)) + "\n"


def _sessions(cte: str) -> str:
    return cte.replace("9161 AS session_key", "CAST(9161 + event_id % 3 AS INT) AS session_key")


# Leaderboard

_LAST = """
l AS (SELECT time_bucket(INTERVAL 10 SECOND, t) AS w, driver_number, max(seq) AS s, max_by(position, seq) AS p
  FROM positions GROUP BY 1, 2),
ranked AS (SELECT w, p, max_by(driver_number, s) AS d FROM l GROUP BY 1, 2),
snapshots AS (SELECT w AS window_start, w + INTERVAL 10 SECOND AS window_end,
  '{"type":"leaderboard","rankings":{' || string_agg('"' || p || '":' || d, ',' ORDER BY p) || '}}' AS value
  FROM ranked GROUP BY w)"""

_BY_SESSION = """
SELECT w AS window_start, session_key, p AS position, max_by(driver_number, s) AS driver_number
FROM (SELECT time_bucket(INTERVAL 10 SECOND, t) AS w, session_key, driver_number, max(seq) AS s,
  max_by(position, seq) AS p FROM positions GROUP BY 1, 2, 3) GROUP BY 1, 2, 3"""

# Lap enrichment

_LAP_COLUMNS = "laps.seq, laps.session_key, laps.driver_number, laps.lap_number, lap_duration, date_start, is_pit_out_lap"


def _arrival(keys: str) -> str:
    return f""",
u AS (SELECT seq, {keys}, t, 0 AS is_pit FROM laps UNION ALL SELECT seq, {keys}, t, 1 FROM pits),
x AS (SELECT *, last_value(CASE WHEN is_pit = 1 THEN seq END IGNORE NULLS) OVER (
  PARTITION BY {keys} ORDER BY t, is_pit, seq ROWS UNBOUNDED PRECEDING) AS ps FROM u)
SELECT {_LAP_COLUMNS}, p.pit_duration, p.pit_duration IS NOT NULL AS had_pit_stop
FROM laps JOIN x ON x.seq = laps.seq AND x.is_pit = 0 LEFT JOIN pits p ON p.seq = x.ps"""


def _complete(keys: str) -> str:
    return f""",
p AS (SELECT {keys}, max_by(struct_pack(d := pit_duration), seq) AS m FROM pits GROUP BY ALL)
SELECT {_LAP_COLUMNS}, m.d AS pit_duration, m.d IS NOT NULL AS had_pit_stop FROM laps LEFT JOIN p USING ({keys})"""


# Of each lap the latest pit stop from its start to ten minutes later; all laps, as the stream gives out the last ones at its end.
_COMPLETE_STREAM = f""",
p AS (SELECT laps.seq, max_by(struct_pack(d := pit_duration), struct_pack(t := pits.t, s := pits.seq)) AS m
  FROM laps JOIN pits USING (driver_number, lap_number)
  WHERE pits.t >= laps.t AND pits.t <= laps.t + INTERVAL 10 MINUTE GROUP BY 1)
SELECT {_LAP_COLUMNS}, m.d AS pit_duration, m.d IS NOT NULL AS had_pit_stop FROM laps LEFT JOIN p USING (seq)"""

# Delayed records: micro-batches by arrival, the watermark of each (five seconds behind the newest record of earlier batches), and what
# the leaderboard drops and holds. The epoch stands for no watermark.

_ARRIVING = """
arriving AS (SELECT *, t + to_milliseconds(CASE event_id % 9 WHEN 4 THEN 600000 WHEN 7 THEN 1100000 ELSE 0 END) AS i FROM ev),
bucketed AS (SELECT *, CAST(floor((epoch_ms(i) - epoch_ms(TIMESTAMP '2023-05-28 13:00:00')) / 500000.0) AS BIGINT) AS bucket FROM arriving),
batched AS (SELECT *, dense_rank() OVER (ORDER BY bucket) - 1 AS b FROM bucketed),
sizes AS (SELECT b, count(*) AS input_rows FROM batched GROUP BY b)"""

_DELAYED_POSITIONS = f"""{_ARRIVING},
positions AS (SELECT b, event_id AS seq, t, driver_number, k % 20 + 1 AS position, time_bucket(INTERVAL 10 SECOND, t) AS w
  FROM batched WHERE event_type IN ('click', 'signup')),
marks AS (SELECT s.b, input_rows, coalesce(max(t) - INTERVAL 5 SECOND, TIMESTAMP '1970-01-01') AS mark
  FROM sizes s LEFT JOIN positions p ON p.b < s.b GROUP BY ALL),
judged AS (SELECT p.*, w + INTERVAL 10 SECOND <= coalesce(m.mark, TIMESTAMP '1970-01-01') AS late
  FROM positions p LEFT JOIN marks m ON m.b = p.b - 1),
late AS (SELECT b, count(*) AS late_records, count(DISTINCT (w, driver_number)) AS late_groups FROM judged WHERE late GROUP BY b),
held AS (SELECT m.b, count(DISTINCT (w, driver_number)) AS open_groups
  FROM marks m JOIN judged j ON j.b <= m.b AND NOT late AND w + INTERVAL 10 SECOND > m.mark GROUP BY m.b)"""

_LATE_BY_BATCH = """
SELECT b AS batch_id, input_rows, coalesce(late_records, 0) AS late_records, coalesce(late_groups, 0) AS late_groups,
  coalesce(late_groups, 0) AS dropped_groups, coalesce(open_groups, 0) AS open_groups
FROM marks LEFT JOIN late USING (b) LEFT JOIN held USING (b)"""

_OPEN_WINDOWS = """
SELECT w AS window_start, driver_number, max_by(position, seq) AS position FROM judged
WHERE NOT late AND w + INTERVAL 10 SECOND > (SELECT max(t) FROM positions) - INTERVAL 5 SECOND GROUP BY 1, 2"""

# A lap sees the latest pit stop of its micro-batch that is older by event time, or else that of the newest batch before, unless it came
# more than five minutes before the watermark of ingest time: five seconds behind the newest of the slower input in earlier batches.
_BY_INGEST_TIME = f"""{_ARRIVING},
laps AS (SELECT b, event_id AS seq, 9161 AS session_key, driver_number, k % 78 + 1 AS lap_number,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS lap_duration, t, i,
  strftime(t, '%Y-%m-%dT%H:%M:%S.%g+00:00') AS date_start, event_id % 10 = 0 AS is_pit_out_lap FROM batched WHERE event_type = 'view'),
pits AS (SELECT b, event_id AS seq, driver_number, k % 78 + 1 AS lap_number,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS pit_duration, t, i FROM batched WHERE event_type = 'purchase'),
newest AS (SELECT b, (SELECT max(i) FROM laps l WHERE l.b < s.b) AS lap, (SELECT max(i) FROM pits p WHERE p.b < s.b) AS pit FROM sizes s),
marks AS (SELECT b, CASE WHEN lap IS NULL OR pit IS NULL THEN TIMESTAMP '1970-01-01' ELSE least(lap, pit) - INTERVAL 5 SECOND END AS mark
  FROM newest),
latest AS (SELECT b, driver_number, lap_number, max_by(struct_pack(d := pit_duration, i := i), struct_pack(t := t, s := seq)) AS m
  FROM pits GROUP BY ALL),
now AS (SELECT l.seq, max_by(struct_pack(d := pit_duration), struct_pack(t := p.t, s := p.seq)) AS m
  FROM laps l JOIN pits p USING (b, driver_number, lap_number) WHERE p.t < l.t GROUP BY 1),
before AS (SELECT l.seq, l.b, max_by(p.m, p.b) AS m FROM laps l JOIN latest p USING (driver_number, lap_number) WHERE p.b < l.b GROUP BY ALL),
seen AS (SELECT l.seq, CASE WHEN now.m IS NOT NULL THEN now.m.d WHEN before.m.i >= mark - INTERVAL 5 MINUTE THEN before.m.d END AS d
  FROM laps l JOIN marks USING (b) LEFT JOIN now USING (seq) LEFT JOIN before USING (seq))
SELECT {_LAP_COLUMNS}, d AS pit_duration, d IS NOT NULL AS had_pit_stop FROM laps JOIN seen USING (seq)"""

# Alerts

_SEVERITY = """,
c AS (SELECT *, CASE WHEN contains(f, 'RED') OR contains(m, 'RED FLAG') THEN 'CRITICAL'
  WHEN contains(f, 'SAFETY CAR') OR contains(m, 'SAFETY CAR') THEN 'HIGH'
  WHEN contains(f, 'YELLOW') THEN 'MEDIUM' WHEN contains(m, 'DRS DISABLED') THEN 'LOW' END AS severity
  FROM (SELECT *, upper(coalesce(flag, '')) AS f, upper(coalesce(message, '')) AS m FROM race_control))
"""

_WHOLE_WORDS = r""",
c AS (SELECT *, CASE
  WHEN regexp_matches(f, '\bRED\b') OR regexp_matches(m, '\bRED FLAG\b') THEN 'CRITICAL'
  WHEN regexp_matches(f, '\bSAFETY CAR\b') OR regexp_matches(m, '\bSAFETY CAR\b') THEN 'HIGH'
  WHEN regexp_matches(f, '\bYELLOW\b') THEN 'MEDIUM' WHEN regexp_matches(m, '\bDRS DISABLED\b') THEN 'LOW'
  END AS severity
  FROM (SELECT *, upper(coalesce(flag, '')) AS f, upper(coalesce(message, '')) AS m FROM race_control))
"""

_ALERTS = """SELECT seq, 'race_alert' AS type, severity, flag, category, message, date, driver_number, session_key
FROM c WHERE severity IS NOT NULL"""

_ALERTS_JSON = """SELECT seq, '{"type":"race_alert","severity":"' || severity || '"'
  || ',"flag":' || coalesce('"' || flag || '"', 'null')
  || ',"category":"' || category || '"'
  || ',"message":' || coalesce('"' || message || '"', 'null')
  || ',"date":"' || date || '"'
  || ',"driver_number":' || coalesce(CAST(driver_number AS VARCHAR), 'null')
  || ',"session_key":' || session_key || '}' AS value
FROM c WHERE severity IS NOT NULL"""

# Decoding: what each kind of document must become.

_DECODE_POSITIONS = """
SELECT seq, CASE WHEN n = 10 THEN 0 ELSE session_key END AS session_key,
  CASE WHEN n IN (2, 3, 4) THEN 0 ELSE driver_number END AS driver_number, position,
  CASE WHEN n = 10 THEN NULL ELSE date END AS date
FROM (SELECT *, seq % 16 AS n FROM positions) WHERE n NOT IN (5, 6, 7, 8, 9, 14)"""

_MALFORMED_POSITIONS = """
SELECT seq, CASE n
  WHEN 5 THEN '{' || s || 'true' || p || '}'
  WHEN 6 THEN '{' || s || '3000000000' || p || '}'
  WHEN 7 THEN '{"session_key":' || session_key || ','
  WHEN 8 THEN ''
  WHEN 9 THEN '[{' || s || driver_number || p || '}]' END AS value
FROM (SELECT *, seq % 16 AS n, '"session_key":' || session_key || ',"driver_number":' AS s,
  ',"position":' || position || ',"date":"' || date || '"' AS p FROM positions) WHERE n IN (5, 6, 7, 8, 9, 14)"""

_DECODE_LAPS = """
SELECT seq, session_key, driver_number, lap_number,
  CASE n WHEN 1 THEN NULL WHEN 12 THEN 90.0 WHEN 13 THEN 90.5 ELSE lap_duration END::DOUBLE AS lap_duration, date_start,
  CASE WHEN n IN (2, 4) THEN true WHEN n IN (3, 5, 6, 7) THEN false ELSE is_pit_out_lap END AS is_pit_out_lap
FROM (SELECT *, seq % 16 AS n FROM laps) WHERE n NOT IN (8, 9, 10, 11)"""

_DECODE_RACE_CONTROL = """
SELECT seq, CASE WHEN n = 7 THEN 0 ELSE session_key END AS session_key,
  CASE n WHEN 0 THEN 'DRS DISABLED' WHEN 1 THEN '5' WHEN 2 THEN 'true' WHEN 3 THEN NULL WHEN 7 THEN NULL
    ELSE message END AS message,
  CASE WHEN n <= 7 THEN NULL ELSE category END AS category, CASE WHEN n <= 7 THEN NULL ELSE flag END AS flag,
  CASE WHEN n <= 7 THEN NULL ELSE date END AS date,
  CASE WHEN n IN (0, 3) THEN 44 WHEN n IN (1, 2, 7) THEN NULL ELSE driver_number END AS driver_number
FROM (SELECT *, seq % 12 AS n FROM race_control) WHERE n NOT IN (4, 5, 6)"""

def _decode_matrix() -> str:
    intact = {"lap_number": "7", "lap_duration": "80.5", "date_start": "'d'", "is_pit_out_lap": "true"}
    rows = []
    for name, cases in defects.MATRIX.items():
        for _, value, malformed in cases:
            rows.append({name: "NULL" for name in intact} if malformed else {**intact, name: value})
    for _, malformed in defects.WHOLE:
        whole = {"lap_number": "1", "lap_duration": "NULL", "date_start": "NULL", "is_pit_out_lap": "false"}
        rows.append({name: "NULL" for name in intact} if malformed else whole)
    bad = [m for cases in defects.MATRIX.values() for *_, m in cases] + [m for _, m in defects.WHOLE]
    types = {"lap_number": "INT", "lap_duration": "DOUBLE", "date_start": "VARCHAR", "is_pit_out_lap": "BOOLEAN"}
    values = ", ".join(
        f"({i}, {str(bad[i]).lower()}, {', '.join(f'CAST({row[c]} AS {kind})' for c, kind in types.items())})" for i, row in enumerate(rows)
    )
    return f""",
m(n, malformed, {", ".join(types)}) AS (VALUES {values})
SELECT seq, malformed, {", ".join(f"m.{c} AS {c}" for c in types)} FROM laps JOIN m ON m.n = seq % {len(rows)}"""


# The last positions of those drivers and records that the parts hold, of the windows that the last part touches.
_CHANGED = """,
held AS (SELECT *, time_bucket(INTERVAL 10 SECOND, t) AS w FROM positions WHERE driver_number <= 12 OR seq % 40 < 20 OR seq % 40 = 39),
l AS (SELECT w, driver_number, max(seq) AS s, max_by(position, seq) AS p FROM held
  WHERE w IN (SELECT w FROM held WHERE seq % 40 = 39) GROUP BY 1, 2)
SELECT w AS window_start, p AS position, max_by(driver_number, s) AS driver_number FROM l GROUP BY 1, 2"""

_EVENT_TIME = """,
o AS (SELECT seq, t, CASE seq % 16 WHEN 0 THEN t WHEN 1 THEN t WHEN 2 THEN date_trunc('second', t)
  WHEN 3 THEN date_trunc('minute', t) WHEN 4 THEN t - INTERVAL 2 HOUR WHEN 5 THEN t + INTERVAL 5 HOUR
  WHEN 6 THEN date_trunc('minute', t) - INTERVAL 330 MINUTE END AS parsed FROM positions)
SELECT seq, coalesce(parsed, t) AS ingest, coalesce(parsed, TIMESTAMP '1970-01-01 00:00:00') AS epoch,
  parsed IS NULL AS unusable FROM o"""

# Replay

_MERGED = """,
merged AS (SELECT t AS time, 0 AS source_rank, seq, 'f1.positions' AS topic, CAST(driver_number AS VARCHAR) AS key FROM positions
  UNION ALL SELECT t, 1, seq, 'f1.laps', CAST(driver_number AS VARCHAR) FROM laps
  UNION ALL SELECT t, 2, seq, 'f1.pit_stops', CAST(driver_number AS VARCHAR) FROM pits
  UNION ALL SELECT t, 3, seq, 'f1.race_control', 'rc' FROM race_control)"""

_MESSAGES = """
SELECT seq, 'f1.positions' AS topic, CAST(driver_number AS VARCHAR) AS key,
  '{"session_key":' || session_key || ',"driver_number":' || driver_number || ',"position":' || position
    || ',"date":"' || date || '"}' AS value,
  session_key, driver_number, position, NULL::INT AS lap_number, NULL::DOUBLE AS lap_duration, NULL::DOUBLE AS pit_duration,
  date, NULL::VARCHAR AS date_start, NULL::BOOLEAN AS is_pit_out_lap, NULL::VARCHAR AS message, NULL::VARCHAR AS category,
  NULL::VARCHAR AS flag FROM positions
UNION ALL SELECT seq, 'f1.race_control', 'rc', '{"session_key":' || session_key
  || ',"message":' || coalesce('"' || message || '"', 'null') || ',"category":"' || category || '"'
  || ',"flag":' || coalesce('"' || flag || '"', 'null') || ',"date":"' || date || '"'
  || ',"driver_number":' || coalesce(CAST(driver_number AS VARCHAR), 'null') || '}',
  session_key, driver_number, NULL, NULL, NULL, NULL, date, NULL, NULL, message, category, flag FROM race_control
UNION ALL SELECT seq, 'f1.laps', CAST(driver_number AS VARCHAR), NULL, session_key, driver_number, NULL, lap_number,
  lap_duration, NULL, NULL, date_start, is_pit_out_lap, NULL, NULL, NULL FROM laps
UNION ALL SELECT seq, 'f1.pit_stops', CAST(driver_number AS VARCHAR), NULL, session_key, driver_number, NULL, lap_number,
  NULL, pit_duration, date, NULL, NULL, NULL, NULL, NULL FROM pits"""


def _schedule(speed: str, source: str = "merged") -> str:
    return f"""
SELECT seq, topic, time, CAST(floor((epoch_ms(time) - epoch_ms((SELECT min(time) FROM {source}))) / {speed}) AS BIGINT)
  AS target_ms FROM {source}"""


_UNDATED = """,
undated AS (SELECT * REPLACE (CASE WHEN topic = 'f1.pit_stops' AND seq % 50 = 7 THEN TIMESTAMP '1970-01-01 00:00:00'
  ELSE time END AS time) FROM merged)"""
_DROPPED = """,
dropped AS (SELECT * FROM merged WHERE NOT (topic = 'f1.pit_stops' AND seq % 50 = 7))"""

_ONE_SESSION = "SELECT session_key, driver_number, position, date FROM positions WHERE session_key = 9161"

# The place of each record among those of its key, by time and then by the order of the source.
_IN_KEY_ORDER = f""",
sent AS ({_MESSAGES}),
timed AS (SELECT sent.topic, sent.key, sent.value, merged.time, merged.seq FROM sent JOIN merged USING (topic, seq))
SELECT topic, key, row_number() OVER (PARTITION BY topic, key ORDER BY time, seq) AS nth, time, value FROM timed"""

# The last position of a window by event time, then by arrival; so too among drivers that claim a position.
_EVENT_ORDER = """
SELECT w AS window_start, p AS position, max_by(driver_number, s) AS driver_number
FROM (SELECT time_bucket(INTERVAL 10 SECOND, t) AS w, driver_number, max(struct_pack(t := t, s := seq)) AS s,
  max_by(position, struct_pack(t := t, s := seq)) AS p FROM positions GROUP BY 1, 2) GROUP BY 1, 2"""

_ALL = (_POSITIONS, _LAPS, _PITS, _RACE_CONTROL)
_KEYS, _SESSION_KEYS = "driver_number, lap_number", "session_key, driver_number, lap_number"

ORACLES: dict[str, str] = {
    "leaderboard_10s": _with(_POSITIONS, _LAST)
    + "SELECT w AS window_start, p AS position, d AS driver_number FROM ranked",
    "leaderboard_by_session": _with(_sessions(_POSITIONS)) + _BY_SESSION,
    "leaderboard_json": _with(_POSITIONS, _LAST) + "SELECT * FROM snapshots",
    "leaderboard_event_order": _with(_POSITIONS) + _EVENT_ORDER,
    "window_last_position": _with(_POSITIONS, _LAST)
    + "SELECT w AS window_start, driver_number, p AS position FROM l",
    "leaderboard_stream": _with(_POSITIONS, _LAST)
    + "SELECT * FROM snapshots WHERE window_end <= (SELECT max(t) FROM positions) - INTERVAL 5 SECOND",
    "laps_enriched_arrival": _with(_LAPS, _PITS) + _arrival(_KEYS),
    "laps_enriched_arrival_crowded": _with(_LAPS, _PITS) + _arrival(_KEYS),
    "laps_enriched_arrival_by_session": _with(_sessions(_LAPS), _sessions(_PITS)) + _arrival(_SESSION_KEYS),
    "laps_enriched_complete": _with(_LAPS, _PITS) + _complete(_KEYS),
    "laps_enriched_complete_by_session": _with(_sessions(_LAPS), _sessions(_PITS)) + _complete(_SESSION_KEYS),
    "laps_enriched_stream": _with(_LAPS, _PITS) + _arrival(_KEYS),
    "laps_enriched_complete_stream": _with(_LAPS, _PITS) + _COMPLETE_STREAM,
    "leaderboard_stream_restarted": _with(_POSITIONS, _LAST)
    + "SELECT * FROM snapshots WHERE window_end <= (SELECT max(t) FROM positions) - INTERVAL 5 SECOND",
    "laps_enriched_stream_restarted": _with(_LAPS, _PITS) + _arrival(_KEYS),
    "laps_enriched_complete_stream_restarted": _with(_LAPS, _PITS) + _COMPLETE_STREAM,
    "laps_enriched_stream_by_ingest_time": _with(_BY_INGEST_TIME),
    "leaderboard_late_by_batch": _with(_DELAYED_POSITIONS) + _LATE_BY_BATCH,
    "leaderboard_open_windows": _with(_DELAYED_POSITIONS) + _OPEN_WINDOWS,
    "race_alerts": _with(_RACE_CONTROL) + _SEVERITY + _ALERTS,
    "race_alerts_whole_words": _with(_RACE_CONTROL) + _WHOLE_WORDS + _ALERTS,
    "race_alerts_json": _with(_RACE_CONTROL) + _SEVERITY + _ALERTS_JSON,
    "race_alerts_stream": _with(_RACE_CONTROL) + _SEVERITY + _ALERTS,
    "decode_positions": _with(_POSITIONS) + _DECODE_POSITIONS,
    "decode_laps": _with(_LAPS) + _DECODE_LAPS,
    "decode_race_control": _with(_RACE_CONTROL) + _DECODE_RACE_CONTROL,
    "malformed_positions": _with(_POSITIONS) + _MALFORMED_POSITIONS,
    "laps_roundtrip": _with(_LAPS) + f"SELECT {_LAP_COLUMNS} FROM laps",
    "pit_stops_roundtrip": _with(_PITS)
    + "SELECT seq, session_key, driver_number, lap_number, pit_duration, date FROM pits",
    "event_time_fallback": _with(_POSITIONS) + _EVENT_TIME,
    "session_filter": _with(_sessions(_POSITIONS)) + _ONE_SESSION,
    "session_filter_json": _with(_sessions(_POSITIONS)) + _ONE_SESSION,
    "timeline": _with(*_ALL) + _MERGED + "\nSELECT * FROM merged",
    "timeline_messages": _with(*_ALL) + _MESSAGES,
    "replay_schedule": _with(*_ALL) + _MERGED + _schedule("2.0"),
    "replay_schedule_undated_first": _with(*_ALL) + _MERGED + _UNDATED + _schedule("3.0", "undated"),
    "replay_schedule_undated_dropped": _with(*_ALL) + _MERGED + _DROPPED + _schedule("3.0", "dropped"),
    "published_in_key_order": _with(*_ALL) + _MERGED + _IN_KEY_ORDER,
    "published_counts": _with(*_ALL) + _MERGED + "\nSELECT topic, count(*) AS records FROM merged GROUP BY topic",
    "leaderboard_by_increments": _with(_POSITIONS, _LAST) + "SELECT w AS window_start, p AS position, d AS driver_number FROM ranked",
    "leaderboard_changed_by_increment": _with(_POSITIONS) + _CHANGED,
    "decode_matrix_exact": _with(_LAPS) + _decode_matrix(),
    "topic_counts": _with(*_ALL) + _MERGED + "\nSELECT topic, count(*) AS records FROM merged GROUP BY topic",
}
