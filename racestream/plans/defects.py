"""Documents with the defects a topic can carry, derived from the event tables row by row.

The defect of a row depends on its ``seq``; every row of the table takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from racestream.schemas import LAPS, POSITIONS, RACE_CONTROL

SCHEMAS = {"positions": POSITIONS, "laps": LAPS, "race_control": RACE_CONTROL}

KINDS = {"positions": 16, "laps": 16, "race_control": 12}


def _document(**fields: str) -> str:
    """SQL for JSON text from the SQL of its field texts, which need not be valid JSON."""
    parts = ["'{'"]
    for i, (name, text) in enumerate(fields.items()):
        parts += [f"""'{"," if i else ""}"{name}":'""", text]
    return f"concat({', '.join(parts)}, '}}')"


def _quoted(text: str) -> str:
    return f"""concat('"', {text}, '"')"""


def _position(driver: str) -> str:
    return _document(session_key="session_key", driver_number=driver, position="position", date=_quoted("date"))


def _lap(duration: str = "coalesce(string(lap_duration), 'null')", pit_out: str = "string(is_pit_out_lap)") -> str:
    return _document(
        session_key="session_key",
        driver_number="driver_number",
        lap_number="lap_number",
        lap_duration=duration,
        date_start=_quoted("date_start"),
        is_pit_out_lap=pit_out,
    )


def _message(driver: str, message: str) -> str:
    return _document(session_key="session_key", message=f'"{message}"', flag="'null'", driver_number=f"'{driver}'")


_INTACT_POSITION = _position("driver_number")

_KINDS = {
    "positions": {
        0: _position(_quoted("driver_number")),
        1: _position("concat(driver_number, '.7')"),
        2: _document(session_key="session_key", position="position", date=_quoted("date")),
        3: _position("'null'"),
        4: _position("""'""'"""),
        5: _position("'true'"),
        6: _position("'3000000000'"),
        7: """concat('{"session_key":', session_key, ',')""",
        8: "''",
        9: f"concat('[', {_INTACT_POSITION}, ']')",
        10: _document(unknown="""'{"a":[1,2]}'""", driver_number="driver_number", position="position"),
        11: f"""concat({_INTACT_POSITION}, '{{"position":99}}')""",
        12: _position("""concat('" ', driver_number, ' "')"""),
        13: _position("concat(driver_number, 'e0')"),
        14: "NULL",
        15: _INTACT_POSITION,
    },
    "laps": {
        0: _lap(duration=_quoted("coalesce(string(lap_duration), 'null')")),
        1: _lap(duration="""'""'"""),
        2: _lap(pit_out="'1'"),
        3: _lap(pit_out="'0'"),
        4: _lap(pit_out="""'"True"'"""),
        5: _lap(pit_out="""'"FALSE"'"""),
        6: _lap(pit_out="'null'"),
        7: _lap(pit_out="""'""'"""),
        8: _lap(pit_out="""'"yes"'"""),
        9: _lap(duration="""'"fast"'"""),
        10: _lap(duration="'NaN'"),
        11: _lap(duration="'{}'"),
        12: _lap(duration="'90'"),
        13: _lap(duration="'9.05e1'"),
        14: _lap(),
        15: _lap(),
    },
    "race_control": {
        0: _message("44", '\\"DRS DISABLED\\"'),
        1: _message("null", "5"),
        2: _message('""', "true"),
        3: _message('"44"', "null"),
        4: _message("[44]", '\\"x\\"'),
        5: _message("44", "'x'"),
        6: "'null'",
        7: "'{}'",
    },
}

# Kinds without an entry are documents as they are published.
_PUBLISHED = f"to_json(struct({', '.join(RACE_CONTROL.names)}), map('ignoreNullFields', 'false'))"


def documents(table: DataFrame, name: str) -> DataFrame:
    """``seq, value``: one document per row of the raw table ``name``, some defective."""
    cases = " ".join(f"WHEN {kind} THEN {text}" for kind, text in _KINDS[name].items())
    otherwise = _PUBLISHED if name == "race_control" else "NULL"
    return table.selectExpr("seq", f"CASE seq % {KINDS[name]} {cases} ELSE {otherwise} END AS value")


# Pattern and offset of each spelling; from 7 on they are not accepted.
_SPELLINGS = [
    ("yyyy-MM-dd'T'HH:mm:ss.SSS", "+00:00"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSS", "Z"),
    ("yyyy-MM-dd't'HH:mm:ss", "z"),
    ("yyyy-MM-dd'T'HH:mm", "Z"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSS", "+02:00"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSS", "-05"),
    ("yyyy-MM-dd'T'HH:mm", "+05:30"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSS", ""),
    ("yyyy-MM-dd", ""),
    ("yyyy-MM-dd HH:mm:ss", "+00:00"),
    ("' 'yyyy-MM-dd'T'HH:mm:ss", "Z"),
    ("yyyy-MM-dd'T'HH:mm:ss", "+0000"),
    ("yyyy'-02-30T'HH:mm:ss", "Z"),
    ("yyyy-MM-dd'T24:00:00'", "Z"),
    ("'soon'", ""),
]


def odd_dates(table: DataFrame) -> DataFrame:
    """``seq, t, text``: the time of a row in accepted and unaccepted spellings, or NULL."""
    cases = " ".join(
        f"""WHEN {kind} THEN concat(date_format(t, "{pattern}"), '{offset}')"""
        for kind, (pattern, offset) in enumerate(_SPELLINGS)
    )
    return table.selectExpr("seq", "t", f"CASE seq % {len(_SPELLINGS) + 1} {cases} END AS text")


# Every kind of value that a field of each type can hold, and what it must become: the text of the JSON value (None: the field is left
# out), the decoded value as SQL, and whether the document is malformed. The field stands in an otherwise intact lap.
MATRIX = {
    "lap_number": [
        (None, "0", False), ("null", "0", False), ('""', "0", False), ('"  "', "0", False), ('"44"', "44", False), ('" 7 "', "7", False),
        ("44", "44", False), ("44.0", "44", False), ("44.7", "44", False), ("-44.7", "-44", False), ("1e2", "100", False),
        ('"44.0"', "0", True), ('"1e2"', "0", True), ("true", "0", True), ("{}", "0", True), ("[1]", "0", True), ("3000000000", "0", True),
        ('"x"', "0", True),
    ],
    "is_pit_out_lap": [
        (None, "false", False), ("null", "false", False), ('""', "false", False), ("1", "true", False), ("0", "false", False),
        ("true", "true", False), ("false", "false", False), ('"true"', "true", False), ('"False"', "false", False), ("1.5", "false", True),
        ('"yes"', "false", True), ('"1"', "false", True), ("{}", "false", True), ("[true]", "false", True),
    ],
    "lap_duration": [
        (None, "NULL", False), ("null", "NULL", False), ('""', "NULL", False), ('"20.5"', "20.5", False), ("44", "44", False),
        ("44.75", "44.75", False), ("1e2", "100", False), ('"NaN"', "'NaN'", False), ("NaN", "NULL", True), ("true", "NULL", True),
        ("{}", "NULL", True), ('"fast"', "NULL", True),
    ],
    "date_start": [
        (None, "NULL", False), ("null", "NULL", False), ('""', "''", False), ("5", "'5'", False), ("true", "'true'", False),
        ('"2023"', "'2023'", False), ("{}", "NULL", True), ("[]", "NULL", True), ('{"a":1}', "NULL", True),
    ],
}

# Whole documents: their text and whether they are malformed. Those that are not hold lap 1.
WHOLE = [
    ('{"lap_number":1}{"lap_number":2}', False),
    ('{"lap_number":1,"unknown":{"a":[1,2]}}', False),
    ("", True),
    ("not json", True),
    ("null", True),
    ('[{"lap_number":1}]', True),
    ('{"lap_number":', True),
]

_INTACT = {"session_key": "9161", "driver_number": "44", "lap_number": "7", "lap_duration": "80.5", "date_start": '"d"', "is_pit_out_lap": "true"}


def matrix_documents() -> list[str]:
    """The documents of the matrix, field by field, and then the whole ones."""
    found = []
    for name, cases in MATRIX.items():
        for text, _, _ in cases:
            fields = {**_INTACT, name: text}
            found.append("{" + ",".join(f'"{k}":{v}' for k, v in fields.items() if v is not None) + "}")
    return found + [text for text, _ in WHOLE]
