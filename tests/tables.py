"""Small hand-written tables. Times are seconds after 13:00:00 UTC on 2023-05-28."""

from datetime import datetime, timedelta, timezone

START = datetime(2023, 5, 28, 13, tzinfo=timezone.utc)


def at(seconds):
    return None if seconds is None else START + timedelta(seconds=seconds)


def iso(seconds):
    return None if seconds is None else at(seconds).strftime("%Y-%m-%dT%H:%M:%S.%f+00:00")


def positions(spark, rows, session=9161):
    """Rows of (t, driver, position), in arrival order."""
    data = [(session, d, p, iso(t), at(t), i) for i, (t, d, p) in enumerate(rows)]
    ddl = "session_key INT, driver_number INT, position INT, date STRING, t TIMESTAMP, seq BIGINT"
    return spark.createDataFrame(data, ddl)


def laps(spark, rows, session=9161):
    """Rows of (t, seq, driver, lap)."""
    data = [(session, d, n, 80.5, iso(t), False, at(t), s) for t, s, d, n in rows]
    ddl = (
        "session_key INT, driver_number INT, lap_number INT, lap_duration DOUBLE, date_start STRING, "
        "is_pit_out_lap BOOLEAN, t TIMESTAMP, seq BIGINT"
    )
    return spark.createDataFrame(data, ddl)


def pits(spark, rows, session=9161):
    """Rows of (t, seq, driver, lap, duration)."""
    data = [(session, d, n, x, iso(t), at(t), s) for t, s, d, n, x in rows]
    ddl = (
        "session_key INT, driver_number INT, lap_number INT, pit_duration DOUBLE, date STRING, t TIMESTAMP, seq BIGINT"
    )
    return spark.createDataFrame(data, ddl)


def race_control(spark, rows, session=9161):
    """Rows of (flag, message)."""
    data = [(session, m, "Other", f, iso(i), None, at(i), i) for i, (f, m) in enumerate(rows)]
    ddl = (
        "session_key INT, message STRING, category STRING, flag STRING, date STRING, driver_number INT, "
        "t TIMESTAMP, seq BIGINT"
    )
    return spark.createDataFrame(data, ddl)
