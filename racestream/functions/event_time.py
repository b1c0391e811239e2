"""ISO-8601 offset timestamps as event time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date and time with a mandatory offset; seconds, fraction and the parts of the offset may be missing.
_ISO_OFFSET = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:\d{2}(:\d{2})?)?)\z"
_NO_SECONDS = r"^(.{10}T\d{2}:\d{2})(Z|[+-])"


def parse_iso_offset(text: Column) -> Column:
    """TIMESTAMP of an ISO-8601 date-time with offset, NULL for anything else.

    A plain cast would also accept dates without a time or an offset, and would reject a time without
    seconds, so the text is checked and completed first. Digits beyond microseconds are cut, and years
    of more than four digits are not accepted.
    """
    upper = F.upper(text)
    completed = F.regexp_replace(upper, _NO_SECONDS, "$1:00$2")
    instant = F.coalesce(upper.try_cast("timestamp"), completed.try_cast("timestamp"))
    return F.when(upper.rlike(_ISO_OFFSET), instant)


def event_time(text: Column, fallback: Column | str = "null") -> Column:
    """Event time of a record: its own timestamp, else ``fallback``.

    ``fallback`` is a column (such as the ingest time), ``'epoch'`` or ``'null'``. An ingest-time fallback
    on historical data can move a watermark years ahead and make all later records late; use ``'null'``
    to have such records left out of windows instead.
    """
    parsed = parse_iso_offset(text)
    if isinstance(fallback, Column):
        return F.coalesce(parsed, fallback)
    if fallback == "epoch":
        return F.coalesce(parsed, F.timestamp_millis(F.lit(0)))
    if fallback == "null":
        return parsed
    raise ValueError(f"fallback must be a column, 'epoch' or 'null', got {fallback!r}")
