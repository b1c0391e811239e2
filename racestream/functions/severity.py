"""Severity of a race-control message."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity, patterns looked for in the flag, patterns looked for in the message.
# The first rule that matches decides.
SEVERITY_RULES = (
    ("CRITICAL", ("RED",), ("RED FLAG",)),
    ("HIGH", ("SAFETY CAR",), ("SAFETY CAR",)),
    ("MEDIUM", ("YELLOW",), ()),
    ("LOW", (), ("DRS DISABLED",)),
)


def classify(flag: Column, message: Column, whole_words: bool = False) -> Column:
    """Severity name, or NULL for a message that is no alert.

    Patterns are matched anywhere and without regard to case, so the flag ``CHEQUERED`` and the message
    ``CHEQUERED FLAG`` count as red. ``whole_words=True`` asks for word boundaries instead.
    """
    flag_text = F.upper(F.coalesce(flag, F.lit("")))
    message_text = F.upper(F.coalesce(message, F.lit("")))

    def found(text: Column, pattern: str) -> Column:
        return text.rlike(rf"\b{pattern}\b") if whole_words else text.contains(pattern)

    cases = []
    for name, in_flag, in_message in SEVERITY_RULES:
        hits = [found(flag_text, p) for p in in_flag] + [found(message_text, p) for p in in_message]
        cases.append(F.when(reduce(or_, hits), F.lit(name)))
    return F.coalesce(*cases)
