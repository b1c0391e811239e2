"""JSON documents to typed rows and back.

Fields are first read as text and then converted, because the typed JSON reader has no defaults and
rejects numbers in quotes or with a fraction. The rules, per type of field:

* INT: absent, null or blank is 0 (NULL where the schema allows it); ``44``, ``"44"``, ``44.7`` and ``1e2``
  are numbers, cut towards zero; anything else or out of range is malformed;
* BOOLEAN: absent, null or blank is false; true/false in lower, upper or title case; integers are true
  unless zero;
* DOUBLE: absent, null or blank is NULL; numbers, ``NaN`` and infinities in quotes;
* STRING: taken as it is, numbers and booleans in their text form (``1.50`` as ``1.5``).

Read as text, the string ``"44.0"`` cannot be told from the number 44.0 and is accepted as one. With ``exact=True`` documents are parsed to
variants, which keep the type of each value: quoted numbers must be whole for an INT, quoted booleans words, and an object or an array is
malformed for a STRING; a document that repeats a key is malformed, too.
Unknown fields are ignored. A value that is no JSON object is malformed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MALFORMED = "malformed"
_CORRUPT = "_corrupt"
_DOCUMENT = "_document"

# The JSON reader is lenient by default; these make it accept standard JSON only.
STRICT_JSON = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}

# SQL of the typed value of a field, given its text; NULL if the text does not fit the type. The common case comes
# first. Words of a double in quotes are how the JSON reader spells numbers too large for one.
_CONVERT = {
    T.IntegerType(): r"""coalesce(try_cast({text} AS INT), CASE WHEN {blank} THEN {default}
        WHEN {text} RLIKE r'^ *[+-]?\d+(\.\d+)?([eE][+-]?\d+)? *\z'
            AND try_cast({text} AS DOUBLE) BETWEEN -2147483648D AND 2147483647D
        THEN try_cast(try_cast({text} AS DOUBLE) AS INT) END)""",
    T.DoubleType(): r"""CASE WHEN {text} RLIKE r'^ *[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)? *\z' THEN try_cast({text} AS DOUBLE)
        WHEN trim({text}) IN ('NaN', 'Infinity', '-Infinity', 'INF', '-INF', '"Infinity"', '"-Infinity"')
        THEN try_cast(replace({text}, '"', '') AS DOUBLE) END""",
    T.BooleanType(): r"""CASE WHEN {blank} THEN {default} WHEN trim({text}) IN ('true', 'True', 'TRUE') THEN true
        WHEN trim({text}) IN ('false', 'False', 'FALSE') THEN false
        WHEN {text} RLIKE r'^[+-]?\d+\z' THEN NOT {text} RLIKE r'^[+-]?0+\z' END""",
}
_DEFAULT = {T.IntegerType(): "0", T.DoubleType(): "NULL", T.BooleanType(): "false"}


# SQL of the text of a field, given that and the kind of its value, where the text alone says too little. The mark '!' fits no type.
_EXACT = {
    T.IntegerType(): r"CASE WHEN {kind} = 'STRING' AND NOT {blank} AND NOT {text} RLIKE r'^\s*[+-]?\d+\s*\z' THEN '!' ELSE {text} END",
    T.DoubleType(): r"{text}",
    T.BooleanType(): r"""CASE WHEN {kind} IN ('VOID', 'BIGINT', 'BOOLEAN') OR {kind} IS NULL THEN {text}
        WHEN {kind} = 'STRING' AND ({blank} OR lower(trim({text})) IN ('true', 'false')) THEN {text} ELSE '!' END""",
    T.StringType(): r"{text}",
}
_FIELDS, _PARTS = "_fields", "_parts"


def text_schema(schema: T.StructType) -> T.StructType:
    """The same fields, all as text, and a column for documents that cannot be read."""
    fields = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    return T.StructType(fields + [T.StructField(_CORRUPT, T.StringType())])


def _blank(text: str) -> str:
    return f"({text} IS NULL OR trim({text}) IN ('', 'null'))"


def _convert(text: str, field: T.StructField) -> str:
    if isinstance(field.dataType, T.StringType):
        return text
    default = "NULL" if field.nullable else _DEFAULT[field.dataType]
    return _CONVERT[field.dataType].format(text=text, blank=_blank(text), default=default)


def _misfit(text: str, field: T.StructField) -> str:
    """SQL of whether the text of a field did not become a value."""
    no_value = f"`{field.name}` IS NULL"
    return f"({no_value} AND NOT {_blank(text)})" if field.nullable else no_value


def coerce(documents: DataFrame, schema: T.StructType, keep: list[str]) -> DataFrame:
    """Columns of ``schema`` converted from their text form, the columns in ``keep``, and ``malformed``.

    The texts are the fields of the struct ``_document``.
    """
    texts = {f.name: f"{_DOCUMENT}.`{f.name}`" for f in schema.fields}
    values = ", ".join(f"{_convert(texts[f.name], f)} AS `{f.name}`" for f in schema.fields)
    kept = [f"`{c}`" for c in keep]
    # Unnesting keeps later filters above the conversion, which so runs once per record.
    rows = documents.selectExpr(*kept, _DOCUMENT, f"inline(array(struct({values})))")
    unreadable = [f"{_DOCUMENT} IS NULL", f"{_DOCUMENT}.{_CORRUPT} IS NOT NULL"]
    misfits = [_misfit(texts[f.name], f) for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    malformed = " OR ".join([*unreadable, *misfits])
    return rows.selectExpr(*[f"`{n}`" for n in schema.names], *kept, f"{malformed} AS {MALFORMED}")


def apply_policy(rows: DataFrame, on_malformed: str, describe: Column) -> DataFrame:
    """``drop`` leaves malformed rows out, ``fail`` ends the job on the first, ``keep`` flags them."""
    if on_malformed == "keep":
        return rows
    if on_malformed == "drop":
        return rows.where(~F.col(MALFORMED)).drop(MALFORMED)
    if on_malformed == "fail":
        error = F.raise_error(F.concat(F.lit("malformed record: "), F.coalesce(describe, F.lit("NULL"))))
        return rows.where(F.when(F.col(MALFORMED), error.cast("boolean")).otherwise(F.lit(True))).drop(MALFORMED)
    raise ValueError(f"on_malformed must be 'drop', 'fail' or 'keep', got {on_malformed!r}")


def _texts_of_variants(df: DataFrame, schema: T.StructType, value: str, others: list[str]) -> DataFrame:
    """The rows with ``_document``, the fields as text, by way of variants. Each step is unnested, so that it runs once."""
    parsed = F.expr(f"try_variant_get(try_parse_json(`{value}`), '$', 'map<string, variant>')")
    rows = df.select(*others, value, F.explode(F.array(parsed)).alias(_FIELDS))
    parts = ", ".join(
        f"try_variant_get({_FIELDS}['{f.name}'], '$', 'string') AS `t_{f.name}`, "
        f"split(schema_of_variant({_FIELDS}['{f.name}']), '[<(]')[0] AS `k_{f.name}`"
        for f in schema.fields
    )
    rows = rows.selectExpr(*[f"`{c}`" for c in (*others, value)], f"{_FIELDS} IS NULL AS _no_object", f"inline(array(struct(struct({parts}) AS {_PARTS})))")
    nested = [f"{_PARTS}.`k_{f.name}` IN ('OBJECT', 'ARRAY')" for f in schema.fields if isinstance(f.dataType, T.StringType)]
    corrupt = " OR ".join(["_no_object", *[f"coalesce({n}, false)" for n in nested]])
    texts = []
    for f in schema.fields:
        text, kind = f"{_PARTS}.`t_{f.name}`", f"{_PARTS}.`k_{f.name}`"
        texts.append(f"{_EXACT[f.dataType].format(text=text, kind=kind, blank=_blank(text))} AS `{f.name}`")
    document = f"struct({', '.join(texts)}, CASE WHEN {corrupt} THEN '' END AS {_CORRUPT})"
    return rows.selectExpr(*[f"`{c}`" for c in (*others, value)], f"inline(array(struct({document} AS {_DOCUMENT})))")


def decode(df: DataFrame, schema: T.StructType, on_malformed: str = "fail", value: str = "value", exact: bool = False) -> DataFrame:
    """Parse the JSON text in column ``value`` once; all other columns are kept. ``exact`` tells quoted values from others.

    With ``on_malformed='keep'`` the raw text stays too, next to the flag ``malformed``; split the result
    with ``split_malformed`` to put bad records in quarantine.
    """
    others = [c for c in df.columns if c != value]
    if exact:
        documents = _texts_of_variants(df, schema, value, others)
    else:
        parsed = F.from_json(F.col(value), text_schema(schema), STRICT_JSON)
        documents = df.select(*others, value, F.explode(F.array(parsed)).alias(_DOCUMENT))
    rows = coerce(documents, schema, [*others, value])
    rows = apply_policy(rows, on_malformed, F.col(value))
    return rows if on_malformed == "keep" else rows.drop(value)


def split_malformed(rows: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Good rows, typed; and bad ones, as the raw text with whatever came next to it."""
    good = rows.where(~F.col(MALFORMED)).drop(MALFORMED, value)
    metadata = [c for c in rows.columns if c in ("key", "topic", "ingest_time", "partition", "offset", "seq")]
    bad = rows.where(F.col(MALFORMED)).select(value, *metadata)
    return good, bad


def encode(*columns: Column | str) -> Column:
    """JSON text of the columns; NULLs are written out, not left away."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
