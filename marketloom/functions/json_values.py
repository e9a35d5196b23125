"""Strictly typed reads of JSON text.

``read_object`` parses a text once against a schema. The JSON reader is strict about numbers: an
integer field takes neither ``1.5`` nor ``true`` nor ``"7"``; such a value leaves NULL and marks the
record. Where only text is allowed, or any type is, the schema says VARIANT and the type is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BAD_RECORD = "bad_record"
END_MARK = "end_of_payload_mark"

# Text that is not plain JSON is refused; NaN is read and fails the range checks.
READ_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD, "allowSingleQuotes": "false"}

# (?U) makes \s cover Unicode white space; the four separators count as white space as well.
VISIBLE_TEXT = r"(?U)[^\s\x1c-\x1f]"
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def read_object(text: Column, fields: str) -> Column:
    """A struct of ``payload`` (NULL unless the text is one JSON object) and ``well_typed``.

    The reader stops after the first value. Reading the text as first element of a two-element array
    whose second is a mark makes anything after the object break the array or hide the mark. The mark is the
    text's own hash, which no text can contain.
    """
    wrapped = F.concat(F.lit('{"parts":['), text, F.lit(',{"' + END_MARK + '":"'), end_mark(text), F.lit('"}]}'))
    schema = f"parts ARRAY<STRUCT<{fields}, {END_MARK} STRING>>, {BAD_RECORD} STRING"
    return F.from_json(wrapped, schema, READ_OPTIONS)


def end_mark(text: Column) -> Column:
    return F.sha2(text, 256)


def payload_of(read: Column, text: Column) -> Column:
    """The payload that ``read_object`` found in ``text``."""
    parts = read["parts"]
    complete = (F.size(parts) == 2) & F.coalesce(F.get(parts, F.lit(1))[END_MARK] == end_mark(text), F.lit(False))
    return F.when(complete, F.get(parts, F.lit(0)))


def is_well_typed(read: Column) -> Column:
    return read[BAD_RECORD].isNull()


def json_type(value: Column) -> Column:
    """Type name of a scalar VARIANT: BIGINT, DECIMAL(p,s), DOUBLE, STRING, BOOLEAN, VOID; NULL if absent."""
    return F.schema_of_variant(value)


def text_value(value: Column) -> Column:
    """The text of a VARIANT that holds a string; NULL for every other type."""
    return F.when(json_type(value) == "STRING", F.try_variant_get(value, "$", "string"))


def whole_number(value: Column) -> Column:
    """The number of a VARIANT that holds an integer; NULL for every other type."""
    return F.when(json_type(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))


def nested_object(value: Column, fields: str) -> Column:
    """The fields of a VARIANT that holds an object; NULLs for every other type."""
    return F.from_json(F.to_json(value), fields, READ_OPTIONS)


def to_decimal(number: Column, precision: int, scale: int) -> Column:
    """Half-up through double to the column type; NULL when it is not a number or does not fit."""
    return number.try_cast("double").try_cast(f"decimal({precision},{scale})")


def holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def is_visible(text: Column) -> Column:
    return holds(text.rlike(VISIBLE_TEXT))


def is_amount(number: Column, precision: int = 18, scale: int = 2) -> Column:
    """A number >= 0 that the target column can hold."""
    return holds((number >= 0) & to_decimal(number, precision, scale).isNotNull())


def is_optional_amount(number: Column, precision: int = 18, scale: int = 2) -> Column:
    return number.isNull() | is_amount(number, precision, scale)


def is_optional_count(number: Column) -> Column:
    return number.isNull() | (number >= 0)
