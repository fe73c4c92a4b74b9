"""Type tests and reads on VARIANT rows, by the JSON type of each value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _at(row: Column, field: str, kind: str) -> Column:
    return F.try_variant_get(row, f"$.{field}", kind)


def text_of(row: Column, field: str) -> Column:
    return _at(row, field, "string")


def integer_of(row: Column, field: str) -> Column:
    """Value of a JSON integer, 1 or 0 for a JSON boolean, NULL for other types."""
    kind = F.schema_of_variant(_at(row, field, "variant"))
    return F.when(kind.isin("BIGINT", "BOOLEAN"), _at(row, field, "bigint"))


def list_size(row: Column, field: str) -> Column:
    """Length of a JSON list, NULL for other types."""
    return F.size(_at(row, field, "array<variant>"))


def truthy_json(row: Column, field: str) -> Column:
    """JSON text of a value that is not null, false, zero or empty; else NULL."""
    text = F.to_json(_at(row, field, "variant"))
    # The whole text or no match at all: a condition on the text would work it out again.
    whole = r'(?s)^(?!(?:null|false|""|\[\]|\{\}|-?0(?:\.0*)?(?:E.*)?)\z).+'
    return F.get(F.regexp_extract_all(text, F.lit(whole), F.lit(0)), F.lit(0))
