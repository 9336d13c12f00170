"""Scalars out of JSON text. A document that does not parse counts as NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _document(content: Column | str) -> Column:
    # As the one element of an array, a document with text after its end does not parse either.
    column = F.col(content) if isinstance(content, str) else content
    return F.try_parse_json(F.concat(F.lit("["), column, F.lit("]")))


def json_text(content: Column | str, key: str) -> Column:
    return F.try_variant_get(_document(content), f"$[0].{key}", "string")


def json_int(content: Column | str, key: str) -> Column:
    """NULL when the value is not a number."""
    return F.try_variant_get(_document(content), f"$[0].{key}", "int")


def json_int_strict(content: Column | str, key: str) -> Column:
    """Raises when the document parses but the value is not a number."""
    return F.variant_get(_document(content), f"$[0].{key}", "int")
