"""Selectors over JSON and XML columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pointer_path(pointer: str) -> str:
    """The Spark JSON path of a JSON pointer with its ~0 and ~1 escapes."""
    if pointer in ("", "/"):
        return "$"
    path = "$"
    for part in pointer.lstrip("/").split("/"):
        part = part.replace("~1", "/").replace("~0", "~")
        path += f"[{part}]" if part.isdigit() else f"['{part}']"
    return path


def json_pointer(document: Column, pointer: str) -> Column:
    """The text at a JSON pointer, null where there is none or the document is broken."""
    return F.get_json_object(document, pointer_path(pointer))


def select_fields(df, selectors: dict[str, tuple[str, str, str]]):
    """df's fields by (kind, column, path): kind is FIELD, JSON_POINTER or XPATH. A target may be named once only."""
    out = []
    for target, (kind, column, path) in selectors.items():
        if kind == "FIELD":
            value = F.col(column)
        elif kind == "JSON_POINTER":
            value = json_pointer(F.col(column), path)
        elif kind == "XPATH":
            value = F.xpath_string(F.col(column), F.lit(path))
        else:
            raise ValueError(f"no selector of kind {kind}")
        out.append(value.alias(target))
    return df.select(*out)
