"""Source type text to Spark type text."""

from __future__ import annotations

import re
from collections.abc import Mapping

# Used where a delivery brings no type map of its own.
DEFAULT_TYPE_NAMES = {
    "char": "string",
    "clob": "string",
    "date": "timestamp_ntz",
    "float": "double",
    "integer": "bigint",
    "number": "bigint",
    "nvarchar2": "string",
    "timestamp": "timestamp_ntz",
    "varchar2": "string",
}

MAX_PRECISION = 38


def resolve_type(text: str, names: Mapping[str, str] = DEFAULT_TYPE_NAMES) -> str:
    """Map one declared type.

    ``number(p,s)`` becomes ``decimal(min(p+s, 38), s)``. ``number(p)`` is looked
    up without its size and must be known. Any other sized type is looked up
    without its size, an unsized one as it stands, and both stay as they are
    where the map has no entry.
    """
    declared = re.sub(r"\s+", "", text.strip().lower())
    sized = re.fullmatch(r"(\w+)\((.*)\)", declared)
    if not sized:
        return names.get(declared, declared)
    base, size = sized.groups()
    if base == "number":
        if "," in size:
            precision, scale = (int(part) for part in size.split(","))
            return f"decimal({min(precision + scale, MAX_PRECISION)},{scale})"
        if base not in names:
            raise ValueError(f"no mapping for type {text!r}")
        return names[base]
    return names.get(base, declared)
