from granary.functions.columns import (
    DAY_FORMAT,
    day_of,
    is_true,
    join_fields,
    parse_day,
    replaced_day,
    shift_day,
)
from granary.functions.types import DEFAULT_TYPE_NAMES, resolve_type

__all__ = [
    "DAY_FORMAT",
    "DEFAULT_TYPE_NAMES",
    "day_of",
    "is_true",
    "join_fields",
    "parse_day",
    "replaced_day",
    "resolve_type",
    "shift_day",
]
