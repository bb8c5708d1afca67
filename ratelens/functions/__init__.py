"""Column expressions (built-in Spark functions only)."""

from ratelens.functions.labels import (
    AGE_BOUNDS,
    AGE_LABELS,
    FEMALE,
    MALE,
    MISSING_TEXT,
    bucket_label,
    unknown_label,
)
from ratelens.functions.text import (
    field,
    first_char,
    fmt2,
    jtrim,
    parse_double,
    parse_int,
    split_fields,
    split_list,
)

__all__ = [
    "AGE_BOUNDS", "AGE_LABELS", "FEMALE", "MALE", "MISSING_TEXT",
    "bucket_label", "unknown_label",
    "field", "first_char", "fmt2", "jtrim", "parse_double", "parse_int",
    "split_fields", "split_list",
]
