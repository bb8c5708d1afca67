"""Column expressions reproducing the reports' text and number rules.

All of these are built-in Spark expressions (JVM side, whole-stage codegen);
no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reports' rules:
# - trim removes every character from U+0000 to U+0020 at both ends
#   (Spark's own trim removes only the space character);
# - fields are separated by a literal comma; trailing empty fields are dropped;
# - list values (genres) are separated by a literal pipe;
# - the only accepted spellings of the special doubles are NaN and Infinity,
#   with an optional sign, in exactly that case;
# - averages are printed with the pattern 0.00, rounding half-even on the
#   exact binary value, no grouping separator.
TRIM_CHARS = "".join(chr(c) for c in range(0x21))  # U+0000 .. U+0020
FIELD_SEPARATOR = ","
LIST_SEPARATOR_REGEX = r"[|]"
SPECIAL_DOUBLE_ACCEPTED = r"^[+-]?(NaN|Infinity)$"
DECIMAL_PATTERN = "0.00"
DELETE_CHAR = "\x7f"
ID_TYPES = ("int", "long")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jtrim(c: Column | str) -> Column:
    """Strip control characters and spaces (<= U+0020) at both ends.

    A character-set trim, not a regex: it runs on every line and on every
    field of every line.
    """
    return F.trim(_col(c), F.lit(TRIM_CHARS))


def split_fields(c: Column | str) -> Column:
    """Split on commas, dropping trailing empty fields."""
    return F.split(F.rtrim(_col(c), F.lit(FIELD_SEPARATOR)), FIELD_SEPARATOR)


def field(parts: Column, i: int) -> Column:
    """``parts[i]`` or NULL when absent (safe under ANSI mode)."""
    return F.get(parts, F.lit(i))


def parse_int(c: Column | str, id_type: str = "int") -> Column:
    """Trimmed text as a 32-bit ``int`` (or a 64-bit ``long``), NULL when it is not one.

    Accepts an optional sign and ASCII digits; rejects decimals, suffixes and
    values outside the range of the type.  (Non-ASCII digits are rejected as
    well.)
    """
    if id_type not in ID_TYPES:
        raise ValueError(f"id_type must be one of {ID_TYPES}")
    s = jtrim(c)
    # Spark's own cast also trims U+007F, which is no part of a number here
    padded = s.startswith(DELETE_CHAR) | s.endswith(DELETE_CHAR)
    return F.when(~padded, s.try_cast("int" if id_type == "int" else "bigint"))


def parse_double(c: Column | str) -> Column:
    """Trimmed text as a double, NULL when it is not one.

    Spark's cast also reads ``nan``/``inf`` in any case; only the exact
    spellings ``NaN`` and ``Infinity`` are accepted here.
    """
    s = jtrim(c)
    # Every spelling Spark reads as NaN or infinity contains an n/N and no
    # ordinary number does, so only those strings get the exact check.
    maybe_special = s.contains("n") | s.contains("N")
    return F.when(maybe_special & ~s.rlike(SPECIAL_DOUBLE_ACCEPTED),
                  F.lit(None).cast("double")).otherwise(s.try_cast("double"))


def first_char(c: Column | str) -> Column:
    """First character of the trimmed text, NULL for an empty field."""
    s = jtrim(c)
    return F.when(F.length(s) > 0, F.substring(s, 1, 1))


def split_list(c: Column | str, separator_regex: str = LIST_SEPARATOR_REGEX) -> Column:
    """Split a pipe-separated list (empty tokens are kept, filter later)."""
    return F.split(_col(c), separator_regex)


def fmt2(c: Column | str) -> Column:
    """Two decimals, half-even on the exact value, no grouping (0.00)."""
    return F.call_function("format_number", _col(c), F.lit(DECIMAL_PATTERN))
