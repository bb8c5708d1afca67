"""Generators: one output row per token of a list-valued column (GEN-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions.text import LIST_SEPARATOR_REGEX, jtrim, split_list


def explode_tokens(df: DataFrame, list_col: str, out_col: str,
                   separator_regex: str = LIST_SEPARATOR_REGEX) -> DataFrame:
    """Replace ``list_col`` (pipe list) with one row per trimmed, non-empty token.

    A token repeated in the list yields a row each time.
    """
    rest = [c for c in df.columns if c != list_col]
    return (df.select(*rest, F.explode(split_list(list_col, separator_regex)).alias("_tok"))
            .select(*rest, jtrim("_tok").alias(out_col))
            .where(F.col(out_col) != ""))
