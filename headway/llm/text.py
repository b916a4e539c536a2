"""Column expressions and constants shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASCII_SPACE = " \t\n\x0b\f\r"
#: Java regular expression of the same characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is.

    ``lower`` has a byte loop for texts that are ASCII only, where it means the
    same; other texts go through ``translate``.
    """
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, _UPPER, _UPPER.lower()))


def ascii_strip(c: Column) -> Column:
    return F.btrim(c, F.lit(ASCII_SPACE))


def space_words(c: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``; empty for null and blank texts."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), SPACE_CLASS + "+"), "")


def hash128(*cols: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes with different seeds."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(0x5BD1E995), *cols)


def with_columns(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """Adds or replaces columns; a column that is there under another case of the name is replaced as well."""
    taken = {k.lower() for k in cols}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken], *[v.alias(k) for k, v in cols.items()])
