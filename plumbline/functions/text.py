"""Text standardisation as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The white space trimmed from the edges of text, and what is dropped from a key.
ASCII_SPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"
OTHER_SPACE = (
    "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
NOT_ALPHANUMERIC = r"[^\p{L}\p{N}]+"


def strip(c: Column) -> Column:
    """Drop leading and trailing white space of any Unicode kind (C5); ASCII text takes the short list."""
    is_ascii = F.octet_length(c) == F.length(c)
    return F.when(is_ascii, F.trim(c, F.lit(ASCII_SPACE))).otherwise(F.trim(c, F.lit(ASCII_SPACE + OTHER_SPACE)))


def normalize_key(c: Column) -> Column:
    """Business key: upper case, letters and digits only."""
    return F.regexp_replace(F.upper(c), NOT_ALPHANUMERIC, "")


def normalize_enum(c: Column) -> Column:
    """Domain value: trimmed, upper case, each hyphen or blank an underscore."""
    return F.replace(F.replace(F.upper(strip(c)), F.lit("-"), F.lit("_")), F.lit(" "), F.lit("_"))


def normalize_code(c: Column) -> Column:
    """Short code such as a currency or a source system: trimmed, upper case."""
    return F.upper(strip(c))


def is_blank(c: Column, is_text: bool = True) -> Column:
    """NULL, or for text also only blanks (F8). Never NULL itself."""
    if not is_text:
        return c.isNull()
    return c.isNull() | (F.trim(c) == "")


# Longest value that `identity` keeps as it is; its digests are longer.
_LONGEST_KEPT = 64


def identity(c: Column) -> Column:
    """Value that is equal exactly where `c` is, and short: long text is its SHA-256 digest.

    For grouping and distinct counts of whole texts, which would otherwise be shuffled in full.
    """
    return F.when(F.length(c) > _LONGEST_KEPT, F.concat(F.lit("sha256:"), F.sha2(c, 256))).otherwise(c)
