"""Text cleanup and the text -> integer cast."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode space separators (category Zs), all of which are trimmed.
# Tabs and newlines are not separators and stay.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)

# The ways to write a number.
PLAIN_INTEGER = r"\A\s*[+-]?\d{1,9}\s*\z"
NUMBER = r"\A\s*[+-]?(?:\d[\d_]*\.?[\d_]*|\.\d[\d_]*)(?:[eE][+-]?\d+)?\s*\z"
DIGIT_GROUP_MARK = r"(?<=\d)_(?=\d)"
HEX_INTEGER = r"\A\s*0[xX]0*([0-9a-fA-F]{1,8})\s*\z"
BINARY_INTEGER = r"\A\s*0[bB]0*([01]{1,32})\s*\z"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def constant_map(entries: dict[str, str | int]) -> Column:
    """A map literal, written as one expression because each single literal costs a call."""
    return F.expr("map(" + ", ".join(f"{k!r}, {v!r}" for k, v in entries.items()) + ")")


def trim_text(c: Column | str) -> Column:
    """Strip space separators from both ends; NULL stays NULL, blank becomes ''.

    A value without multi-byte characters can only carry plain spaces, and the plain
    trim is several times cheaper than the trim with a character set.
    """
    c = col(c)
    plain = F.octet_length(c) == F.length(c)
    return F.when(plain, F.trim(c)).otherwise(F.trim(c, F.lit(SPACE_SEPARATORS)))


def trim_upper(c: Column | str) -> Column:
    return F.upper(trim_text(c))


def trim_lower(c: Column | str) -> Column:
    return F.lower(trim_text(c))


def safe_int_cast(c: Column | str) -> Column:
    """Text to INT, NULL when it is not a number.

    The shape is matched before any cast: a cast that fails is caught inside Spark as an
    exception, which costs as much as a hundred matches. Fractions and exponents go
    through DECIMAL, which rounds half away from zero. Digit groups ('4_5'), hexadecimal
    and binary integers are accepted too.
    """
    c = col(c)
    grouped = F.regexp_replace(c, DIGIT_GROUP_MARK, "")
    hexadecimal = F.conv(F.regexp_extract(c, HEX_INTEGER, 1), 16, 10)
    binary = F.conv(F.regexp_extract(c, BINARY_INTEGER, 1), 2, 10)
    return (
        F.when(c.rlike(PLAIN_INTEGER), c.try_cast("int"))
        .when(c.rlike(NUMBER), F.round(grouped.try_cast("decimal(38,20)"), 0).try_cast("int"))
        .when(c.rlike(HEX_INTEGER), hexadecimal.try_cast("int"))
        .when(c.rlike(BINARY_INTEGER), binary.try_cast("int"))
    )
