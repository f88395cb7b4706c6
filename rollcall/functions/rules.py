"""Cleaning rules for single values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.states import STATE_LOOKUP
from rollcall.functions.text import col, constant_map, trim_upper
from rollcall.schema import DEFAULT_NAME, MAX_AGE, MIN_AGE

# Accepted spellings per category, and the shortest plausible address.
GENDER_SPELLINGS = {"M": ("M", "MALE"), "F": ("F", "FEMALE")}
OTHER_GENDER = "U"
SHORTEST_EMAIL = 5


def default_if_null(c: Column | str, default: str = DEFAULT_NAME) -> Column:
    """NULL becomes ``default``; an empty string is a value and stays."""
    return F.coalesce(col(c), F.lit(default))


def bounded_or_null(c: Column | str, low: int = MIN_AGE, high: int = MAX_AGE) -> Column:
    c = col(c)
    return F.when(c.between(low, high), c)


def out_of_range_flag(c: Column | str, low: int = MIN_AGE, high: int = MAX_AGE) -> Column:
    """TRUE for NULL as well as for values outside the bounds."""
    return F.coalesce(~col(c).between(low, high), F.lit(True))


def normalize_gender(
    c: Column | str,
    spellings: dict[str, tuple[str, ...]] = GENDER_SPELLINGS,
    other: str = OTHER_GENDER,
) -> Column:
    c = col(c)
    picks = [F.when(c.isin(*words), F.lit(code)) for code, words in spellings.items()]
    return F.coalesce(*picks, F.lit(other))


def standardize_state(c: Column | str, lookup: dict[str, str] = STATE_LOOKUP) -> Column:
    """Names and codes in any case to the two-letter code; anything else to NULL.

    The lookup is a constant map that the optimizer folds into one literal.
    """
    return F.try_element_at(constant_map(lookup), trim_upper(c))


def email_plausible(c: Column | str, shortest: int = SHORTEST_EMAIL) -> Column:
    """At least ``shortest`` characters with an '@' and a '.' in any order. Never NULL."""
    c = col(c)
    plausible = c.contains("@") & c.contains(".") & (F.length(c) >= shortest)
    return F.coalesce(plausible, F.lit(False))


def missing_data_flag(*required: Column | str) -> Column:
    """TRUE when any of the required values is NULL."""
    return reduce(lambda a, b: a | b, (col(c).isNull() for c in required))
