"""Field cleaning: one Column in, one Column out."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rounding import round_exact

# Country codes a price file may carry.
COUNTRIES = ["MX", "CO", "PE", "EC", "PA", "SV", "HN"]

# Characters dropped from a price text, and the shape of a number.
PRICE_NOISE = r'["$,cu/]'
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Texts a delimited-file reader takes for a missing value.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def strip_all(col: Column) -> Column:
    """Strip every kind of white space at both ends."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def missing_to_null(col: Column) -> Column:
    return F.when(~col.isin(MISSING), col)


def parse_price(col: Column, digits: int | None = 2, on_error: float | None = None) -> Column:
    """Price text to double: currency noise dropped, null (or ``on_error``) when not a number."""
    bare = strip_all(F.regexp_replace(col.cast("string"), PRICE_NOISE, ""))
    value = F.when(bare.rlike(NUMBER), bare.try_cast("double"))
    if digits is not None:
        value = round_exact(value, digits)
    return value if on_error is None else F.coalesce(value, F.lit(on_error))


def check_url(col: Column) -> Column:
    """Null up to 10 characters; http(s) addresses as they are; else ``https://`` in front."""
    has_scheme = col.rlike(r"(?U)^https?://[\w.-]+")
    return F.when(
        F.length(col) > 10,
        F.when(has_scheme, col).otherwise(F.concat(F.lit("https://"), col)),
    )


def split_gift(col: Column) -> tuple[Column, Column]:
    """Product and gift around the first `` + ``; the gift is the text ``None`` when absent."""
    parts = F.split(col, r" \+ ", 2)
    return parts.getItem(0), F.coalesce(F.get(parts, F.lit(1)), F.lit("None"))


def check_name(col: Column) -> Column:
    """Null under 10 characters or 3 words; words of 3 letters or more capitalised, others lower."""
    words = F.split(col, " ", -1)

    def capital(letter: Column) -> Column:
        # the one common letter whose title case is not its upper case
        return F.when(letter == "ß", F.lit("Ss")).otherwise(F.upper(letter))

    cased = F.transform(
        words,
        lambda w: F.when(
            F.length(w) >= 3,
            F.concat(capital(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2)))),
        ).otherwise(F.lower(w)),
    )
    return F.when((F.length(col) >= 10) & (F.size(words) > 2), F.array_join(cased, " "))


def with_quantity(name: Column, quantity: Column) -> Column:
    """Name, a blank, and the quantity text (empty when missing)."""
    return F.concat(name, F.lit(" "), F.coalesce(quantity, F.lit("")))


def strip_zeros(col: Column) -> Column:
    """Product id without leading zeros, then without outer white space."""
    return strip_all(F.regexp_replace(col, r"^0+", ""))


def float_id(col: Column) -> Column:
    """A numeric id read as a floating number, as text without a fraction."""
    return col.cast("double").cast("bigint").cast("string")


def replace_zone(col: Column) -> Column:
    """The zone ``unique`` stands for the whole country."""
    return F.when(col == "unique", F.lit("Nacional")).otherwise(col)


def price_diff(own: Column, other: Column, digits: int = 2) -> Column:
    return F.round(own - other, digits)


def price_index(diff: Column, own: Column, digits: int | None = 2) -> Column:
    ratio = F.try_divide(diff, own)
    return ratio if digits is None else F.round(ratio, digits)


def has_broken_encoding(col: Column) -> Column:
    """True where a text shows the marker left by a wrong decoding."""
    return F.coalesce(col.contains("√"), F.lit(False))


def contains_lower(col: Column, needle: str) -> Column:
    return F.lower(col).contains(needle.lower())


def sanitize_name(name: str) -> str:
    """Column name without dashes, blanks as underscores, doubled underscores collapsed."""
    return re.sub("__", "_", name.replace("-", "").replace(" ", "_"))
