"""Address text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Postal suffixes and their short forms.
SUFFIXES = {
    "ALLEY": "ALY",
    "AVENUE": "AVE",
    "BOULEVARD": "BLVD",
    "CIRCLE": "CIR",
    "COURT": "CT",
    "DRIVE": "DR",
    "HIGHWAY": "HWY",
    "LANE": "LN",
    "PARKWAY": "PKWY",
    "PLACE": "PL",
    "ROAD": "RD",
    "SQUARE": "SQ",
    "STREET": "ST",
    "TERRACE": "TER",
}


def normalise_address(text: Column) -> Column:
    """Upper case, single blanks, last word in its short form; blank text is NULL."""
    clean = F.trim(F.regexp_replace(F.upper(text), r"[\s.,]+", " "))
    words = F.split(clean, " ")
    last = F.element_at(words, -1)
    short = F.create_map(*[F.lit(v) for pair in SUFFIXES.items() for v in pair])
    rest = F.slice(words, F.lit(1), F.size(words) - 1)
    line = F.concat_ws(" ", F.concat(rest, F.array(F.coalesce(F.element_at(short, last), last))))
    return F.when(clean != "", line)


# Words before the number of a unit.
UNIT_WORDS = ("APT", "APARTMENT", "UNIT", "STE", "SUITE", "#")


def parse_address(text: Column) -> Column:
    """struct(number, street, unit) of an address line, written as :func:`normalise_address` does.

    The number is the whole number that comes first; a unit is what follows a word
    for one at the end. What is missing is NULL; a blank line has none of the three.
    """
    clean = F.trim(F.regexp_replace(F.upper(text), r"[\s.,]+", " "))
    unit = r"(?:^| )(?:" + "|".join(w for w in UNIT_WORDS if w != "#") + r"|#) ?([0-9A-Z-]+)$"
    rest = F.trim(F.regexp_replace(clean, unit, ""))
    number = F.nullif(F.regexp_extract(rest, r"^([0-9]+)(?: |$)", 1), F.lit("")).try_cast("bigint")
    street = normalise_address(F.when(number.isNotNull(), F.regexp_replace(rest, r"^[0-9]+(?: |$)", "")).otherwise(rest))
    return F.struct(number.alias("number"), street.alias("street"), F.nullif(F.regexp_extract(clean, unit, 1), F.lit("")).alias("unit"))
