"""Canonical names of entities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that end a company's name and are cut off there, and words that say nothing anywhere.
LEGAL_SUFFIXES = ("inc", "incorporated", "llc", "ltd", "corp", "corporation", "plc")
FILLERS = ("inc", "llc", "ltd", "corp", "corporation", "the", "labs", "co", "company", "foundation")


def canonical_name(c: Column) -> Column:
    """Letters and digits of a name without legal suffixes and fillers, joined without blanks.

    Names without Latin letters or digits, and null, give ''.
    """
    words = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " ")))
    cut = F.regexp_replace(words, "( ({}))+$".format("|".join(LEGAL_SUFFIXES)), "")
    return F.array_join(F.filter(F.split(cut, " "), lambda w: ~w.isin(*FILLERS)), "")
