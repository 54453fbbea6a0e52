"""First and last name of a contact, in column expressions: titles and suffixes dropped, "Last, First" turned, particles kept with the last name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewright.functions.text import clean

# Titles before a name, suffixes after it, particles that belong to the last name.
TITLES = r"(?iU)^(?:(?:dr|prof|mr|mrs|ms|miss|sir|madam|herr|frau|hr|fr|dipl|ing|mag)\b\.?[\s-]*)+"
SUFFIXES = r"(?iU)[\s,]+(?:jr|sr|ii|iii|iv|phd|ph\.d|md|mba|msc|bsc|ma|ba|esq)\.?$"
PARTICLES = ["von", "van", "de", "der", "den", "di", "da", "du", "la", "le", "zu", "zum", "zur", "del", "bin", "al", "ter"]


def split_name(c: Column | str) -> Column:
    """struct(first, last), both null unless both can be told."""
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(clean(c), r"(?U)\s+", " "), SUFFIXES, ""), TITLES, "")
    turned = F.concat(F.trim(F.substring_index(s, ",", -1)), F.lit(" "), F.trim(F.substring_index(s, ",", 1)))
    s = F.when(s.rlike(r"^[^,]+,[^,]+$"), F.regexp_replace(turned, TITLES, "")).otherwise(s)
    words = F.split(s, " ")
    parts = F.transform(words, lambda w, i: F.lower(w).isin(PARTICLES) & (i > 0))
    at = F.array_position(parts, True)
    last = F.when(at > 0, F.array_join(F.slice(words, at.cast("int"), F.size(words)), " ")).otherwise(F.element_at(words, -1))
    ok = (F.size(words) >= 2) & (words[0] != "") & (last != "")
    return F.when(ok, F.struct(words[0].alias("first"), last.alias("last"))).otherwise(F.struct(F.lit(None).cast("string").alias("first"), F.lit(None).cast("string").alias("last")))
