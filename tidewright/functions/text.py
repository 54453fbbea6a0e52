"""Text columns: trimming, missing values, matching keys. All expressions stay inside the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a cell holds when it only says that there is no value, written without punctuation, lower case.
NO_VALUE_WORDS = [
    "nan", "none", "null", "nil", "na", "nn", "ka", "tbd", "tba", "tbc", "unknown", "unbekannt", "missing", "empty", "leer",
    "keineangabe", "keineangaben", "ohneangabe", "keine", "nichtbekannt", "nichtangegeben", "nichtvorhanden", "fehlt",
    "fehltnoch", "entfällt", "folgt", "wirdnachgereicht", "notavailable", "notapplicable", "notknown", "notgiven",
    "novalue", "nodata", "noinformation", "noentry", "nv", "undefined",
]

BLANK_ENDS = r"(?U)^[\s\p{Cf}]+|[\s\p{Cf}]+$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, and generated code that doesn't repeat it."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column | str) -> Column:
    """Cut Unicode white space at both ends (``trim`` only knows U+0020); null stays null."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def clean(c: Column | str) -> Column:
    """Stripped text, "" for null."""
    return F.coalesce(strip(c), F.lit(""))


def blank_to_null(c: Column | str) -> Column:
    """Stripped text, null for blank."""
    return F.nullif(strip(c), F.lit(""))


def val(c: Column | str, also_na: bool = True) -> Column:
    """Null for blank, nan, none, <na> and (by default) na, in either case; otherwise the stripped text."""
    words = ["", "nan", "none", "<na>"] + (["na"] if also_na else [])
    s = strip(c)
    return F.when(F.lower(s).isin(words), F.lit(None).cast("string")).otherwise(s)


def nonblank(c: Column | str) -> Column:
    """True where a text has a character that is not white space; false for null."""
    return F.coalesce(_c(c).rlike(r"(?U)\S"), F.lit(False))


def is_missing(c: Column | str) -> Column:
    """True for null, blank, texts without letter or digit, and texts that only say there is no value."""
    c = _c(c)
    says_none = (F.length(c) < 40) & F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]", "")).isin(NO_VALUE_WORDS)
    return F.coalesce(~c.rlike(r"[\p{L}\p{N}]") | says_none, F.lit(True))


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    """Characters whose compatibility decomposition is one base character plus marks, and those base characters."""
    source, target = [], []
    for code in range(0xA0, 0x10000):
        if 0xD800 <= code < 0xE000 or 0xAC00 <= code < 0xD7A4:
            continue
        char = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFKD", char) if not unicodedata.combining(x))
        if len(base) == 1 and base != char and base.isalnum():
            source.append(char)
            target.append(base)
    return "".join(source), "".join(target)


@lru_cache(maxsize=1)
def _expansions() -> dict[str, str]:
    """Letters, fractions and signs whose compatibility decomposition is several characters (¼ to 1⁄4, ™ to TM, ﬁ to fi)."""
    out = {}
    for code in [*range(0xA0, 0x2C00), *range(0xFB00, 0xFB07)]:
        base = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(x))
        if len(base) > 1 and base.isascii() | ("⁄" in base) and any(x.isalnum() for x in base):
            out[chr(code)] = base
    return out


def fold_accents(c: Column | str) -> Column:
    """Letters without their accents (ü to u, é to e), compatibility characters as plain ones; marks that stand alone are
    dropped; ß and ł stay."""
    source, target = _fold_table()
    c = _c(c)
    table = F.create_map(*[F.lit(x) for kv in _expansions().items() for x in kv])
    rare = "[" + "".join(_expansions()) + "]"
    spelled = F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(table[x], x)), "")
    return F.regexp_replace(F.translate(F.when(c.rlike(rare), spelled).otherwise(c), source, target), r"\p{M}+", "")


def match_key(c: Column | str) -> Column:
    """Lower case, accents folded, everything but word characters to one space, stripped; "" for null. ß and _ survive."""
    folded = fold_accents(F.lower(F.coalesce(_c(c), F.lit(""))))
    spaced = F.regexp_replace(folded, r"(?U)[^\w\s]", " ")
    return F.trim(F.regexp_replace(spaced, r"(?U)\s+", " "))


def german_fold(c: Column | str) -> Column:
    """Lower case, umlauts and ß spelled out (ä to ae, ß to ss), other accents folded."""
    c = F.lower(F.coalesce(_c(c), F.lit("")))
    for a, b in (("ä", "ä"), ("ö", "ö"), ("ü", "ü"), ("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), ("ø", "oe"), ("ł", "l"), ("æ", "ae")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return fold_accents(c)


def unique_list(values: Column) -> Column:
    """Strip each value, cut ``.,;:`` at its end, drop blanks, keep the first of values equal but for case."""
    tidy = F.transform(values, lambda v: F.regexp_replace(strip(v), r"[.,;:]+$", ""))
    kept = F.filter(tidy, lambda v: v.isNotNull() & (v != ""))
    lowered = F.transform(kept, lambda v: F.lower(v))
    return F.filter(kept, lambda v, i: F.array_position(lowered, F.lower(v)) == i + 1)


def split_pipes(c: Column | str) -> Column:
    """Non-blank parts of a text joined by ``|``; an empty array for null."""
    parts = F.transform(F.split(F.coalesce(_c(c), F.lit("")), r"\|"), strip)
    return F.filter(parts, lambda v: v != "")


def join_pipes(values: Column) -> Column:
    """Array to ``a | b``; "" for an empty array."""
    return F.array_join(values, " | ")


def slugify(c: Column | str) -> Column:
    """Without punctuation, white space and ``_`` to ``-``, lower case, at most 80 characters."""
    s = F.regexp_replace(F.lower(strip(c)), r"(?U)[^\w\s-]", "")
    return F.substring(F.regexp_replace(s, r"(?U)[\s_]+", "-"), 1, 80)
