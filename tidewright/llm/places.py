"""Postal addresses of one place, written differently.

The hierarchy is matched from the top. Every address is parsed into postcode, town, street, number and unit. Regions first:
a postcode stands for the town most of its addresses name. Localities: a town is read as its standard spelling, or as the
town of its postcode if it resembles that; a missing town is inherited from the postcode, else from the contact's location,
else from the only town that knows the same street and number; several such towns stay explicit as ``ambiguous``. Streets:
the standard spelling over all towns (types written alike: Str., strasse, -straße); a spelling is read
as a street of the same town with the same number within two edits that is ``RATIO`` times as frequent over all towns, or
as the first of two that are each seen once only.
Numbers are compared as written (12, 12a and 12-14 are three); units are parsed and left out of the place.

Standard spellings come from counts, so hot towns or streets are single rows; addresses themselves are only joined to
lookup tables on their keys. PO boxes, bare towns and texts without street and number are no places (status ``none``).
Null and blank addresses are left out. Contacts that repeat an address are one member of its place.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.memo import memo
from tidewright.functions.text import german_fold
from tidewright.llm.edits import standard_spellings
from tidewright.session import broadcast_if_small, checkpointed

#: A street this many times as frequent (over all towns) may be meant by another spelling in the same town with the same number.
RATIO = 2

_PARSED = T.StructType([T.StructField(n, T.StringType()) for n in ("postcode", "town", "street", "number", "unit")])


@memo
def _patterns() -> dict[str, re.Pattern]:
    return {
        "care": re.compile(r"(?:c\s*/\s*o|z\.\s*hd\.?|attn\.?|bei)\s[^,;|]*[,;|]"),
        "country": re.compile(r"\(\s*(?:de|d|at|ch|fr)\s*\)|\b(?:deutschland|germany|allemagne|federal republic of germany|österreich|schweiz)\b"),
        "box": re.compile(r"\b(?:postfach|p\.?\s*o\.?\s*box|pf|boîte postale|postbox)\b"),
        "unit": re.compile(
            r"\(?\b(?:aufgang|eingang|haus|gebäude|geb\.|block|raum|zimmer|top|tür|suite|room|flat|apt\.?|bldg\.?)\s*(?:nr\.?\s*)?(?:\d{1,3}|[a-z])\b\)?"
            r"|\b\d{1,2}\.?\s*(?:og|ug|stock|etage|obergeschoss|hinterhof|hof|floor|étage|hh)\b\.?(?:\s*(?:links|rechts|mitte|left|right))?"
            r"|\b(?:eg|erdgeschoss|dg|dachgeschoss|hinterhaus|hinterhof|seitenflügel|vorderhaus|ground floor)\b(?:\s*(?:links|rechts|mitte))?"
        ),
        "postcode": re.compile(r"(?<![\w-])(?:(?:d|de)\s*-?\s*)?(\d{5})(?!\d)"),
        "number": re.compile(r"(?<![\w])(\d{1,4})\s?([a-z](?![\w.]))?(?:\s?(?:-|–|—|/|bis)\s?(\d{1,4})\s?([a-z](?![\w.]))?)?(?![\w])"),
        "label": re.compile(r"[\s,.:]*\b(?:nr|no|nummer|hausnr|hausnummer)\b\.?\s*$"),
    }


def town_key(text: str) -> str:
    """Letters only, ä as ae, ß as ss, other accents dropped."""
    s = text.lower()
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), ("ø", "oe"), ("ł", "l")):
        s = s.replace(a, b)
    return "".join(c for c in unicodedata.normalize("NFKD", s) if c.isalpha())


def street_key(text: str) -> str:
    """As ``town_key``, with the abbreviated street types spelled out."""
    s = town_key(text)
    for short, long in (("str", "strasse"), ("strase", "strasse"), ("pl", "platz")):
        if s.endswith(short) and not s.endswith(long) and len(s) > len(short) + 2:
            return s[: -len(short)] + long
    return s


def parse(text: str | None) -> tuple[str | None, ...]:
    """(postcode, town, street, number, unit); None for what is missing. No street or no number: no place."""
    p = _patterns()
    s = re.sub(r"[\n\r\t;|]+", ",", unicodedata.normalize("NFC", text or "").lower())
    s = re.sub(r"\s+", " ", s).strip()
    s = p["care"].sub(" ", s + ",", count=1) if p["care"].match(s + ",") else s
    s = p["country"].sub(" ", s)
    box = bool(p["box"].search(s))
    units = [m[0] for m in p["unit"].finditer(s)]
    s = p["unit"].sub(" , ", s)
    codes = p["postcode"].findall(s)
    s = p["postcode"].sub(" | ", s)
    parts, street, number, towns, after_code = [], None, None, [], []
    for i, piece in enumerate(re.split(r"(\||,)", s)):
        parts.append((piece, i))
    following = False
    for piece, _ in parts:
        if piece in ("|", ","):
            following = following or piece == "|"
            continue
        piece = piece.strip(" .-–()/")
        if not piece:
            continue
        m = p["number"].search(piece) if street is None and not box else None
        if m:
            before = p["label"].sub("", piece[: m.start()]).strip(" .,-–")
            rest = piece[m.end() :].strip(" .,-–()")
            number = m[1].lstrip("0") + (m[2] or "") + (f"-{m[3].lstrip('0')}{m[4] or ''}" if m[3] else "")
            if before:
                street, rest_town = before, rest
            else:
                street, rest_town = rest, ""
            if rest_town:
                (after_code if following else towns).append(rest_town)
        elif re.search(r"[^\W\d_]", piece):
            (after_code if following else towns).append(piece)
    town = after_code[0] if after_code else (towns[-1] if towns else None)
    key = street_key(street) if street else ""
    if not key or not number or box:
        return (codes[0] if codes else None, town_key(town) or None if town else None, None, None, None)
    return (codes[0] if codes else None, (town_key(town) or None) if town else None, key, number, ", ".join(units) or None)


@F.pandas_udf(_PARSED)
def _parse_all(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse(t) for t in texts], columns=["postcode", "town", "street", "number", "unit"])


def addresses(df: DataFrame, key: str, address: str, alternatives: str | None, location: str | None) -> DataFrame:
    """(key, pos, address, location, postcode, town, street, number, unit): pos 0 is the address, 1.. its alternatives."""
    more = F.split(F.coalesce(F.col(alternatives), F.lit("")), r"\s\|\s") if alternatives else F.array().cast("array<string>")
    listed = F.concat(F.array(F.coalesce(F.col(address), F.lit(""))), more)
    where = german_fold(F.regexp_replace(F.col(location), r"(?i)^(?:region|raum|kreis|großraum|greater)\s+|\s+(?:nord|süd|ost|west|mitte|north|south|east)$", "")) if location else F.lit("")
    rows = df.select(key, F.nullif(F.regexp_replace(where, r"[^\p{L}]", ""), F.lit("")).alias("location"), F.posexplode(listed).alias("pos", "address"))
    return rows.where(F.col("address").rlike(r"[\p{L}\p{N}]")).withColumn("p", _parse_all("address")).select(key, "pos", "address", "location", "p.*")


def places(parsed: DataFrame, key: str) -> DataFrame:
    """(key, pos, address, town, street, number, unit, status): the standard place of every address; status ``place``,
    ``ambiguous`` (street and number known in several towns) or ``none``. ``parsed`` should be checkpointed."""
    # Towns: standard spelling over all addresses, then what most addresses of a postcode say.
    towns = standard_spellings(parsed.groupBy("town").agg(F.count(F.lit(1)).alias("n")), [], "town").withColumnRenamed("standard", "std_town")
    towns = checkpointed(towns)
    named = parsed.join(broadcast_if_small(towns), "town", "left")
    votes = named.where("postcode is not null and std_town is not null").groupBy("postcode", "std_town").agg(F.count(F.lit(1)).alias("n"))
    by_code = votes.groupBy("postcode").agg(F.max_by("std_town", F.struct("n", "std_town")).alias("code_town"))
    known = towns.select(F.col("std_town").alias("location")).distinct().withColumn("loc_town", F.col("location"))
    named = named.join(by_code, "postcode", "left").join(broadcast_if_small(known), "location", "left")
    like_code = F.levenshtein("town", "code_town", 2) >= 0
    named = named.withColumn("std_town", F.when(F.col("code_town").isNotNull() & like_code, F.col("code_town")).otherwise(F.coalesce("std_town", "code_town", "loc_town")))
    # Streets: standard spelling over all towns, then among the streets of the same town and number.
    streets = standard_spellings(named.groupBy("street").agg(F.count(F.lit(1)).alias("n")), [], "street").withColumnRenamed("standard", "std_street")
    placed = checkpointed(named.join(streets, "street", "left"))
    local = placed.where("std_street is not null and std_town is not null").groupBy("std_town", "number", "std_street").agg(F.count(F.lit(1)).alias("n"))
    wide = local.groupBy("std_street").agg(F.sum("n").alias("n_wide"))
    local = local.join(wide, "std_street")
    sound = local.select("std_town", "number", F.col("std_street").alias("near_street"), F.col("n_wide").alias("n_near"))
    short = F.regexp_replace(F.regexp_replace("near_street", "strasse$", "str"), "platz$", "pl")
    close = F.least(*[F.when(F.levenshtein("std_street", x, 2) >= 0, F.levenshtein("std_street", x)) for x in (F.col("near_street"), short)])
    likelier = f"n_near >= {RATIO} * n_wide or (n_near = 1 and n_wide = 1 and near_street < std_street)"
    near = local.join(sound, ["std_town", "number"]).where(likelier).withColumn("_d", close).where("_d >= 0")
    near = near.groupBy("std_town", "number", "std_street").agg(F.min(F.struct("_d", (-F.col("n_near")).alias("m"), "near_street"))["near_street"].alias("near_street"))
    placed = placed.join(near, ["std_town", "number", "std_street"], "left").withColumn("std_street", F.coalesce("near_street", "std_street"))
    # No town at all: the only town that knows this street and number.
    candidates = placed.where("std_town is not null and std_street is not null").groupBy("std_street", "number").agg(F.min("std_town").alias("only_town"), F.count_distinct("std_town").alias("n_towns"))
    placed = placed.join(candidates, ["std_street", "number"], "left")
    town = F.coalesce("std_town", F.when(F.col("n_towns") == 1, F.col("only_town")))
    status = F.when(F.col("std_street").isNull(), "none").when(town.isNotNull(), "place").when(F.col("n_towns") > 1, "ambiguous").otherwise("none")
    return placed.select(key, "pos", "address", town.alias("town"), F.col("std_street").alias("street"), "number", "unit", status.alias("status"))


def place_key(df: DataFrame) -> Column:
    return F.concat_ws("/", df["town"], df["street"], df["number"])


def pairs(place: DataFrame, key: str) -> DataFrame:
    """(id_a, id_b), id_a < id_b, of keys that share a place."""
    members = checkpointed(place.where("status = 'place'").select(key, "town", "street", "number").distinct())
    a = members.withColumnRenamed(key, "id_a")
    b = members.withColumnRenamed(key, "id_b")
    return a.join(b, ["town", "street", "number"]).where("id_a < id_b").select("id_a", "id_b").distinct()
