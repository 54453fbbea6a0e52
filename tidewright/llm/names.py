"""Spellings of one organisation or person, as people typed them.

Organisations. A row that gives a well-formed address of a domain of the organisation's own is told by that domain (mailbox
providers are recognised by the many unlike names that use them). Names are brought to a key (damaged encoding undone, legal
forms, punctuation and case dropped); keys that belong to one domain bring rows without a domain to it. The remaining keys
are joined to the known ones within an edit radius by metric-space partitioning: rings around the empty key (lengths) and
segments, then a bounded sample of known keys as pivots divide the cells that would compare too many pairs. Known keys are
replicated to every cell that may hold one of their pairs (triangle inequality: no pair within the radius is lost), and inside
a cell an exact radius join runs under the Levenshtein metric, behind cheap bounds on letters and on distances to the pivot.
Keys without a town, initials and abbreviated words are resolved by the row's location or by the words that are left.

Persons are compared within their organisation: parts of the name are brought to the standard spelling of the organisation
(one edit), the same radius join finds parts of it two edits apart, and persons whose parts are equal or so near are one;
order is ignored, nicknames and initials stand for the first name they fit, a family name alone for its only bearer.

Rows whose cell is missing or names nobody are left out. Exact repeats share a class and are no pair.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.memo import memo
from tidewright.functions.text import is_missing, strip
from tidewright.llm.edits import followed, one_edit, standard_spellings
from tidewright.llm.mojibake import restore
from tidewright.session import broadcast_if_small, checkpointed

#: Pivots drawn from a cell that is divided, pairs that a cell may compare, and divisions by pivots at most.
PIVOTS = 64
HEAVY = 20_000_000
LEVELS = 4
#: Edit radius of names (two: a swap of neighbours costs two edits); keys below SHORTEST letters meet within one edit or swap,
#: those below SHORTEST_SLIP (initials, where one letter makes another name) exactly.
RADIUS = 2
SHORTEST = 9
SHORTEST_SLIP = 5
#: Parts of a person's name of this length or more meet within the radius, shorter ones within one edit or swap, those below
#: SHORTEST_SLIP_PART exactly.
SHORTEST_PART = 7
SHORTEST_SLIP_PART = 4
#: Organisations from which a part of persons' names counts as established.
ESTABLISHED = 3

#: Bounds of a broadcast here: many lookup tables live side by side, and the driver keeps each until it is collected.
FEW_ROWS, FEW_BYTES = 5_000, 256 << 10

_HOST = r"((?:[A-Z0-9](?:[A-Z0-9-]*[A-Z0-9])?\.)++[A-Z]{2,})"
_EMAIL_HOST = rf"(?i)^[A-Z0-9_%+-]++(?:\.[A-Z0-9_%+-]++)*+@{_HOST}$"
_WEB_HOST = rf"(?i)^(?:https?://)?(?:www\.)?{_HOST}(?::[0-9]++)?(?:[/?]\S*+)?$"


def _small(df: DataFrame) -> DataFrame:
    return broadcast_if_small(df, FEW_ROWS, FEW_BYTES)


def email_host(c: Column | str) -> Column:
    """Lower-case host of a well-formed e-mail address; null for anything else."""
    return F.nullif(F.lower(F.regexp_extract(strip(c), _EMAIL_HOST, 1)), F.lit(""))


def web_host(c: Column | str) -> Column:
    """Lower-case host of a well-formed web address, without ``www.``; null for anything else."""
    return F.nullif(F.lower(F.regexp_extract(strip(c), _WEB_HOST, 1)), F.lit(""))


def damaged_label(c: Column | str) -> Column:
    """First label of the host that a misspelt address seems to hold (``https;//a-b.example``, ``x(at)a-b,example``)."""
    s = F.regexp_replace(F.lower(F.coalesce(strip(c), F.lit(""))), r"\s*(?:\(at\)|\[at\]|@+)\s*", "@")
    s = F.regexp_replace(s, r"\s*(?:\(dot\)|\[dot\]|,|\.)\s*", ".")
    return F.nullif(F.regexp_extract(s, r"(?:@|/|^|\s|<|www\.)-?([a-z0-9][a-z0-9-]{4,})(?=\.|>|/|$)(?!\S*@)", 1), F.lit(""))


# ---------------------------------------------------------------------------------------------- organisations

# Legal forms, longest first, after folding and with dots and blanks optional.
LEGAL_FORMS = [
    r"g ?gmbh", r"gemeinnuetzige ?gmbh", r"gemeinnutzige ?gmbh", r"gmbh (?:und )?co ?kg", r"gmbh", r"g m b h", r"mbh", r"m b h", r"ug haftungsbeschr\w*", r"ug",
    r"haftungsbeschr\w*", r"aktiengesellschaft", r"ag", r"a g", r"eingetragene ?genossenschaft", r"eg", r"e g", r"eingetragener ?verein", r"ev", r"e v", r"gbr", r"ohg", r"kg", r"ltd", r"inc",
]


def fold(text: str) -> str:
    """Lower case, umlauts and ß spelled out, accents dropped."""
    s = unicodedata.normalize("NFC", text).lower()
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), ("ø", "oe"), ("ł", "l")):
        s = s.replace(a, b)
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def squeeze(text: str) -> str:
    """ae, oe, ue as a, o, u, so that spelled-out, kept and dropped umlauts agree."""
    return text.replace("ae", "a").replace("oe", "o").replace("ue", "u")


def _squeezed(c: Column) -> Column:
    for a, b in (("ae", "a"), ("oe", "o"), ("ue", "u")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


@memo
def _legal() -> re.Pattern:
    return re.compile(r"(?<!\w)(?:" + "|".join(LEGAL_FORMS) + r")(?!\w)")


def org_words(text: str) -> list[str]:
    """Words of a name without legal forms; an abbreviated word keeps its dot."""
    s = fold((restore(text)[1] or text).strip())
    s = re.sub(r"(?<!\w)((?:\w\.\s?){2,})", lambda m: m[1].replace(".", " ") + " ", s)  # e.V., G.m.b.H.
    s = re.sub(r"&", " und ", s)
    s = re.sub(r"\b(\w{3,})\.(?=\s|$|,)", r"\1·", s)
    s = re.sub(r"[^\w·]+", " ", s.replace("_", " "))
    s = re.sub(r"\s+", " ", s).strip()
    bare = _legal().sub(" ", s)
    words = [w for w in bare.split() if w not in ("in", "und")]
    return [w.replace("·", ".") for w in words] or s.replace("·", "").split()


_ORG = T.StructType([T.StructField("key", T.StringType()), T.StructField("bag", T.StringType()), T.StructField("words", T.ArrayType(T.StringType()))])


@F.pandas_udf(_ORG)
def _org_keys(names: pd.Series) -> pd.DataFrame:
    rows = []
    for name in names:
        words = org_words(name) if name else []
        plain = [squeeze(w.rstrip(".")) for w in words]
        rows.append(("".join(plain), " ".join(sorted(plain)), words))
    return pd.DataFrame(rows, columns=["key", "bag", "words"])


def host_label(c: Column) -> Column:
    """Letters of the first label of a host, squeezed like a name."""
    return _squeezed(F.regexp_replace(F.regexp_extract(c, r"^(?:(?:blog|shop|alt|mail|info)\.)?([^.]+)", 1), "[^a-z0-9]", ""))


def own_hosts(rows: DataFrame) -> DataFrame:
    """(host) that stand for one organisation: the names of a third or more of their named rows resemble the host's label,
    or fewer than three rows are named. Mailbox providers and placeholder hosts fail this."""
    label = host_label(F.col("host"))
    close = (F.levenshtein(label, "key") <= F.greatest(F.length(label), F.length("key")) * 0.35) | label.startswith(F.col("key")) | F.col("key").startswith(label)
    uses = rows.where("host is not null").groupBy("host", "key").agg(F.count(F.lit(1)).alias("n"))
    uses = uses.withColumn("named", F.when(F.col("key").isNotNull(), F.col("n")).otherwise(0)).withColumn("like", F.when(F.coalesce(close, F.lit(False)), F.col("n")).otherwise(0))
    totals = uses.groupBy("host").agg(F.sum("named").alias("named"), F.sum("like").alias("like"))
    return totals.where((F.col("named") < 3) | (F.col("like") * 3 >= F.col("named"))).select("host")


def radius_join(unknown: DataFrame, known: DataFrame, key: str, radius: int = RADIUS, scope: tuple[str, ...] = (), pivots: int = PIVOTS, heavy: int = HEAVY, levels: int = LEVELS) -> DataFrame:
    """(scope, key, known_key, distance) of every pair of distinct keys within ``radius`` edits, by metric-space partitioning.

    Both sides hold distinct keys and should be checkpointed. Keys meet only where the columns of ``scope`` are equal: each scope
    is a cell at first. Where more than ``heavy`` pairs would be compared in a cell, all are divided by rings and segments, and
    cells that are still heavy by pivots; neither loses a pair within the radius:

    * rings: the length of a key is its distance to the empty key, so a key meets the lengths within the radius only;
    * segments of a ring: of ``radius + 1`` segments of an unknown key one at least is untouched and stands in the known key, moved by no
      more than the edits before and after it allow;
    * pivots, ``levels`` times: up to ``pivots`` of the known keys are drawn by hash, each unknown key goes to the cell of its
      nearest pivot, each known key to every cell whose pivot is within its nearest distance plus twice the radius (triangle
      inequality). What is then still heavy (keys that are all alike can't be told apart by pivots), the join itself splits.

    Inside a cell the letters that two keys don't share bound their distance before it is computed: one edit changes two at
    most. Nothing but the number of heavy cells reaches the driver.
    """
    group = [*scope, "cell"]
    none = F.lit(None).cast("int")
    u = unknown.select(*scope, key, F.substring(key, 1, 0).alias("cell"), none.alias("_du"), _letters(F.col(key)).alias("_mu"))
    k = known.select(*scope, F.col(key).alias("known_key"), F.substring(key, 1, 0).alias("cell"), none.alias("_dk"), _letters(F.col(key)).alias("_mk"))

    def heavy_cells() -> DataFrame:
        sizes = u.groupBy(*group).agg(F.count(F.lit(1)).alias("_nu")).join(k.groupBy(*group).agg(F.count(F.lit(1)).alias("_nk")), group)
        return sizes.where(F.col("_nu") * F.col("_nk") > heavy).select(*group)

    repeated = False
    for _ in range(levels + 1):
        cells = heavy_cells()
        if cells.isEmpty():
            break
        if not repeated:
            u, k = _segments(u, k, key, radius)
            repeated = True
            continue
        cells = checkpointed(cells)
        chosen = _small(cells)
        drawn = k.join(chosen, group).groupBy(*group, F.pmod(F.xxhash64("known_key"), F.lit(pivots)).alias("_b")).agg(F.min_by("known_key", F.xxhash64("known_key", F.lit(1))).alias("_p"))
        centres = _small(checkpointed(drawn.groupBy(*group).agg(F.array_sort(F.collect_list("_p")).alias("_c"))))
        du = F.transform("_c", lambda p: F.levenshtein(F.col(key), p))
        own = u.join(centres, group).withColumn("_d", du).withColumn("_du", F.array_min("_d"))
        place = F.array_position("_d", F.col("_du")).cast("string")
        own = own.withColumn("cell", F.concat("cell", F.lit("/"), place))
        dk = F.transform("_c", lambda p: F.levenshtein(F.col("known_key"), p))
        near = F.transform("_d", lambda d, i: F.when(d <= F.array_min("_d") + 2 * radius, F.struct((i + 1).cast("string").alias("place"), d.alias("_dk"))))
        copies = k.join(centres, group).withColumn("_d", dk).withColumn("c", F.explode(F.array_compact(near)))
        copies = copies.withColumn("cell", F.concat("cell", F.lit("/"), "c.place")).withColumn("_dk", F.col("c._dk"))
        u = checkpointed(u.join(chosen, group, "left_anti").unionByName(own.select(*u.columns)))
        k = checkpointed(k.join(chosen, group, "left_anti").unionByName(copies.select(*k.columns)))
    # The cheapest bound first. Keys of a ring are within the radius in length.
    close = F.bit_count(F.col("_mu").bitwiseXOR(F.col("_mk"))) <= 2 * radius
    close = close & (F.coalesce(F.abs(F.col("_du") - F.col("_dk")) <= radius, F.lit(True)) if repeated else F.abs(F.length(key) - F.length("known_key")) <= radius)
    pairs = u.join(k, group).where(close).withColumn("distance", F.levenshtein(key, "known_key", radius)).where("distance >= 0")
    pairs = pairs.select(*scope, key, "known_key", "distance")
    return pairs.distinct() if repeated else pairs


def _letters(key: Column) -> Column:
    """A bit for each letter of a key (letters may share one)."""
    return F.aggregate(F.split(key, ""), F.lit(0).cast("long"), lambda acc, x: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(x), F.lit(64)))))


def _segments(u: DataFrame, k: DataFrame, key: str, radius: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with the cells of their rings and segments. A ring is a length of unknown keys; segment i of ``radius + 1``
    (from 0) stands in a known key that is d letters longer moved by at most i (the edits before it) and by d give or take
    ``radius - i`` (those after it)."""
    part = F.floor(F.col("_ring") / (radius + 1)).cast("int")
    cell = lambda i, text: F.concat("_ring", F.lit(f"/{i}:"), text)
    size = lambda i: part if i < radius else F.col("_ring") - part * radius
    own = F.array(*[cell(i, F.substr(key, part * i + 1, size(i))) for i in range(radius + 1)])
    longer = F.length("known_key") - F.col("_ring")
    moved = [
        F.when((F.abs(F.lit(m) - longer) <= radius - i) & (part * i + 1 + m >= 1), cell(i, F.substr("known_key", part * i + 1 + m, size(i))))
        for i in range(radius + 1) for m in range(-i, i + 1)
    ]
    rings = F.explode(F.sequence(F.length("known_key") - radius, F.length("known_key") + radius))
    u = u.withColumn("_ring", F.length(key)).withColumn("cell", F.explode(own)).drop("_ring")
    return u, k.withColumn("_ring", rings).withColumn("cell", F.explode(F.array_distinct(F.array_compact(F.array(*moved))))).drop("_ring")


def organisation_classes(contacts: DataFrame, key: str = "ID") -> DataFrame:
    """(key, organisation, spelled, how): the organisation of every row that tells one, its name where the cell has one, and by
    which step it was told.

    ``organisation`` is the own domain, or a class of names without any domain.
    """
    cells = contacts.select(
        F.col(key).alias("id"), F.when(~is_missing("Organisation_Name"), F.col("Organisation_Name")).alias("name"), email_host("Email").alias("eh"), web_host("Website").alias("wh"),
        damaged_label("Website").alias("wl"), damaged_label("Email").alias("el"), strip(F.coalesce("Location", F.lit(""))).alias("loc"),
    )
    names = checkpointed(cells.select("name").where("name is not null").distinct().withColumn("k", _org_keys("name")).select("name", "k.*"))
    rows = checkpointed(cells.join(names.withColumnRenamed("name", "n2"), F.col("name") == F.col("n2"), "left").drop("n2"))
    stacked = rows.select("key", F.explode(F.array_distinct(F.array_compact(F.array("eh", "wh")))).alias("host"))
    hosts = checkpointed(own_hosts(stacked))
    known = _small(hosts)
    rows = rows.join(known.select(F.col("host").alias("wh"), F.col("host").alias("w")), "wh", "left").join(known.select(F.col("host").alias("eh"), F.col("host").alias("e")), "eh", "left")
    # A misspelt address tells its organisation beside a name, if its label is that of one known host.
    labels = hosts.select(F.regexp_extract("host", r"^([^.]+)", 1).alias("label"), "host").groupBy("label").agg(F.min("host").alias("h"), F.count(F.lit(1)).alias("c")).where("c = 1")
    labels = labels.select("label", "h")
    rows = rows.join(labels.select(F.col("label").alias("wl"), F.col("h").alias("lw")), "wl", "left").join(labels.select(F.col("label").alias("el"), F.col("h").alias("le")), "el", "left")
    helped = F.when(F.col("key").isNotNull(), F.coalesce("lw", "le"))
    rows = checkpointed(rows.withColumn("host", F.coalesce("w", "e", helped)).select("id", "name", "key", "bag", "words", "loc", "host"))
    told = rows.where("host is not null and key is not null")
    spelled_keys = told.select("key", "host").distinct().unionByName(hosts.select(host_label(F.col("host")).alias("key"), "host")).distinct()
    by_key = checkpointed(_only(spelled_keys, "key").select("key", F.col("h").alias("key_host")))
    by_bag = _only(told.select("bag", "host").distinct(), "bag").select("bag", F.col("h").alias("bag_host"))
    open_ = rows.where("host is null and key is not null").join(by_key, "key", "left").join(by_bag, "bag", "left").withColumn("found", F.coalesce("key_host", "bag_host"))
    open_ = checkpointed(open_.select("id", "name", "key", "bag", "words", "loc", "found", "key_host", "bag_host"))
    rest = checkpointed(open_.where("found is null").select("key", "bag", "words", "loc").distinct())
    asked = rest.where(F.length("key") >= SHORTEST_SLIP).select("key").distinct()
    near = _by_length(radius_join(checkpointed(asked), checkpointed(by_key.where(F.length("key") >= SHORTEST_SLIP)), "key")).join(by_key.withColumnRenamed("key", "known_key"), "known_key")
    least = near.groupBy("key", "key_host").agg(F.min("distance").alias("d")).groupBy("key").agg(F.min("d").alias("m"), F.collect_list(F.struct("d", "key_host")).alias("all"))
    least = least.withColumn("best", F.filter("all", lambda x: x["d"] == F.col("m"))).where(F.size("best") == 1).select("key", F.col("best")[0]["key_host"].alias("near_host"))
    least = checkpointed(least)
    spelled = _by_standard_words(rest.join(least.select("key"), "key", "left_anti"), rows, by_key, by_bag)
    short = _by_words(rest, told)
    # Keys without any domain are joined among themselves.
    open_ = open_.join(spelled, "key", "left").join(least, "key", "left").join(short, ["key", "loc"], "left")
    how = F.when(F.col("key_host").isNotNull(), "equal key").when(F.col("bag_host").isNotNull(), "equal words").when(F.col("near_host").isNotNull(), "radius").when(F.col("spelled_host").isNotNull(), "words").when(F.col("word_host").isNotNull(), "pattern")
    open_ = checkpointed(open_.select("id", F.col("name").alias("spelled"), F.coalesce("found", "near_host", "spelled_host", "word_host").alias("host"), F.col("key").alias("own"), how.alias("how")))
    slips = _own_spellings(open_.where("host is null and own <> ''").groupBy(F.col("own").alias("key")).agg(F.count(F.lit(1)).alias("n")))
    open_ = open_.join(slips.select(F.col("node").alias("own"), "target"), "own", "left")
    how = F.coalesce("how", F.when(F.col("target").isNotNull(), "radius, no domain").otherwise("own key"))
    open_ = open_.select("id", F.coalesce("host", F.concat(F.lit("name:"), F.coalesce("target", "own"))).alias("organisation"), "spelled", how.alias("how"))
    direct = rows.where("host is not null").select("id", F.col("host").alias("organisation"), F.col("name").alias("spelled"), F.lit("domain").alias("how"))
    return direct.unionByName(open_).withColumnRenamed("id", key)


def _by_length(near: DataFrame) -> DataFrame:
    """Of pairs within the radius those that their length allows: short keys differ by one edit or swap."""
    return near.where((F.least(F.length("key"), F.length("known_key")) >= SHORTEST) | one_edit(F.col("key"), F.col("known_key")))


def _own_spellings(counts: DataFrame) -> DataFrame:
    """(node, target): keys of (key, n) read as the nearest, then most frequent key within the radius, followed to the end."""
    keys = checkpointed(counts.where(F.length("key") >= SHORTEST_SLIP))
    near = _by_length(radius_join(keys, keys, "key")).join(keys, "key").join(keys.select(F.col("key").alias("known_key"), F.col("n").alias("m")), "known_key")
    upward = (F.col("m") > F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("known_key") < F.col("key")))
    return followed(near.where(upward).groupBy(F.col("key").alias("node")).agg(F.min(F.struct("distance", (-F.col("m")).alias("m"), "known_key"))["known_key"].alias("target")))


def _only(df: DataFrame, key: str) -> DataFrame:
    """(key, h): keys that belong to one host."""
    return df.groupBy(key).agg(F.min("host").alias("h"), F.count_distinct("host").alias("c")).where("c = 1").drop("c")


def _by_standard_words(rest: DataFrame, rows: DataFrame, by_key: DataFrame, by_bag: DataFrame) -> DataFrame:
    """(key, spelled_host): names whose rare words, each read as the frequent word one edit away, are those of one host."""
    counts = rows.where("key is not null").select(F.explode(F.split("bag", " ")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    standard = standard_spellings(counts, [], "w", ratio=5).join(counts, "w").where("w <> standard").select("w", "standard")
    words = rest.select("key", F.posexplode(F.transform("words", lambda w: _squeezed(F.regexp_replace(w, r"\.$", "")))).alias("i", "w")).distinct()
    read = words.join(standard, "w", "left").withColumn("r", F.coalesce("standard", "w"))
    again = read.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("i", "r"))).alias("l"), F.max(F.col("standard").isNotNull()).alias("changed")).where("changed")
    again = again.select(F.col("key").alias("raw"), F.array_join(F.transform("l", lambda x: x["r"]), "").alias("key"), F.array_join(F.array_sort(F.transform("l", lambda x: x["r"])), " ").alias("bag"))
    found = again.join(by_key, "key", "left").join(by_bag, "bag", "left").withColumn("spelled_host", F.coalesce("key_host", "bag_host"))
    return found.where("spelled_host is not null").groupBy(F.col("raw").alias("key")).agg(F.min("spelled_host").alias("spelled_host"))


def _by_words(rest: DataFrame, told: DataFrame) -> DataFrame:
    """(key, loc, word_host) for names without town, initials and names with an abbreviated word, where one domain fits.

    Known names give patterns of their words with one word left out, and their initials; the word left out must begin like
    the abbreviation, or be the town of the row's location. All patterns meet by equality.
    """
    place = F.regexp_replace(F.lower(F.col("loc")), r"^(?:region|raum|kreis)\s+|\s+(?:nord|süd|ost|west|mitte)$", "")
    town = F.translate(F.replace(F.replace(F.replace(F.replace(place, F.lit("ä"), F.lit("ae")), F.lit("ö"), F.lit("oe")), F.lit("ü"), F.lit("ue")), F.lit("ß"), F.lit("ss")), " -", "")
    full = told.where(F.size("words") >= 2).where(~F.exists("words", lambda w: w.endswith("."))).select("words", "host").distinct()
    gap = F.transform("words", lambda w, i: F.struct(F.array_join(F.concat(F.slice("words", 1, i), F.array(F.lit("*")), F.slice("words", i + 2, F.size("words"))), " ").alias("pattern"), w.alias("word")))
    gaps = full.select("host", F.explode(gap).alias("g")).select("host", "g.pattern", "g.word").distinct()
    initials = F.array_join(F.transform("words", lambda w: F.substring(w, 1, 1)), "")
    letters = full.where(F.size("words") >= 3).select(initials.alias("pattern"), F.element_at("words", -1).alias("word"), "host").distinct()
    want = rest.withColumn("town", town)
    abbreviated = want.where(F.exists("words", lambda w: w.endswith("."))).select("key", "loc", F.posexplode("words").alias("i", "w"), "words").where(F.col("w").endswith("."))
    cut = F.array_join(F.concat(F.slice("words", 1, F.col("i")), F.array(F.lit("*")), F.slice("words", F.col("i") + 2, F.size("words"))), " ")
    asked = abbreviated.select("key", "loc", cut.alias("pattern"), F.regexp_replace("w", r"\.$", "").alias("start"))
    townless = want.where("town <> ''").select("key", "loc", F.concat(F.array_join("words", " "), F.lit(" *")).alias("pattern"), F.col("town").alias("start"))
    by_gap = asked.unionByName(townless).join(gaps, "pattern").where(F.col("word").startswith(F.col("start")))
    by_letters = want.where(F.size("words") == 1).select("key", "loc", F.col("key").alias("pattern"), F.col("town").alias("start")).join(letters, "pattern").where((F.col("start") == "") | F.col("word").startswith(F.col("start")))
    both = by_gap.select("key", "loc", "host").unionByName(by_letters.select("key", "loc", "host"))
    return both.groupBy("key", "loc").agg(F.min("host").alias("word_host"), F.count_distinct("host").alias("c")).where("c = 1").drop("c")


def organisation_pairs(classes: DataFrame, key: str = "ID") -> DataFrame:
    """(id_a, id_b) of rows whose names differ and denote one organisation."""
    return _pairs(classes.where("spelled is not null").select(F.col(key).alias("id"), F.col("organisation").alias("g"), F.col("spelled").alias("t")))


def _pairs(members: DataFrame) -> DataFrame:
    m = checkpointed(members)
    a, b = m.select("g", F.col("id").alias("id_a"), F.col("t").alias("ta")), m.select("g", F.col("id").alias("id_b"), F.col("t").alias("tb"))
    return a.join(b, "g").where("id_a < id_b and ta <> tb").select("id_a", "id_b")


# ---------------------------------------------------------------------------------------------- persons

# Short forms of first names and the names they stand for.
NICKNAMES = {
    "alex": "alexander alexandra", "sascha": "alexander alexandra", "sandra": "alexandra", "toni": "antonia anton", "basti": "sebastian", "bastian": "sebastian", "ben": "benjamin", "benni": "benjamin",
    "benny": "benjamin", "chris": "christian christiane christoph christina", "christl": "christiane christina", "tina": "christina martina", "doro": "dorothea", "doerte": "dorothea", "thea": "dorothea theodora",
    "dora": "dorothea theodora", "elli": "elisabeth", "elisa": "elisabeth", "lisa": "elisabeth", "lisbeth": "elisabeth", "sissi": "elisabeth", "betty": "elisabeth", "fips": "philipp", "phil": "philipp",
    "franzi": "franziska", "friedel": "friedrich", "fritz": "friedrich", "fred": "friedrich alfred", "gabi": "gabriele gabriela", "gaby": "gabriele gabriela", "grete": "margarete", "gretel": "margarete", "gretchen": "margarete",
    "rita": "margarete", "guenni": "guenther", "hannes": "johannes", "hans": "johannes", "jo": "johannes johanna", "hanna": "johanna", "heidi": "adelheid", "heide": "adelheid", "henni": "henriette", "jette": "henriette",
    "hias": "matthias", "matze": "matthias", "matti": "matthias", "inge": "ingeborg", "kaethe": "katharina", "kathi": "katharina", "kati": "katharina", "trine": "katharina", "klaus": "nikolaus", "niko": "nikolaus",
    "nik": "nikolaus", "kuni": "kunigunde", "leo": "leopold leonhard", "poldi": "leopold", "manu": "emanuel manuela manuel", "max": "maximilian", "maxi": "maximilian", "minna": "wilhelmina", "mina": "wilhelmina",
    "helma": "wilhelmina", "willi": "wilhelm", "rosi": "rosalinde rosemarie", "linde": "rosalinde", "susi": "susanne", "sanne": "susanne", "tobi": "tobias", "uli": "ulrich ulrike", "ulli": "ulrich ulrike", "vale": "valentin valentina",
    "vroni": "veronika", "vera": "veronika", "wolle": "wolfram wolfgang", "wolf": "wolfram wolfgang", "yasi": "yasemin", "lenz": "lorenz", "jojo": "johannes", "emil": "emilian", "zoe": "zoey", "hardy": "hartmut", "hartl": "hartmut",
}

# Words before a name that are no part of it, and words that name nobody.
TITLES = r"(?:herrn?|hr|frau|fr|fraeulein|mr|mrs|ms|miss|mx|dr|prof|professor|dipl|ing|mag|med|phil|jur|rer|nat|habil|h\.?\s?c|m\.?\s?a|b\.?\s?a|msc|bsc|mba|phd|familie|fam|z\.?\s?hd|zhd|attn|c/o)"
NOBODY = [
    "empfang", "personen", "person", "kontakt", "kontakte", "ansprechpartner", "ansprechpartnerin", "ansprechperson", "sekretariat", "buero", "zentrale", "team", "info", "office", "vorstand", "geschaeftsfuehrung",
    "verwaltung", "leitung", "reception", "contact", "admin", "vertrieb", "redaktion", "presse", "pressestelle", "service", "support", "einkauf", "projektleitung", "lagerleitung", "werkstattleitung", "n", "x",
]


@memo
def _person_patterns() -> dict[str, re.Pattern]:
    return {
        "other": re.compile(r"<[^>]*>|(?<!\S)\S*@\S*|(?:https?://|www\.)\S*|\([^)]*\)|[\n\r\t;|].*|(?:\+|\b0)\d[\d\s()/.-]{4,}", re.S),
        "title": re.compile(rf"^(?:{TITLES}(?![\w])[.\s/-]*)+"),
        "digit": re.compile(r"(?<=[^\W\d_])[0135](?=[^\W\d_])"),
    }


def parse_person(text: str | None) -> tuple[str | None, str | None, str | None]:
    """(a, b, initial): two squeezed name parts in alphabetical order, or one part a (with the initial of the other, or without);
    all None for a text that names nobody. Middle initials are dropped; titles and text beside the name don't matter."""
    p = _person_patterns()
    if not text:
        return None, None, None
    s = p["other"].sub(" ", (restore(text)[1] or text).strip())
    s = p["digit"].sub(lambda m: {"0": "o", "1": "l", "3": "e", "5": "s"}[m[0]], fold(s))
    s = re.sub(r"\d+", " ", s).strip()
    s = p["title"].sub("", s).strip(" .,-")
    family = None
    if "," in s:
        family, _, given = s.partition(",")
        s = p["title"].sub("", given.strip()) + " " + p["title"].sub("", family.strip())
    parts = [w.strip(".-'") for w in re.findall(r"[^\W\d_][\w'-]*\.?", s)]
    long = [w for w in parts if len(w) > 1]
    if not long or any(w in NOBODY for w in long):
        return None, None, None
    if len(long) == 1:
        initial = next((w for w in parts if len(w) == 1), None)
        return squeeze(long[0]), None, initial
    a, b = sorted((squeeze(long[0]), squeeze(long[-1])))
    return a, b, None


_PERSON = T.StructType([T.StructField(n, T.StringType()) for n in ("a", "b", "initial")])


@F.pandas_udf(_PERSON)
def _parse_persons(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse_person(t) for t in texts], columns=["a", "b", "initial"])


#: A filter on its result must not be moved before the distinct texts, where it would parse every row once more.
_parse_persons = _parse_persons.asNondeterministic()


def _near_parts(counts: DataFrame) -> DataFrame:
    """(org, w, v, d, swap): parts of names (org, w, n) of an organisation within the radius of each other. Parts below
    SHORTEST_PART letters differ by one edit or one swap of neighbours; parts of SHORTEST_PART or more by two edits, unless both
    are established (each in ``ESTABLISHED`` organisations or more and in a tenth as many as the other: Martin, Martina) or both
    are names that short forms stand for (Alexander, Alexandra)."""
    full = F.array(*[F.lit(x) for x in sorted({squeeze(n) for n in " ".join(NICKNAMES.values()).split()})])
    parts = counts.where(F.length("w") >= SHORTEST_SLIP_PART).select("org", "w")
    near = radius_join(parts, parts, "w", scope=("org",)).where("w <> known_key")
    near = near.withColumn("slip", one_edit(F.col("w"), F.col("known_key")))
    near = near.where(F.col("slip") | (F.least(F.length("w"), F.length("known_key")) >= SHORTEST_PART))
    spread = parts.groupBy("w").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= ESTABLISHED)
    near = near.join(spread, "w", "left").join(spread.select(F.col("w").alias("known_key"), F.col("k").alias("l")), "known_key", "left")
    both = F.coalesce((F.col("k") * 10 >= F.col("l")) & (F.col("l") * 10 >= F.col("k")), F.lit(False))
    both = both | (F.array_contains(full, F.col("w")) & F.array_contains(full, F.col("known_key")))
    return near.select("org", "w", F.col("known_key").alias("v"), F.col("distance").alias("d"), "slip", both.alias("apart"))


def _standard_parts(counts: DataFrame, near: DataFrame) -> DataFrame:
    """(org, w, standard): parts read as the most frequent part of the organisation one edit or swap away that is as frequent at
    least, followed to the end; all others as they are."""
    n = counts.select("org", "w", "n")
    slips = near.where("slip").join(n, ["org", "w"]).join(n.select("org", F.col("w").alias("v"), F.col("n").alias("m")), ["org", "v"])
    upward = (F.col("m") > F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("v") < F.col("w")))
    node = lambda c: F.concat_ws("\x1f", "org", c)
    step = slips.where(upward).groupBy(node("w").alias("node")).agg(F.min(F.struct((-F.col("m")).alias("m"), node("v").alias("t")))["t"].alias("target"))
    ends = followed(step).select(F.split("node", "\x1f")[0].alias("org"), F.split("node", "\x1f")[1].alias("w"), F.split("target", "\x1f")[1].alias("standard"))
    return counts.select("org", "w").join(ends, ["org", "w"], "left").select("org", "w", F.coalesce("standard", "w").alias("standard"))


def _slips(persons: DataFrame, near: DataFrame) -> DataFrame:
    """(org, a, b, sa, sb): persons read as the nearest, then most frequent one of the organisation whose parts are equal or near."""
    swaps = F.array(F.struct(F.col("a").alias("w"), F.col("b").alias("rest")), F.struct(F.col("b").alias("w"), F.col("a").alias("rest")))
    one = persons.select("org", "a", "b", "n", F.explode(swaps).alias("x")).select("org", "a", "b", "n", "x.*").join(near, ["org", "w"])
    one = checkpointed(one.select("org", "a", "b", "n", F.col("v").alias("p"), "rest", "d"))
    both = one.join(near.select("org", F.col("w").alias("rest"), F.col("v").alias("q"), F.col("d").alias("e")), ["org", "rest"])
    both = both.select("org", "a", "b", "n", F.least("p", "q").alias("sa"), F.greatest("p", "q").alias("sb"), (F.col("d") + F.col("e")).alias("d"))
    read = one.select("org", "a", "b", "n", F.least("p", "rest").alias("sa"), F.greatest("p", "rest").alias("sb"), "d").unionByName(both)
    there = persons.select("org", F.col("a").alias("sa"), F.col("b").alias("sb"), F.col("n").alias("m"))
    node, target = F.concat_ws("", "org", "a", "b"), F.concat_ws("", "org", "sa", "sb")
    upward = (F.col("m") > F.col("n")) | ((F.col("m") == F.col("n")) & (target < node))
    best = read.join(there, ["org", "sa", "sb"]).where(upward).groupBy(node.alias("node")).agg(F.min(F.struct("d", (-F.col("m")).alias("m"), target.alias("target")))["target"].alias("target"))
    parts = lambda c: F.split(c, "")
    return followed(best).select(parts("node")[0].alias("org"), parts("node")[1].alias("a"), parts("node")[2].alias("b"), parts("target")[1].alias("sa"), parts("target")[2].alias("sb"))


def person_pairs(contacts: DataFrame, classes: DataFrame, key: str = "ID") -> DataFrame:
    """(id_a, id_b) of rows whose Contact_Name differs and denotes one person of one organisation."""
    cells = contacts.select(F.col(key).alias("id"), F.col("Contact_Name").alias("t")).where(~is_missing("Contact_Name"))
    parsed = cells.select("t").distinct().withColumn("p", _parse_persons("t")).where("p.a is not null").select("t", "p.*")
    rows = cells.join(parsed, "t").join(classes.select(F.col(key).alias("id"), F.col("organisation").alias("org")), "id")
    rows = checkpointed(rows)
    parts = rows.select("org", F.explode(F.array_compact(F.array("a", "b"))).alias("w")).groupBy("org", "w").agg(F.count(F.lit(1)).alias("n"))
    parts = checkpointed(parts)
    near = checkpointed(_near_parts(parts))
    standard = _standard_parts(parts, near)
    sa = standard.select("org", F.col("w").alias("a"), F.col("standard").alias("sa"))
    sb = standard.select("org", F.col("w").alias("b"), F.col("standard").alias("sb"))
    rows = rows.join(sa, ["org", "a"], "left").join(sb, ["org", "b"], "left")
    rows = rows.select("id", "t", "org", F.when(F.col("b").isNull(), F.col("sa")).otherwise(F.least("sa", "sb")).alias("a"), F.when(F.col("b").isNotNull(), F.greatest("sa", "sb")).alias("b"), "initial")
    rows = checkpointed(rows)
    full = rows.where("b is not null")
    # Two edits: persons whose parts are within the radius of those of another.
    near = near.where("not apart and length(w) >= {0} and length(v) >= {0}".format(SHORTEST_PART)).drop("slip", "apart")
    slips = _slips(full.groupBy("org", "a", "b").agg(F.count(F.lit(1)).alias("n")), near)
    slip = F.when(F.col("sa").isNotNull(), F.struct("a", "b")).alias("slip")
    full = checkpointed(full.join(slips, ["org", "a", "b"], "left").select("id", "t", "org", slip, F.coalesce("sa", "a").alias("a"), F.coalesce("sb", "b").alias("b")))
    persons = full.groupBy("org", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    # Nicknames: the pair with the full name, if the organisation has it; else with the first name it stands for.
    table = F.create_map(*[F.lit(x) for kv in NICKNAMES.items() for x in map(squeeze, kv)])
    swaps = F.array(F.struct(F.col("a").alias("nick"), F.col("b").alias("other")), F.struct(F.col("b").alias("nick"), F.col("a").alias("other")))
    nick = persons.select("org", "a", "b", F.explode(swaps).alias("x")).where(table[F.col("x.nick")].isNotNull())
    nick = nick.select("org", "a", "b", "x.other", F.explode(F.split(table[F.col("x.nick")], " ")).alias("formal"))
    nick = nick.select("org", "a", "b", F.least("other", "formal").alias("fa"), F.greatest("other", "formal").alias("fb"))
    formal = persons.select("org", F.col("a").alias("fa"), F.col("b").alias("fb"), F.col("n").alias("fn"))
    chosen = nick.join(formal, ["org", "fa", "fb"], "left").groupBy("org", "a", "b").agg(F.min(F.struct(F.coalesce(-F.col("fn"), F.lit(0)).alias("o"), "fa", "fb")).alias("c"))
    full = full.join(chosen, ["org", "a", "b"], "left").select("id", "t", "org", "slip", F.coalesce("c.fa", "a").alias("a"), F.coalesce("c.fb", "b").alias("b"))
    # Half of a double name with the same first name is the bearer of the double name, if there is one only.
    pairs_ = full.select("org", "a", "b").distinct()
    halves = pairs_.select("org", "a", "b", F.explode(swaps).alias("x")).where(F.contains(F.col("x.nick"), F.lit("-")))
    halves = halves.select("org", "a", "b", "x.other", F.explode(F.split("x.nick", "-")).alias("half")).where("half <> ''")
    halves = halves.select("org", F.least("half", "other").alias("ha"), F.greatest("half", "other").alias("hb"), F.struct("a", "b").alias("double"))
    halves = halves.groupBy("org", "ha", "hb").agg(F.min("double").alias("d"), F.count_distinct("double").alias("c")).where("c = 1").select("org", F.col("ha").alias("a"), F.col("hb").alias("b"), "d")
    full = checkpointed(full.join(halves, ["org", "a", "b"], "left").select("id", "t", "org", "slip", F.coalesce("d.a", "a").alias("a"), F.coalesce("d.b", "b").alias("b")))
    bearers = full.select("org", "a", "b").distinct()
    ends = bearers.select("org", "a", "b", F.explode(F.array(F.struct(F.col("a").alias("w"), F.col("b").alias("rest")), F.struct(F.col("b").alias("w"), F.col("a").alias("rest")))).alias("e")).select("org", "a", "b", "e.*")
    ends = ends.select("org", "a", "b", F.explode(F.array_distinct(F.concat(F.array("w"), F.split("w", "-")))).alias("w"), "rest").distinct()
    # The bearer of a slip is also asked for by it. A lone part two edits away is not read so: nothing beside it supports that.
    slipped = full.where("slip is not null").select("org", "a", "b", F.explode(F.array(F.struct(F.col("slip.a").alias("w"), F.col("slip.b").alias("rest")), F.struct(F.col("slip.b").alias("w"), F.col("slip.a").alias("rest")))).alias("e"))
    ends = ends.unionByName(slipped.select("org", "a", "b", "e.*").distinct())
    partial = rows.where("b is null").select("id", "t", "org", F.col("a").alias("w"), "initial")
    fits = F.col("initial").isNull() | F.col("rest").startswith(F.col("initial"))
    asked = partial.select("org", "w", "initial").distinct()
    only = asked.join(ends, ["org", "w"]).where(fits).groupBy("org", "w", "initial").agg(F.min(F.struct("a", "b")).alias("one"), F.count_distinct("a", "b").alias("c")).where("c = 1")
    only = only.select(F.col("org").alias("o2"), F.col("w").alias("w2"), F.col("initial").alias("i2"), "one")
    part = partial.join(only, (F.col("org") == F.col("o2")) & (F.col("w") == F.col("w2")) & F.col("initial").eqNullSafe(F.col("i2")), "left")
    part = part.select("id", "t", "org", F.coalesce("one.a", "w").alias("a"), F.coalesce("one.b", F.concat(F.lit("?"), F.coalesce("initial", F.lit("")))).alias("b"))
    return _pairs(full.drop("slip").unionByName(part).select("id", F.concat_ws("\x1f", "org", "a", "b").alias("g"), "t"))
