"""Staging: map exports onto one schema, drop empty rows, flag suspicious cells, select and exclude rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions import values as v
from tidewright.functions.text import clean, match_key, nonblank
from tidewright.operators.numbering import flag_repeated, sequential_ids
from tidewright.session import broadcast_if_small

CONSTANT = "__CONSTANT__:"


def map_columns(source: DataFrame, mapping: dict[str, str], targets: list[str]) -> DataFrame:
    """One select: each target from its source column, from a constant, or blank where the mapping or the source has none."""
    def one(target: str) -> Column:
        origin = mapping.get(target)
        if origin is None:
            return F.lit("").alias(target)
        if origin.startswith(CONSTANT):
            return F.lit(origin[len(CONSTANT) :]).alias(target)
        return (clean(F.col(f"`{origin}`")) if origin in source.columns else F.lit("")).alias(target)

    return source.select(*[one(t) for t in targets])


def ensure_columns(df: DataFrame, columns: list[str], fill: str | None = "") -> DataFrame:
    """Missing columns added, filled with ``fill``; those there stripped, null as ``fill``."""
    new = {c: (F.coalesce(F.nullif(clean(c), F.lit("")), F.lit(fill)) if c in df.columns else F.lit(fill).cast("string")) for c in columns}
    return df.withColumns(new)


def ordered_columns(df: DataFrame, known: list[str]) -> DataFrame:
    """Known columns first, further ones after them."""
    return df.select(*[c for c in known if c in df.columns], *[c for c in df.columns if c not in known])


def fill_blank(first: str, *others: str) -> Column:
    """First of the columns that is not blank, "" if none."""
    return F.coalesce(*[F.nullif(clean(c), F.lit("")) for c in (first, *others)], F.lit(""))


def combine(*columns: str) -> Column:
    """Distinct non-blank cells in order, joined by `` | ``; case counts."""
    return F.array_join(F.array_distinct(F.filter(F.array(*[clean(c) for c in columns]), lambda x: x != "")), " | ")


def flags_to_tags(columns: list[str]) -> Column:
    """Names of the columns whose cell is not blank, joined by `` | ``."""
    return F.array_join(F.array_compact(F.array(*[F.when(nonblank(F.col(f"`{c}`")), F.lit(c)) for c in columns])), " | ")


def drop_blank_rows(df: DataFrame, ignore: list[str]) -> DataFrame:
    """Rows where some column besides ``ignore`` is not blank."""
    some = F.lit(False)
    for c in df.columns:
        if c not in ignore:
            some = some | nonblank(c)
    return df.where(some)


def suspicious_name(c: Column | str) -> Column:
    s = clean(c)
    return F.lower(s).isin(v.NAME_PLACEHOLDERS) | (F.length(s) <= 1) | ~s.rlike(r"\p{L}")


def _occurrences(s: Column, marker: str) -> Column:
    return (F.length(s) - F.length(F.replace(s, F.lit(marker), F.lit("")))) / len(marker)


def staging_flags(df: DataFrame) -> DataFrame:
    """``df`` with nine flags and ``Issues``, the names of the true ones in order. Null counts as blank."""
    email, site = clean("Email"), clean("Website")
    low = F.lower(email)
    noise = F.lit(False)
    for m in v.EMAIL_NOISE:
        noise = noise | low.contains(m)
    sites = F.lit(0.0)
    for m in v.URL_MARKERS:
        sites = sites + _occurrences(F.lower(site), m)
    one_url = F.regexp_replace(site, r"[.,;]+$", "").rlike(r"(?i)^(?:https?://)?(?:www\.)?[A-Z0-9-]+(?:\.[A-Z0-9-]+)+(?::[0-9]+)?(?:/\S*)?$")
    flags = {
        "Suspicious_Contact_Name": (clean("Contact_Name") != "") & suspicious_name("Contact_Name"),
        "Suspicious_Organisation_Name": (clean("Organisation_Name") != "") & suspicious_name("Organisation_Name"),
        "Invalid_Email_Format": (email != "") & ~email.rlike(r"(?i)^[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}$"),
        "Multiple_Emails_In_Main_Field": _occurrences(email, "@") > 1,
        "Email_Field_Contains_Text": noise,
        "Invalid_Website_Format": (site != "") & ~one_url,
        "Multiple_Websites_In_Main_Field": (sites > 1) | site.rlike(r"[|;\n]"),
        "Duplicate_Email": F.col("Duplicate_Email"),
        "Almost_Empty_Row": (clean("Organisation_Name") == "") & (clean("Contact_Name") == "") & (email == "") & (site == ""),
    }
    marked = flag_repeated(df, low, "Duplicate_Email").withColumns({k: x for k, x in flags.items() if k != "Duplicate_Email"})
    return marked.withColumn("Issues", F.array_join(F.array_compact(F.array(*[F.when(F.col(k), F.lit(k)) for k in flags])), " | "))


def suspicious_rows(df: DataFrame) -> DataFrame:
    return staging_flags(df).where("Issues <> ''")


def staging_report(df: DataFrame) -> DataFrame:
    """(metric, n): rows, missing cells of the main columns and counts of each flag, in one aggregation."""
    flagged = staging_flags(df)
    counts = {"Rows": F.count(F.lit(1))}
    for c in ("Organisation_Name", "Contact_Name", "Email", "Website"):
        counts[f"Missing_{c}"] = F.count_if(clean(c) == "")
    for c in flagged.columns[len(df.columns) : -1]:
        counts[c] = F.count_if(F.col(c))
    wide = flagged.agg(*[x.cast("bigint").alias(k) for k, x in counts.items()])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("n")) for k in counts])).alias("x")).select("x.*")


def enrichment_buckets(df: DataFrame) -> DataFrame:
    """(bucket, n): rows by what is missing and what is there to find it with. One aggregation."""
    has = {c: F.nullif(clean(c), F.lit("")).isNotNull() for c in ("Email_Domain", "Website", "Organisation_Name", "Email", "Contact_Name")}
    domain, site, org, email, contact = has.values()
    buckets = {
        "site from name": ~site & org, "site from domain": ~site & (domain | email), "email from site": ~email & site & contact, "name from site": ~org & (site | domain),
        "contact name only": contact & ~domain & ~site & ~org & ~email, "nothing": ~domain & ~site & ~org & ~email & ~contact,
    }
    wide = df.agg(*[F.count_if(x).cast("bigint").alias(k) for k, x in buckets.items()])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(k).alias("bucket"), F.col(f"`{k}`").alias("n")) for k in buckets])).alias("x")).select("x.*")


def mark_rejected(contacts: DataFrame, selection: DataFrame, status: str = "Status", email: str = "Email", organisation: str = "Organisation_Name") -> DataFrame:
    """``contacts`` with Excluded_By_Email, Excluded_By_Organisation and Exclusion_Reason: the row's e-mail or organisation
    key is among the rows of ``selection`` marked x. Blank keys never match. The key lists are broadcast while small."""
    marked = selection.where(F.lower(clean(status)) == "x")
    by_email = marked.select(F.lower(clean(email)).alias("_e")).where("_e <> ''").distinct().withColumn("Excluded_By_Email", F.lit(True))
    by_org = marked.select(match_key(organisation).alias("_g")).where("_g <> ''").distinct().withColumn("Excluded_By_Organisation", F.lit(True))
    keyed = contacts.withColumn("_e", F.lower(clean("Email"))).withColumn("_g", match_key("Organisation_Name"))
    out = keyed.join(broadcast_if_small(by_email), "_e", "left").join(broadcast_if_small(by_org), "_g", "left")
    flags = {"Excluded_By_Email": "Email matched the selection", "Excluded_By_Organisation": "Organisation matched the selection"}
    out = out.withColumns({k: F.coalesce(k, F.lit(False)) for k in flags})
    reason = F.array_join(F.array_compact(F.array(*[F.when(F.col(k), F.lit(t)) for k, t in flags.items()])), " | ")
    return out.withColumn("Exclusion_Reason", reason).drop("_e", "_g")


def useful_rows(df: DataFrame) -> DataFrame:
    """Rows with a contact, an e-mail, an organisation or a site."""
    return df.where((clean("Contact_Name") != "") | (clean("Email") != "") | (clean("Organisation_Name") != "") | (clean("Website") != ""))


def included_contacts(staging: DataFrame, selection: DataFrame, order: str) -> DataFrame:
    """Useful rows that aren't rejected, numbered 1..n in order, with the host of the e-mail."""
    from tidewright.functions.contact import domain_strict

    kept = mark_rejected(useful_rows(staging), selection).where("Exclusion_Reason = ''").drop("Excluded_By_Email", "Excluded_By_Organisation", "Exclusion_Reason")
    return sequential_ids(kept.withColumn("Email_Domain", domain_strict("Email")), [order], "ID")
