"""Scored candidates of a site: best one per type, conflicts, audit rows; and their way into the contact rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions import contact as c
from tidewright.functions import urls as u
from tidewright.functions import values as v
from tidewright.functions.text import val

KEYS = ["site", "candidate_type"]


def scored(candidates: DataFrame) -> DataFrame:
    """``candidates`` (site, url, page_type, candidate_type, value, evidence, extra, ord) with priority and score."""
    return candidates.withColumn("priority", c.page_priority(F.col("page_type"))).withColumn("score", F.col("priority") * 10 + F.coalesce("extra", F.lit(0)))


def best_candidates(candidates: DataFrame) -> DataFrame:
    """(site, candidate_type, value, url, page_type, score): the highest score, the first of equals. One aggregation."""
    best = F.max_by(F.struct("value", "url", "page_type", "score"), F.struct("score", (-F.col("ord")).alias("o")))
    return scored(candidates).groupBy(*KEYS).agg(best.alias("b")).select(*KEYS, "b.*")


def _same(x: str) -> Column:
    return F.lower(F.trim(F.regexp_replace(x, r"(?U)\s+", " ")))


def candidate_conflicts(candidates: DataFrame) -> DataFrame:
    """(site, candidate_type, value_key, value, n): distinct values within the priority gap of the best page, where there are
    several; one row per value."""
    s = scored(candidates).withColumn("value_key", _same("value"))
    top = s.groupBy(*KEYS).agg(F.max("priority").alias("_top"))
    play = s.join(top, KEYS).where(F.col("_top") - F.col("priority") < v.CONFLICT_GAP)
    values = play.groupBy(*KEYS, "value_key").agg(F.min_by("value", "ord").alias("value"), F.count(F.lit(1)).alias("n"))
    several = values.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*KEYS)
    return values.join(several, KEYS, "left_semi")


def audit(candidates: DataFrame, rows: DataFrame) -> DataFrame:
    """Every candidate with a flag for the selected one and the ids of the contact rows of its site."""
    best = best_candidates(candidates).select(*KEYS, F.col("value").alias("_v"), F.col("url").alias("_u"))
    ids = rows.groupBy("site").agg(F.array_join(F.transform(F.array_sort(F.collect_set("ID")), lambda x: x.cast("string")), " | ").alias("Related_Row_IDs"))
    selected = (F.col("value") == F.col("_v")) & (F.col("url") == F.col("_u"))
    out = scored(candidates).join(best, KEYS).join(ids, "site", "left").withColumn("Selected", selected)
    return out.select(
        F.col("site").alias("Website_Normalized"), F.col("url").alias("Page_URL"), F.col("page_type").alias("Page_Type"), F.col("candidate_type").alias("Candidate_Type"), F.col("value").alias("Candidate_Value"),
        F.substring("evidence", 1, 200).alias("Evidence_Text"), F.col("Selected").cast("string").alias("Selected"), F.when(selected, F.concat(F.lit("Score "), F.col("score").cast("string"))).otherwise("").alias("Selection_Reason"), "Related_Row_IDs",
    )


def replace_in_log(log: DataFrame, new: DataFrame, types: list[str], column: str) -> DataFrame:
    """Log rows whose ``column`` contains none of the types, and the new rows."""
    hit = F.lit(False)
    for t in types:
        hit = hit | F.coalesce(F.contains(F.col(column), F.lit(t)), F.lit(False))
    return log.where(~hit).unionByName(new, allowMissingColumns=True)


def replace_groups(kept: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of groups that ``new`` doesn't have, and the new rows."""
    return kept.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def eligible_sites(contacts: DataFrame, require_200: bool = True) -> DataFrame:
    """``contacts`` that name a site of their own, with ``site``: the key of the effective website, response 200 if asked for,
    no blocked host."""
    site = u.effective_website()
    ok = site.isNotNull() & ~u.is_blocked(site)
    if require_200:
        ok = ok & (val("Website_Response_Code") == "200")
    return contacts.where(ok).withColumn("site", u.url_key(site))


def sites(contacts: DataFrame, limit: int | None = None) -> DataFrame:
    """(site, first_id, ids): distinct eligible sites by first appearance; ``limit`` is a top-k."""
    out = eligible_sites(contacts).groupBy("site").agg(F.min("ID").alias("first_id"), F.count(F.lit(1)).alias("n_rows"))
    return out if limit is None else out.orderBy("first_id").limit(limit)


def clear_ineligible(contacts: DataFrame, fields: list[tuple[str, str]], generated: list[str]) -> DataFrame:
    """On rows without an eligible site: website values with their labels nulled; generated columns too if any was."""
    site = u.effective_website()
    eligible = F.coalesce(site.isNotNull() & ~u.is_blocked(site) & (val("Website_Response_Code") == "200"), F.lit(False))
    from_site = {s: ~eligible & c.from_website(s) for _, s in fields}
    some = F.lit(False)
    for x in from_site.values():
        some = some | x
    new = {x: F.when(some, None).otherwise(F.col(x)) for x in generated if x in contacts.columns}
    for value, source in fields:
        new[value] = F.when(from_site[source], None).otherwise(F.col(value))
        new[source] = F.when(from_site[source], None).otherwise(F.col(source))
    return contacts.withColumns(new)


def fill_with_source(df: DataFrame, target: str, value: Column, label: str, source: str | None = None) -> DataFrame:
    """Null targets filled where a value is there, with the provenance label beside them."""
    source = source or f"{target}_Source"
    fill = F.col(target).isNull() & value.isNotNull()
    return df.withColumns({target: F.coalesce(F.col(target), value), source: F.when(fill, F.lit(label)).otherwise(F.col(source) if source in df.columns else F.lit(None).cast("string"))})


def update_by_key(df: DataFrame, key: str, values: DataFrame, target: str, value: str, label: str) -> DataFrame:
    """A value found once per key written to every row of the key whose target is null."""
    found = values.select(key, F.col(value).alias("_found"))
    return fill_with_source(df.join(found, key, "left"), target, F.col("_found"), label).drop("_found")


def source_column(field: str) -> str:
    """The column that tells where a field's value came from."""
    return "Organisation_Nonprofit_Source" if field == "Organisation_Nonprofit_Status" else f"{field}_Source"


def apply_metadata(contacts: DataFrame, best: DataFrame, fields: list[str]) -> DataFrame:
    """Contacts of eligible sites with the best candidates: earlier website values are recomputed, other values kept."""
    rows = eligible_sites(contacts)
    picked = best.where(F.col("candidate_type").isin(fields)).groupBy("site").agg(*[F.max(F.when(F.col("candidate_type") == f, F.struct("value", "page_type"))).alias(f"_{f}") for f in fields])
    out = rows.join(picked, "site", "left")
    new = {}
    for f in fields:
        source = source_column(f)
        kept = F.when(~c.from_website(source), val(f))
        new[f] = F.coalesce(kept, F.col(f"_{f}.value"))
        new[source] = F.when(kept.isNotNull(), F.col(source)).otherwise(F.when(F.col(f"_{f}").isNotNull(), c.source_label(F.col(f"_{f}.page_type"), v.METADATA_LABELS)))
    return out.withColumns(new).drop(*[f"_{f}" for f in fields])


def metadata_conflicts(contacts: DataFrame, best: DataFrame, fields: list[str]) -> DataFrame:
    """(ID, site, field, existing, candidate): kept values that differ from the best candidate but for case."""
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.when(~c.from_website(source_column(f)), val(f)).alias("existing")) for f in fields]))
    rows = eligible_sites(contacts).select("ID", "site", cells.alias("x")).select("ID", "site", "x.*").where("existing is not null")
    both = rows.join(best.select("site", F.col("candidate_type").alias("field"), F.col("value").alias("candidate")), ["site", "field"])
    return both.where(F.lower(F.trim("existing")) != F.lower(F.trim("candidate"))).select("ID", "site", "field", "existing", "candidate")


def primary_emails(contacts: DataFrame, emails: DataFrame, mode: str = "compat") -> DataFrame:
    """(ID, Email, alternatives): of the addresses of the row's site the one that best fits the contact's name, then the page;
    none without a fit. Alternatives are the others that fit."""
    rows = eligible_sites(contacts).select("ID", "site", val("Contact_Name_First_Name").alias("f"), val("Contact_Name_Last_Name").alias("l"))
    fit = c.name_in_email(F.col("email"), F.col("f"), F.col("l"))
    pairs = rows.where("f is not null or l is not null").join(emails, "site").withColumn("fit", fit).where("fit > 0")
    rank = F.struct((-F.col("fit")).alias("a"), (-c.page_priority(F.col("page_type"))).alias("b"), "first", "email")
    ranked = pairs.groupBy("ID").agg(F.array_sort(F.collect_list(F.struct(rank.alias("r"), F.col("email").alias("e")))).alias("x"))
    return ranked.select("ID", F.col("x")[0]["e"].alias("Email"), F.array_join(F.transform(F.slice("x", F.lit(2), F.size("x")), lambda y: y["e"]), " | ").alias("Email_Alternatives"))


def apply_addresses(contacts: DataFrame, best: DataFrame) -> DataFrame:
    """Address filled if absent or from the site, replaced only by a more complete one; ``outcome`` tells which."""
    picked = best.where("candidate_type = 'Address'").select("site", F.col("value").alias("_a"), F.col("page_type").alias("_p"))
    rows = eligible_sites(contacts).join(picked, "site", "left")
    kept = F.when(~c.from_website("Address_Source"), val("Address"))
    better = F.col("_a").isNotNull() & (kept.isNull() | (c.address_completeness("_a") > c.address_completeness(kept)))
    tie = F.col("_a").isNotNull() & kept.isNotNull() & (c.address_completeness("_a") == c.address_completeness(kept)) & (F.lower(F.trim("_a")) != F.lower(F.trim(kept)))
    outcome = F.when(better & kept.isNull(), "filled").when(better, "replaced").when(tie, "conflict").otherwise("kept")
    return rows.select("ID", "site", outcome.alias("outcome"), F.when(better, F.col("_a")).otherwise(kept).alias("Address"), F.when(better, c.source_label(F.col("_p"), v.ADDRESS_LABELS)).when(kept.isNotNull(), F.col("Address_Source")).alias("Address_Source"))


def search_ranking(organisations: DataFrame, results: DataFrame) -> DataFrame:
    """(Organisation_Name, Rank, Score, Selected, URL): results of each organisation scored against its name; the best by score,
    then rank, is selected, whatever its score; all results with its URL count as selected."""
    s = results.join(organisations.select("Organisation_Name").distinct(), "Organisation_Name").withColumn("Score", c.search_score(F.col("URL"), c.keywords("Organisation_Name")))
    best = s.groupBy("Organisation_Name").agg(F.max_by("URL", F.struct("Score", (-F.col("Rank")).alias("r"))).alias("_u"))
    return s.join(best, "Organisation_Name").select("Organisation_Name", "Rank", "Score", F.when(F.col("URL") == F.col("_u"), "yes").otherwise("no").alias("Selected"), "URL")


def upsert_status(status: DataFrame, new: DataFrame, now: Column | None = None) -> DataFrame:
    """Keyed upsert of scrape records: new records replace old ones, their step results stay where the new one has none, the
    time is stamped where it is absent."""
    steps = ["Org_Meta_Status", "Email_Scrape_Status", "Address_Scrape_Status"]
    plain = ["Scrape_Status", "Scraped_At", "Pages_Checked", "HTTP_Status", "Error_Message"]
    stamp = now if now is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    o, n = status.alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
    both = o.join(n, F.col("o.Website_Normalized") == F.col("n.Website_Normalized"), "full")
    def pick(x: str) -> Column:
        fresh = F.coalesce(F.col(f"n.{x}"), stamp) if x == "Scraped_At" else F.col(f"n.{x}")
        if x in steps:
            fresh = F.coalesce(F.col(f"n.{x}"), F.col(f"o.{x}"))
        return F.when(F.col("_new"), fresh).otherwise(F.col(f"o.{x}")).alias(x)

    return both.select(F.coalesce("n.Website_Normalized", "o.Website_Normalized").alias("Website_Normalized"), *[pick(x) for x in plain + steps])


def fresh(status: DataFrame, now: Column, max_age_days: int = 30) -> DataFrame:
    """Records younger than ``max_age_days`` whole days; unreadable or absent times are not fresh."""
    return status.where(F.floor((F.unix_timestamp(now) - F.unix_timestamp(F.try_to_timestamp("Scraped_At"))) / 86_400) < max_age_days)


def unchecked_sites(contacts: DataFrame) -> DataFrame:
    """(Website): distinct sites none of whose rows has a response code."""
    named = contacts.where(val("Website").isNotNull())
    checked = named.where(val("Website_Response_Code").isNotNull()).select("Website").distinct()
    return named.select("Website").distinct().join(checked, "Website", "left_anti")
