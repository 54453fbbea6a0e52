"""Queries of the preparation operators and their SQL: reading fields, staging flags, selection, cleaning, resolving, review."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions import contact as c
from tidewright.functions import urls as u
from tidewright.functions import values as v
from tidewright.functions.text import clean, match_key, slugify
from tidewright.operators import names, numbering, resolve, staging
from tidewright.session import checkpointed, table

_list = lambda a: F.array_join(a, " | ")


def email_domains(spark: SparkSession, d: str) -> DataFrame:
    """The three readings of an e-mail's host."""
    return table(spark, d, "staging_all_rows").select("row_id", c.domain_strict("Email").alias("strict"), c.domain_last("Email").alias("last"), c.domain_first("Email").alias("first"))


def extracted_emails(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contacts_raw").select("ID", _list(c.emails("Email", "Email_Alternatives")).alias("emails"))


def extracted_emails_strict(spark: SparkSession, d: str) -> DataFrame:
    """``at`` and ``dot`` rewritten only as words of their own."""
    return table(spark, d, "contacts_raw").select("ID", _list(c.emails("Email", "Email_Alternatives", mode="strict")).alias("emails"))


def extracted_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contacts_raw").select("ID", _list(c.urls("Website", "Website_Alternatives")).alias("urls"))


def extracted_phones(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contacts_raw").select("ID", _list(c.phones("Phone", "Phone_Alternatives")).alias("phones"))


def match_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contacts_raw").select("ID", match_key("Organisation_Name").alias("org_key"), match_key("Contact_Name").alias("name_key"))


def cleaned_names(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "contacts_raw")
    return t.select("ID", c.clean_name("Contact_Name").alias("name"), c.organisation_name("Organisation_Name").alias("org"), c.organisation_leftovers("Organisation_Name").alias("leftovers"), c.is_strong_name("Contact_Name").alias("strong"), c.is_weak_name("Contact_Name").alias("weak"))


def slugs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "organisations_enriched").select("Organisation_ID", slugify("Organisation_Name").alias("slug"), _list(c.keywords("Organisation_Name")).alias("keywords"))


def address_scores(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contacts_raw").select("ID", c.address_quality("Address").alias("quality"), F.coalesce(c.address_completeness("Address"), F.lit(0)).alias("completeness"))


def row_priorities(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contacts_raw").select("ID", c.row_priority().alias("priority"))


def parsed_names(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "contacts_raw").select("ID", names.split_name(c.clean_name("Contact_Name")).alias("n"))
    return t.select("ID", F.col("n.first").alias("first_name"), F.col("n.last").alias("last_name"))


def staging_flags(spark: SparkSession, d: str) -> DataFrame:
    f = staging.staging_flags(table(spark, d, "staging_all_rows"))
    return f.select("row_id", "Issues")


def suspicious_rows(spark: SparkSession, d: str) -> DataFrame:
    return staging.suspicious_rows(table(spark, d, "staging_all_rows")).select("row_id", "Source_File", "Source_Row", "Issues")


def staging_report(spark: SparkSession, d: str) -> DataFrame:
    return staging.staging_report(table(spark, d, "staging_all_rows"))


def enrichment_buckets(spark: SparkSession, d: str) -> DataFrame:
    return staging.enrichment_buckets(table(spark, d, "contacts_enriched"))


def nonblank_rows(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "staging_all_rows")
    return staging.drop_blank_rows(t, ["row_id", "load_no", "loaded_at", "Source_File", "Source_Row"]).groupBy("Source_File").agg(F.count(F.lit(1)).alias("n_rows"))


def mapped_columns(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers and customers brought onto the contact columns by a mapping with a constant and an absent column, united."""
    maps = {"supplier": {"Source_Row": "s_suppkey", "Organisation_Name": "s_name", "Sector": "__CONSTANT__:Supply", "Email": "s_email"}, "customer": {"Source_Row": "c_custkey", "Organisation_Name": "c_name", "Sector": "c_mktsegment"}}
    targets = ["Source_Row", "Organisation_Name", "Sector", "Email"]
    parts = [staging.map_columns(table(spark, d, t).select(*[F.col(x).cast("string").alias(x) for x in table(spark, d, t).columns]), m, targets).withColumn("Source_File", F.lit(t)) for t, m in maps.items()]
    return parts[0].unionByName(parts[1])


def combined_cells(spark: SparkSession, d: str) -> DataFrame:
    """First filled of several columns, distinct cells joined, and the names of the filled columns as tags."""
    t = table(spark, d, "staging_all_rows")
    return t.select("row_id", staging.fill_blank("Organisation_Name", "Contact_Name", "Email").alias("label"), staging.combine("Original_Contact_Info", "Website", "Email").alias("combined"), staging.flags_to_tags(["Sector", "Role", "Status", "Direction"]).alias("filled"))


def _selection(spark: SparkSession, d: str) -> DataFrame:
    """The list that people mark: reviewed duplicates."""
    return table(spark, d, "duplicate_list").select(F.col("selected").alias("Status"), "Email", "Organisation_Name")


def rejected_contacts(spark: SparkSession, d: str) -> DataFrame:
    rows = staging.mark_rejected(staging.useful_rows(table(spark, d, "staging_all_rows")), _selection(spark, d))
    return rows.where("Exclusion_Reason <> ''").select("row_id", "Exclusion_Reason")


def included_contacts(spark: SparkSession, d: str) -> DataFrame:
    return staging.included_contacts(table(spark, d, "staging_all_rows"), _selection(spark, d), "row_id").select("ID", "row_id", "Email_Domain")


def duplicate_emails(spark: SparkSession, d: str) -> DataFrame:
    f = numbering.flag_repeated(table(spark, d, "contacts_raw"), F.lower(clean("Email")), "repeated")
    return f.where("repeated").select("ID", "Email")


def _cleaned(spark: SparkSession, d: str) -> DataFrame:
    return checkpointed(resolve.clean_contacts(table(spark, d, "contacts_raw")))


def cleaned_contacts(spark: SparkSession, d: str) -> DataFrame:
    return resolve.clean_contacts(table(spark, d, "contacts_raw")).select("ID", "Email", "Email_Domain", "Email_Alternatives", "Website", "Phone", "Contact_Name", "Organisation_Name", "Cleaning_Issues")


def exclusion_reasons(spark: SparkSession, d: str) -> DataFrame:
    rows = resolve.exclusion_reasons(resolve.clean_contacts(table(spark, d, "contacts_raw"))).withColumn("name_review", resolve.organisation_name_reason())
    return rows.where("Exclusion_Reason <> '' or name_review <> ''").select("ID", "Exclusion_Reason", "name_review")


def contact_clusters(spark: SparkSession, d: str) -> DataFrame:
    return resolve.contact_clusters(_cleaned(spark, d)).select("ID", "org_key", "cluster")


def cluster_conflicts(spark: SparkSession, d: str) -> DataFrame:
    rows = checkpointed(resolve.contact_clusters(_cleaned(spark, d)))
    return resolve.cluster_conflicts(rows)


def recommended_rows(spark: SparkSession, d: str) -> DataFrame:
    return resolve.recommended_rows(resolve.contact_clusters(_cleaned(spark, d)))


def resolved_contacts(spark: SparkSession, d: str) -> DataFrame:
    return resolve.resolved_contacts(_cleaned(spark, d))


def review_list(spark: SparkSession, d: str) -> DataFrame:
    return resolve.review_list(_cleaned(spark, d))


def reviewed_contacts(spark: SparkSession, d: str) -> DataFrame:
    """Contacts after the reviewers' decisions in the list of duplicates."""
    return resolve.apply_review(table(spark, d, "contacts_raw"), table(spark, d, "duplicate_list")).select("ID", "Organisation_Name", "Contact_Name", "Email", "Phone")


def organisation_preview(spark: SparkSession, d: str) -> DataFrame:
    return resolve.organisation_preview(_cleaned(spark, d))


def legal_forms(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "contacts_raw").select("ID", c.legal_form("Organisation_Name").alias("form"), F.coalesce("Description", F.lit("")).alias("text"))
    return t.select("ID", "form", c.organisation_type(F.col("form"), F.col("text")).alias("kind"), c.nonprofit(F.col("form"), F.col("text")).alias("nonprofit"))


def plausible_names(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "contacts_raw")
    return t.select("ID", c.plausible_organisation("Organisation_Name").alias("plausible"), c.title_name("Organisation_Name").alias("title_name"))


def website_domains(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contacts_raw").select("ID", u.url_candidate("Website").alias("candidate"), u.website_domain("Website").alias("domain"))


QUERIES = {f.__name__: f for f in (
    email_domains, extracted_emails, extracted_emails_strict, extracted_urls, extracted_phones, match_keys, cleaned_names, slugs, address_scores, row_priorities, parsed_names, staging_flags, suspicious_rows, staging_report,
    enrichment_buckets, nonblank_rows, mapped_columns, combined_cells, rejected_contacts, included_contacts, duplicate_emails, cleaned_contacts, exclusion_reasons, contact_clusters, cluster_conflicts, recommended_rows,
    resolved_contacts, review_list, reviewed_contacts, organisation_preview, legal_forms, plausible_names, website_domains,
)}


# ---------------------------------------------------------------------------------------------- SQL
def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\x{{85}}\p{{Z}}]+|[\s\x{{85}}\p{{Z}}]+$', '', 'g')"


def _clean(x: str) -> str:
    return f"coalesce({_strip(x)}, '')"


def _key(x: str) -> str:
    folded = f"strip_accents(lower(coalesce({x}, '')))"
    for a, b in (("¼", "1⁄4"), ("½", "1⁄2"), ("¾", "3⁄4"), ("™", "TM")):
        folded = f"replace({folded}, '{a}', '{b}')"
    folded = f"translate({folded}, '³²¹ⁿªºµ', '321naoμ')"
    return rf"trim(regexp_replace(regexp_replace({folded}, '[^\p{{L}}\p{{N}}_\s\p{{Z}}]', ' ', 'g'), '[\s\p{{Z}}]+', ' ', 'g'))"


def _in(words: list[str]) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def _unique(x: str) -> str:
    t = rf"list_filter(list_transform({x}, lambda q: regexp_replace({_strip('q')}, '[.,;:]+$', '')), lambda q: q <> '')"
    return f"list_filter({t}, lambda q, i: list_position(list_transform({t}, lambda r: lower(r)), lower(q)) = i)"


def _joined(cells: list[str]) -> str:
    return "array_to_string(list_filter([" + ", ".join(cells) + "], lambda q: q <> ''), ' | ')"


def _open(x: str) -> str:
    return rf"regexp_replace(regexp_replace({_clean(x)}, '(?i)\s*(?:\(at\)|\[at\]|[(\[]?at[)\]]?)\s*', '@', 'g'), '(?i)\s*(?:\(dot\)|\[dot\]|[(\[]?dot[)\]]?)\s*', '.', 'g')"


def _name(x: str) -> str:
    return f"CASE WHEN lower({_clean(x)}) IN {_in(v.INVALID_NAMES)} OR length({_clean(x)}) = 1 OR NOT regexp_matches({_clean(x)}, '\\p{{L}}') THEN '' ELSE {_clean(x)} END"


def _words(x: str) -> str:
    return f"CASE WHEN {_key(x)} = '' THEN 0 ELSE len(string_split({_key(x)}, ' ')) END"


def _lines(x: str) -> str:
    t = rf"list_transform(list_filter(regexp_split_to_array({_clean(x)}, '[\r\n]+'), lambda q: regexp_matches(q, '[^\s\p{{Z}}]')), lambda q: regexp_replace(regexp_replace(q, '^[>\-*•\s\p{{Z}}]+', ''), '[\s\p{{Z}}]+$', ''))"
    return f"list_filter({t}, lambda q: lower(q) NOT IN {_in(v.INVALID_NAMES)} AND regexp_matches(q, '\\p{{L}}'))"


def _org(x: str) -> str:
    return rf"regexp_replace(regexp_replace(coalesce({_lines(x)}[1], ''), '(?i)[\s\p{{Z}}]+\p{{Nd}}+[\s\p{{Z}}]*x[\s\p{{Z}}]+.*$', ''), '^[ ,;-]+|[ ,;-]+$', '', 'g')"


def _quality(x: str) -> str:
    s = _clean(x)
    cities = "|".join(v.LARGE_CITIES)
    return rf"CASE WHEN {s} = '' THEN 0 ELSE least(length({s}), 100) + (CASE WHEN regexp_matches({s}, '(?:^|[^\p{{L}}\p{{N}}_])\d{{5}}(?:$|[^\p{{L}}\p{{N}}_])') THEN 100 ELSE 0 END) + (CASE WHEN regexp_matches({s}, '(?:^|[^\p{{L}}\p{{N}}_])\d+[a-zA-Z]?(?:$|[^\p{{L}}\p{{N}}_])') THEN 40 ELSE 0 END) + (CASE WHEN regexp_matches({s}, '(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:{cities})(?:$|[^\p{{L}}\p{{N}}_])') THEN 30 ELSE 0 END) + (CASE WHEN contains({s}, ',') THEN 10 ELSE 0 END) END"


def _strong(x: str) -> str:
    return rf"(({_name(x)}) <> '' AND NOT contains(({_name(x)}), chr(10)) AND NOT regexp_matches(({_name(x)}), '\p{{Nd}}') AND ({_words(x)}) >= 2)"


def _weak(x: str) -> str:
    return f"(({_name(x)}) <> '' AND ({_words(x)}) = 1)"


def _priority() -> str:
    parts = [f"CASE WHEN {_strong('Contact_Name')} THEN 100 WHEN {_weak('Contact_Name')} THEN 10 ELSE 0 END", _quality("Address")]
    for column, points in (("Website", 70), ("Email", 40), ("Phone", 10), ("LinkedIn", 10), ("Organisation_Type", 5), ("Sector", 5), ("Location", 5), ("Description", 5), ("Role", 5)):
        parts.append(f"CASE WHEN {_clean(column)} <> '' THEN {points} ELSE 0 END")
    return " + ".join(f"({x})" for x in parts)


def _plausible(x: str) -> str:
    t = rf"regexp_replace(regexp_replace({x}, '[\s\p{{Z}}]+', ' ', 'g'), '^[ \t\r\n|,;:-]+|[ \t\r\n|,;:-]+$', '', 'g')"
    forms = "|".join(p for p, _, _ in v.LEGAL_FORMS)
    no = [v.ERROR_NAME, r"https?://|www\.|linkedin\.com|facebook\.com", r"^[\p{L}\p{M}\p{N}_-]+(?:\.[\p{L}\p{M}\p{N}_-]+)+/?$", f"^(?:{forms})$"]
    tests = " AND ".join(f"NOT regexp_matches({t}, '(?i){r}')" for r in no)
    return f"coalesce(length({t}) BETWEEN 3 AND 140 AND lower({t}) NOT IN {_in(v.GENERIC_TITLES)} AND regexp_matches({t}, '[A-Za-zÄÖÜäöüß]') AND {tests}, false)"


def _title(x: str) -> str:
    s = _clean(x)
    tries = []
    for sep in v.TITLE_SEPARATORS:
        first = f"trim(split_part({s}, '{sep}', 1))"
        tries.append(f"WHEN contains({s}, '{sep}') AND {_plausible(first)} THEN {first}")
    return f"CASE {' '.join(tries)} WHEN {_plausible(s)} THEN {s} END"


_EMAIL_RX = r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"
_EMAILS = _unique(f"list_transform(regexp_extract_all({_joined([_open('Email'), _open('Email_Alternatives')])}, '{_EMAIL_RX}'), lambda q: lower(q))")
_EMAILS_STRICT = _EMAILS.replace("?at[", r"?\bat\b[").replace("?dot[", r"?\bdot\b[")
_PHONE_RX = r"(?:^|[^\p{L}\p{N}_])(\+?\p{Nd}[\p{Nd}\s\p{Z}()./-]{6,}\p{Nd})"
_PHONES = _unique(f"regexp_extract_all({_joined([_clean('Phone'), _clean('Phone_Alternatives')])}, '{_PHONE_RX}', 1)")
_CAND = lambda s: rf"CASE WHEN {s} <> '' AND contains(regexp_extract(CASE WHEN regexp_matches({s}, '(?i)^https?://') THEN {s} ELSE 'https://' || {s} END, '//([^/?#]*)', 1), '.') THEN CASE WHEN regexp_matches({s}, '(?i)^https?://') THEN {s} ELSE 'https://' || {s} END ELSE '' END"
_CANDIDATE = _CAND(rf"regexp_replace({_clean('Website')}, '[.,;:)]+$', '')")
_DOMAIN = rf"regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract({_CANDIDATE}, '//([^/?#]*)', 1)), '^.*@', ''), ':.*$', ''), '^www\.', '')"

_FLAG_SQL = {
    "Suspicious_Contact_Name": f"{_clean('Contact_Name')} <> '' AND (lower({_clean('Contact_Name')}) IN {_in(v.NAME_PLACEHOLDERS)} OR length({_clean('Contact_Name')}) <= 1 OR NOT regexp_matches({_clean('Contact_Name')}, '\\p{{L}}'))",
    "Suspicious_Organisation_Name": f"{_clean('Organisation_Name')} <> '' AND (lower({_clean('Organisation_Name')}) IN {_in(v.NAME_PLACEHOLDERS)} OR length({_clean('Organisation_Name')}) <= 1 OR NOT regexp_matches({_clean('Organisation_Name')}, '\\p{{L}}'))",
    "Invalid_Email_Format": rf"{_clean('Email')} <> '' AND NOT regexp_full_match({_clean('Email')}, '(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{{2,}}')",
    "Multiple_Emails_In_Main_Field": f"length({_clean('Email')}) - length(replace({_clean('Email')}, '@', '')) > 1",
    "Email_Field_Contains_Text": "(" + " OR ".join(f"contains(lower({_clean('Email')}), {'chr(10)' if m == chr(10) else repr(m)})" for m in v.EMAIL_NOISE) + ")",
    "Invalid_Website_Format": rf"{_clean('Website')} <> '' AND NOT regexp_full_match(regexp_replace({_clean('Website')}, '[.,;]+$', ''), '(?i)(?:https?://)?(?:www\.)?[A-Z0-9-]+(?:\.[A-Z0-9-]+)+(?::[0-9]+)?(?:/\S*)?')",
    "Multiple_Websites_In_Main_Field": "(" + " + ".join(f"(length({_clean('Website')}) - length(replace(lower({_clean('Website')}), '{m}', ''))) / {len(m)}" for m in v.URL_MARKERS) + rf" > 1 OR regexp_matches({_clean('Website')}, '[|;\n]'))",
    "Duplicate_Email": f"lower({_clean('Email')}) <> '' AND count(*) OVER (PARTITION BY lower({_clean('Email')})) > 1",
    "Almost_Empty_Row": " AND ".join(f"{_clean(x)} = ''" for x in ("Organisation_Name", "Contact_Name", "Email", "Website")),
}
_FLAGGED = "SELECT *, " + ", ".join(f"({x}) AS {k}" for k, x in _FLAG_SQL.items()) + " FROM staging_all_rows"
_ISSUES = "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {k} THEN '{k}' END" for k in _FLAG_SQL) + "], lambda q: q IS NOT NULL), ' | ')"
_USEFUL = "(" + " OR ".join(f"{_clean(x)} <> ''" for x in ("Contact_Name", "Email", "Organisation_Name", "Website")) + ")"
_MARKED = f"""
WITH s AS (SELECT lower({_clean('Email')}) AS e, {_key('Organisation_Name')} AS g FROM duplicate_list WHERE lower({_clean('selected')}) = 'x'),
m AS (SELECT *, lower({_clean('Email')}) <> '' AND lower({_clean('Email')}) IN (SELECT e FROM s) AS by_email,
  {_key('Organisation_Name')} <> '' AND {_key('Organisation_Name')} IN (SELECT g FROM s) AS by_org FROM staging_all_rows WHERE {_USEFUL})"""

# Cleaned contacts and their clusters, for the queries built on them.
_CLEANED = f"""
WITH x AS (SELECT *, {_EMAILS} AS es, {_PHONES} AS ps, {_name('Contact_Name')} AS n0, {_org('Organisation_Name')} AS o, array_to_string({_lines('Organisation_Name')}[2:], ' | ') AS lo FROM contacts_raw),
k AS (SELECT ID, coalesce(es[1], '') AS Email, coalesce(ps[1], '') AS Phone, {_clean('Address')} AS Address, {_clean('Role')} AS Role, {_clean('Location')} AS Location, Website, Website_Alternatives,
  {_clean('LinkedIn')} AS LinkedIn, {_clean('Organisation_Type')} AS Organisation_Type, {_clean('Sector')} AS Sector, {_clean('Description')} AS Description, Contact_Name AS raw_name, Organisation_Name AS raw_org, lo, es,
  CASE WHEN n0 <> '' AND o <> '' AND {_key('n0')} = {_key('o')} THEN '' ELSE n0 END AS Contact_Name, o AS Organisation_Name FROM x)"""
_CLUSTERED = _CLEANED + f""",
b AS (SELECT *, {_key('Organisation_Name')} AS org_key, {_key('Contact_Name')} AS nk, lower(Email) AS mail, CASE WHEN {_strong('Contact_Name')} THEN 's' WHEN {_weak('Contact_Name')} THEN 'w' ELSE 'n' END AS kind FROM k),
tok AS (SELECT DISTINCT org_key, 's:' || nk AS cl, unnest(string_split(nk, ' ')) AS t FROM b WHERE kind = 's' AND org_key <> ''),
only_t AS (SELECT org_key, t, min(cl) AS cl FROM tok GROUP BY ALL HAVING count(*) = 1),
named AS (SELECT b.ID, b.org_key, b.mail, CASE WHEN kind = 's' THEN 's:' || nk ELSE coalesce(only_t.cl, 'w:' || b.ID) END AS cluster
  FROM b LEFT JOIN only_t ON only_t.org_key = b.org_key AND only_t.t = b.nk AND b.kind = 'w' WHERE b.org_key <> '' AND kind <> 'n'),
only_m AS (SELECT org_key, mail, min(cluster) AS cl FROM named WHERE mail <> '' GROUP BY ALL HAVING count(DISTINCT cluster) = 1),
sole AS (SELECT org_key, min(cluster) AS cl FROM named GROUP BY ALL HAVING count(DISTINCT cluster) = 1),
clusters AS (SELECT ID, org_key, cluster FROM named UNION ALL
  SELECT b.ID, b.org_key, coalesce(only_m.cl, sole.cl, 'o:') FROM b LEFT JOIN only_m ON only_m.org_key = b.org_key AND only_m.mail = b.mail LEFT JOIN sole ON sole.org_key = b.org_key WHERE b.org_key <> '' AND kind = 'n'
  UNION ALL SELECT ID, '', 'r:' || ID FROM b WHERE org_key = '')"""

_B, _E = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"
_COMPLETE = " + ".join(f"(CASE WHEN regexp_matches(coalesce(Address, ''), '{x}') THEN 1 ELSE 0 END)" for x in (
    rf"(?i)[A-ZÄÖÜa-zäöüß]{{3,}}(?:{'|'.join(v.STREET_ENDINGS)})|[A-ZÄÖÜa-zäöüß]{{3,}}[\s\p{{Z}}]+(?:Straße|Str\.|Weg|Gasse|Platz|Allee|Ring|Damm|Ufer|Steig|Berg)", rf"{_B}\d{{1,4}}[\s\p{{Z}}]*[a-zA-Z]?{_E}", rf"{_B}\d{{5}}{_E}",
    rf"Berlin|Hamburg|München|Köln|{_B}[A-ZÄÖÜ][a-zäöüß]{{3,}}{_E}"))
_FORM = "CASE " + " ".join(f"WHEN regexp_matches(Organisation_Name, '(?i)" + p.replace(r"(?:\b|$)", r"(?:[^\p{L}\p{N}_]|$)") + f"') THEN '{x}'" for p, x, _ in v.LEGAL_FORMS) + " END"
_HITS = "list_distinct(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(t, '(?i){p}') THEN '{k}' END" for p, k in v.TYPE_WORDS) + "], lambda q: q IS NOT NULL))"
_KIND = "CASE WHEN form IS NOT NULL THEN CASE " + " ".join(f"WHEN form = '{x}' THEN '{k}'" for _, x, k in v.LEGAL_FORMS) + f" END WHEN len({_HITS}) = 1 THEN {_HITS}[1] END"
_PRIORITY_K = _priority().replace("Contact_Name", "k.Contact_Name")
_SITE_URL = r"(?i)(?:https?://|www\.)[^\s\p{Z},;|]+|(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?::[0-9]+)?(?:/[^\s\p{Z},;|]*)?"
_CLUSTERED = _CLUSTERED + f""",
w AS (SELECT k.* REPLACE (coalesce(list_filter(list_transform(regexp_extract_all({_joined([_clean('Website'), _clean('Website_Alternatives')])}, '{_SITE_URL}'), lambda u: {_CAND("regexp_replace(u, '[.,;:)]+$', '')")}), lambda u: u <> '')[1], '') AS Website) FROM k)"""

ORACLE = {
    "email_domains": rf"SELECT row_id, CASE WHEN length({_clean('Email')}) - length(replace({_clean('Email')}, '@', '')) = 1 THEN lower(string_split({_clean('Email')}, '@')[-1]) ELSE '' END AS strict, CASE WHEN contains(Email, '@') THEN string_split({_clean('Email')}, '@')[-1] ELSE '' END AS last, CASE WHEN contains(Email, '@') THEN lower({_strip('substring(Email, instr(Email, chr(64)) + 1)')}) END AS first FROM staging_all_rows",
    "extracted_emails": f"SELECT ID, array_to_string({_EMAILS}, ' | ') AS emails FROM contacts_raw",
    "plausible_names": f"SELECT ID, {_plausible('Organisation_Name')} AS plausible, {_title('Organisation_Name')} AS title_name FROM contacts_raw",
    "extracted_emails_strict": f"SELECT ID, array_to_string({_EMAILS_STRICT}, ' | ') AS emails FROM contacts_raw",
    "extracted_phones": f"SELECT ID, array_to_string({_PHONES}, ' | ') AS phones FROM contacts_raw",
    "match_keys": f"SELECT ID, {_key('Organisation_Name')} AS org_key, {_key('Contact_Name')} AS name_key FROM contacts_raw",
    "cleaned_names": f"SELECT ID, {_name('Contact_Name')} AS name, {_org('Organisation_Name')} AS org, array_to_string({_lines('Organisation_Name')}[2:], ' | ') AS leftovers, {_strong('Contact_Name')} AS strong, {_weak('Contact_Name')} AS weak FROM contacts_raw",
    "slugs": rf"SELECT Organisation_ID, substring(regexp_replace(regexp_replace(lower({_strip('Organisation_Name')}), '[^\p{{L}}\p{{M}}\p{{Nd}}_\s\p{{Z}}-]', '', 'g'), '[\s\p{{Z}}_]+', '-', 'g'), 1, 80) AS slug, array_to_string(list_reduce([[]::VARCHAR[]] || list_transform(list_filter(regexp_extract_all(lower({_clean('Organisation_Name')}), '[a-zäöüß]+'), lambda w: length(w) > 2 AND w NOT IN {_in(v.STOPWORDS)}), lambda w: [w]), lambda a, w: CASE WHEN list_contains(a, w[1]) THEN a ELSE a || w END), ' | ') AS keywords FROM organisations_enriched",
    "row_priorities": f"SELECT ID, ({_priority()})::INT AS priority FROM contacts_raw",
    "staging_flags": f"SELECT row_id, {_ISSUES} AS Issues FROM ({_FLAGGED})",
    "suspicious_rows": f"SELECT row_id, Source_File, Source_Row, {_ISSUES} AS Issues FROM ({_FLAGGED}) WHERE {_ISSUES} <> ''",
    "staging_report": f"WITH f AS ({_FLAGGED}) SELECT 'Rows' AS metric, count(*) AS n FROM f " + " ".join(f"UNION ALL SELECT 'Missing_{x}', count(*) FILTER ({_clean(x)} = '') FROM f" for x in ("Organisation_Name", "Contact_Name", "Email", "Website")) + " " + " ".join(f"UNION ALL SELECT '{k}', count(*) FILTER ({k}) FROM f" for k in _FLAG_SQL),
    "enrichment_buckets": f"""WITH t AS (SELECT {_clean('Email_Domain')} <> '' AS d, {_clean('Website')} <> '' AS w, {_clean('Organisation_Name')} <> '' AS o, {_clean('Email')} <> '' AS e, {_clean('Contact_Name')} <> '' AS c FROM contacts_enriched)
SELECT 'site from name' AS bucket, count(*) FILTER (NOT w AND o) AS n FROM t UNION ALL SELECT 'site from domain', count(*) FILTER (NOT w AND (d OR e)) FROM t UNION ALL SELECT 'email from site', count(*) FILTER (NOT e AND w AND c) FROM t
UNION ALL SELECT 'name from site', count(*) FILTER (NOT o AND (w OR d)) FROM t UNION ALL SELECT 'contact name only', count(*) FILTER (c AND NOT d AND NOT w AND NOT o AND NOT e) FROM t UNION ALL SELECT 'nothing', count(*) FILTER (NOT d AND NOT w AND NOT o AND NOT e AND NOT c) FROM t""",
    "nonblank_rows": "SELECT Source_File, count(*) AS n_rows FROM staging_all_rows WHERE " + " OR ".join(f"{_clean(x)} <> ''" for x in (
        "Organisation_Name", "Contact_Name", "Email", "Email_Alternatives", "Phone", "Phone_Alternatives", "Website", "Website_Alternatives", "LinkedIn", "Social_Media", "Role", "Organisation_Type", "Sector", "Location", "Address",
        "Description", "Status", "Notes", "Tags", "Responsible_Person", "Project_or_Event", "Last_Contact_Date", "Email_Count", "Direction", "Relationship_Strength", "Last_Subject_Line", "Source_Document", "Original_Contact_Info")) + " GROUP BY Source_File",
    "mapped_columns": "SELECT s_suppkey::VARCHAR AS Source_Row, s_name AS Organisation_Name, 'Supply' AS Sector, '' AS Email, 'supplier' AS Source_File FROM supplier UNION ALL SELECT c_custkey::VARCHAR, c_name, c_mktsegment, '', 'customer' FROM customer",
    "combined_cells": f"SELECT row_id, coalesce(nullif({_clean('Organisation_Name')}, ''), nullif({_clean('Contact_Name')}, ''), nullif({_clean('Email')}, ''), '') AS label, array_to_string(list_filter([{_clean('Original_Contact_Info')}, CASE WHEN {_clean('Website')} <> {_clean('Original_Contact_Info')} THEN {_clean('Website')} ELSE '' END, CASE WHEN {_clean('Email')} NOT IN ({_clean('Original_Contact_Info')}, {_clean('Website')}) THEN {_clean('Email')} ELSE '' END], lambda q: q <> ''), ' | ') AS combined, array_to_string(list_filter([" + ", ".join(f"CASE WHEN {_clean(x)} <> '' THEN '{x}' END" for x in ("Sector", "Role", "Status", "Direction")) + "], lambda q: q IS NOT NULL), ' | ') AS filled FROM staging_all_rows",
    "rejected_contacts": _MARKED + " SELECT row_id, array_to_string(list_filter([CASE WHEN by_email THEN 'Email matched the selection' END, CASE WHEN by_org THEN 'Organisation matched the selection' END], lambda q: q IS NOT NULL), ' | ') AS Exclusion_Reason FROM m WHERE by_email OR by_org",
    "included_contacts": _MARKED + f" SELECT row_number() OVER (ORDER BY row_id) AS ID, row_id, CASE WHEN length({_clean('Email')}) - length(replace({_clean('Email')}, '@', '')) = 1 THEN lower(string_split({_clean('Email')}, '@')[-1]) ELSE '' END AS Email_Domain FROM m WHERE NOT by_email AND NOT by_org",
    "duplicate_emails": f"SELECT ID, Email FROM contacts_raw WHERE lower({_clean('Email')}) <> '' QUALIFY count(*) OVER (PARTITION BY lower({_clean('Email')})) > 1",
    "contact_clusters": _CLUSTERED + " SELECT ID, org_key, cluster FROM clusters",
    "reviewed_contacts": """WITH v AS (SELECT trim(ID::VARCHAR) AS id, max(CASE WHEN selected = 'X' THEN 1 ELSE 0 END) AS chosen FROM duplicate_list WHERE to_verify = 'yes' GROUP BY ALL),
e AS (SELECT trim(ID::VARCHAR) AS id, Organisation_Name, Contact_Name, Email, Phone FROM duplicate_list WHERE to_verify = 'yes' AND selected = 'X' GROUP BY ALL)
SELECT c.ID, CASE WHEN e.id IS NOT NULL THEN e.Organisation_Name ELSE c.Organisation_Name END AS Organisation_Name, CASE WHEN e.id IS NOT NULL THEN e.Contact_Name ELSE c.Contact_Name END AS Contact_Name,
  CASE WHEN e.id IS NOT NULL THEN e.Email ELSE c.Email END AS Email, CASE WHEN e.id IS NOT NULL THEN e.Phone ELSE c.Phone END AS Phone
FROM contacts_raw c LEFT JOIN v ON v.id = c.ID::VARCHAR LEFT JOIN e ON e.id = c.ID::VARCHAR WHERE v.id IS NULL OR v.chosen = 1""",
    "address_scores": f"SELECT ID, ({_quality('Address')})::INT AS quality, ({_COMPLETE})::INT AS completeness FROM contacts_raw",
    "legal_forms": f"WITH f AS (SELECT ID, {_FORM} AS form, coalesce(Description, '') AS t FROM contacts_raw) SELECT ID, form, {_KIND} AS kind, CASE WHEN form IN {_in(v.NONPROFIT_FORMS)} OR regexp_matches(t, '(?i){v.NONPROFIT_WORDS}') THEN 'Yes' WHEN form IN {_in(v.PROFIT_FORMS)} THEN 'No' ELSE 'Unclear' END AS nonprofit FROM f",
    "recommended_rows": _CLUSTERED + f" SELECT c.org_key, c.cluster, arg_max(c.ID, ({_PRIORITY_K}, -c.ID)) AS recommended FROM clusters c JOIN w k ON k.ID = c.ID GROUP BY ALL",
    "website_domains": f"SELECT ID, {_CANDIDATE} AS candidate, {_DOMAIN} AS domain FROM contacts_raw",
}
