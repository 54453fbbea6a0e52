"""Queries of the enrichment operators and their SQL: sites, pages, candidates, applying them, splitting, acquisition.

The tables hold no web pages, so three pages per organisation (home, imprint, contact) are written from its own row; what the
extractors read from them can then be held against that row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions import contact as c
from tidewright.functions import urls as u
from tidewright.functions import values as v
from tidewright.operators import candidates as cd
from tidewright.operators import pages as pg
from tidewright.operators import split
from tidewright.plans.preparation import _clean, _in, _strip
from tidewright.session import checkpointed, table
from tidewright.sources import acquire


def organisations(spark: SparkSession, d: str) -> DataFrame:
    return split.organisations(table(spark, d, "contacts_enriched"))


def contacts_split(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "contacts_enriched")
    return split.contacts_split(t, checkpointed(split.organisations(t).select("Organisation_Key", "Organisation_ID"))).select("ID", "Organisation_ID", "Contact_Name", "Email", "Phone")


def url_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contacts_enriched").select("ID", u.url_key("Website").alias("url_key"), u.organisation_key().alias("org_key"))


def probe_variants(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contacts_enriched").select("ID", F.explode(u.probe_variants("Website")).alias("variant"))


def page_classes(spark: SparkSession, d: str) -> DataFrame:
    """Page type and file type of every site's address."""
    t = table(spark, d, "contacts_enriched").where("Website is not null")
    return t.select("ID", u.page_class(u.url_path("Website")).alias("page_type"), u.skippable("Website").alias("skippable"))


def cache_digests(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "organisations_enriched").where("Website_Normalized is not null").select("Organisation_ID", u.cache_digest("Website_Normalized").alias("digest"))


def blocked_sites(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "contacts_enriched").where("Website is not null")
    return t.select("ID", u.bare_host("Website").alias("host"), u.is_blocked("Website").alias("blocked"), u.is_directory("Website").alias("directory"))


def response_texts(spark: SparkSession, d: str) -> DataFrame:
    codes = table(spark, d, "contacts_enriched").select(F.expr("try_cast(Website_Response_Code as int)").alias("code")).where("code is not null")
    return codes.groupBy("code").agg(F.count(F.lit(1)).alias("n")).select("code", c.status_text(F.col("code")).alias("text"), "n")


def eligible_sites(spark: SparkSession, d: str) -> DataFrame:
    return cd.sites(table(spark, d, "contacts_enriched"))


def first_sites(spark: SparkSession, d: str) -> DataFrame:
    """The first hundred eligible sites: a top-k."""
    return cd.sites(table(spark, d, "contacts_enriched"), 100)


def unchecked_sites(spark: SparkSession, d: str) -> DataFrame:
    return cd.unchecked_sites(table(spark, d, "contacts_enriched"))


def filled_domains(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "contacts_enriched")
    return cd.fill_with_source(t, "Email_Domain", c.domain_first("Email"), "Derived from email").select("ID", "Email_Domain", "Email_Domain_Source")


def cleared_contacts(spark: SparkSession, d: str) -> DataFrame:
    out = cd.clear_ineligible(table(spark, d, "contacts_enriched"), [("Address", "Address_Source")], ["Address_Alternatives"])
    return out.select("ID", "Address", "Address_Source", "Address_Alternatives")


def updated_websites(spark: SparkSession, d: str) -> DataFrame:
    """A site found once per e-mail host (here: the most frequent one of its rows) written to the rows that have none."""
    t = table(spark, d, "contacts_enriched")
    found = t.where("Website is not null and Email_Domain is not null").groupBy("Email_Domain", "Website").agg(F.count(F.lit(1)).alias("n"))
    found = found.groupBy("Email_Domain").agg(F.max_by("Website", F.struct("n", "Website")).alias("site"))
    return cd.update_by_key(t, "Email_Domain", found, "Website", "site", "Email domain").select("ID", "Website", "Website_Source")


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """(site, url, page_type, page_ord, html), three per organisation with a site."""
    text = lambda x: F.replace(F.replace(F.coalesce(F.col(x), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    t = table(spark, d, "organisations_enriched").where("Website_Normalized is not null")
    row = F.struct(text("Organisation_Name").alias("n"), text("Address").alias("a"), u.bare_host("Website_Normalized").alias("h"))
    o = t.groupBy(u.url_key("Website_Normalized").alias("site")).agg(F.min_by(row, "Organisation_ID").alias("o")).select("site", "o.*")
    cat = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) and not x.startswith("$") else F.col(x[1:]) for x in xs])
    home = cat("<html><head><title>", "$n", " | Start</title><meta property='og:site_name' content='' ></head><body><nav><a href='#top'>x</a><a href='/impressum'>Impressum</a><a href='kontakt.html'>Kontakt</a></nav><h1>Willkommen</h1><p>Offen<p>Werkstatt</body></html>")
    legal = cat("<html><head><title>Impressum</title><script type='application/ld+json'>{\"@graph\":[{\"@type\":\"Organization\",\"email\":\"mailto:post@", "$h", "\"}]}</script></head><body><h1>Impressum</h1><p>Anbieter: ", "$n", "</p><p>", "$a", "</p><footer>Stand 2024</footer></body></html>")
    reach = cat("<html><head><title>Kontakt</title></head><body><a href='mailto:Info@", "$h", "?subject=Hallo'>Schreiben</a><p>team (at) ", "$h", " oder noreply@", "$h", "</p></body></html>")
    page = lambda i, k, path, html: F.struct(F.lit(i).alias("page_ord"), F.lit(k).alias("page_type"), F.concat("site", F.lit(path)).alias("url"), html.alias("html"))
    listed = F.array(page(0, "Homepage", "", home), page(1, "Impressum", "/impressum", legal), page(2, "Contact", "/kontakt.html", reach))
    return o.select("site", F.explode(listed).alias("p")).select("site", "p.*")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return checkpointed(pg.parsed_pages(_pages(spark, d)))


def parsed_pages(spark: SparkSession, d: str) -> DataFrame:
    p = pg.parsed_pages(_pages(spark, d))
    return p.select("site", "url", "page_type", F.col("doc.title").alias("title"), F.col("doc.text").alias("text"), F.col("doc.footer").alias("footer"), F.size("doc.anchors").alias("n_anchors"))


def soft_errors(spark: SparkSession, d: str) -> DataFrame:
    """Which pages are error pages in disguise: each site's pages, and a page under its own answer whose title or heading is the
    response text and name of the organisation's row."""
    t = table(spark, d, "organisations_enriched").where("Website_Normalized is not null")
    text = lambda x: F.replace(F.replace(F.coalesce(F.col(x), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    phrase = F.element_at(F.array(*[F.lit(x) for x in ERROR_TITLES]), (F.col("Organisation_ID") % len(ERROR_TITLES) + 1).cast("int"))
    title = F.concat(text("Website_Response_Text"), F.lit(" | "), text("Organisation_Name"))
    shown = F.array(
        F.struct(F.lit("/t").alias("p"), F.concat(F.lit("<title>"), title, F.lit("</title><h1>Willkommen</h1>")).alias("html")),
        F.struct(F.lit("/h").alias("p"), F.concat(F.lit("<title>x</title><h1>"), phrase, F.lit("</h1><p>Text")).alias("html")),
    )
    more = t.select(F.col("Organisation_ID").cast("string").alias("id"), F.explode(shown).alias("x")).select(F.concat("id", "x.p").alias("url"), "x.html")
    return pg.parsed_pages(_pages(spark, d).select("url", "html").unionByName(more)).select("url", pg.is_soft_error(F.col("doc")).alias("soft_error"))


#: Headings of pages, of which some say that there is no page.
ERROR_TITLES = ["404", "Seite nicht gefunden", "Page not found", "Service unavailable", "Not found here", "Über uns", "Access denied", "Zugriff verweigert!", "Error 404", "Kontakt"]


def discovered_pages(spark: SparkSession, d: str) -> DataFrame:
    return pg.discovered_pages(_docs(spark, d).where("page_type = 'Homepage'"))


def manifests(spark: SparkSession, d: str) -> DataFrame:
    """Manifests written and read again."""
    return pg.read_manifests(pg.manifest_json(_pages(spark, d)))


def loadable_pages(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    return pg.loadable_pages(docs.select("site", "url", "page_ord", "page_type"), docs.select("site", "url", "doc")).select("site", "page_ord", "page_type", "url")


def linked_objects(spark: SparkSession, d: str) -> DataFrame:
    return pg.linked_objects(_docs(spark, d)).select("site", "url", F.array_join(F.col("pos").cast("array<string>"), ".").alias("pos"), F.to_json("obj").alias("obj"))


def page_names(spark: SparkSession, d: str) -> DataFrame:
    return pg.page_names(_docs(spark, d))


def page_emails(spark: SparkSession, d: str) -> DataFrame:
    return pg.page_emails(_docs(spark, d)).select("site", "page_type", "email", "how")


def site_emails(spark: SparkSession, d: str) -> DataFrame:
    return pg.site_emails(_docs(spark, d)).select("site", "email", "url", "page_type")


def page_addresses(spark: SparkSession, d: str) -> DataFrame:
    return pg.page_addresses(_docs(spark, d)).select("site", "page_type", "address", "how")


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    """Name, legal form, type, nonprofit status and address candidates of all pages."""
    docs = _docs(spark, d)
    keys = ["site", "url", "page_type"]
    named = pg.page_names(docs).join(docs.select("site", "url", F.col("doc.text").alias("text"), "page_ord"), ["site", "url"]).withColumn("form", c.legal_form("name"))
    cell = lambda t, x, e: F.struct(F.lit(t).alias("candidate_type"), x.alias("value"), F.substring(e, 1, 200).alias("evidence"))
    derived = F.concat(F.lit("Legal form: "), F.col("form"))
    kinds = F.array(
        cell("Organisation_Name", F.col("name"), F.col("evidence")), cell("Organisation_Legal_Form", F.col("form"), F.col("evidence")), cell("Organisation_Type", c.organisation_type(F.col("form"), F.col("text")), derived),
        cell("Organisation_Nonprofit_Status", F.when(F.col("form").isNotNull(), c.nonprofit(F.col("form"), F.col("text"))), derived),
    )
    meta = named.select(*keys, "page_ord", F.explode(F.filter(kinds, lambda x: x["value"].isNotNull())).alias("k"), F.lit(0).alias("extra")).select(*keys, "k.*", "extra", F.col("page_ord").cast("long").alias("ord"))
    addr = pg.page_addresses(docs).join(docs.select("site", "url", "page_ord"), ["site", "url"])
    addr = addr.select(*keys, F.lit("Address").alias("candidate_type"), F.col("address").alias("value"), F.concat(F.lit("["), "how", F.lit("] "), "address").alias("evidence"), c.address_completeness("address").alias("extra"), F.col("page_ord").cast("long").alias("ord"))
    return checkpointed(meta.unionByName(addr))


_META = ["Organisation_Name", "Organisation_Legal_Form", "Organisation_Type", "Organisation_Nonprofit_Status"]


def best_candidates(spark: SparkSession, d: str) -> DataFrame:
    return cd.best_candidates(_candidates(spark, d))


def candidate_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Conflicts among the names that contacts of one site carry, each row a candidate of its source."""
    t = cd.eligible_sites(table(spark, d, "contacts_enriched")).where("Organisation_Name is not null")
    label = F.coalesce("Organisation_Name_Source", F.lit(""))
    kind = F.when(label.contains("Impressum"), "Impressum").when(label.contains("contact"), "Contact").when(label.contains("about"), "About").otherwise("Homepage")
    rows = t.select("site", F.col("Website").alias("url"), kind.alias("page_type"), F.lit("Organisation_Name").alias("candidate_type"), F.col("Organisation_Name").alias("value"), F.lit("").alias("evidence"), F.lit(0).alias("extra"), F.col("ID").alias("ord"))
    return cd.candidate_conflicts(rows).select("site", "value_key", "n")


def audit_rows(spark: SparkSession, d: str) -> DataFrame:
    return cd.audit(_candidates(spark, d), cd.eligible_sites(table(spark, d, "contacts_enriched")).select("site", "ID"))


def replaced_log(spark: SparkSession, d: str) -> DataFrame:
    """The audit of addresses replaced in an audit of everything."""
    rows = checkpointed(audit_rows(spark, d))
    return cd.replace_in_log(rows, rows.where("Candidate_Type = 'Address'"), ["Address"], "Candidate_Type").groupBy("Candidate_Type", "Selected").agg(F.count(F.lit(1)).alias("n"))


def applied_metadata(spark: SparkSession, d: str) -> DataFrame:
    best = checkpointed(cd.best_candidates(_candidates(spark, d)))
    return cd.apply_metadata(table(spark, d, "contacts_enriched"), best, _META).select("ID", "site", *_META, "Organisation_Name_Source")


def metadata_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return cd.metadata_conflicts(table(spark, d, "contacts_enriched"), checkpointed(cd.best_candidates(_candidates(spark, d))), _META[:3])


def primary_emails(spark: SparkSession, d: str) -> DataFrame:
    """Of all addresses that rows of a site carry the one that fits each contact's name."""
    t = table(spark, d, "contacts_enriched")
    rows = cd.eligible_sites(t).withColumn("email", F.lower(F.trim("Email"))).where(F.col("email").rlike(r"^[^\s@]+@[^\s@]+\.[a-z]{2,}$") & u.email_on_site(F.col("email"), F.col("site")))
    known = rows.groupBy("site", "email").agg(F.min("ID").alias("first")).select("site", "email", "first", F.lit("Homepage").alias("page_type"))
    return cd.primary_emails(t, known)


def applied_addresses(spark: SparkSession, d: str) -> DataFrame:
    return cd.apply_addresses(table(spark, d, "contacts_enriched"), checkpointed(cd.best_candidates(_candidates(spark, d))))


def search_ranking(spark: SparkSession, d: str) -> DataFrame:
    """Search results (here: sites of organisations that share a name's first word) scored against the name."""
    orgs = table(spark, d, "organisations_enriched").where("Organisation_Name is not null")
    word = F.lower(F.regexp_extract("Organisation_Name", r"^\s*(\S+)", 1))
    sites = orgs.where("Website_Normalized is not null").groupBy(word.alias("w")).agg(F.array_sort(F.collect_set("Website_Normalized")).alias("s"))
    results = orgs.select("Organisation_Name", word.alias("w")).distinct().join(sites, "w").select("Organisation_Name", F.posexplode("s").alias("p", "URL"))
    return cd.search_ranking(orgs, results.select("Organisation_Name", (F.col("p") + 1).alias("Rank"), "URL"))


def status_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Scrape records of all sites, upserted by a second run over the sites that answered 200."""
    t = table(spark, d, "organisations_enriched").where("Website_Normalized is not null").groupBy("Website_Normalized").agg(F.min("Website_Response_Code").alias("code"))
    record = lambda df, status, meta: df.select("Website_Normalized", F.lit(status).alias("Scrape_Status"), F.lit("2024-01-01T00:00:00+00:00").alias("Scraped_At"), F.lit("3").alias("Pages_Checked"), F.col("code").alias("HTTP_Status"), F.lit(None).cast("string").alias("Error_Message"), F.lit(meta).cast("string").alias("Org_Meta_Status"), F.lit(None).cast("string").alias("Email_Scrape_Status"), F.lit(None).cast("string").alias("Address_Scrape_Status"))
    return cd.upsert_status(record(t, "failed", "ok"), record(t.where("code = '200'"), "ok", None)).groupBy("Scrape_Status", "Org_Meta_Status").agg(F.count(F.lit(1)).alias("n"))


def checked_websites(spark: SparkSession, d: str) -> DataFrame:
    """Sites checked through a client that replays the table's own answers: the class of the host decides."""
    def replay(url: str) -> tuple[str, int | None, str | None]:
        return (url, 200, None) if url.startswith("https://www.") else (url, None, "CONNECTION_ERROR")

    sites = table(spark, d, "organisations_enriched").select(F.col("Website").alias("site"))
    return acquire.check_websites(sites, "site", replay)


QUERIES = {f.__name__: f for f in (
    organisations, contacts_split, url_keys, probe_variants, page_classes, cache_digests, blocked_sites, response_texts, eligible_sites, first_sites, unchecked_sites, filled_domains, cleared_contacts, updated_websites,
    parsed_pages, soft_errors, discovered_pages, manifests, loadable_pages, linked_objects, page_names, page_emails, site_emails, page_addresses, best_candidates, candidate_conflicts, audit_rows, replaced_log,
    applied_metadata, metadata_conflicts, primary_emails, applied_addresses, search_ranking, status_upsert, checked_websites,
)}


# ---------------------------------------------------------------------------------------------- SQL
def _val(x: str, na: bool = True) -> str:
    words = ["", "nan", "none", "<na>"] + (["na"] if na else [])
    return f"CASE WHEN lower({_strip(x)}) IN {_in(words)} THEN NULL ELSE {_strip(x)} END"


def _auth(x: str) -> str:
    return rf"regexp_extract({x}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)"


def _bare(x: str) -> str:
    return rf"regexp_replace(regexp_replace(lower({_auth(x)}), ':.*$', ''), '^www\.', '')"


def _url_key(x: str) -> str:
    s = f"regexp_replace({_strip(x)}, '#.*$', '')"
    rest = f"regexp_replace({s}, '^[A-Za-z][A-Za-z0-9+.-]*:', '')"
    path = rf"regexp_replace(regexp_replace(regexp_extract(regexp_replace({rest}, '^//[^/?]*', ''), '^([^?]*)', 1), ';[^/]*$', ''), '/+$', '')"
    query = rf"regexp_extract({rest}, '\?(.+)$', 1)"
    return rf"coalesce(nullif(lower(regexp_extract({s}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)), ''), 'https') || '://' || lower(regexp_extract({rest}, '^//([^/?]*)', 1)) || {path} || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END"


def _hosts(x: str, hosts: list[str]) -> str:
    return f"({x} IN {_in(hosts)} OR " + " OR ".join(f"ends_with({x}, '.{h}')" for h in hosts) + ")"


_ORG_KEY = f"regexp_replace(lower(coalesce({_val('Website_Normalized', False)}, {_val('Website', False)}, {_val('Email_Domain', False)})), '/+$', '')"
_EFF = f"coalesce({_val('Website_Normalized')}, {_val('Website')})"
_ELIGIBLE = f"(SELECT *, {_url_key(_EFF)} AS site FROM contacts_enriched WHERE {_EFF} IS NOT NULL AND NOT {_hosts(_bare(_EFF), v.BLOCKED_HOSTS)} AND {_val('Website_Response_Code')} = '200')"
_ORGS = f"""
WITH t AS (SELECT *, {_ORG_KEY} AS k FROM contacts_enriched),
u AS (UNPIVOT (SELECT k, ID, {", ".join(v.ORGANISATION_COLUMNS)} FROM t WHERE k IS NOT NULL) ON {", ".join(v.ORGANISATION_COLUMNS)} INTO NAME col VALUE raw),
n AS (SELECT k, col, {_strip('raw')} AS value, count(*) AS cnt, min(ID) AS first FROM u GROUP BY ALL HAVING value <> ''),
r AS (SELECT k, col, arg_max(value, (length(value), cnt, -first)) AS value FROM n GROUP BY ALL),
g AS (SELECT k, min(ID) AS first, count(*) AS Contact_Count, string_agg(ID::VARCHAR, ' | ' ORDER BY ID) AS Related_Contact_IDs FROM t WHERE k IS NOT NULL GROUP BY k),
o AS (SELECT row_number() OVER (ORDER BY first) AS Organisation_ID, k AS Organisation_Key, Related_Contact_IDs, Contact_Count FROM g)"""
_CLASS = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(p, '{w}')" for w in ws) + f" THEN '{k}'" for k, ws in v.PAGE_WORDS.items()) + " END"
_PATH = r"lower(regexp_extract(regexp_replace(Website, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '^([^?#]*)', 1))"
_VARIANT_BASE = rf"regexp_replace(lower({_auth(f'''CASE WHEN regexp_matches({_clean('Website')}, '(?i)^https?://') THEN {_clean('Website')} ELSE 'https://' || {_clean('Website')} END''')}), '^www\.', '')"
_SITES = f"(SELECT DISTINCT {_url_key('Website_Normalized')} AS site, {_bare('Website_Normalized')} AS h FROM organisations_enriched WHERE Website_Normalized IS NOT NULL)"

ORACLE = {
    "organisations": _ORGS + " SELECT Organisation_ID, Organisation_Key, " + ", ".join(f"max(value) FILTER (col = '{x}') AS {x}" for x in v.ORGANISATION_COLUMNS) + ", Related_Contact_IDs, Contact_Count FROM o LEFT JOIN r ON r.k = o.Organisation_Key GROUP BY ALL",
    "contacts_split": _ORGS + " SELECT t.ID, o.Organisation_ID, t.Contact_Name, t.Email, t.Phone FROM t LEFT JOIN o ON o.Organisation_Key = t.k",
    "url_keys": f"SELECT ID, {_url_key('Website')} AS url_key, {_ORG_KEY} AS org_key FROM contacts_enriched",
    "probe_variants": f"SELECT ID, unnest(['https://' || b, 'https://www.' || b, 'http://' || b, 'http://www.' || b]) AS variant FROM (SELECT ID, {_VARIANT_BASE} AS b FROM contacts_enriched) WHERE b <> ''",
    "page_classes": f"SELECT ID, {_CLASS} AS page_type, regexp_matches(p, '\\.(?:{'|'.join(v.SKIPPED_ENDINGS)})$') AS skippable FROM (SELECT ID, {_PATH} AS p FROM contacts_enriched WHERE Website IS NOT NULL)",
    "cache_digests": f"SELECT Organisation_ID, substring(sha256({_url_key('Website_Normalized')}), 1, 20) AS digest FROM organisations_enriched WHERE Website_Normalized IS NOT NULL",
    "blocked_sites": f"SELECT ID, h AS host, {_hosts('h', v.BLOCKED_HOSTS)} AS blocked, {_hosts('h', v.DIRECTORY_HOSTS)} AS directory FROM (SELECT ID, {_bare('Website')} AS h FROM contacts_enriched WHERE Website IS NOT NULL)",
    "response_texts": "WITH t AS (SELECT try_cast(Website_Response_Code AS INT) AS code FROM contacts_enriched) SELECT code, CASE code " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in v.STATUS_TEXTS.items()) + " ELSE 'HTTP ' || code END AS text, count(*) AS n FROM t WHERE code IS NOT NULL GROUP BY ALL",
    "eligible_sites": f"SELECT site, min(ID) AS first_id, count(*) AS n_rows FROM {_ELIGIBLE} GROUP BY site",
    "first_sites": f"SELECT site, min(ID) AS first_id, count(*) AS n_rows FROM {_ELIGIBLE} GROUP BY site ORDER BY first_id LIMIT 100",
    "unchecked_sites": f"SELECT DISTINCT Website FROM contacts_enriched WHERE {_val('Website')} IS NOT NULL AND Website NOT IN (SELECT Website FROM contacts_enriched WHERE {_val('Website')} IS NOT NULL AND {_val('Website_Response_Code')} IS NOT NULL)",
    "filled_domains": f"SELECT ID, coalesce(Email_Domain, d) AS Email_Domain, CASE WHEN Email_Domain IS NULL AND d IS NOT NULL THEN 'Derived from email' ELSE Email_Domain_Source END AS Email_Domain_Source FROM (SELECT *, CASE WHEN contains(Email, '@') THEN lower({_strip('substring(Email, instr(Email, chr(64)) + 1)')}) END AS d FROM contacts_enriched)",
    "cleared_contacts": f"WITH t AS (SELECT *, coalesce({_EFF} IS NOT NULL AND NOT {_hosts(_bare(_EFF), v.BLOCKED_HOSTS)} AND {_val('Website_Response_Code')} = '200', false) AS ok, coalesce(starts_with(lower(trim(Address_Source)), 'website'), false) AS w FROM contacts_enriched) SELECT ID, CASE WHEN NOT ok AND w THEN NULL ELSE Address END AS Address, CASE WHEN NOT ok AND w THEN NULL ELSE Address_Source END AS Address_Source, CASE WHEN NOT ok AND w THEN NULL ELSE Address_Alternatives END AS Address_Alternatives FROM t",
    "updated_websites": "WITH f AS (SELECT Email_Domain, Website, count(*) AS n FROM contacts_enriched WHERE Website IS NOT NULL AND Email_Domain IS NOT NULL GROUP BY ALL), b AS (SELECT Email_Domain, arg_max(Website, (n, Website)) AS s FROM f GROUP BY ALL) SELECT ID, coalesce(t.Website, b.s) AS Website, CASE WHEN t.Website IS NULL AND b.s IS NOT NULL THEN 'Email domain' ELSE Website_Source END AS Website_Source FROM contacts_enriched t LEFT JOIN b ON b.Email_Domain = t.Email_Domain",
    "soft_errors": f"""WITH n AS (SELECT {_url_key('Website_Normalized')} AS site, arg_min(coalesce(Organisation_Name, ''), Organisation_ID) AS name FROM organisations_enriched WHERE Website_Normalized IS NOT NULL GROUP BY 1),
o AS (SELECT *, [{', '.join(f"'{x}'" for x in ERROR_TITLES)}][Organisation_ID % {len(ERROR_TITLES)} + 1] AS h FROM organisations_enriched WHERE Website_Normalized IS NOT NULL)
SELECT site || p AS url, p = '' AND regexp_matches(name, '(?i){v.SOFT_ERROR}') AS soft_error FROM n, (SELECT unnest(['', '/impressum', '/kontakt.html']) AS p)
UNION ALL SELECT Organisation_ID || '/t', regexp_matches(coalesce(Website_Response_Text, '') || ' | ' || coalesce(Organisation_Name, ''), '(?i){v.SOFT_ERROR}') FROM o
UNION ALL SELECT Organisation_ID || '/h', regexp_full_match(h, '(?i)(?:{v.SOFT_ERROR})') FROM o""",
    "linked_objects": f"""SELECT site, site || '/impressum' AS url, '0.0.0' AS pos, '{{"@type":"Organization","email":"mailto:post@' || h || '"}}' AS obj FROM {_SITES}""",
    "parsed_pages": f"""WITH o AS (SELECT {_url_key('Website_Normalized')} AS site, arg_min({{'n': coalesce(Organisation_Name, ''), 'a': coalesce(Address, ''), 'h': {_bare('Website_Normalized')}}}, Organisation_ID) AS o
    FROM organisations_enriched WHERE Website_Normalized IS NOT NULL GROUP BY 1)
SELECT site, site AS url, 'Homepage' AS page_type, {_strip("o.n || ' | Start'")} AS title, 'x Impressum Kontakt Willkommen Offen Werkstatt' AS text, '' AS footer, 3::INT AS n_anchors FROM o
UNION ALL SELECT site, site || '/impressum', 'Impressum', 'Impressum', array_to_string(list_filter(['Impressum', {_strip("'Anbieter: ' || o.n")}, {_strip('o.a')}, 'Stand 2024'], lambda q: q <> ''), ' '), 'Stand 2024', 0 FROM o
UNION ALL SELECT site, site || '/kontakt.html', 'Contact', 'Kontakt', 'Schreiben team (at) ' || o.h || ' oder noreply@' || o.h, '', 1 FROM o""",
    "search_ranking": rf"""WITH g AS (SELECT DISTINCT Organisation_Name, lower(regexp_extract(Organisation_Name, '^\s*(\S+)', 1)) AS w FROM organisations_enriched WHERE Organisation_Name IS NOT NULL),
s AS (SELECT DISTINCT lower(regexp_extract(Organisation_Name, '^\s*(\S+)', 1)) AS w, Website_Normalized AS URL FROM organisations_enriched WHERE Organisation_Name IS NOT NULL AND Website_Normalized IS NOT NULL),
r AS (SELECT Organisation_Name, URL, row_number() OVER (PARTITION BY Organisation_Name ORDER BY URL) AS Rank,
    list_distinct(list_filter(regexp_extract_all(lower({_clean('Organisation_Name')}), '[a-zäöüß]+'), lambda q: length(q) > 2 AND q NOT IN {_in(v.STOPWORDS)})) AS kw FROM g JOIN s USING (w)),
h AS (SELECT *, {_bare('URL')} AS host, {_PATH.replace('Website', 'URL')} AS path FROM r),
p AS (SELECT *, (CASE WHEN {_hosts('host', v.DIRECTORY_HOSTS)} THEN -1 ELSE coalesce(list_sum(list_transform(kw, lambda q: CASE WHEN contains(host, q) THEN 2 WHEN contains(path, q) THEN 1 ELSE 0 END)), 0) END)::INT AS Score FROM h),
b AS (SELECT Organisation_Name, arg_max(URL, (Score, -Rank)) AS u FROM p GROUP BY ALL)
SELECT p.Organisation_Name, Rank::INT AS Rank, Score, CASE WHEN URL = b.u THEN 'yes' ELSE 'no' END AS Selected, URL FROM p JOIN b ON b.Organisation_Name = p.Organisation_Name""",
    "checked_websites": f"WITH s AS (SELECT DISTINCT Website FROM organisations_enriched WHERE Website IS NOT NULL), b AS (SELECT Website AS site, {_VARIANT_BASE} AS b FROM s) SELECT site, 'https://www.' || b AS website, '200' AS code, 'OK' AS text FROM b WHERE b <> ''",
    "discovered_pages": f"SELECT site, CASE t WHEN 'Impressum' THEN site || '/impressum' WHEN 'Contact' THEN site || '/kontakt.html' WHEN 'About' THEN site || '/ueber-uns' ELSE site || '/team' END AS url, t AS page_type, t IN ('About', 'Team') AS guessed FROM {_SITES}, (SELECT unnest(['Impressum', 'Contact', 'About', 'Team']) AS t)",
    "manifests": f"SELECT site, p AS page_ord, ['Homepage', 'Impressum', 'Contact'][p + 1] AS page_type, site || ['', '/impressum', '/kontakt.html'][p + 1] AS url FROM {_SITES}, (SELECT unnest([0, 1, 2])::INT AS p)",
    "loadable_pages": f"SELECT site, p AS page_ord, ['Homepage', 'Impressum', 'Contact'][p + 1] AS page_type, site || ['', '/impressum', '/kontakt.html'][p + 1] AS url FROM {_SITES}, (SELECT unnest([0, 1, 2])::INT AS p)",
    "page_emails": f"SELECT site, t AS page_type, e || '@' || h AS email, w AS how FROM {_SITES}, (VALUES ('Impressum', 'post', 'JSON-LD'), ('Contact', 'info', 'mailto')) x(t, e, w)",
    "site_emails": f"SELECT site, e || '@' || h AS email, site || p AS url, t AS page_type FROM {_SITES}, (VALUES ('Impressum', 'post', '/impressum'), ('Contact', 'info', '/kontakt.html')) x(t, e, p)",
    "candidate_conflicts": f"""WITH c AS (SELECT site, lower(trim(regexp_replace(Organisation_Name, '[\\s\\p{{Z}}]+', ' ', 'g'))) AS value_key, CASE WHEN contains(Organisation_Name_Source, 'Impressum') THEN 6 WHEN contains(Organisation_Name_Source, 'contact') THEN 5 WHEN contains(Organisation_Name_Source, 'about') THEN 3 ELSE 1 END AS p FROM {_ELIGIBLE} WHERE Organisation_Name IS NOT NULL),
i AS (SELECT * FROM c QUALIFY max(p) OVER (PARTITION BY site) - p < {v.CONFLICT_GAP}), g AS (SELECT site, value_key, count(*) AS n FROM i GROUP BY ALL) SELECT site, value_key, n FROM g QUALIFY count(*) OVER (PARTITION BY site) > 1""",
    "status_upsert": "WITH t AS (SELECT Website_Normalized, min(Website_Response_Code) AS c FROM organisations_enriched WHERE Website_Normalized IS NOT NULL GROUP BY ALL) SELECT CASE WHEN c = '200' THEN 'ok' ELSE 'failed' END AS Scrape_Status, 'ok' AS Org_Meta_Status, count(*) AS n FROM t GROUP BY ALL",
}
