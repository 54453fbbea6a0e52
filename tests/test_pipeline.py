import json
from urllib.parse import urljoin

from pyspark.sql import functions as F

from tidewright.functions import contact as c
from tidewright.functions import values as v
from tidewright.operators import candidates as cd
from tidewright.operators import numbering, resolve, split, staging
from tidewright.operators import pages as pg
from tidewright.sources import acquire, files
from tidewright.streaming import incremental

CONTACT = ", ".join(f"{x} {'long' if x == 'ID' else 'string'}" for x in v.CONTACT_COLUMNS)


def contacts(spark, *rows):
    return spark.createDataFrame([tuple(r.get(x) for x in v.CONTACT_COLUMNS) for r in rows], CONTACT)


def test_numbers_follow_the_order(spark):
    df = spark.range(1000).select((F.lit(1000) - F.col("id")).alias("k"), F.lit("a").alias("ID_old"))
    got = numbering.sequential_ids(df, ["k"]).orderBy("k").collect()
    assert [r.ID for r in got] == list(range(1, 1001))
    assert numbering.sequential_ids(df.limit(0), ["k"]).count() == 0


def test_clusters(spark):
    rows = contacts(spark, *[dict(ID=i, Organisation_Name="Org", Contact_Name=n, Email=e) for i, n, e in (
        (1, "Anna Berg", "a@x.de"), (2, "Anna", None), (3, None, "a@x.de"), (4, "Jo", None), (5, "Jo", None), (6, None, "z@x.de"))], dict(ID=7, Contact_Name="Solo Person"))
    got = {r.ID: r.cluster for r in resolve.contact_clusters(rows).collect()}
    assert got[1] == got[2] == got[3] and len({got[i] for i in (1, 4, 5, 6, 7)}) == 5
    again = {r.ID: r.cluster for r in resolve.contact_clusters(rows.orderBy(F.rand(1))).collect()}
    assert again == got


def test_conflicts_and_merge(spark):
    base = dict(Organisation_Name="Org e.V.", Contact_Name="Anna Berg")
    rows = contacts(
        spark, base | dict(ID=1, Email="a@x.de", Phone_Alternatives="1 | 2"), base | dict(ID=2, Website="https://x.de", Phone_Alternatives="2 | 3", Role="Lead"), base | dict(ID=3, Contact_Name="Bo Ray", Email="b@x.de"),
        base | dict(ID=4, Contact_Name="Bo Ray", Email="c@x.de"),
    )
    out = resolve.resolved_contacts(rows).collect()
    assert sorted(r.outcome for r in out) == ["conflict", "conflict", "merged"]
    merged = next(r for r in out if r.outcome == "merged")
    assert (merged.ID, merged.Email, merged.Website, merged.Phone_Alternatives, merged.Role, merged.Organisation_Name) == (2, "a@x.de", "https://x.de", "1 | 2 | 3", "Lead", "Org e.V")
    review = resolve.review_list(rows).collect()
    assert {(r.ID, r.selected) for r in review} == {(3, "X"), (4, "")} and review[0].verify_reason == "Email"


def test_review_overrides(spark):
    staged = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "ID long, Email string, Role string")
    dup = spark.createDataFrame([("1", "X", "yes", "edited", "g"), ("2", "", "yes", "b", "g")], "ID string, selected string, to_verify string, Email string, duplicate_group string")
    names = spark.createDataFrame([("1", "yes", ""), ("3", "no", "c")], "ID string, selected string, Email string")
    assert {tuple(r) for r in resolve.apply_review(staged, dup).collect()} == {(1, "edited", "x"), (3, "c", "z")}
    assert {tuple(r) for r in resolve.apply_review(staged, dup, names).collect()} == {(1, "", "x")}


def test_staging(spark):
    df = spark.createDataFrame([("team", "", "a@x.de b@y.de", "https://www.foo.de"), (None, None, None, None)], "Contact_Name string, Organisation_Name string, Email string, Website string")
    got = [r.Issues for r in staging.staging_flags(df).orderBy(F.col("Email").isNull()).collect()]
    assert got == ["Suspicious_Contact_Name | Invalid_Email_Format | Multiple_Emails_In_Main_Field | Multiple_Websites_In_Main_Field", "Almost_Empty_Row"]
    src = spark.createDataFrame([(" x ", "1")], "`A b` string, B string")
    row = staging.map_columns(src, {"Name": "A b", "Kind": "__CONSTANT__:k", "No": "zz"}, ["Name", "Kind", "No", "Free"]).first()
    assert tuple(row) == ("x", "k", "", "")


def test_split(spark):
    df = spark.createDataFrame([(1, "https://A.de/", "AB"), (2, "https://a.de", "AB"), (3, "https://a.de", "ABC"), (4, None, "Z")], "ID long, Website string, Organisation_Name string")
    df = df.withColumns({x: F.lit(None).cast("string") for x in ("Website_Normalized", "Email_Domain")})
    orgs = split.organisations(df).collect()
    assert [(o.Organisation_ID, o.Organisation_Name, o.Related_Contact_IDs, o.Contact_Count) for o in orgs] == [(1, "ABC", "1 | 2 | 3", 3)]
    assert {(r.ID, r.Organisation_ID) for r in split.contacts_split(df, split.organisations(df)).collect()} == {(1, 1), (2, 1), (3, 1), (4, None)}


HTML = """<html><head><title>Foo Verein | Start</title><script type="application/ld+json">{"@graph":[{"@type":"Organization","name":"Foo Verein e.V.","email":"mailto:ld@foo.de",
"address":{"@type":"PostalAddress","streetAddress":"Alter Ring 1","postalCode":"10115","addressLocality":"Berlin"}}]}</script><script>var a = "</p>";</script></head>
<body><a href="mailto:In%66o@foo.de?subject=x">Mail</a><a href="/impressum">I</a><a href="https://foo.de/kontakt/">K</a><p>team (at) foo (dot) de<p>x@example.com<p>Hauptstraße 5, 10117 Berlin</p><footer>F</footer></body>"""


def page_frame(spark, *rows):
    return spark.createDataFrame(list(rows), "site string, url string, page_type string, page_ord int, html string")


def test_pages(spark):
    docs = pg.parsed_pages(page_frame(spark, ("https://foo.de", "https://foo.de", "Homepage", 0, HTML), ("https://foo.de", "https://foo.de/x", "About", 1, "<title>404 - not found</title><p>unclosed"), ("https://foo.de", "https://foo.de/n", "Team", 2, None)))
    docs = docs.cache()
    home = docs.where("page_ord = 0")
    doc = home.first().doc
    assert doc.title == "Foo Verein | Start" and doc.footer == "F" and "var a" not in doc.text
    assert [(r.name, r.evidence) for r in pg.page_names(home).collect()] == [("Foo Verein e.V.", "[JSON-LD] Foo Verein e.V.")]
    assert {(r.email, r.how) for r in pg.page_emails(home).collect()} == {("info@foo.de", "mailto"), ("ld@foo.de", "JSON-LD"), ("team@foo.de", "text")}
    assert {(r.address, r.how) for r in pg.page_addresses(home).collect()} == {("Alter Ring 1, 10115 Berlin", "JSON-LD"), ("Hauptstraße 5, 10117 Berlin", "text")}
    found = {(r.page_type, r.url, r.guessed) for r in pg.discovered_pages(home).collect()}
    assert ("Impressum", "https://foo.de/impressum", False) in found and ("Contact", "https://foo.de/kontakt", False) in found and ("Team", "https://foo.de/team", True) in found
    assert [r[0] for r in docs.orderBy("page_ord").select(pg.is_soft_error(F.col("doc"))).collect()] == [False, True, False]
    back = pg.read_manifests(pg.manifest_json(docs))
    assert [r.url for r in back.orderBy("page_ord").collect()] == ["https://foo.de", "https://foo.de/x", "https://foo.de/n"]
    assert pg.loadable_pages(back, docs.select("site", "url", "doc")).count() == 2
    assert pg.loadable_pages(back, home.select("site", "url", "doc")).count() == 0
    assert pg.read_manifests(spark.createDataFrame([("s", "{bad"), ("s", json.dumps({"cache_version": 1, "pages": []}))], "site string, manifest string")).count() == 0


def test_loadable_pages_broadcast_no_parsed_page(spark):
    pages = page_frame(spark, ("s", "s/a", "Homepage", 0, HTML), ("s", "s/b", "Team", 1, "<title>404 - not found</title>"), ("t", "t/a", "Homepage", 0, HTML), ("t", "t/b", "Team", 1, None))
    docs = pg.parsed_pages(pages).where("url <> 't/b'").localCheckpoint()
    got = pg.loadable_pages(pages.drop("html"), docs.select("site", "url", "doc"))
    assert [(r.url, r.page_ord, r.doc.title) for r in got.collect()] == [("s/a", 0, "Foo Verein | Start")]
    for df in (got, got.select("site", "url")):
        assert "BroadcastExchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_urls_resolve_as_in_a_browser(spark):
    cases = [("https://a.de", h) for h in ("", "/x", "x/y", "../z", "a/../b?q=1#f", "./", "//b.de/x", "https://c.de", "?q=2", "kontakt.html", "/a/./b/..", "#top", "mailto:x@y.de")] + [("https://a.de/verein/", "team"), ("https://a.de/v", "../x")]
    df = spark.createDataFrame(cases, "site string, href string")
    got = [r[0] for r in df.select(pg.resolve_url("site", "href")).collect()]
    assert got[1:] == [urljoin(s.rstrip("/") + "/", h) for s, h in cases][1:] and got[0] == "https://a.de/"
    assert [r[0] for r in spark.createDataFrame([("a%20b+c",), ("50%",), (None,)], "s string").select(pg.unquoted(F.col("s"))).collect()] == ["a b+c", "50%", None]


def test_impressum_names_carry_the_written_form(spark):
    page = "<title>x</title><body><p>Impressum</p><p>Anbieter: Foo e. V.</p>" + "<p>z</p>" * 900 + "<p>Late GmbH</p>"
    late = "<title>x</title><body><p>" + "wort " * 400 + "</p><p>Late GmbH</p>"
    docs = pg.parsed_pages(page_frame(spark, ("https://f.de", "https://f.de/i", "Impressum", 1, page), ("https://g.de", "https://g.de/i", "Impressum", 1, late)))
    assert {(r.site, r.name) for r in pg.page_names(docs).collect()} == {("https://f.de", "Foo e.V.")}


def test_many_objects_keep_their_order(spark):
    graph = [{"@type": "Organization", "name": f"Nr {i} Verein"} for i in range(1500)]
    html = f'<script type="application/ld+json">{json.dumps({"@graph": graph})}</script><script type="application/ld+json">{json.dumps({"@type": "Organization", "name": "Zweiter"})}</script>'
    docs = pg.parsed_pages(page_frame(spark, ("https://f.de", "https://f.de", "Homepage", 0, html)))
    listed = [r.name for r in pg.linked_objects(docs).orderBy("pos").select(F.expr("try_variant_get(obj, '$.name', 'string')").alias("name")).collect()]
    assert listed == [g["name"] for g in graph] + ["Zweiter"]
    assert pg.page_names(docs).first().name == "Nr 0 Verein"


def test_long_lists_are_not_cut(spark):
    lines = spark.createDataFrame([("\n".join(f"Zeile {chr(97 + i % 26)}{i}" for i in range(10_050)),)], "o string")
    assert len(lines.select(c.organisation_leftovers("o")).first()[0].split(" | ")) == 10_049


def test_candidates(spark):
    rows = [("s", f"u{i}", t, "Organisation_Name", val, "e", 0, i) for i, (t, val) in enumerate([("Impressum", "A GmbH"), ("Contact", "B GmbH"), ("Homepage", "C"), ("Impressum", "a  gmbh")])]
    df = spark.createDataFrame(rows, "site string, url string, page_type string, candidate_type string, value string, evidence string, extra int, ord long")
    assert [r.value for r in cd.best_candidates(df).collect()] == ["A GmbH"]
    assert sorted(r.value for r in cd.candidate_conflicts(df).collect()) == ["A GmbH", "B GmbH"]
    log = spark.createDataFrame([("Multiple scraped addresses",), ("Conflicting Address",)], "Issue_Type string")
    assert [r[0] for r in cd.replace_in_log(log, log.limit(0), ["Address"], "Issue_Type").collect()] == ["Multiple scraped addresses"]


def test_acquisition(spark):
    def probe(url):
        return (url, 200, None) if url == "http://a.de" else (url, 404, None) if "b.de" in url else (url, None, "TIMEOUT")

    sites = spark.createDataFrame([("a.de",), ("b.de",), ("c.de",), ("a.de",), (None,)], "site string")
    got = {r.site: (r.code, r.text) for r in acquire.check_websites(sites, "site", probe).collect()}
    assert got == {"a.de": ("200", "OK"), "b.de": ("404", "Not Found"), "c.de": ("TIMEOUT", "Connection failed")}
    assert [tuple(r) for r in acquire.probe_hosts(sites, "site", probe).collect()] == [("a.de", "http://a.de", 200)]
    calls = {"n": 0}

    def client(name):
        calls["n"] += 1
        return (200, {"web": {"results": [{"url": f"https://{name}.de"}]}}, None)

    orgs = spark.createDataFrame([("x",), ("x",), (None,)], "Organisation_Name string")
    assert [(r.Rank, r.URL) for r in acquire.search(orgs, client, sleep=lambda _: None).collect()] == [(1, "https://x.de")]
    pages = spark.createDataFrame([("https://a.de/p",), ("https://a.de/k",), ("https://a.de/f.pdf",)], "url string")
    known = spark.createDataFrame([("https://a.de/k",)], "url string")
    assert [r.url for r in acquire.fetch_pages(pages, known, lambda u: (u, 200, "text/html", "x")).collect()] == ["https://a.de/p"]

    def failing(url):
        if url.endswith("/e"):
            raise OSError("reset")
        return (url, 200, "text/html", "<title>404</title>" if url.endswith("/s") else "ä" * 20)

    asked = spark.createDataFrame([("https://a.de/e",), ("https://a.de/s",), ("https://a.de/p",)], "url string")
    assert [(r.url, r.html) for r in acquire.fetch_pages(asked, known, failing, most=31, sleep=lambda _: None).collect()] == [("https://a.de/p", "ä" * 15)]


def test_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "plain.csv").write_bytes("﻿Name,Mail,Mail\nBüro,a@x.de,b@x.de\n".encode())
    (folder / "offset.csv").write_bytes("junk\nName,Ort\nCaf\xe9,\"Köln\nSüd\"\n".encode("cp1252"))
    (folder / "empty.csv").write_bytes(b"")
    (folder / "selection.csv").write_bytes(b"a,b\n1,2\n")
    exports = files.read_exports(spark, str(folder), {"offset.csv": 1}).cache()
    got = {(r.Source_File, r.Source_Row): r.cells for r in exports.collect()}
    assert got["plain.csv", "2"] == {"Name": "Büro", "Mail": "a@x.de", "Mail.1": "b@x.de"}
    assert got["offset.csv", "3"]["Ort"] == "Köln\nSüd" and len(got) == 2
    maps = {"plain.csv": {"Organisation_Name": "Name", "Sector": "__CONSTANT__:S", "Phone": "none"}}
    assert [tuple(r) for r in files.map_exports(exports, maps, ["Organisation_Name", "Sector", "Phone"]).collect()] == [("plain.csv", "2", "Büro", "S", "")]
    assert {(r.Source_File, r.state) for r in files.import_report(exports, maps).collect()} == {("plain.csv", "OK"), ("offset.csv", "NO MAPPING")}
    df = spark.createDataFrame([('a "q", b\nc', None)], "x string, y string")
    files.write_csv(df, str(tmp_path / "out"), bom=True)
    assert tuple(files.read_csv(spark, str(tmp_path / "out")).first()) == ('a "q", b\nc', "")
    assert files.optional(spark, str(tmp_path / "none"), "a string").count() == 0


def test_stream(spark, tmp_path):
    src, out = str(tmp_path / "pages"), str(tmp_path / "names")
    page_frame(spark, ("https://foo.de", "https://foo.de", "Homepage", 0, HTML)).write.parquet(src)
    for _ in range(2):
        incremental.page_stream(spark, src, out, str(tmp_path / "ck")).awaitTermination()
    page_frame(spark, ("https://foo.de", "https://foo.de", "Homepage", 0, HTML.replace("Foo Verein e.V.", "Neu e.V."))).write.mode("append").parquet(src)
    incremental.page_stream(spark, src, out, str(tmp_path / "ck")).awaitTermination()
    assert [r.name for r in incremental.latest(spark, out, "url").collect()] == ["Neu e.V."]
