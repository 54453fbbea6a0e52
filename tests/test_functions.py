from pyspark.sql import functions as F

from tidewright.functions import contact as c
from tidewright.functions import text as t
from tidewright.functions import urls as u
from tidewright.operators.names import split_name


def one(spark, expr, **cells):
    schema = ", ".join(f"{k} string" for k in cells) or "x string"
    return spark.createDataFrame([tuple(cells.values()) or (None,)], schema).select(expr.alias("r")).first()[0]


def test_strip_and_missing(spark):
    assert one(spark, t.strip("x"), x="  a b \n") == "a b"
    for cell in (None, "", "  ", "k. A.", "N.N.", "--", "keine Angabe", "NULL", "–"):
        assert one(spark, t.is_missing("x"), x=cell) is True
    for cell in ("X", "12", "Nina", "info@x.example"):
        assert one(spark, t.is_missing("x"), x=cell) is False


def test_match_key(spark):
    assert one(spark, t.match_key("x"), x="  Straße & Café_Büro!  ") == "straße cafe_buro"
    assert one(spark, t.match_key("x"), x=None) == ""
    assert one(spark, t.match_key("x"), x="¼ ™") == "1 4 TM"
    assert one(spark, t.match_key("x"), x="über") == "uber"


def test_unique_list_and_pipes(spark):
    assert one(spark, t.unique_list(F.split("x", "#")), x="a.#A#b;# #c") == ["a", "b", "c"]
    assert one(spark, t.split_pipes("x"), x=" a |b|| ") == ["a", "b"]
    assert one(spark, t.val("x"), x=" NaN ") is None
    assert one(spark, t.val("x", also_na=False), x="na") == "na"


def test_emails(spark):
    get = lambda x, **k: one(spark, c.emails("x", **k), x=x)
    assert get("kate@firma.de") == ["e@firma.de"]
    assert get("info@data.de") == ["d@a.de"]
    assert get("info (at) firma (dot) de") == ["info@firma.de"]
    assert get("A@x.de; a@X.de") == ["a@x.de"]
    assert get("kate@firma.de", mode="strict") == ["kate@firma.de"]
    assert get(None) == []


def test_urls_and_phones(spark):
    assert one(spark, c.urls("x"), x="info@foo.de") == ["https://foo.de"]
    assert one(spark, c.phones("x"), x="+49 30 1234567") == ["+49 30 1234567"]
    assert one(spark, c.phones("x"), x="(030) 1234567") == ["030) 1234567"]
    assert one(spark, c.phones("x"), x="12345") == []
    assert len(one(spark, c.phones("x"), x="2024-01-01")) == 1
    assert one(spark, u.url_candidate("x"), x="www.Foo.de.") == "https://www.Foo.de"
    assert one(spark, u.website_domain("x"), x="www.Foo.de.") == "foo.de"
    assert one(spark, u.url_key("x"), x="HTTPS://WWW.Foo.de/Path/?q=1#x") == "https://www.foo.de/Path?q=1"
    assert one(spark, u.url_key(F.lit("https://www.foo.de/Path?q=1"))) == "https://www.foo.de/Path?q=1"
    assert one(spark, u.page_class("x"), x="/company/contact") == "Contact"
    assert one(spark, u.page_class("x"), x="/steam") == "Team"
    assert one(spark, u.probe_variants("x"), x="http://www.a.de/p")[:2] == ["https://a.de", "https://www.a.de"]
    assert one(spark, u.skippable("x"), x="https://a.de/b.PDF?x") is True


def test_names_and_organisations(spark):
    assert one(spark, c.organisation_name("x"), x="> Foo GmbH\nBar") == "Foo GmbH"
    assert one(spark, c.organisation_leftovers("x"), x="> Foo GmbH\nBar") == "Bar"
    assert one(spark, c.organisation_name("x"), x="Foo 3 x Bar") == "Foo"
    assert one(spark, c.clean_name("x"), x="N/A") == ""
    assert [one(spark, c.domain_strict("x"), x="a@b@c"), one(spark, c.domain_last("x"), x="a@b@c"), one(spark, c.domain_first("x"), x="a@b@c")] == ["", "c", "b@c"]
    assert tuple(one(spark, split_name("x"), x="Dr. Anna von der Heide")) == ("Anna", "von der Heide")
    assert tuple(one(spark, split_name("x"), x="Berg, Anna")) == ("Anna", "Berg")
    assert tuple(one(spark, split_name("x"), x="Anna")) == (None, None)


def test_scores(spark):
    assert one(spark, c.address_quality("x"), x="Hauptstr. 5, 10115 Berlin") == 205
    assert one(spark, c.address_completeness("x"), x="Hauptstr. 5, 10115 Berlin") == 4
    assert one(spark, c.name_in_email(F.lit("j.mueller@x.de"), F.lit(None).cast("string"), F.lit("Müller"))) == 0
    words = c.keywords(F.lit("Blau Werk GmbH"))
    assert one(spark, words) == ["blau", "werk"]
    for url, score in (("https://blauwerk.de/", 4), ("https://foo.de/blau", 1), ("https://www.linkedin.com/company/blau", -1)):
        assert one(spark, c.search_score(F.lit(url), words)) == score


def test_legal_forms(spark):
    for text, form in (("Foo gGmbH", "gGmbH"), ("Foo GmbH & Co. KG", "GmbH & Co. KG"), ("Werkzeug AG", "UG"), ("Kiev", "e.V."), ("Foo", None)):
        assert one(spark, c.legal_form("x"), x=text) == form
    for form, text, status in (("GmbH", "", "No"), ("e.V.", "", "Unclear"), ("e.V.", "gemeinnützig", "Yes")):
        assert one(spark, c.nonprofit(F.lit(form), F.lit(text))) == status
    assert one(spark, c.title_name("x"), x="Foo Verein | Start") == "Foo Verein"
    assert one(spark, c.plausible_organisation("x"), x="GmbH") is False


def test_sites(spark):
    on = lambda e, s: one(spark, u.email_on_site(F.lit(e), F.lit(s)))
    assert on("x@mail.foo.de", "https://foo.de") and on("x@foo.de", "https://shop.foo.de") and not on("x@bar.de", "https://foo.de")
    assert one(spark, u.is_blocked("x"), x="https://de.linkedin.com/in/a") is True
    assert one(spark, u.is_blocked("x"), x="gmail.com") is False  # without a scheme there is no host
