"""Functions of names and texts against tables of cases."""

from pyspark.sql import functions as F
from test_urls import column, values

from millrace.functions import text as tx


def test_organisation_types(spark):
    rows = [
        ("Oslo University Hospital", None, "education"), ("Cégep de Matane", None, "education"), ("Mayo Clinic", None, "healthcare"), ("Clinical Labs", None, "company"), ("City of Boston", None, "public body"),
        ("Pearson", "education; publishing", "company"), ("Acme", "Higher Education ; x", "education"), ("Acme", "hospital", "healthcare"), ("British Army", None, "public body"), ("Armytek", None, "company"), (None, None, "company"),
    ]
    got = values(spark, [r[:2] for r in rows], tx.organization_type(F.col("a"), F.col("b")))
    assert [g[0] for g in got] == [r[2] for r in rows]


def test_sectors(spark):
    column(spark, [
        ("computer software", "it"), ("retail; Cloud computing", "it"), ("computer science", ""), ("computer simulation", ""), ("computer hardware", "it"), ("IT services", "it"), ("italian food", ""),
        ("internet", "it"), ("internet of things", ""), ("medical technology", ""), ("technology", "it"), ("", ""), (None, ""),
    ], tx.sector)


def test_names(spark):
    column(spark, [("tata consultancy services pvt ltd", "Tata Consultancy Services Pvt Ltd"), ("l&t infotech", "L&T Infotech"), ("bank of india", "Bank of India"), ("the coca-cola plc", "The Coca-Cola PLC"), ("IBM india", "IBM india"), (None, None)], tx.nice_name)
    column(spark, [("united states of america", "United States of America"), ("", None), (None, None)], tx.nice_place)
    column(spark, [("1001-5000", 1001), ("10,001+", 10001), (" 51-200", 51), ("unknown", None), (None, None)], tx.band_lower_bound)
    match = tx.name_matches(F.col("a"), F.col("b"))
    assert values(spark, [("General Motors Company", "https://www.general-motors.com/"), ("General Motors", "https://general-electric.com"), ("The Co", "https://the.co"), ("AB InBev", None)], match) == [(True,), (False,), (False,), (False,)]


def test_career_words(spark):
    column(spark, [("Careers", True), ("Our JOBS", True), ("carrières", True), ("TYÖPAIKAT", True), ("採用情報", True), ("jobless", False), ("About", False)], tx.has_career_text)
    column(spark, [("Graduate programme", True), ("Praktikum bei uns", True), ("校招", True), ("Undergraduates", False)], tx.is_graduate)


def test_regions(spark):
    region = tx.region_of(F.col("a"), F.col("b"))
    rows = [("Jobs in South Africa", "/", "South Africa"), ("Indiana", "/", None), ("india", "/", None), ("Careers", "/en/united-kingdom/", "United Kingdom"), ("Careers", "/uk/", None), ("Lambda USA careers", "/", "USA"), ("x", "/latin_america", "Latin America")]
    assert [g[0] for g in values(spark, [r[:2] for r in rows], region)] == [r[2] for r in rows]


def test_bands_and_countries(spark):
    got = values(spark, [("1,001-5,000 employees",), ("10,001+",), ("51 to 200",), ("about 300",), ("none",), (None,)], tx.employee_band(F.col("a")))
    assert [tuple(g[0]) for g in got] == [("1,001-5,000", 1001), ("10,001+", 10001), ("51-200", 51), ("about 300", 300), (None, None), (None, None)]
    known = F.create_map(F.lit("norway"), F.lit("Norway"), F.lit("germany"), F.lit("Germany"))
    column(spark, [("Bengaluru, Karnataka", "India"), ("Austin, Texas, US", "United States"), ("Oslo, Norway", "Norway"), ("Berlin, DE", "United States"), ("Atlantis", None), (None, None)], lambda c: tx.country_from(c, known))
    assert values(spark, [("acme-inc", None), (None, "Acme & Co."), (None, "  ")], tx.cache_key(F.col("a"), F.col("b"))) == [("acme-inc",), ("acme_co.",), ("unnamed",)]


def test_references_without_a_semicolon_can_stay():
    from millrace.operators import pages

    html = "<title>A&amp;B &quot;C&quot; &#65;&#x42; R&D &notit; &amp</title><body><a href='/x?a=1&copy=2&amp;b=3'>&lt;go&gt</a>"
    title, _, links = pages.read_html("https://e.com", html, closed_references=True)
    assert title == 'A&B "C" AB R&D &notit; &amp' and [x[1:3] for x in links] == [("https://e.com/x?a=1&copy=2&b=3", "<go&gt")]
    assert pages.read_html("https://e.com", html)[0].endswith("&")
