"""URL functions against tables of cases."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import url as ux


def values(spark, rows, *columns):
    """rows: tuples of strings; columns: expressions over a, b, ..."""
    names = "abcdef"[: len(rows[0])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{n} string" for n in names))
    return [tuple(r)[1:] for r in df.select("i", *(c.alias(f"c{k}") for k, c in enumerate(columns))).orderBy("i").collect()]


def column(spark, cases, expression):
    got = [r[0] for r in values(spark, [(c,) for c, _ in cases], expression(F.col("a")))]
    assert got == [want for _, want in cases]


def test_providers(spark):
    column(spark, [
        ("https://acme.wd5.myworkdayjobs.com/External", "Workday"), ("https://wd3.myworkdaysite.com/recruiting/x", "Workday"), ("https://www.workday.com/acme/d/home", "Workday"),
        ("https://www.workday.com/en-us/home.html", None), ("boards.greenhouse.io/acme", "Greenhouse"), ("https://jobs.lever.co/acme", "Lever"), ("https://career5.successfactors.eu/career", "SuccessFactors"),
        ("https://jobs.sap.com/x", "SuccessFactors"), ("https://notjobs.sap.com/x", None), ("https://acme.taleo.net/careersection", "Oracle/Taleo"),
        ("https://x.fa.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX", "Oracle Recruiting Cloud"), ("https://x.fa.oraclecloud.com/other", None),
        ("https://careers.acme.com/hcmUI/CandidateExperience/en", "Oracle Recruiting Cloud"), ("https://workforcenow.adp.com/mascsr/default/mdf/recruitment/x", "ADP"), ("https://www.adp.com/about", None),
        ("https://fakelever.co/acme", None), ("https://www.acme.com/careers", None), (None, None), ("", None),
    ], ux.detect_ats)


def cleaned(url):
    return ux.clean_ats_url(url, ux.detect_ats(url))


def test_clean_provider_urls(spark):
    column(spark, [
        ("https://acme.wd3.myworkdayjobs.com/AcmeCareers/login?redirect=%2Fx", "https://acme.wd3.myworkdayjobs.com/AcmeCareers"),
        ("https://acme.wd3.myworkdayjobs.com/en-US/AcmeCareers/job/1", "https://acme.wd3.myworkdayjobs.com/en-US/AcmeCareers"),
        ("https://acme.wd3.myworkdayjobs.com/", "https://acme.wd3.myworkdayjobs.com/"),
        ("https://career5.successfactors.eu/career?company=acme&site=1", "https://career5.successfactors.eu/career?company=acme"),
        ("https://e.fa.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX_1/jobs?keyword=MBA", "https://e.fa.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX_1"),
        ("https://jobs.lever.co/acme/1234?utm_source=x", "https://jobs.lever.co/acme"), ("https://boards.greenhouse.io/embed/job_board?for=acme", "https://boards.greenhouse.io/acme"),
        ("https://acme.icims.com/jobs/login?x=1", "https://acme.icims.com/"), ("https://acme.avature.net/careers?utm_source=a&b=c#top", "https://acme.avature.net/careers?b=c"), ("https://jobs.lever.co", "https://jobs.lever.co/"),
    ], cleaned)


def test_tenants(spark):
    column(spark, [
        ("https://jobs.lever.co/Acme/1", "Lever:acme"), ("https://boards.greenhouse.io/embed/job_board/js?for=acme", "Greenhouse:acme"),
        ("https://acme.wd3.myworkdayjobs.com/en-US/X", "Workday:acme.wd3.myworkdayjobs.com"), ("https://www.acme.com/", None),
    ], lambda u: ux.ats_tenant(u, ux.detect_ats(u)))


def test_tracking(spark):
    column(spark, [
        ("https://a.com/x?utm_source=b&utm_medium=c", "https://a.com/x"), ("https://a.com/x?q=1&gclid=2#f", "https://a.com/x?q=1"), ("https://a.com/x?cid=5", "https://a.com/x?cid=5"),
        ("https://a.com/x?LNK=5&b", "https://a.com/x?b="), ("https://a.com/x?q=a%20b&r=%2A~", "https://a.com/x?q=a+b&r=%2A~"),
    ], ux.strip_tracking)


def test_page_keys_join_variants(spark):
    key = lambda u: ux.page_key(u, ux.detect_ats(u))
    rows = [("https://A.com/careers/?locale=de_DE&utm_source=x",), ("http://a.com/careers",), ("https://a.com/careers?b=2&a=1",), ("https://a.com/careers?a=1&b=2&lang=en",), ("https://a.com/",), ("https://a.com",)]
    got = [r[0] for r in values(spark, rows, key(F.col("a")))]
    assert got[0] == got[1] and got[2] == got[3] and got[4] == got[5] and len(set(got)) == 3


@pytest.mark.parametrize("url", [
    "https://a.com/login", "https://a.com/my-account/x", "https://a.com/saved-jobs", "https://a.com/job/123", "https://a.com/jobs/4", "https://a.com/x?jobId=5", "https://stories.a.com/x", "https://a.com/blog/x",
    "https://a.com/careers/eeo", "https://a.com/recruitment-fraud", "https://a.com/privacy", "https://a.com/a-plan-to-create-many-new-jobs",
])
def test_pages_that_are_no_portal(spark, url):
    assert values(spark, [(url,)], ux.is_not_portal(F.col("a"))) == [(True,)]


@pytest.mark.parametrize("url", ["https://a.com/careers", "https://a.com/jobs", "https://a.com/work-with-us", "https://jobs.a.com/search?q=x", "https://a.com/en/about/careers-at-a"])
def test_pages_that_may_be_portals(spark, url):
    assert values(spark, [(url,)], ux.is_not_portal(F.col("a"))) == [(False,)]


def test_hosts_and_profiles(spark):
    column(spark, [("https://www.Acme.com/x", "acme.com"), ("acme.com:8080", "acme.com"), (" http://u:p@www.www.acme.com ", "www.acme.com"), ("", None), (None, None)], ux.website_domain)
    column(spark, [
        ("https://uk.linkedin.com/company/Acme-Inc/about/", "https://www.linkedin.com/company/acme-inc"), ("Acme", "https://www.linkedin.com/company/acme"), ("1234", "https://www.linkedin.com/company/1234"),
        ("a/b", None), ("a b", None), ("", None), (None, None),
    ], ux.linkedin_company_url)
    column(spark, [("www.acme.co.uk", "acme.co.uk"), ("careers.acme.com", "acme.com"), ("acme.com", "acme.com"), ("localhost", "localhost")], ux.registrable_domain)
    column(spark, [("https://www.indeed.co.uk/x", True), ("https://x.com/a", True), ("https://www.xerox.com/", False), ("https://play.google.com/a", True), ("https://careers.google.com/", False)], ux.is_third_party)
    column(spark, [("https://www./karriere", False), ("https://acme.com/", True), ("https:///x", False)], ux.has_valid_host)
    column(spark, [("https://nupost.gov.in/", True), ("https://www.usajobs.gov/", True), ("https://www.governance.com/", False)], ux.is_government)


def test_career_words_in_urls(spark):
    has = lambda u: ux.has_career_url(ux.host(u), ux.path(u))
    column(spark, [("https://careers.a.com/", True), ("https://talent.a.com/", True), ("https://a.com/talent", True), ("https://a.com/talent-services", False), ("https://a.com/en/work-with-us", True), ("https://a.com/scholarships", False)], has)
