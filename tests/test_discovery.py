"""Portals from a snapshot: one invented site for each rule, then sites with many links for the order-dependent rules."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import lexicon as lx
from millrace.functions import url as ux
from millrace.operators import discovery, pages
from millrace.plans import schemas


class Web:
    """A snapshot being written: sites are added page by page, links as 'text > target'."""

    def __init__(self):
        self.rows, self.companies, self.wanted = [], [], {}

    def put(self, url, *links, title="", says="", plain=0, lands=None, status=200, kind="text/html", raw=None, error=None):
        told = [x.split(" > ") for x in links] + [(f"Product {i}", f"/shop/{i}") for i in range(plain)]
        anchors = "<ul>" + "".join(f"<li><a href='{to}'>{text}</a></li>" for text, to in told) + "</ul>"
        body = raw if raw is not None else f"<!doctype html><title>{title}</title><body><h1>{says}</h1>{anchors}"
        self.rows.append((url, lands or url, None if error else status, kind, None if error else body, error))
        return self

    def company(self, name, website, status, reason=None, *portals):
        self.companies.append((len(self.companies) + 1, name, website))
        self.wanted[len(self.companies)] = (status, reason, list(portals))
        return self

    def tables(self, spark):
        return spark.createDataFrame(self.companies, "id long, name string, website string"), spark.createDataFrame(self.rows, schemas.FETCHES)


def small_web():
    w = Web()
    w.company("Harbor Freightways", "harborfreight.no", "discovered", None, "https://harborfreight.no/join", "https://harborfreight.no/trainees", "https://harborfreight.no/join/norway", "https://jobs.ashbyhq.com/drydock")
    w.put("https://harborfreight.no", "Join us > /join", "Jobs for trainees > /trainees", plain=6)
    w.put("https://harborfreight.no/join", "See vacancies > https://harborfreight.bamboohr.com/jobs/", "Jobs in Norway > /join/norway", "Jobs in Norway, Bergen > /join/norway/bergen", "Work with us at Drydock > https://jobs.ashbyhq.com/drydock", "Careers: our canteen > /join/canteen", title="Join", says="View all jobs")
    w.put("https://harborfreight.no/join/norway", title="Norway").put("https://harborfreight.no/trainees", title="Trainees").put("https://harborfreight.bamboohr.com/jobs/", title="Harbor Freightways").put("https://jobs.ashbyhq.com/drydock", title="Drydock")
    # a usual path, though the homepage has no link to it
    w.company("Lumen Dairy", "https://lumendairy.com/", "discovered", None, "https://lumendairy.com/about/careers")
    w.put("https://lumendairy.com/", plain=7).put("https://lumendairy.com/careers", title="Not found", status=404).put("https://lumendairy.com/about/careers", title="Milk", says="Current openings")
    # a usual path that only leads home; one whose page says nothing of jobs
    w.company("Quillfeather", "https://quillfeather.com/", "no_portal_found", "no_careers_link")
    w.put("https://quillfeather.com/", plain=9, says="Apply now").put("https://quillfeather.com/jobs", lands="https://quillfeather.com", says="Apply now").put("https://quillfeather.com/career", says="Feathers")
    w.company("Unmapped Shores", "https://unmappedshores.com/", "failed", "site_unreachable")
    w.company("Walled Orchard", "https://walledorchard.com/", "failed", "blocked_by_robots").put("https://walledorchard.com/", error="blocked_by_robots")
    w.company("Paper Lantern", " ­ ", "no_portal_found", "no_website")
    w.company("Gravel Pit", "https://gravelpit.com/", "failed", "http_503").put("https://gravelpit.com/", status=503)
    w.company("Blank Slate", "https://blankslate.com/", "no_portal_found", "no_links_in_html").put("https://blankslate.com/", plain=3)
    # the homepage is down, but a host of its own for jobs isn't
    w.company("Night Ferry", "https://www.nightferry.co.uk/", "discovered", None, "https://jobs.nightferry.co.uk/")
    w.put("https://www.nightferry.co.uk/", error="timeout").put("https://jobs.nightferry.co.uk/", title="Jobs on board")
    w.company("Bolted Gate", "https://boltedgate.com/", "needs_review", "careers_page_unreachable", "https://jobs.lever.co/boltedgate")
    w.put("https://boltedgate.com/", "Careers > https://jobs.lever.co/boltedgate?utm_source=home", plain=5).put("https://jobs.lever.co/boltedgate?utm_source=home", status=410)
    # the best of several links: the exact text beats a graduates' page before it
    w.company("Copper Kettle", "https://copperkettle.com/", "discovered", None, "https://copperkettle.com/people/careers", "https://copperkettle.com/careers/students")
    w.put("https://copperkettle.com/", "Careers for students > /careers/students", "Careers > /people/careers", plain=5)
    w.put("https://copperkettle.com/people/careers", title="Careers", says="Kettles", raw="<html><body><script src='https://cdn.phenompeople.com/p.js'></script></body></html>")
    # a parent's page that links the boards of several firms has no board of its own
    w.company("Twelve Houses", "https://twelvehouses.com/", "discovered", None, "https://twelvehouses.com/careers", "https://jobs.lever.co/northhouse", "https://jobs.lever.co/southhouse")
    w.put("https://twelvehouses.com/", "Careers > /careers", plain=5).put("https://twelvehouses.com/careers", "North > https://jobs.lever.co/northhouse", "South > https://jobs.lever.co/southhouse", title="Houses")
    # maps: an index, the child about careers first, and the shortest page of it
    w.company("Map Room", "https://maproom.com/", "discovered", None, "https://maproom.com/work/careers")
    w.put("https://maproom.com/", plain=8).put("https://maproom.com/sitemap.xml", kind="application/xml", raw="<sitemapindex><loc>https://maproom.com/m/goods.xml</loc><loc>https://maproom.com/careers/map.xml</loc><loc>https://maproom.com/m/old.xml.gz</loc></sitemapindex>")
    w.put("https://maproom.com/careers/map.xml", kind="application/xml", raw="<urlset><loc>https://maproom.com/work/careers/all/of/them</loc><loc> https://maproom.com/work/careers </loc><loc>https://maproom.com/jobs/poster.pdf</loc></urlset>")
    w.put("https://maproom.com/work/careers", says="Open roles").put("https://maproom.com/work/careers/all/of/them", says="Open roles")
    # maps that robots.txt names, in place of the usual one
    w.company("Tide Table", "https://tidetable.com/", "discovered", None, "https://tidetable.com/crew/jobs")
    w.put("https://tidetable.com/", plain=8).put("https://tidetable.com/robots.txt", kind="text/plain", raw="User-agent: *\n  SITEMAP:https://files.tidetable.net/a%2Db.xml # new\n# Sitemap: https://tidetable.com/none.xml")
    w.put("https://files.tidetable.net/a-b.xml", kind="text/xml", raw="<loc>https://tidetable.com/crew/jobs</loc>").put("https://tidetable.com/crew/jobs", says="Browse jobs")
    w.put("https://tidetable.com/sitemap.xml", raw="<loc>https://tidetable.com/jobs/first</loc>").put("https://tidetable.com/jobs/first", says="Browse jobs")
    return w


@pytest.fixture(scope="module")
def found(spark):
    web = small_web()
    outcomes, portals = discovery.discover(*web.tables(spark))
    rows = {}
    for r in portals.orderBy("company_id", "pos").collect():
        rows.setdefault(r["company_id"], []).append(r)
    return web, {r["company_id"]: r for r in outcomes.collect()}, rows


def test_outcomes_and_portals(found):
    web, outcomes, rows = found
    got = {i: (o["status"], o["reason"], [r["career_page_url"] for r in rows.get(i, [])]) for i, o in outcomes.items()}
    assert got == web.wanted


def of(found, name):
    web, outcomes, rows = found
    i = next(i for i, n, _ in web.companies if n == name)
    return outcomes[i], rows.get(i, [])


def test_boards_scopes_and_confidence(found):
    _, rows = of(found, "Harbor Freightways")
    assert [(r["scope"], r["region"], r["discovered_via"]) for r in rows] == [("global", None, "homepage_link"), ("graduate", None, "careers_page_link"), ("regional", "Norway", "careers_page_link"), ("other", None, "careers_page_link")]
    main = rows[0]
    signals = json.loads(main["evidence"])["signals"]
    assert (main["ats_provider"], main["final_ats_url"], main["http_status"], main["page_title"]) == ("BambooHR", "https://harborfreight.bamboohr.com/jobs/", 200, "Join")
    assert main["confidence"] == min(100, sum(lx.SIGNAL_WEIGHTS[s] for s, on in signals.items() if on)) / 100 == 0.85
    assert rows[-1]["ats_provider"] == "Ashby"


def test_unreachable_page_of_a_provider(found):
    outcome, (main,) = of(found, "Bolted Gate")
    told = json.loads(main["evidence"])
    assert json.loads(outcome["detail"]) == {"error": "http_410"} and told["fetch_error"] == "http_410" and told["signals"]["name_match"]
    assert (main["ats_provider"], main["final_ats_url"], main["http_status"], main["page_title"]) == ("Lever", "https://jobs.lever.co/boltedgate", 410, None)


def test_guesses_say_how(found):
    assert {n: of(found, n)[1][0]["discovered_via"] for n in ("Lumen Dairy", "Night Ferry", "Map Room", "Tide Table")} == {"Lumen Dairy": "path_probe", "Night Ferry": "path_probe", "Map Room": "sitemap", "Tide Table": "sitemap"}
    assert json.loads(of(found, "Blank Slate")[0]["detail"]) == {"links_on_homepage": 3}
    assert json.loads(of(found, "Gravel Pit")[0]["detail"]) == {"url": "https://gravelpit.com/"}


def test_scripts_name_a_provider_and_groups_none(found):
    kettle, house = of(found, "Copper Kettle")[1][0], of(found, "Twelve Houses")[1][0]
    assert (kettle["ats_provider"], kettle["final_ats_url"], json.loads(kettle["evidence"])["ats_found_via"]) == ("Phenom", "https://copperkettle.com/people/careers", "page_scripts")
    assert house["ats_provider"] is None and house["final_ats_url"] == "https://twelvehouses.com/careers"


def test_board_links_caps_and_landings(spark):
    w = Web()
    # a board's link is followed once; sandboxes and asset folders aren't boards; what a script loads for whom is one
    w.company("Salt Works", "https://saltworks.com/", "discovered", None).put("https://saltworks.com/", "Careers > /c/careers", plain=5)
    w.put("https://saltworks.com/c/careers", "Staging jobs > https://salt-staging.eightfold.ai/careers", "Jobs > https://apply.workable.com/old-salt", "Sign in > https://saltworks.wd3.myworkdayjobs.com/en-US/Salt/login")
    w.put("https://apply.workable.com/old-salt", lands="https://apply.workable.com/saltworks/j/77")
    w.company("Rope Walk", "https://ropewalk.com/", "discovered", None).put("https://ropewalk.com/", "Careers > /careers", plain=5)
    w.put("https://ropewalk.com/careers", raw="<html><script src='https://boards.greenhouse.io/embed/job_board/js?for=ropewalk'></script><p>x</p></html>")
    # more graduates' pages than their cap, one below another, one on a government's site, several that land on the same page
    w.company("Long Pier", "https://longpier.com/", "discovered", None).put("https://longpier.com/", "Careers > /careers", plain=5)
    grads = [f"Interns {x} > /careers/interns-{x}" for x in "abcd"]
    w.put("https://longpier.com/careers", *grads, "Interns a again > /careers/interns-a/more", "Jobs fraud warning > https://www.jobs.gov.uk/jobs", "Careers in France > /careers/fr", "Careers in Spain > /careers/es", "Careers in Italy > /careers/it?locale=it", "Careers in Italy > /careers/it?locale=en")
    w.put("https://longpier.com/careers/es", lands="https://longpier.com/careers/fr").put("https://longpier.com/careers/it?locale=it", lands="https://longpier.com/careers")
    outcomes, portals = discovery.discover(*w.tables(spark))
    rows = {i: [r for r in portals.orderBy("pos").collect() if r["company_id"] == i] for i in (1, 2, 3)}
    assert (rows[1][0]["ats_provider"], rows[1][0]["final_ats_url"]) == ("Workable", "https://apply.workable.com/saltworks")
    assert (rows[2][0]["ats_provider"], rows[2][0]["final_ats_url"]) == ("Greenhouse", "https://boards.greenhouse.io/ropewalk")
    assert [r["career_page_url"].removeprefix("https://longpier.com/careers") for r in rows[3]] == ["", "/interns-a", "/interns-b", "/interns-c", "/fr"]
    detail = json.loads(outcomes.where("company_id = 3").first()["detail"])
    assert detail == {"extra_portals_over_cap": {"graduate": 1}, "extra_portals_same_page": 2}


def test_saving(spark):
    w = Web().company("Oak Bridge", "https://oakbridge.com/", "discovered", None).put("https://oakbridge.com/", "Jobs > /jobs", "Careers in Chile > /careers/chile", plain=5).put("https://oakbridge.com/jobs", title="Jobs")
    companies, fetches = w.tables(spark)
    state = schemas.empty_state(spark)
    state["companies"] = state["companies"].unionByName(companies.withColumn("status", F.lit("pending")), allowMissingColumns=True)
    hand = [(9, 1, u, None, None, "global", None, "unverified", None, None, via, None, None, None) for u, via in (("https://oakbridge.com/jobs", "manual"), ("https://oakbridge.com/gone", "sitemap"), ("https://oakbridge.com/odd", None))]
    state["portals"] = spark.createDataFrame([(i + 5, *r[1:]) for i, r in enumerate(hand)], schemas.PORTALS)
    after = discovery.save_discovery(state, *discovery.discover(companies, fetches))
    assert sorted((r["id"], r["career_page_url"], r["discovered_via"]) for r in after["portals"].collect()) == [(5, "https://oakbridge.com/jobs", "manual"), (7, "https://oakbridge.com/odd", None), (8, "https://oakbridge.com/careers/chile", "careers_page_link")]
    (event,) = after["events"].collect()
    told = json.loads(event["detail"])
    assert (event["event"], told["portals"], told["replaced_portals"], told["detail"]) == ("discovered", 2, 1, {})
    assert after["companies"].first()["status"] == "discovered"


def test_nothing_to_do(spark):
    outcomes, portals = discovery.discover(spark.createDataFrame([], "id long, name string, website string"), spark.createDataFrame([], schemas.FETCHES))
    assert outcomes.count() == portals.count() == 0


def test_read_html():
    html = "<title>\n A  b</title><body>x<style>y</style> <p>z</p><a href=' ../q?r=1 '> go <em>there</em></a><a href='tel:1'>call</a><a href='//h.org' title='T'></a><form action='/f'></form><script src='s.js'></script><iframe src='data:x'></iframe>"
    title, text, links = pages.read_html("https://k.org/a/b/", html)
    assert title == "A  b" and text == "x z go there call"
    assert links == [(0, "https://k.org/a/q?r=1", "go there", "a"), (1, "https://h.org", "T", "a"), (2, "https://k.org/a/b/s.js", "", "script"), (3, "https://k.org/f", "", "form")]


def test_public_suffix_lists(spark):
    rules = spark.createDataFrame([(r,) for r in ("com", "uk", "co.uk", "gov.uk", "*.island", "!city.island", "Jobs ")], "rule string")
    hosts = ["a.b.co.uk", "uk", "x.gov.uk", "shop.far.island", "city.island", "www.city.island", "intranet", "box.lan", "mill.jobs", "", "com"]
    known = pages.public_suffixes(spark.createDataFrame([(h,) for h in hosts], "host string"), rules)
    told = {r["host"]: (r["suffix"], r["domain"]) for r in known.withColumn("domain", ux.label_before(F.col("host"), F.col("suffix"))).collect()}
    assert told == {
        "a.b.co.uk": ("co.uk", "b.co.uk"), "uk": ("uk", "uk"), "x.gov.uk": ("gov.uk", "x.gov.uk"), "shop.far.island": ("far.island", "shop.far.island"), "city.island": ("island", "city.island"),
        "www.city.island": ("island", "city.island"), "intranet": ("", "intranet"), "box.lan": ("", "box.lan"), "mill.jobs": ("jobs", "mill.jobs"), "": ("", ""), "com": ("com", "com"),
    }
    facts = {r["url"]: r for r in pages.url_facts(spark.createDataFrame([("https://a.x.gov.uk/jobs",), ("https://box.lan/careers",)], "url string"), rules).collect()}
    assert facts["https://a.x.gov.uk/jobs"]["government"] and facts["https://a.x.gov.uk/jobs"]["valid"] and not facts["https://box.lan/careers"]["valid"]
    w = Web().company("Mill", "https://old.mill.island/", "discovered").put("https://old.mill.island/", "Careers > https://box.lan/careers", "Jobs > /jobs", plain=5).put("https://old.mill.island/jobs", title="Jobs")
    _, portals = discovery.discover(*w.tables(spark), rules)
    assert [r["career_page_url"] for r in portals.collect()] == ["https://old.mill.island/jobs"]


LINKS = "company_id long, origin int, at int, url string, text string, key string, tenant string, provider string, government boolean, scope string, region string"


def admitted_by_loop(links, seeds):
    out = {}
    for c, keys, tenants in seeds:
        seen, tenants, kept, over = set(keys), set(tenants), [], []
        own = sorted((x for x in links if x[0] == c), key=lambda x: x[1:3])
        for _, _, _, url, text, key, tenant, provider, government, scope, region in own:
            if key in seen or tenant in tenants or (scope == "other" and provider is None) or (scope == "affiliate" and government):
                continue
            seen.add(key)
            same = [k for k in kept if k[0] == scope]
            if any(key.startswith(k[1] + "/") for k in same):
                continue
            if len(same) >= lx.SCOPE_CAPS[scope]:
                over.append(scope)
                continue
            kept.append((scope, key, url, text, region))
            tenants |= {tenant} - {None}
        if own:
            out[c] = (kept, over)
    return out


def test_links_are_admitted_in_order(spark):
    import random

    draw = random.Random(3)
    links = []
    for c in range(12):
        for n in range(draw.choice([0, 3, 60, 120])):
            key = "/".join(draw.choice("abcdef") for _ in range(draw.randrange(1, 5)))
            scope = draw.choice([*lx.SCOPE_CAPS, "regional"])
            links.append((c, n % 2, n, f"u{n}", f"t{n}", key, draw.choice([None] * 6 + ["x", "y", "z"]), draw.choice([None, "p"]), draw.choice([True, False, None]), scope, draw.choice([None, "Asia"])))
    # company 11 has no seed, company 20 no links
    seeds = [(c, ["a"] if c % 2 else [], ["x"] if c % 3 == 0 else []) for c in [*range(11), 20]]
    got = discovery.admitted(spark.createDataFrame(links, LINKS).repartition(7), spark.createDataFrame(seeds, "company_id long, keys array<string>, tenants array<string>")).collect()
    assert {r["company_id"]: ([tuple(k) for k in r["kept"]], r["over"]) for r in got} == admitted_by_loop(links, seeds)
    assert len(got) == len({r["company_id"] for r in got}) and any(r["over"] for r in got)


def test_a_company_with_very_many_links_is_no_square(spark):
    import time

    n = 40_000
    links = spark.range(n).selectExpr("1L AS company_id", "0 AS origin", "CAST(id AS INT) AS at", "'u' AS url", "'t' AS text", "concat('h/', id) AS key", "CAST(NULL AS STRING) AS tenant", "CAST(NULL AS STRING) AS provider", "false AS government", "'regional' AS scope", "CAST(NULL AS STRING) AS region")
    started = time.time()
    found = discovery.admitted(links, spark.createDataFrame([(1, [], [])], "company_id long, keys array<string>, tenants array<string>")).first()
    assert [k["key"] for k in found["kept"]] == [f"h/{i}" for i in range(30)] and found["over"] == ["regional"] * (n - 30)
    assert time.time() - started < 60
