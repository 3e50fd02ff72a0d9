"""Fetched pages to tables: title, text and links, and what URLs and links say by themselves."""

from __future__ import annotations

import re
from html.entities import html5
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import lexicon as lx
from millrace.functions import text as tx
from millrace.functions import url as ux

# lengths at which texts are cut
LINK_TEXT, BODY_TEXT, TITLE_TEXT, PROBE_TEXT = 200, 200_000, 300, 20_000
LINK = "struct<pos:int,url:string,text:string,kind:string>"
SOURCES = {"a": "href", "iframe": "src", "script": "src", "form": "action"}
_SKIPPED = ("#", "mailto:", "tel:", "javascript:", "data:")
_HOST = re.compile(r"https?://([^/?#]*)", re.I)
_AMPERSAND = re.compile(r"&(?!#[0-9]+;|#[xX][0-9a-fA-F]+;)(?:([a-zA-Z][a-zA-Z0-9]*;))?")


class _Reader(HTMLParser):
    """One pass over a page; texts are the stripped pieces between tags, joined by a space."""

    SILENT = {"script", "style"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title: str | None = None
        self.in_title = False
        self.body: list[str] = []
        self.in_body = False
        self.silent = 0
        self.open: dict | None = None  # the anchor whose text is being read
        self.found: dict[str, list[dict]] = {kind: [] for kind in SOURCES}

    def handle_starttag(self, tag, attrs):
        own = dict(attrs)
        if tag in self.SILENT:
            self.silent += 1
        self.in_title = tag == "title" and self.title is None
        if self.in_title:
            self.title = ""
        if tag == "body":
            self.in_body = True
        if tag == "a":
            self.open = None
        if tag in SOURCES and own.get(SOURCES[tag]) is not None:
            link = {"raw": own[SOURCES[tag]], "pieces": [], "spare": own.get("aria-label") or own.get("title") or ""}
            self.found[tag].append(link)
            if tag == "a":
                self.open = link

    def handle_endtag(self, tag):
        if tag in self.SILENT:
            self.silent = max(0, self.silent - 1)
        if tag == "title":
            self.in_title = False
        if tag == "a":
            self.open = None

    def handle_data(self, data):
        piece = data.strip()
        if self.in_title:
            self.title += data
        elif piece and not self.silent:
            if self.open is not None:
                self.open["pieces"].append(piece)
            if self.in_body:
                self.body.append(piece)


def _absolute(base: str, raw: str) -> str | None:
    raw = raw.strip()
    if not raw or raw.lower().startswith(_SKIPPED):
        return None
    try:
        url = urljoin(base, raw)
    except ValueError:
        return None
    host = _HOST.match(url)
    return url if host and not re.search(r"[\s<>\[\]{}|\\^`]", host[1]) else None


def _closed(html: str) -> str:
    """html where an ampersand stands for itself but in a reference that a semicolon ends."""
    return _AMPERSAND.sub(lambda m: m[0] if m[1] in html5 else f"&amp;{m[1] or ''}", html)


def read_html(base: str, html: str, closed_references: bool = False) -> tuple[str, str, list[tuple]]:
    """title, text, links (pos, url, text, kind): all anchors, then iframes, scripts and forms. A page that can't be read is cut off there.

    HTML also reads some references that no semicolon ends (&amp, &copy); with closed_references these stay as they are.
    """
    html = _closed(html) if closed_references else html
    reader = _Reader()
    try:
        reader.feed(html)
        reader.close()
    except (AssertionError, ValueError):
        pass
    links = []
    for kind, found in reader.found.items():
        for link in found:
            url = _absolute(base, link["raw"])
            if url:
                text = (" ".join(link["pieces"]) or link["spare"]) if kind == "a" else ""
                links.append((len(links), url, text[:LINK_TEXT], kind))
    return (reader.title or "").strip(), " ".join(reader.body)[:BODY_TEXT], links


def parsed(pages: DataFrame, url_col: str = "url", html_col: str = "html", closed_references: bool = False) -> DataFrame:
    """pages with title, text and links, as read_html() has them."""

    @F.pandas_udf(f"struct<title:string,text:string,links:array<{LINK}>>")
    def read(urls: pd.Series, bodies: pd.Series) -> pd.DataFrame:
        rows = [read_html(u or "", b or "", closed_references) for u, b in zip(urls, bodies)]
        return pd.DataFrame({"title": [r[0] for r in rows], "text": [r[1] for r in rows], "links": [[dict(zip(("pos", "url", "text", "kind"), x)) for x in r[2]] for r in rows]})

    return pages.withColumn("_page", read(F.col(url_col), F.col(html_col))).select(*pages.columns, "_page.title", "_page.text", "_page.links")


def page_error() -> Column:
    """Of rows of fetches: why there is no page to read; null: there is one."""
    kind, body = F.lower(F.trim(F.split(F.coalesce("content_type", F.lit("")), ";")[0])), F.lower(F.ltrim(F.coalesce("body", F.lit(""))))
    looks = F.startswith(body, F.lit("<!doctype")) | F.startswith(body, F.lit("<html"))
    html = kind.isin("text/html", "application/xhtml+xml") | (kind.isin("", "text/plain", "application/octet-stream") & looks)
    return F.when(F.col("error_reason").isNotNull(), F.col("error_reason")).when((F.col("status") < 200) | (F.col("status") >= 300), F.concat(F.lit("http_"), "status")).when(~html, "not_html")


def public_suffixes(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """host, suffix of hosts (column host, distinct) by a public suffix list: rules (column rule) such as "com", "co.uk", "*.ck", "!www.ck".

    Each host is joined with the rules by the ends it has; an exception wins, then the longest rule; without any the host has no known suffix (empty).
    """
    labels = F.split("host", "[.]")
    ends = hosts.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.slice(labels, i, F.size(labels)))).alias("end"))
    told = F.array_join("end", ".")
    above = F.array_join(F.slice("end", 2, 1 << 20), ".")
    keys = ends.select("host", F.size("end").alias("n"), F.explode(F.array(F.struct(told.alias("rule"), told.alias("suffix"), F.lit(0).alias("first")), F.struct(F.concat(F.lit("*."), above).alias("rule"), told.alias("suffix"), F.lit(0).alias("first")), F.struct(F.concat(F.lit("!"), told).alias("rule"), above.alias("suffix"), F.lit(1).alias("first")))).alias("k")).select("host", "n", "k.*")
    met = keys.join(rules.select(F.lower(ux.stripped(F.col("rule"))).alias("rule")).distinct(), "rule").groupBy("host").agg(F.max_by("suffix", F.struct("first", "n")).alias("suffix"))
    return hosts.join(met, "host", "left").select("host", F.coalesce("suffix", F.lit("")).alias("suffix"))


def url_facts(urls: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """urls (column url, distinct) with what each says by itself. The provider table is looked through once for each URL.

    suffixes: the rules of a public suffix list; without them a short table of suffixes of two labels is taken, else the last label.
    """
    if suffixes is None:
        return _url_facts(urls.withColumns({"suffix": ux.public_suffix(ux.host(F.col("url"))), "domain": ux.registrable_domain(ux.host(F.col("url")))}))
    named = urls.withColumn("host", ux.host(F.col("url")))
    known = public_suffixes(named.select("host").distinct(), suffixes)
    return _url_facts(named.join(known, "host").withColumn("domain", ux.label_before(F.col("host"), F.col("suffix"))).drop("host"))


def _url_facts(urls: DataFrame) -> DataFrame:
    """urls with suffix and domain."""
    u = F.col("url")
    out = urls.withColumn("provider", ux.detect_ats(u))
    out = out.withColumn("clean", ux.clean_ats_url(u, F.col("provider")))
    out = out.withColumns({
        "tenant": ux.ats_tenant(u, F.col("provider")), "key": ux.page_key(u, F.col("provider")), "clean_provider": ux.detect_ats(F.col("clean")),
        "stripped": ux.strip_tracking(u), "norm": ux.normalize_url(u), "asset": ux.is_asset(u), "not_portal": ux.is_not_portal(u), "sandbox": ux.is_sandbox(u),
        "third_party": ux.is_third_party(u, F.col("domain")), "government": ux.is_government(u, F.col("suffix"), F.col("domain")), "valid": F.col("suffix") != "",
        "career_url": ux.has_career_url(ux.host(u), ux.path(u)), "graduate_path": tx.is_graduate(F.replace(ux.path(u), F.lit("-"), F.lit(" "))),
        "graduate_url": u.rlike(tx.GRADUATE_URL), "compact": F.regexp_replace(F.lower(u), "[^a-z0-9]+", ""), "depth": F.size(ux.segments(u)),
        "label": F.substring_index(ux.host(u), ".", 1), "url_path": ux.path(u),
    })
    board = F.substring_index(F.col("tenant"), ":", -1)
    shared = F.coalesce(F.col("provider").isin(lx.SHARED_HOST_PROVIDERS), F.lit(False))
    return out.withColumns({"shared_path": shared & board.isin(lx.NOT_TENANTS), "has_board": shared & ~board.isin(lx.NOT_TENANTS + [""])})


def is_careers_link() -> Column:
    """Of links with the facts of their URL."""
    able = (F.col("kind") == "a") & F.col("valid") & ~F.col("third_party") & ~F.col("asset") & ~F.col("not_portal") & ~F.col("sandbox")
    return able & (tx.has_career_text(F.col("text")) | F.col("career_url") | F.col("provider").isNotNull())


def link_score() -> Column:
    """How likely a careers link is the main one, in halves: the sum of points for its text, URL and provider, less those for graduates and regions."""
    exact = F.lower(ux.stripped(F.col("text"))).isin(lx.EXACT_CAREER_TEXTS)
    return (
        F.when(exact, 6).when(tx.has_career_text(F.col("text")), 4).otherwise(0)
        + F.when(F.col("career_url"), 4).otherwise(0)
        + F.when(F.col("label").isin(lx.PROBE_SUBDOMAINS), 2).otherwise(0)
        + F.when(F.col("provider").isNotNull(), 3).otherwise(0)
        - F.when(tx.is_graduate(F.col("text")) | F.col("graduate_path"), 3).otherwise(0)
        - F.when(tx.region_of(F.col("text"), F.col("url_path")).isNotNull(), 2).otherwise(0)
        + F.when(F.col("depth") <= 2, 1).otherwise(0)
    )


def links_with_facts(pages: DataFrame, page_id: str) -> DataFrame:
    """A row for each link of pages (columns page_id and links), with the facts of its URL."""
    links = pages.select(page_id, F.explode("links").alias("l")).select(page_id, "l.*")
    return links.join(url_facts(links.select("url").distinct()), "url")
