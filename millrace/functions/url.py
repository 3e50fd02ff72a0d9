"""URL functions as Columns. One RFC 3986 expression takes a URL apart; Spark's own parser refuses too many real URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as lx

URL = r"^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def _part(url: Column, i: int) -> Column:
    return F.regexp_extract(url, URL, i)


def with_scheme(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("://")), url).otherwise(F.concat(F.lit("https://"), url))


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def netloc(url: Column) -> Column:
    return _part(url, 2)


def host(url: Column) -> Column:
    """Lower case, without user and port; empty where there is none."""
    return F.lower(F.regexp_replace(F.regexp_replace(netloc(url), r"^.*@", ""), r":\d*$", ""))


def path(url: Column) -> Column:
    return _part(url, 3)


def query(url: Column) -> Column:
    return _part(url, 4)


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _nulled(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def website_domain(url: Column) -> Column:
    """The host without one leading www.; null where there is none."""
    return _nulled(F.regexp_replace(host(with_scheme(stripped(url))), r"^www\.", ""))


def linkedin_company_url(value: Column) -> Column:
    """The canonical company URL of a URL or a bare slug; null for anything else."""
    value = stripped(value)
    found = F.regexp_extract(value, r"(?i)linkedin\.com/company/([^/?#\s]+)", 1)
    slug = F.when(found != "", found).otherwise(F.regexp_replace(value, r"^/+|/+$", ""))
    fits = (slug != "") & ~F.contains(slug, F.lit("/")) & ~F.contains(slug, F.lit(" "))
    return F.when(fits, F.concat(F.lit("https://www.linkedin.com/company/"), F.lower(slug)))


def linkedin_slug(url: Column) -> Column:
    return F.substring_index(linkedin_company_url(url), "/", -1)


def _form_encoded(text: Column) -> Column:
    """Percent-encoded as in HTML forms, with ~ left as it is and * encoded."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def params(url: Column) -> Column:
    """The query as an array of (name, value), decoded, in order; blank values stay."""
    parts = F.filter(F.split(query(url), "&"), lambda p: p != "")
    decoded = lambda x: F.coalesce(F.try_url_decode(x), x)
    return F.transform(parts, lambda p: F.struct(decoded(F.substring_index(p, "=", 1)).alias("name"), decoded(F.when(F.contains(p, F.lit("=")), F.regexp_replace(p, r"^[^=]*=", "")).otherwise("")).alias("value")))


def encoded_params(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda p: F.concat(_form_encoded(p["name"]), F.lit("="), _form_encoded(p["value"]))), "&")


def joined(url: Column, new_path: Column, new_query: Column | None = None) -> Column:
    """scheme://netloc of url with another path and query."""
    out = F.concat(F.when(scheme(url) != "", F.concat(scheme(url), F.lit(":"))).otherwise(""), F.when(netloc(url) != "", F.concat(F.lit("//"), netloc(url))).otherwise(""), new_path)
    if new_query is None:
        return out
    return F.concat(out, F.when(new_query != "", F.concat(F.lit("?"), new_query)).otherwise(""))


TRACKING = r"(?i)^(utm_[a-z]+|" + "|".join(lx.TRACKING_NAMES) + ")$"


def strip_tracking(url: Column) -> Column:
    """Without tracking parameters and fragment; the other parameters are encoded anew."""
    return joined(url, path(url), encoded_params(F.filter(params(url), lambda p: ~p["name"].rlike(TRACKING))))


def normalize_url(url: Column) -> Column:
    bare = F.regexp_replace(path(url), r"/+$", "")
    lowered = F.concat(F.when(scheme(url) != "", F.concat(scheme(url), F.lit(":"))).otherwise(""), F.lit("//"), F.lower(netloc(url)))
    return F.concat(lowered, F.when(bare == "", "/").otherwise(bare), F.when(query(url) != "", F.concat(F.lit("?"), query(url))).otherwise(""))


def _on(host_: Column, hosts: str) -> Column:
    out = F.lit(False)
    for h in hosts.split():
        out = out | (F.lit(True) if h == "*" else host_ == h[1:] if h[0] == "=" else (host_ == h) | F.endswith(host_, F.lit("." + h)))
    return out


def detect_ats(url: Column) -> Column:
    """The provider of the first line of the table that fits; null without one. Evaluate it once for each distinct URL: it is long."""
    full = with_scheme(url)
    h, p = host(full), path(full)
    rules = [F.when((h != "") & _on(h, hosts) & (p.rlike(pattern) if pattern else F.lit(True)), name) for name, hosts, pattern in lx.PROVIDERS]
    return F.coalesce(*rules)


def is_asset(url: Column) -> Column:
    return path(url).rlike(r"(?i)\.(" + "|".join(lx.ASSET_ENDINGS) + ")$")


NOT_PORTAL = "(?i)(" + lx.NOT_PORTAL + ")"


def is_article(url: Column) -> Column:
    return F.exists(F.split(path(url), "/"), lambda s: F.size(F.split(s, "[-_]")) >= lx.ARTICLE_WORDS)


def is_not_portal(url: Column) -> Column:
    return F.concat(netloc(url), path(url), F.lit("?"), query(url)).rlike(NOT_PORTAL) | is_article(url)


def is_sandbox(url: Column) -> Column:
    return url.rlike("(?i)" + lx.SANDBOX)


def segments(url: Column) -> Column:
    return F.filter(F.split(path(url), "/"), lambda s: s != "")


def _value_of(url: Column, *names: str) -> Column:
    """The last value of the first of these parameters that has one."""
    of = lambda n: _nulled(F.try_element_at(F.filter(F.transform(params(url), lambda p: F.when((p["name"] == n) & (p["value"] != ""), p["value"])), lambda v: v.isNotNull()), F.lit(-1)))
    return F.coalesce(*(of(n) for n in names))


def clean_ats_url(url: Column, provider: Column) -> Column:
    """The entry page of a provider's portal; other URLs without tracking. provider: detect_ats(url)."""
    parts = segments(url)
    # Workday: locales, then the name of the site
    first_site = F.regexp_extract(F.concat(F.lit("/"), F.array_join(parts, "/")), r"(?i)^((?:/[a-z]{2}(?:-[a-z]{2})?(?=/|$))*(?:/[^/]+)?)", 1)
    company = _value_of(url, "company", "career_company")
    site = F.regexp_extract(path(url), r"(?i)^(/hcmUI/CandidateExperience/[^/]+/sites/[^/]+)", 1)
    board = _value_of(url, "for")
    return (
        F.when((provider == "Workday") & F.contains(host(url), F.lit("myworkday")), joined(url, F.when(F.size(parts) > 0, first_site).otherwise("/")))
        .when((provider == "SuccessFactors") & F.regexp_replace(path(url), r"/+$", "").rlike("/career$") & company.isNotNull(), joined(url, path(url), F.concat(F.lit("company="), _form_encoded(company))))
        .when((provider == "Oracle Recruiting Cloud") & (site != ""), joined(url, site))
        .when((provider == "Greenhouse") & board.isNotNull(), F.concat(F.lit("https://boards.greenhouse.io/"), board))
        .when(provider.isin(lx.SHARED_HOST_PROVIDERS), joined(url, F.concat(F.lit("/"), F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit("")))))
        .when(provider.isNotNull() & is_not_portal(url), joined(url, F.lit("/")))
        .otherwise(strip_tracking(url))
    )


def ats_tenant(url: Column, provider: Column) -> Column:
    """The same for all URLs of one company's portal; null without a provider."""
    board = F.lower(F.regexp_replace(path(clean_ats_url(url, provider)), r"^/+|/+$", ""))
    return F.when(provider.isin(lx.SHARED_HOST_PROVIDERS), F.concat(provider, F.lit(":"), board)).when(provider.isNotNull(), F.concat(provider, F.lit(":"), host(with_scheme(url))))


def page_key(url: Column, provider: Column) -> Column:
    """The same for all variants of a page: no scheme, tracking or language parameters; parameters in order."""
    clean = F.when(provider.isNotNull(), clean_ats_url(url, provider)).otherwise(strip_tracking(url))
    kept = F.filter(params(clean), lambda p: ~F.lower(p["name"]).isin(lx.LANGUAGE_NAMES))
    told = encoded_params(F.array_sort(kept))
    bare = F.regexp_replace(path(clean), r"/+$", "")
    return F.concat(F.lower(netloc(clean)), F.when(bare == "", "/").otherwise(bare), F.when(told != "", F.concat(F.lit("?"), told)).otherwise(""))


def url_tokens(host_: Column, path_: Column) -> Column:
    whole = F.filter(F.split(F.lower(path_), "/"), lambda s: s != "")
    parts = F.array_except(F.flatten(F.transform(whole, lambda s: F.split(s, "[-_]"))), F.array(*map(F.lit, lx.WEAK_URL_WORDS)))
    return F.array_union(F.array_union(F.split(F.lower(host_), "[./]"), whole), parts)


def has_career_url(host_: Column, path_: Column) -> Column:
    return F.arrays_overlap(url_tokens(host_, path_), F.array(*map(F.lit, lx.CAREER_URL_WORDS)))


def public_suffix(host_: Column) -> Column:
    """The last label, or the last two where the table has them; empty for a host of one label."""
    two = F.substring_index(host_, ".", -2)
    return F.when(~F.contains(host_, F.lit(".")) | F.startswith(host_, F.lit(".")) | F.endswith(host_, F.lit(".")), "").when(two.isin(lx.TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host_, ".", -1))


def label_before(host_: Column, suffix: Column) -> Column:
    """The suffix with one label more; the host itself where it has no more, or no suffix."""
    rest = F.split(F.substring(host_, F.lit(1), F.length(host_) - F.length(suffix) - 1), "[.]")
    return F.when((suffix == "") | (host_ == suffix), host_).otherwise(F.concat(F.element_at(rest, -1), F.lit("."), suffix))


def registrable_domain(host_: Column) -> Column:
    """One label more than the public suffix; the host itself where it has no more."""
    two = F.substring_index(host_, ".", -2)
    return F.when(two.isin(lx.TWO_LABEL_SUFFIXES), F.substring_index(host_, ".", -3)).otherwise(two)


def is_third_party(url: Column, domain: Column | None = None) -> Column:
    """Job boards, social sites and app stores. domain: the registrable one, where it is known already."""
    h = host(url)
    return h.isin(lx.THIRD_PARTY_HOSTS) | F.substring_index(registrable_domain(h) if domain is None else domain, ".", 1).isin(lx.THIRD_PARTY_NAMES)


def is_government(url: Column, suffix: Column | None = None, domain: Column | None = None) -> Column:
    h = host(url)
    suffix, domain = public_suffix(h) if suffix is None else suffix, registrable_domain(h) if domain is None else domain
    return F.substring_index(suffix, ".", 1).isin("gov", "mil", "gob", "gouv") | (F.substring_index(domain, ".", 1) == "gov")


def has_valid_host(url: Column) -> Column:
    return public_suffix(host(url)) != ""
