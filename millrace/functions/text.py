"""Functions of names, texts and labels as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as lx
from .url import stripped


def _words(phrases: list[str]) -> str:
    return r"(?iuU)\b(" + "|".join(phrases) + r")\b"


CAREER_TEXT, GRADUATE = _words(lx.CAREER_PHRASES), _words(lx.GRADUATE_PHRASES)
GRADUATE_URL = "(?i)" + lx.GRADUATE_URL
JOB_CONTENT = "(?iu)(" + lx.JOB_CONTENT + ")"
REGION_NAMES = sorted(lx.REGIONS + lx.COUNTRIES, key=len, reverse=True)
REGION_TEXT = r"(?U)(?<![\w])(" + "|".join(REGION_NAMES) + r")(?![\w])"


def has_career_text(text: Column) -> Column:
    out = text.rlike(CAREER_TEXT)
    for word in lx.CAREER_CJK:
        out = out | F.contains(text, F.lit(word))
    return out


def is_graduate(text: Column) -> Column:
    return text.rlike(GRADUATE)


def has_job_content(text: Column) -> Column:
    return text.rlike(JOB_CONTENT)


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def _slugs() -> dict[str, str]:
    """Path forms of the ASCII names longer than three letters."""
    return {"-".join(n.lower().split()): n for n in REGION_NAMES if n.isascii() and len(n) > 3}


def region_of(text: Column, path: Column) -> Column:
    """The first region or country named in the text, else by a segment of the path; null without one."""
    named = F.regexp_extract(text, REGION_TEXT, 1)
    table = F.create_map(*(F.lit(x) for pair in _slugs().items() for x in pair))
    by_path = F.filter(F.transform(F.split(path, "/"), lambda s: F.try_element_at(table, slug(s))), lambda r: r.isNotNull())
    return F.when(named != "", named).otherwise(F.try_element_at(by_path, F.lit(1)))


def name_tokens(name: Column) -> Column:
    return F.filter(F.regexp_extract_all(F.lower(name), F.lit("([a-z0-9]+)")), lambda t: ~t.isin(lx.NAME_SUFFIXES) & (F.length(t) >= 2))


def name_matches(name: Column, *targets: Column) -> Column:
    """Whether the name's words, run together, stand in a target."""
    whole = F.array_join(name_tokens(name), "")
    found = F.lit(False)
    for t in targets:
        found = found | F.contains(F.regexp_replace(F.lower(F.coalesce(t, F.lit(""))), "[^a-z0-9]+", ""), whole)
    return F.coalesce((F.length(whole) >= 3) & found, F.lit(False))


def _industries(industry: Column) -> Column:
    return F.transform(F.split(F.coalesce(industry, F.lit("")), ";"), stripped)


def organization_type(name: Column, industry: Column) -> Column:
    own = F.transform(_industries(industry), F.lower)
    out = None
    for label, pattern, only in lx.ORGANISATIONS:
        fits = F.coalesce(name, F.lit("")).rlike("(?iuU)" + pattern) | F.arrays_overlap(own, F.array(*map(F.lit, only)))
        out = F.when(fits, label) if out is None else out.when(fits, label)
    return out.otherwise("company")


def sector(industry: Column) -> Column:
    """it, or empty."""
    pattern = "(?iuU)" + lx.IT_INDUSTRY
    return F.when(F.exists(_industries(industry), lambda i: (i != "") & i.rlike(pattern)), "it").otherwise("")


def band_lower_bound(size: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(size, r"^\s*([\d,]+)", 1), ",", "").try_cast("bigint")


def nice_name(name: Column) -> Column:
    """Capitals for a name that has none; a name with some is left alone."""

    def cased(word: Column, i: Column) -> Column:
        # a letter at the start or after - & / . becomes a capital
        parts = F.regexp_extract_all(word, F.lit(r"([^-&/.]*[-&/.]|[^-&/.]+)"))
        capitals = F.array_join(F.transform(parts, lambda p: F.concat(F.when(F.substring(p, 1, 1).rlike("[a-z]"), F.upper(F.substring(p, 1, 1))).otherwise(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 20))), "")
        return F.when(word.isin(lx.UPPER_WORDS), F.upper(word)).when((i > 0) & word.isin(lx.LOWER_WORDS), word).otherwise(capitals)

    words = F.filter(F.split(name, r"(?U)\s+"), lambda w: w != "")
    return F.when(name == F.lower(name), F.array_join(F.transform(words, cased), " ")).otherwise(name)


def nice_place(place: Column) -> Column:
    """Each word with a capital, but for the small ones."""
    words = F.filter(F.split(place, r"(?U)\s+"), lambda w: w != "")
    told = F.array_join(F.transform(words, lambda w: F.when(w.isin(lx.LOWER_WORDS), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 20)))), " ")
    return F.nullif(told, F.lit(""))


def confidence_hundredths(signals: dict[str, Column]) -> Column:
    total = F.lit(0)
    for name, on in signals.items():
        total = total + F.when(on, lx.SIGNAL_WEIGHTS[name]).otherwise(0)
    return F.least(F.lit(100), total)


def employee_band(text: Column) -> Column:
    """struct(band, least) of "1,001-5,000 employees" or "10,001+"; without a band the number that the digits make."""
    span = r"(?iu)([\d,.]+)\s*(?:-|–|to)\s*([\d,.]+)\s*(?:employees)?|([\d,.]+)\s*\+\s*(?:employees)?"
    number = lambda x: F.regexp_replace(x, r"[^\d]", "").try_cast("bigint")
    # the groups of the first match only
    first = F.regexp_extract(text, span, 0)
    low, high, open_ = (F.regexp_extract(text, span, i) for i in (1, 2, 3))
    alone = number(text)
    none = F.struct(F.lit(None).cast("string").alias("band"), F.lit(None).cast("bigint").alias("least"))
    told = lambda band, least: F.struct(band.alias("band"), least.alias("least"))
    return (
        F.when((first != "") & (open_ != ""), told(F.concat(open_, F.lit("+")), number(open_)))
        .when(first != "", told(F.concat(low, F.lit("-"), high), number(low)))
        .when(alone > 0, told(stripped(text), alone))
        .otherwise(none)
    )


def country_from(headquarters: Column, known: Column) -> Column:
    """The country of a place such as "Austin, Texas, US", read from the right. known: a map of lower-case names to countries."""
    parts = F.reverse(F.filter(F.transform(F.split(headquarters, ","), lambda p: F.lower(stripped(p))), lambda p: p != ""))
    one = lambda p: F.coalesce(F.try_element_at(known, p), F.when(p.isin(lx.INDIAN_PLACES + ["india"]), "India"), F.when(p.isin(lx.US_PLACES + ["us", "usa", "united states"]), "United States"))
    return F.try_element_at(F.filter(F.transform(parts, one), lambda c: c.isNotNull()), F.lit(1))


def cache_key(linkedin_slug: Column, name: Column) -> Column:
    key = F.lower(F.coalesce(linkedin_slug, F.nullif(name, F.lit("")), F.lit("")))
    key = F.regexp_replace(F.regexp_replace(key, "[^a-z0-9._-]+", "_"), "^_+|_+$", "")
    return F.when(key == "", "unnamed").otherwise(key)
