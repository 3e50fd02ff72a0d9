"""Denormalised exports: a row for each portal, or one for each company."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from millrace.functions import lexicon as lx
from millrace.functions.text import organization_type, sector


def parent_names(relationships: DataFrame, companies: DataFrame) -> DataFrame:
    """company_id, parent_companies: names joined by '; ', ordered by source and id."""
    known = companies.select(F.col("id").alias("parent_company_id"), F.col("name").alias("_known"))
    named = relationships.join(known, "parent_company_id", "left")
    told = F.struct("parent_source", "parent_source_id", F.coalesce("_known", "parent_name", "parent_source_id").alias("name"))
    out = named.groupBy(F.col("child_company_id").alias("company_id")).agg(F.sort_array(F.collect_list(told)).alias("p"))
    return out.select("company_id", F.array_join(F.transform("p", lambda p: p["name"]), "; ").alias("parent_companies"))


def _checked(given: list[str] | None, known: list[str], what: str) -> list[str]:
    wanted = [g.strip().lower() for g in given or []]
    if unknown := sorted(set(wanted) - set(known)):
        raise ValueError(f"unknown {what}: {unknown}; known: {known}")
    return wanted


def export_portals(state: dict, countries: list[str] | None = None, types: list[str] | None = None, sectors: list[str] | None = None) -> DataFrame:
    """A row for each company and portal, or one without a portal. Filters keep companies with one of the values; the country's case doesn't matter.

    Not sorted; order_export() does that. An excluded company keeps only portals added by hand.
    """
    types, sectors = _checked(types, lx.ORGANISATION_TYPES, "types"), _checked(sectors, ["it"], "sectors")
    c = state["companies"]
    if countries:
        c = c.where(F.lower("country").isin([x.strip().lower() for x in countries]))
    c = c.withColumns({"organization_type": organization_type(F.col("name"), F.col("industry")), "sector": sector(F.col("industry"))})
    if types:
        c = c.where(F.col("organization_type").isin(types))
    if sectors:
        c = c.where(F.col("sector").isin(sectors))
    p = state["portals"].select(F.col("id").alias("portal_id"), F.col("company_id").alias("_of"), "career_page_url", F.col("scope").alias("portal_scope"), F.col("region").alias("portal_region"), "final_ats_url", "ats_provider", "verification_status", "confidence", "last_verified_at", "discovered_via")
    rows = c.join(p, (F.col("id") == F.col("_of")) & ((F.col("status") != "excluded") | (F.col("discovered_via") == "manual")), "left").drop("_of")
    rows = rows.withColumnsRenamed({"id": "company_id", "name": "company_name", "status": "pipeline_status"})
    return rows.join(parent_names(state["relationships"], state["companies"]), "company_id", "left").select("portal_id", *lx.EXPORT_COLUMNS)


def order_export(rows: DataFrame) -> DataFrame:
    keys = [F.desc_nulls_last("employee_count"), F.asc("company_id")] + ([F.asc("portal_id")] if "portal_id" in rows.columns else [])
    return rows.orderBy(*keys)


def per_company(rows: DataFrame) -> DataFrame:
    """One row for each company: its first global portal, else its first; the URLs of the others in one column."""
    told = F.struct((F.coalesce("portal_scope", F.lit("")) != "global").alias("_other"), F.col("portal_id"), *[c for c in rows.columns if c not in ("company_id", "portal_id")])
    ranked = rows.withColumn("_row", told)
    grouped = ranked.groupBy("company_id").agg(F.min("_row").alias("_main"), F.sort_array(F.collect_list(F.struct("portal_id", "career_page_url", "final_ats_url"))).alias("_all"))
    others = F.filter("_all", lambda p: ~p["portal_id"].eqNullSafe(F.col("_main.portal_id")) & (F.coalesce(p["career_page_url"], F.lit("")) != ""))
    pages = F.array_join(F.transform(others, lambda p: F.coalesce(F.nullif(p["final_ats_url"], F.lit("")), p["career_page_url"])), " | ")
    return grouped.select("company_id", "_main.*", pages.alias("other_career_pages")).select(*lx.COMPANY_EXPORT_COLUMNS)


def write_csv(rows: DataFrame, path: str) -> int:
    """One CSV file with a header in the folder path; returns the number of rows, counted while they are written."""
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.coalesce(1).write.csv(path, header=True, mode="overwrite", escape='"', emptyValue="")
    return seen.get["n"]


def countries(companies: DataFrame) -> DataFrame:
    """country, n of companies that aren't excluded, the most frequent first."""
    known = companies.where("status <> 'excluded'").groupBy(F.coalesce("country", F.lit("(unknown)")).alias("country")).agg(F.count(F.lit(1)).alias("n"))
    return known.orderBy(F.desc("n"), "country")


def known_countries(companies: DataFrame) -> DataFrame:
    return companies.where("country IS NOT NULL AND country <> ''").select("country").distinct()


def selected(companies: DataFrame, statuses: list[str] = ["pending"], limit: int | None = None, ids: list[int] | None = None, names: list[str] | None = None) -> DataFrame:  # noqa: B006
    """Companies to work on, the largest first. No ids, no names or no limit: all."""
    _checked(statuses, lx.COMPANY_STATUSES, "statuses")
    out = companies.where(F.col("status").isin(statuses))
    if names:
        out = out.where(F.lower("country").isin([n.strip().lower() for n in names]))
    if ids:
        out = out.where(F.col("id").isin(ids))
    out = out.orderBy(F.desc_nulls_last("employee_count"), "id")
    return out.limit(limit) if limit else out


def capped(rows: DataFrame, group: list[str], order: str, caps: dict[str, int], scope: str = "scope") -> DataFrame:
    """The first rows of each group and scope, as many as the scope's cap."""
    cap = F.coalesce(*(F.when(F.col(scope) == s, n) for s, n in caps.items()))
    place = F.row_number().over(Window.partitionBy(*group, scope).orderBy(order))
    return rows.withColumn("_place", place).where(F.col("_place") <= cap).drop("_place")
