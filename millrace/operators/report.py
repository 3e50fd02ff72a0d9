"""Reconciliation: whether a state's tables agree with each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import lexicon as lx

NEEDS_REASON = ["needs_review", "no_portal_found", "failed", "excluded"]


def orphans(companies: DataFrame, sources: DataFrame) -> DataFrame:
    return companies.join(sources.select(F.col("company_id").alias("id")), "id", "left_anti")


def portal_less(companies: DataFrame, portals: DataFrame) -> DataFrame:
    return companies.where(F.col("status").isin("discovered", "verified")).join(portals.select(F.col("company_id").alias("id")), "id", "left_anti")


def run_checks(runs: DataFrame, events: DataFrame) -> DataFrame:
    """runs with accounted, logged (rejection events) and the faults found."""
    logged = events.where("event = 'rejected'").groupBy(F.col("run_id").alias("id")).agg(F.count(F.lit(1)).alias("logged"))
    out = runs.join(logged, "id", "left").withColumns({"logged": F.coalesce("logged", F.lit(0)), "accounted": F.expr("inserted + updated + merged + rejected")})
    faults = F.array_compact(F.array(F.when(~F.col("finished"), "unfinished").when(F.col("accounted") != F.col("seen"), "counts"), F.when(F.col("logged") != F.col("rejected"), "events")))
    return out.withColumn("faults", faults)


def status_counts(companies: DataFrame) -> DataFrame:
    return companies.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def unknown_statuses(companies: DataFrame) -> DataFrame:
    return status_counts(companies.where(~F.col("status").isin(lx.COMPANY_STATUSES)))


def report(state: dict) -> DataFrame:
    """check, ok, detail: a row for each check that a sound state passes."""
    c = state["companies"]
    by_status = status_counts(c)
    count = lambda df: df.agg(F.count(F.lit(1)).alias("n"))
    none = lambda df, check: count(df).select(F.lit(check).alias("check"), (F.col("n") == 0).alias("ok"), F.col("n").cast("string").alias("detail"))
    sums = by_status.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("s")).crossJoin(count(c))  # one row each
    parts = [
        sums.select(F.lit("status_counts").alias("check"), (F.col("s") == F.col("n")).alias("ok"), F.col("n").cast("string").alias("detail")),
        none(unknown_statuses(c), "unknown_statuses"),
        none(c.where(F.col("status").isin(NEEDS_REASON) & (F.coalesce("status_reason", F.lit("")) == "")), "missing_reasons"),
        none(orphans(c, state["sources"]), "orphans"),
        none(portal_less(c, state["portals"]), "portal_less"),
        none(run_checks(state["runs"], state["events"]).where(F.size("faults") > 0), "runs"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def summary(state: dict) -> dict:
    """total, by_status (by name), runs (by id, with accounted, logged and faults). Statuses are a handful; a row for each run is collected."""
    by_status = {r["status"]: r["n"] for r in status_counts(state["companies"]).orderBy("status").collect()}
    runs = [r.asDict() for r in run_checks(state["runs"], state["events"]).orderBy("id").collect()]
    return {"total": sum(by_status.values()), "by_status": by_status, "runs": runs}
