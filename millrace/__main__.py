"""Commands over a folder of state snapshots: python -m millrace COMMAND --state FOLDER ...

Each command that changes the state reads the newest snapshot v=N and writes v=N+1. Exit codes: 0 done, 1 the report found
problems, 2 wrong options.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from millrace import MIN_EMPLOYEES
from millrace.functions import lexicon as lx
from millrace.operators import discovery, export, report, resolve
from millrace.plans import schemas
from millrace.sources import bindings, dump, profiles


def _folder(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def newest(spark: SparkSession, folder: str) -> int:
    """The number of the newest snapshot; -1: there is none."""
    store, path = _folder(spark, folder)
    if not store.exists(path):
        return -1
    names = [s.getPath().getName() for s in store.listStatus(path)]
    return max((int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit()), default=-1)


def load(spark: SparkSession, folder: str) -> dict:
    n = newest(spark, folder)
    return schemas.load_state(spark, f"{folder}/v={n}") if n >= 0 else schemas.empty_state(spark)


def save(spark: SparkSession, folder: str, state: dict) -> None:
    schemas.save_state(state, f"{folder}/v={newest(spark, folder) + 1}")


def _ingested(spark, a, records, source, merge=False) -> int:
    state = resolve.ingest(load(spark, a.state), records, source, a.min_employees, merge)
    save(spark, a.state, state)
    print(state["runs"].orderBy(F.desc("id")).first().asDict())
    return 0


def ingest_dump(spark, a) -> int:
    rows = dump.normalized(dump.read_rows(spark, a.file))
    return _ingested(spark, a, dump.records(dump.kept(rows, a.country, a.min_employees)), "pdl", True)


def ingest_bindings(spark, a) -> int:
    cells = lambda names: ", ".join(f"{n} struct<value:string>" for n in names)
    items = bindings.listed(spark.read.json(a.list, schema=cells(["item", "employees"])))
    items = items.where(F.col("employees") > a.min_employees)
    names = ["item", "itemLabel", "website", "countryLabel", "industryLabel", "linkedin", "parent", "parentLabel", "dissolved"]
    details = spark.read.json(a.details, schema=cells(names)).withColumn("pos", F.monotonically_increasing_id())
    return _ingested(spark, a, bindings.records(items, bindings.grouped_details(details)), "wikidata")


def ingest_answers(spark, a) -> int:
    rows = profiles.parsed_answers(profiles.read_cache(spark, a.cache)).withColumn("ordinal", F.monotonically_increasing_id())
    known = [r["country"] for r in export.known_countries(load(spark, a.state)["companies"]).collect()]
    found = profiles.results(rows, known)
    if a.out:
        print(export.write_csv(found.select(*profiles.RESULT), a.out), "rows")
    for r in profiles.summary(found).orderBy("status").collect():
        print(r["status"], r["n"])
    return _ingested(spark, a, profiles.records(found), "linkedin")


def lookup_work(spark, a) -> int:
    rows = profiles.lookup_work(load(spark, a.state)["companies"], a.country, a.sector, a.missing_industry)
    print(export.write_csv(rows.select("name", "linkedin_url", "website", "country"), a.out), "rows")
    return 0


def discover(spark, a) -> int:
    statuses = [s for s in lx.COMPANY_STATUSES if s != "excluded"] if a.all else a.status or ["pending"]
    state = load(spark, a.state)
    work = export.selected(state["companies"], statuses, a.limit or None, a.company_id, a.country)
    rules = spark.read.text(a.suffixes).where("value <> '' AND value NOT LIKE '//%'").withColumnRenamed("value", "rule") if a.suffixes else None
    outcomes, portals = discovery.discover(work, spark.read.schema(schemas.FETCHES).parquet(a.fetches), rules)
    save(spark, a.state, discovery.save_discovery(state, outcomes, portals))
    outcomes.groupBy("status").count().orderBy("status").show()
    return 0


def tell_report(spark, a) -> int:
    state = load(spark, a.state)
    rows = [r.asDict() for r in report.report(state).collect()]
    told = report.summary(state) | {"checks": rows, "problems": [f"{r['check']}: {r['detail']}" for r in rows if not r["ok"]]}
    if a.json:
        print(json.dumps(told, indent=1))
    else:
        print(told["total"], "companies", *(f"{s}={n}" for s, n in told["by_status"].items()))
        print("\n".join(f"{'ok' if r['ok'] else 'PROBLEM'}  {r['check']}: {r['detail']}" for r in rows))
    return int(bool(told["problems"]))


def write_export(spark, a) -> int:
    rows = export.export_portals(load(spark, a.state), a.country, a.type, a.sector)
    rows = export.order_export(export.per_company(rows) if a.per_company else rows)
    print(export.write_csv(rows.drop("portal_id"), a.out), "rows")
    return 0


def tell_countries(spark, a) -> int:
    for r in export.countries(load(spark, a.state)["companies"]).collect():
        print(r["n"], r["country"])
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="millrace", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name, does, *options):
        c = sub.add_parser(name)
        c.set_defaults(does=does)
        c.add_argument("--state", required=True)
        for flag, more in options:
            c.add_argument(flag, **more)

    many, least = {"action": "append"}, ("--min-employees", {"type": int, "default": MIN_EMPLOYEES})
    command("ingest-dump", ingest_dump, ("file", {}), ("--country", many), least)
    command("ingest-bindings", ingest_bindings, ("--list", {"required": True}), ("--details", {"required": True}), least)
    command("ingest-answers", ingest_answers, ("--cache", {"required": True}), ("--out", {}), least)
    command("lookup-work", lookup_work, ("--out", {"required": True}), ("--country", many), ("--sector", many), ("--missing-industry", {"action": "store_true"}))
    command("discover", discover, ("--fetches", {"required": True}), ("--suffixes", {"help": "a public suffix list, one rule in a line"}), ("--status", many), ("--all", {"action": "store_true"}), ("--limit", {"type": int, "default": 0}), ("--company-id", many | {"type": int}), ("--country", many))
    command("report", tell_report, ("--json", {"action": "store_true"}))
    command("export", write_export, ("--out", {"required": True}), ("--country", many), ("--type", many), ("--sector", many), ("--per-company", {"action": "store_true"}))
    command("countries", tell_countries)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("millrace").getOrCreate()
    try:
        return a.does(spark, a)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
