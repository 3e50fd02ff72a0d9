"""Schemas of the pipeline's tables."""

RECORD = """ordinal long, source string, source_id string, name string, employee_count long, linkedin_url string, website string,
 country string, industry string, parents array<struct<source_id:string,name:string>>, dissolved string, raw string"""
COMPANIES = """id long, name string, employee_count long, linkedin_url string, website string, website_domain string, country string,
 industry string, status string, status_reason string"""
SOURCES = "company_id long, source string, source_id string, raw string"
RELATIONSHIPS = "child_company_id long, parent_company_id long, parent_source string, parent_source_id string, parent_name string"
PORTALS = """id long, company_id long, career_page_url string, final_ats_url string, ats_provider string, scope string, region string,
 verification_status string, confidence double, last_verified_at string, discovered_via string, page_title string, http_status int, evidence string"""
RUNS = "id long, source string, finished boolean, seen long, inserted long, updated long, merged long, rejected long"
EVENTS = "run_id long, company_id long, stage string, event string, detail string"
FETCHES = "requested_url string, final_url string, status int, content_type string, body string, error_reason string"

TABLES = {"companies": COMPANIES, "sources": SOURCES, "relationships": RELATIONSHIPS, "portals": PORTALS, "runs": RUNS, "events": EVENTS}


def empty_state(spark) -> dict:
    return {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}


def save_state(state: dict, path: str) -> None:
    """A snapshot: one Parquet table for each of the six. Parquet has no row updates, so each run writes a new snapshot."""
    for name, df in state.items():
        df.write.parquet(f"{path}/{name}")


def load_state(spark, path: str) -> dict:
    """Columns that an older snapshot lacks come back as nulls."""
    out = {}
    for name, schema in TABLES.items():
        there = spark.read.parquet(f"{path}/{name}")
        out[name] = spark.createDataFrame([], schema).unionByName(there, allowMissingColumns=True).select(*spark.createDataFrame([], schema).columns)
    return out
