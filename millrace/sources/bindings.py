"""Query-result bindings of a knowledge base: lists of items with counts, and details with one row for each combination of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import lexicon as lx
from millrace.functions.url import linkedin_company_url
from millrace.plans.storage import numbered, written


def employee_bands(min_employees: int) -> list[tuple[int, int | None]]:
    """Bands (low, high] above min_employees, the last one open."""
    edges = [min_employees] + [e for e in lx.BAND_EDGES if e > min_employees]
    return list(zip(edges, [*edges[1:], None]))


def item_id(uri: Column) -> Column:
    return F.substring_index(uri, "/", -1)


def listed(bindings: DataFrame) -> DataFrame:
    """Bindings (item.value, employees.value) -> item, employees: the largest count, truncated."""
    return bindings.groupBy(item_id(F.col("item.value")).alias("item")).agg(F.max(F.col("employees.value").cast("double").cast("bigint")).alias("employees"))


def _firsts(value: Column) -> Column:
    """Distinct values of a group in order of pos."""
    kept = F.sort_array(F.collect_list(F.when(value.isNotNull() & (value != ""), F.struct("pos", value.alias("v")))))
    return F.array_distinct(F.transform(kept, lambda x: x["v"]))


def grouped_details(bindings: DataFrame, source: str = "wikidata") -> DataFrame:
    """Bindings with pos and the columns of a details query (each struct<value>) -> one record for each item, without counts."""
    names = ["item", "itemLabel", "website", "countryLabel", "industryLabel", "linkedin", "parent", "parentLabel", "dissolved"]
    flat = bindings.select("pos", *(F.col(f"{n}.value").alias(n) for n in names)).withColumns({"item": item_id(F.col("item")), "parent": item_id(F.col("parent"))})
    parents = F.sort_array(F.collect_list(F.when(F.col("parent").isNotNull(), F.struct("pos", "parent", F.nullif("parentLabel", "parent").alias("label")))))
    out = flat.groupBy("item").agg(
        F.min_by("itemLabel", "pos").alias("label"), _firsts(F.col("website")).alias("websites"), _firsts(F.col("countryLabel")).alias("countries"),
        _firsts(F.col("industryLabel")).alias("industries"), _firsts(F.col("linkedin")).alias("ids"), _firsts(F.col("dissolved")).alias("ends"), parents.alias("p"),
    )
    first = lambda c: F.try_element_at(F.col(c), F.lit(1))
    # of a parent's rows the first stands for it
    ids = F.array_distinct(F.transform("p", lambda x: x["parent"]))
    own = F.transform(ids, lambda i: F.struct(i.alias("source_id"), F.element_at(F.filter("p", lambda x: x["parent"] == i), 1)["label"].alias("name")))
    raw = F.to_json(F.struct("websites", "countries", "industries", F.col("ids").alias("linkedin_ids"), own.alias("parents")))
    return out.select(
        F.lit(source).alias("source"), F.col("item").alias("source_id"), F.nullif(F.nullif("label", "item"), F.lit("")).alias("name"), linkedin_company_url(first("ids")).alias("linkedin_url"),
        first("websites").alias("website"), first("countries").alias("country"), F.nullif(F.array_join("industries", "; "), F.lit("")).alias("industry"),
        own.alias("parents"), F.substring(first("ends"), 1, 10).alias("dissolved"), raw.alias("raw"),
    )


def missing(items: DataFrame, details: DataFrame) -> DataFrame:
    """item, details (how many rows of details there are), missing: whether there is none."""
    found = details.groupBy(F.col("source_id").alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    return items.join(found, F.col("item") == F.col("_id"), "left").select("item", F.coalesce("_n", F.lit(0)).alias("details"), F.col("_n").isNull().alias("missing"))


def of_class(items: DataFrame, instances: DataFrame, subclasses: DataFrame, classes: list[str], depth: int = 32) -> DataFrame:
    """items (column item) that are instances (item, class) of one of classes or of what is below them by subclasses (class, parent).

    Classes below are reached level by level, at most depth of them, each looked at once, so loops end. A class table is joined, never collected.
    """
    spark = items.sparkSession
    reached = written(spark.createDataFrame([(c,) for c in classes], "class string"), "classes")
    newest = reached
    for _ in range(depth):
        below = subclasses.join(newest.withColumnRenamed("class", "parent"), "parent").select("class").distinct().join(reached, "class", "left_anti")
        newest = written(below, "classes")
        if newest.isEmpty():
            break
        reached = written(reached.unionByName(newest), "classes")
    return items.join(instances.join(reached, "class", "left_semi").select("item"), "item", "left_semi")


def records(items: DataFrame, details: DataFrame) -> DataFrame:
    """One record (schema RECORD) for each listed item, in order of ids; items without details have no name."""
    found = details.drop("source").withColumnRenamed("source_id", "_id")
    out = numbered(items, "item", 0, "ordinal").join(found, F.col("item") == F.col("_id"), "left")
    return out.select(
        "ordinal", F.lit("wikidata").alias("source"), F.col("item").alias("source_id"), "name", F.col("employees").alias("employee_count"), "linkedin_url", "website", "country",
        "industry", F.coalesce("parents", F.array().cast("array<struct<source_id:string,name:string>>")).alias("parents"), "dissolved", F.coalesce("raw", F.lit('{"error": "no details returned"}')).alias("raw"),
    )
