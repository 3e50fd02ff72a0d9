"""Exact deduplication over a log-structured merge index of text digests. DataFrame functions only.

Write path: each task's rows fill memtables of a fixed number of rows; a memtable is flushed as a run of its own, sorted by digest, without a
shuffle. Compaction merges all runs into one level: for each digest the smallest identifier and the number of rows; what a run
has several times is merged before it leaves its task. Of the level only digests that several rows have are ever looked
up, so these are kept, with a filter: a bitmap over hashes of the digests, sized by their number. Look-ups ask the filter
first. Rows that it rules out stay as they are, and neither they nor their texts are shuffled; the others are joined with the
level, and every hit is verified: the least and the greatest text under its digest must be the same, byte by byte. Rows of
digests that turn out to be shared by different texts are grouped again by their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Filter, documents, drop, fresh, keyed_texts, written

def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _digest(text: Column, digest_bytes: int) -> tuple[Column, Column]:
    sha = F.unhex(F.sha2(text, 256))
    return sha, F.substring(sha, 1, digest_bytes)


def flush_runs(docs: DataFrame, memtable_rows: int, digest_bytes: int) -> DataFrame:
    """Runs sorted by digest: run, digest, sha, doc_id, row (a number that only this row has)."""
    sha, digest = _digest(F.col("norm"), digest_bytes)
    rows = keyed_texts(docs).select("doc_id", normalised(F.col("text")).alias("norm"), F.monotonically_increasing_id().alias("row"))
    low = (1 << 33) - 1  # monotonically_increasing_id: task above, row number below
    return (
        rows.select("doc_id", "row", sha.alias("sha"), digest.alias("digest"))
        .withColumn("run", F.shiftright("row", 33) * F.lit(1 << 20) + F.floor(F.col("row").bitwiseAND(F.lit(low)) / memtable_rows))
        .sortWithinPartitions("run", "digest")
    )


def _first(doc_id: str, row: str) -> Column:
    """Sorts rows by identifier, rows without one last, repeated rows by arrival."""
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("doc_id"), F.col(row).alias("row"))


def compact(runs: DataFrame) -> DataFrame:
    """One level: digest, the row with the smallest identifier, the number of rows."""
    return runs.groupBy("digest").agg(F.min(_first("doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("n")).select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), "n")


def _index(docs: DataFrame, memtable_rows: int, digest_bytes: int) -> tuple[DataFrame, DataFrame, Filter]:
    """The runs, the digests that several rows have, and their filter."""
    runs = written(flush_runs(docs, memtable_rows, digest_bytes), "runs", by="run")
    level = written(compact(runs).where("n > 1").sortWithinPartitions("digest"), "level")
    return runs, level, Filter(level, "digest")


def _unlike(docs: DataFrame, level: DataFrame, filter_: Filter, digest_bytes: int) -> DataFrame:
    """Digests under which different texts stand."""
    texts = keyed_texts(docs).select(normalised(F.col("text")).alias("norm"))
    texts = filter_.asked(texts.withColumn("digest", _digest(F.col("norm"), digest_bytes)[1]), F.col("digest"), "maybe").where("maybe")
    seen = texts.groupBy("digest").agg(F.min("norm").alias("least"), F.max("norm").alias("most")).where("least <> most").select("digest")
    return written(seen.join(level, "digest", "left_semi"), "unlike")


def exact_groups(docs: DataFrame, memtable_rows: int = 65536, digest_bytes: int = 32) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space became one space; a null text counts
    as empty and all empty texts are equal. Of equal texts the row with the smallest doc_id stays; a row
    without doc_id loses against any that has one; of rows with the same doc_id and text exactly one stays. An
    empty table gives an empty result. Other columns, whatever their names, are not read.
    digest_bytes shortens the index key (tests use it to force collisions); the result doesn't depend on it.
    """
    runs, level, filter_ = _index(docs, memtable_rows, digest_bytes)
    asked = filter_.asked(runs, F.col("digest"), "maybe")
    own = [F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.lit(1).cast("long").alias("n")]
    alone = asked.where("NOT maybe").select("doc_id", "row", "sha", *own)
    hits = asked.where("maybe").select("doc_id", "row", "sha", "digest")
    unlike = _unlike(docs, level, filter_, digest_bytes)
    again = None
    if not unlike.isEmpty():
        # different texts under one digest: their rows are grouped by the text itself
        sha, digest = _digest(F.col("norm"), digest_bytes)
        texts = keyed_texts(docs).select("doc_id", normalised(F.col("text")).alias("norm")).select("doc_id", "norm", sha.alias("sha"), digest.alias("digest"))
        texts = texts.join(unlike, "digest", "left_semi").dropDuplicates(["doc_id", "norm"]).withColumnsRenamed({"doc_id": "t_id", "sha": "t_sha"}).drop("digest")
        mixed = hits.join(unlike, "digest", "left_semi").join(texts, F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.col("sha") == F.col("t_sha"))).select("doc_id", "row", "sha", "norm")
        by_text = mixed.groupBy("norm").agg(F.min(_first("doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("n")).withColumnRenamed("norm", "g_norm")
        again = mixed.join(by_text, F.col("norm") == F.col("g_norm")).select("doc_id", "row", "sha", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), "n")
        hits = hits.join(unlike, "digest", "left_anti")
    found = hits.join(level, "digest", "left")
    there = F.col("n").isNotNull()
    keep = [F.when(there, F.col(k)).otherwise(F.col(o)).alias(k) for k, o in (("keep_id", "doc_id"), ("keep_row", "row"))]
    out = alone.unionByName(found.select("doc_id", "row", "sha", *keep, F.coalesce("n", F.lit(1)).alias("n")))
    out = out.unionByName(again) if again is not None else out
    return out.select("doc_id", "keep_id", F.col("n").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, memtable_rows: int = 65536) -> DataFrame:
    """The rows of docs that exact_groups() keeps, with all their columns, whatever their names; rows repeated whole or by doc_id and text stay once.

    A null text counts as empty and stays null where its row stays. An empty table gives an empty result. Only rows whose digest may
    occur twice are joined with what stays of them.
    """
    runs, level, filter_ = _index(docs, memtable_rows, 32)
    unlike = _unlike(docs, level, filter_, 32)
    if not unlike.isEmpty():  # whole digests of different texts: what stays is known by row only
        raise ValueError("two different texts have the same SHA-256")
    drop(runs)
    sha, maybe, stays, none, keep, number = (fresh(docs.columns, n) for n in ("_sha", "_maybe", "_stays", "_none", "_keep", "_number"))
    own = docs.withColumn(sha, F.unhex(F.sha2(normalised(F.col("text")), 256)))
    asked = filter_.asked(own, F.col(sha), maybe)
    kept = level.select(F.col("digest").alias(stays), F.col("keep_id").alias(keep), F.col("keep_id").isNull().alias(none))
    hits = asked.where(F.col(maybe)).join(kept, F.col(sha) == F.col(stays), "left")
    # a digest that the filter only seemed to know has no row there
    hits = hits.where(F.col(stays).isNull() | F.col("doc_id").cast("long").eqNullSafe(F.col(keep)))
    once = hits.where(F.col(stays).isNull()).unionByName(hits.where(F.col(stays).isNotNull()).dropDuplicates([sha]))
    return asked.where(~F.col(maybe)).select(*docs.columns).unionByName(once.select(*docs.columns))


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """exact_groups() of all documents; nulls, empty texts, repeated rows, empty tables and clashing columns as said there."""
    return exact_groups(documents(spark, sf_dir))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""
