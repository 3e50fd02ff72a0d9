"""An extension: records that arrive as a stream are ingested batch by batch into snapshots of the state."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace import MIN_EMPLOYEES
from millrace.operators.resolve import ingest
from millrace.plans.schemas import empty_state, load_state, save_state


def ingest_stream(records: DataFrame, folder: str, source: str, checkpoint: str, min_employees: int = MIN_EMPLOYEES, merge_on_domain: bool = False):
    """Start a query that writes the state after batch n under folder/v=n. records: a streaming DataFrame of schema RECORD.

    A batch that is run again after a failure reads the same snapshot as before and writes its own anew.
    """
    spark = records.sparkSession

    def step(batch: DataFrame, number: int) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/v={number}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        state = load_state(spark, f"{folder}/v={number - 1}") if number else empty_state(spark)
        save_state(ingest(state, batch, source, min_employees, merge_on_domain), f"{folder}/v={number}")

    return records.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
