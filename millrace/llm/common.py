"""What the operators of this subpackage share: inputs, the shared folder, tables written there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Rows of an Arrow batch, where the session has Spark's default: texts may be long.
BATCH_ROWS = "1000"


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (as long) and the text (null: empty) of each row."""
    conf = docs.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def whole_ids(column) -> "pd.array":
    """A column of ids as strings (null: none) as nullable whole numbers; as longs they would reach pandas as floats beside a null."""
    import numpy as np
    import pandas as pd

    none = column.isna().to_numpy()
    return pd.arrays.IntegerArray(column.where(~none, "0").to_numpy().astype(np.int64), none)


def mapped(df: DataFrame, work, schema: str) -> DataFrame:
    """df.mapInPandas(work, schema), where doc_id keeps every digit: work finds it as Int64."""

    def run(parts):
        return work(pdf.assign(doc_id=whole_ids(pdf["doc_id"])) for pdf in parts)

    return df.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(run, schema)


def fresh(columns: list[str], name: str) -> str:
    """name, or name with a number, that no column has in any case."""
    taken, out, n = {c.lower() for c in columns}, name, 0
    while out.lower() in taken:
        n += 1
        out = f"{name}{n}"
    return out


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of all texts, by which buckets are counted."""
    return docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: what spark.checkpoint.dir names.

    Only where that is unset, and only on a local master, a folder of its own is made and set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/millrace/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """df as a table in the shared folder, read again: its lineage ends there. by: a column with a folder for each of its values."""
    spark = df.sparkSession
    path = new_path(spark, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    # an empty table may leave no part file with a footer, so the schema is given
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete a table made by written() that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark._jvm
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def partitions(spark: SparkSession, size: int, each: int) -> int:
    """Partitions for what so many bytes of text give, each for so many of them; 100,000 at most."""
    return max(slices(spark), min(100_000, -(-size // each)))


def added_up(rows: DataFrame, finish) -> DataFrame:
    """rows (part, places: sorted distinct uint32, counts: uint64; one for each task and part, none of them empty) -> part, told: finish(places, counts) of all rows of a part.

    They are added up in two steps, over groups of tasks and then over these, so that no step holds a row of every task.
    """
    import numpy as np
    import pandas as pd

    def both(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        own = [np.frombuffer(p, "<u4") for p in pdf["places"]]
        total = np.zeros(1 + max(int(p[-1]) for p in own), "<u8")
        for p, c in zip(own, pdf["counts"]):
            total[p] += np.frombuffer(c, "<u8")
        places = np.flatnonzero(total)
        return places.astype("<u4"), total[places]

    def some(pdf: pd.DataFrame) -> pd.DataFrame:
        places, counts = both(pdf)
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "places": [places.tobytes()], "counts": [counts.tobytes()]})

    def all_(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "told": [finish(*both(pdf))]})

    first = rows.withColumn("_some", F.spark_partition_id() % 256).groupBy("part", "_some").applyInPandas(some, "part long, places binary, counts binary")
    return first.groupBy("part").applyInPandas(all_, "part long, told binary")


#: Places of a filter for each row in it, a power of two in all; at most MOST_PLACES (64 MB when broadcast): beyond that more values pass it by chance.
PLACES, MOST_PLACES = 16, 1 << 29
_PAGE = 32768  # bits of a row of the filter


class Filter:
    """Says of values whether they may be in a column of a table; never no of one that is. A bitmap over hashes, sized by the table's rows."""

    def __init__(self, rows: DataFrame, column: str):
        n = rows.count()
        self.places = max(_PAGE, min(MOST_PLACES, 1 << (max(1, PLACES * n) - 1).bit_length()))
        place = self._place(F.col(column))
        bits = rows.groupBy(F.bitmap_bucket_number(place).alias("_page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits"))
        self.bits = written(bits, "filter")

    def _place(self, value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(self.places)) + 1

    def asked(self, rows: DataFrame, value: Column, name: str) -> DataFrame:
        """rows with column name: whether the value may be there. The filter is broadcast: places / 8 bytes, at most MOST_PLACES / 8."""
        page, bits = fresh(rows.columns, "_page"), fresh(rows.columns, "_bits")
        own = self._place(value)
        joined = rows.join(F.broadcast(self.bits.select(F.col("_page").alias(page), F.col("_bits").alias(bits))), F.bitmap_bucket_number(own) == F.col(page), "left")
        at = F.bitmap_bit_position(own)
        byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        bit = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
        return joined.withColumn(name, F.coalesce(bit, F.lit(False))).drop(page, bits)
