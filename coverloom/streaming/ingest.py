"""Repeated loading of landing folders: every file is taken once, bad rows are set aside, a ledger says what the present extract is."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverloom.functions.schemas import EXTRACTS
from coverloom.sources import tables
from coverloom.sources.extracts import at_same_time, store

#: What a delivery does to those before it.
APPEND, REPLACE = "append", "replace"


def _ledger(out: str, table: str) -> tuple[str, str]:
    """Folders of the batches stored and of the deliveries that are complete."""
    return f"{out}/_ledger/{table}/batches", f"{out}/_ledger/{table}/deliveries"


def ingest(spark: SparkSession, table: str, landing: str, out: str, checkpoint: str, run_ts: str, schema: T.StructType | None = None,
           multi_line: bool = True, files_per_batch: int = 1000, mode: str = APPEND) -> None:
    """Take all files not seen before, then stop. The batches of one ``run_ts`` are one delivery.

    A batch writes to its own ``batch=<n>`` folder and replaces it, then enters the ledger, so a batch repeated after a failure leaves no
    copies. When the files are used up, the delivery enters the ledger; until then readers of ``present`` don't see its
    batches. A failed run is repeated with the same ``run_ts``, which completes its delivery. Under ``REPLACE`` a delivery stands for
    the whole extract; a run without new files leaves the one before.
    """
    schema = schema or EXTRACTS[table]
    batches, deliveries = _ledger(out, table)
    # Only names are streamed; the files are read by their own headers.
    names = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", files_per_batch).load(landing).select("path")

    def take(batch: DataFrame, number: int) -> None:
        paths = sorted(r["path"] for r in batch.collect())  # files_per_batch at most
        store(spark, table, paths, f"{out}/{table}/batch={number}", f"{out}/_rejected/{table}/batch={number}", run_ts, schema, multi_line)
        tables.replace(spark.range(1).select(F.lit(run_ts).alias("run_ts"), F.lit(mode).alias("mode")), f"{batches}/batch={number}")

    query = names.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if tables.exists(spark, batches):
        mine = tables.read(spark, batches).filter(F.col("run_ts") == run_ts)
        whole = mine.groupBy("run_ts", "mode").agg(F.min("batch").alias("first_batch"), F.max("batch").alias("last_batch"))
        if not whole.isEmpty():
            tables.replace(whole, f"{deliveries}/run={tables.run_name(run_ts)}")


def ingest_all(spark: SparkSession, landing: str, out: str, checkpoints: str, run_ts: str, multi_line: bool = True, mode: str = REPLACE) -> None:
    """All extracts below ``landing/<TABLE>/``, side by side."""
    at_same_time([partial(ingest, spark, t, f"{landing}/{t}", out, f"{checkpoints}/{t}", run_ts, multi_line=multi_line, mode=mode) for t in sorted(EXTRACTS)])


def present(spark: SparkSession, out: str, table: str) -> DataFrame:
    """The extract as it stands: the last complete delivery that replaces, and all complete ones after it.

    Folders of earlier deliveries aren't read; those of an incomplete one are left out by the ledger.
    """
    batches, deliveries = _ledger(out, table)
    complete = tables.read(spark, deliveries).drop("run")
    start = complete.agg(F.coalesce(F.max(F.when(F.col("mode") == REPLACE, F.col("first_batch"))), F.lit(0))).first()[0]
    known = tables.read(spark, batches).join(complete.select("run_ts"), "run_ts", "left_semi").select("batch")
    return tables.read(spark, f"{out}/{table}").filter(F.col("batch") >= start).join(known, "batch", "left_semi").drop("batch")
