"""Extract loading and run logs over files that Spark writes from the given orders."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.catalog.registry import register
from coverloom.catalog.star import RUN_TS, Star
from coverloom.functions import schemas as S
from coverloom.functions.exprs import col
from coverloom.plans import quality
from coverloom.session import scratch_dir
from coverloom.sources import extracts
from coverloom.streaming.ingest import REPLACE, ingest, present

_SCHEMA = S.schema("ORDER_NO:long PRICE:decimal(18,2) STATUS:string DAY:date")


def _landing(t: Star) -> str:
    """Orders as Latin-1 CSV, half of the files with other columns in another order; some prices are missing, some are overflow marks, some texts hold quotes, line breaks and accents."""
    urgent, pending = col("o_orderpriority") == "1-URGENT", col("o_orderstatus") == "P"
    price = F.when(pending, ".").when(urgent, "****").otherwise(col("o_totalprice").cast("decimal(18,2)").cast("string"))
    status = F.when(urgent, "é, \"F\"\nx").when(pending, "").otherwise(col("o_orderstatus"))
    path = f"{scratch_dir(t.spark)}/coverloom-landing/{uuid.uuid4().hex}"
    rows = t.orders.select(col("o_orderkey").alias("ORDER_NO"), price.alias("PRICE"), status.alias("STATUS"), F.col("d").alias("DAY"), F.lit(7).alias("EXTRA"))
    odd = F.col("ORDER_NO") % 2 == 1
    for part, names in ((rows.filter(odd), "ORDER_NO PRICE STATUS DAY"), (rows.filter(~odd), "EXTRA DAY STATUS ORDER_NO PRICE")):
        part.select(*names.split()).write.mode("append").options(header=True, encoding="ISO-8859-1", escape='"', emptyValue="").csv(path)
    return path


_ROWS = """SELECT o_orderkey AS "ORDER_NO", CAST(CASE WHEN o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS "PRICE",
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'é, "F"' || chr(10) || 'x' WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS "STATUS", CAST(o_orderdate AS DATE) AS "DAY" FROM orders"""
_GOOD = " WHERE o_orderstatus = 'P' OR o_orderpriority <> '1-URGENT'"


_STAMPED = _ROWS.replace(" FROM orders", f""", '{RUN_TS}' AS "PROCESSED_DTTM" FROM orders""")


@register("csv_load", _STAMPED + _GOOD)
def csv_load(t: Star) -> DataFrame:
    return extracts.load(t.spark, "OTHER", _landing(t), RUN_TS, _SCHEMA).good


@register("csv_load_overflow", _ROWS)
def csv_load_overflow(t: Star) -> DataFrame:
    """With the receipts' marks nothing is rejected."""
    return extracts.load(t.spark, "RECIBO", _landing(t), RUN_TS, _SCHEMA).good.drop("PROCESSED_DTTM")


@register("csv_rejected", """SELECT 'OTHER' AS table_name, CAST(o_orderkey AS VARCHAR) AS order_no, 'PRICE' AS failing FROM orders
  WHERE o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT'""")
def csv_rejected(t: Star) -> DataFrame:
    bad = extracts.load(t.spark, "OTHER", _landing(t), RUN_TS, _SCHEMA).rejected
    return bad.select("table_name", F.get_json_object("raw", "$.ORDER_NO").alias("order_no"), F.concat_ws(",", "columns").alias("failing"))


@register("stream_ingest", _ROWS + _GOOD)
def stream_ingest(t: Star) -> DataFrame:
    """Two runs over one landing folder: the second finds nothing new."""
    landing = _landing(t)
    out = f"{landing}-out"
    for _ in range(2):
        ingest(t.spark, "OTHER", landing, out, f"{landing}-offsets", RUN_TS, _SCHEMA)
    return t.spark.read.parquet(f"{out}/OTHER").select(*_SCHEMA.fieldNames())


@register("ingest_replaces", _ROWS + " WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT'")
def ingest_replaces(t: Star) -> DataFrame:
    """Two deliveries to one landing folder, in several batches each: the second one, without the pending orders, stands for the extract."""
    landing = _landing(t)
    out = f"{landing}-out"
    take = lambda run_ts: ingest(t.spark, "OTHER", landing, out, f"{landing}-offsets", run_ts, _SCHEMA, files_per_batch=5, mode=REPLACE)
    take("2026-06-30 12:00:00")
    rows = t.orders.filter((col("o_orderstatus") != "P") & (col("o_orderpriority") != "1-URGENT")).select(
        col("o_orderkey").alias("ORDER_NO"), col("o_totalprice").cast("decimal(18,2)").alias("PRICE"), col("o_orderstatus").alias("STATUS"), F.col("d").alias("DAY"))
    rows.write.mode("append").options(header=True, encoding="ISO-8859-1", escape='"', emptyValue="").csv(landing)
    take(RUN_TS)
    return present(t.spark, out, "OTHER").select(*_SCHEMA.fieldNames())


@register("run_summary", """SELECT 'PIPELINE_RUN' AS "CHECK_TYPE", 'COMPLETE' AS "STATUS", '{"completed_at":"2026-07-01 12:00:00","uoe_rows":' || (SELECT count(*) FROM lineitem)
  || ',"lpt_rows":' || (SELECT count(*) FROM orders) || '}' AS "DETAILS" """)
def run_summary(t: Star) -> DataFrame:
    return quality.run_summary(t.lines, t.orders, RUN_TS).select("CHECK_TYPE", "STATUS", "DETAILS")
