"""Delimited extracts: tolerant reading, typed and rejected rows, load stamp."""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverloom.functions.exprs import at, col
from coverloom.functions.schemas import EXTRACTS
from coverloom.session import materialise, scratch_scope
from coverloom.sources import tables

# Texts that mean "missing", and the overflow marks of the receipts extract.
MISSING = ("", ".")
OVERFLOW = tuple("*" * n for n in range(2, 8))
#: Load stamp per extract: absent, NULL, or the run time for all others.
NO_STAMP, NULL_STAMP = ("ACTA0P",), ("RECIBO",)


@dataclass(frozen=True)
class Loaded:
    good: DataFrame
    rejected: DataFrame


def markers(table: str) -> tuple[str, ...]:
    return MISSING + OVERFLOW if table == "RECIBO" else MISSING


def text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def csv_options(multi_line: bool = True) -> dict[str, str]:
    """Latin-1, comma, optional quotes, header skipped; short and long rows are tolerated.

    Quoted line breaks make a file unsplittable. ``multi_line=False`` lets Spark split files that
    are known to hold none; otherwise land many files of moderate size.
    """
    return {"header": "true", "encoding": "ISO-8859-1", "sep": ",", "quote": '"', "escape": '"',
            "multiLine": str(multi_line).lower(), "mode": "PERMISSIVE", "enforceSchema": "true",
            "emptyValue": ""}


def headers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, names): the column names in each file's first line, upper case. A file without a line has no row.

    One job over the lines of the files' first blocks: a task sees a file's lines in order and keeps the first one. Nothing is
    opened or listed by the driver beyond Spark's own listing, however many files there are. Names that start with ``_`` or ``.`` are skipped.
    """

    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = None  # a task's files follow one another
        for batch in batches:
            found, names = [], []
            for file in pc.unique(batch.column("file")):
                if file != seen:
                    line = batch.column("line")[pc.index(batch.column("file"), file).as_py()].as_py()
                    found.append(file.as_py())
                    names.append([n.strip().upper() for n in next(csv.reader([line.removeprefix("\u00ef\u00bb\u00bf")]), [])])
                seen = file
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(names, pa.list_(pa.string()))], names=["file", "names"])

    lines = spark.read.options(encoding="ISO-8859-1").text(paths)
    start = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"), F.col("_metadata.file_block_start").alias("block"))
    return start.filter("block = 0").select("file", F.left("line", F.lit(1 << 16)).alias("line")).mapInArrow(first_lines, "file string, names array<string>")


def layouts(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """(file, width, at, absent): where each file has the contract's columns, from 1, and which it lacks."""
    wanted = [f.name for f in schema]
    upper = F.array(*[F.lit(n.upper()) for n in wanted])
    found = headers(spark, paths).withColumn("at", F.transform(upper, lambda n: F.array_position("names", n).cast("int")))
    lacking = F.filter(F.arrays_zip(F.array(*map(F.lit, wanted)).alias("name"), F.col("at").alias("at")), lambda z: z["at"] == 0)
    return found.select("file", F.size("names").alias("width"), "at", F.transform(lacking, lambda z: z["name"]).alias("absent"))


def read_raw(spark: SparkSession, paths: str | list[str], schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """The contract's columns as text, by name, and ``_absent``: contract columns that the row's file lacks.

    Files may hold more columns, in any order; short rows are filled with NULL. A file that lacks a column gives one row, its path
    in ``_file``. A file without a header line is empty. All files are parsed in one scan, whatever their layouts: cells are read by place, and a
    stored table with one row per file says which place a column has; if all files agree, nothing is looked up.
    """
    found = materialise(layouts(spark, paths, schema), "layouts")
    usable = found.filter((F.size("absent") == 0))
    seen = usable.agg(F.max("width").alias("width"), F.min("at").alias("low"), F.max("at").alias("high"), F.count(F.lit(1)).alias("files")).first()
    lost = found.filter((F.size("absent") > 0) & (F.col("width") > 0))
    nothing = [F.lit(None).cast("string").alias(f.name) for f in schema]
    lost = lost.select(*nothing, F.col("absent").alias("_absent"), F.col("file").alias("_file"))
    if not seen.files:
        return lost
    places = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(1, seen.width + 1)])
    rows = spark.read.schema(places).options(**csv_options(multi_line)).csv(paths)
    if seen.low == seen.high and lost.isEmpty():
        cells = [F.col(f"c{i}") for i in seen.low]
    else:
        rows = rows.select(F.array(*places.fieldNames()).alias("cells"), F.col("_metadata.file_path").alias("file"))
        rows = rows.join(usable.select("file", "at"), "file")  # broadcast by its measured size
        cells = [F.get("cells", F.get("at", F.lit(k)) - 1) for k in range(len(schema))]
    rows = rows.select(*[c.alias(f.name) for c, f in zip(cells, schema)], F.lit(None).cast("array<string>").alias("_absent"), F.lit(None).cast("string").alias("_file"))
    return rows.unionByName(lost)


def clean(raw: DataFrame, schema: T.StructType, missing: tuple[str, ...] = MISSING) -> DataFrame:
    """Texts that mean "missing" become NULL, in every column."""
    return raw.select(*[F.when(~col(f.name).isin(*missing), col(f.name)).alias(f.name) for f in schema], *[c for c in ("_absent", "_file") if c in raw.columns])


def _typed(field: T.StructField) -> Column:
    value = col(field.name)
    return value if isinstance(field.dataType, T.StringType) else F.trim(value).try_cast(field.dataType)


def judge(cleaned: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows with ``_failing``: columns whose given value doesn't fit the type, or that the row's file lacks."""
    bad = {f.name: col(f.name).isNotNull() & _typed(f).isNull()
           for f in schema if not isinstance(f.dataType, T.StringType)}
    failing = F.array_compact(F.array(*[F.when(b, F.lit(n)) for n, b in bad.items()]).cast("array<string>"))
    if "_absent" not in cleaned.columns:
        cleaned = cleaned.withColumns({"_absent": F.lit(None).cast("array<string>"), "_file": F.lit(None).cast("string")})
    return cleaned.withColumn("_failing", F.coalesce("_absent", failing))


def parted(judged: DataFrame, schema: T.StructType) -> Loaded:
    """Typed rows, and the others as JSON with the failing columns; of a file without the columns, its path."""
    good = judged.filter(F.size("_failing") == 0).select(*[_typed(f).alias(f.name) for f in schema])
    raw = F.when(F.col("_file").isNotNull(), F.to_json(F.struct(F.col("_file").alias("file")))).otherwise(F.to_json(F.struct(*[col(f.name) for f in schema])))
    rejected = judged.filter(F.size("_failing") > 0).select(raw.alias("raw"), F.col("_failing").alias("columns"))
    return Loaded(good, rejected)


def stamp(df: DataFrame, table: str, run_ts: str) -> DataFrame:
    if table in NO_STAMP:
        return df
    value = F.lit(None).cast("timestamp_ntz") if table in NULL_STAMP else at(run_ts)
    return df.withColumn("PROCESSED_DTTM", value)


def _judged(spark: SparkSession, table: str, paths: str | list[str], schema: T.StructType, multi_line: bool) -> DataFrame:
    return judge(clean(read_raw(spark, paths, schema, multi_line), schema, markers(table)), schema)


def _stamped(parts: Loaded, table: str, run_ts: str) -> Loaded:
    return Loaded(stamp(parts.good, table, run_ts), parts.rejected.withColumn("table_name", F.lit(table)))


def load(spark: SparkSession, table: str, path: str | list[str], run_ts: str, schema: T.StructType | None = None,
         multi_line: bool = True) -> Loaded:
    """One extract, a folder or files: bad rows are set aside, the rest is loaded."""
    schema = schema or EXTRACTS[table]
    return _stamped(parted(_judged(spark, table, path, schema, multi_line), schema), table, run_ts)


def store(spark: SparkSession, table: str, path: str | list[str], good: str, rejected: str, run_ts: str, schema: T.StructType | None = None,
          multi_line: bool = True) -> None:
    """Load one extract into two folders. The files are parsed once, into a table of the shared folder; each folder is swapped in when it is complete."""
    schema = schema or EXTRACTS[table]
    with scratch_scope(spark):
        judged = materialise(_judged(spark, table, path, schema, multi_line), f"judged-{table}")
        parts = _stamped(parted(judged, schema), table, run_ts)
        tables.replace(parts.rejected, rejected)
        tables.replace(parts.good, good)


def load_all(spark: SparkSession, root: str, out: str, run_ts: str, multi_line: bool = True, at_once: int | None = None) -> None:
    """All extracts below ``root/<TABLE>/`` to Parquet, all at a time unless told otherwise; each is replaced, rejects go to one folder."""
    at_same_time([partial(store, spark, t, f"{root}/{t}/", f"{out}/{t}", f"{out}/_rejected/{t}", run_ts, None, multi_line) for t in sorted(EXTRACTS)], at_once)


def at_same_time(jobs: list[Callable[[], None]], at_once: int | None = None) -> None:
    """Run Spark jobs from threads of the driver; the first failure is raised once all have ended."""
    with ThreadPoolExecutor(at_once or len(jobs)) as pool:
        for job in [pool.submit(j) for j in jobs]:
            job.result()
