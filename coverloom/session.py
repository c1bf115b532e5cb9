"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Runtime options every job of this library expects.
#: - a skewed join may be split even when that costs one more exchange;
#: - a join on (id, x) may reuse data already hashed on id alone.
RUNTIME_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}

#: Shuffled bytes a task should read at most, as rows grow several times wider in joins and windows; and input bytes for which there is one shuffle partition.
TASK_BYTES, INPUT_BYTES = 16 << 20, 6 << 20

#: Wide stages generate methods above 8000 bytecodes, which the JVM by default only interprets.
#: With this option they are compiled, several times faster than without.
COMPILE_LARGE = "-XX:-DontCompileHugeMethods"

#: Set before the session exists: Python call sites are not captured for every column of a wide plan.
STATIC_OPTIONS = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.driver.extraJavaOptions": COMPILE_LARGE,
    "spark.executor.extraJavaOptions": COMPILE_LARGE,
    "spark.sql.session.timeZone": "UTC",
}


def get_spark(app: str = "coverloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**STATIC_OPTIONS, **RUNTIME_OPTIONS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime options to a session made elsewhere.

    Where its JVMs were started without ``COMPILE_LARGE``, large methods are not generated at all;
    slower than compiling them, faster than interpreting them.
    """
    for name, value in RUNTIME_OPTIONS.items():
        spark.conf.set(name, value)
    started_with = spark.sparkContext.getConf().get("spark.executor.extraJavaOptions", "")
    if COMPILE_LARGE not in started_with:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def size_shuffles(spark: SparkSession, *paths: str) -> None:
    """Shuffle partitions by the size of the input, so that a task's share does not grow with it; adaptive execution joins small ones.

    Two a core are the least, or as many as the session was given where that is fewer. An advisory size below ``TASK_BYTES`` stays.
    """
    read = lambda name, default: spark.conf.get(name, default)
    size = 0
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        size += files.getContentSummary(path).getLength() if files.exists(path) else 0
    least = min(int(read("spark.sql.shuffle.partitions", "200")), 2 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(least, -(-size // INPUT_BYTES))))
    if _bytes(read("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")) > TASK_BYTES:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TASK_BYTES))


def _bytes(text: str) -> int:
    """A size such as ``64MB`` or ``8m`` as a number."""
    digits = text.rstrip("BbKkMmGg")
    unit = text[len(digits):].lower().rstrip("b")
    return int(digits) << {"": 0, "k": 10, "m": 20, "g": 30}[unit]


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions that Spark deals an exchange to."""
    given, on = spark.conf.get("spark.sql.shuffle.partitions"), lambda name: spark.conf.get(name, "true").lower() == "true"
    if on("spark.sql.adaptive.enabled") and on("spark.sql.adaptive.coalescePartitions.enabled"):
        given = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or given
    return int(given)


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for cut lineage: ``spark.checkpoint.dir`` of the session.

    A temporary folder is used only where the cluster names none (tests, local runs).
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="coverloom-"))
    return sc.getCheckpointDir()


#: A write that ends drops its shuffle files: nothing reads them again, and until the driver's next collection they would fill the executors' disks.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bucketed rows that are dealt by the key already go to one file a task; so many files are kept open instead of sorting the rows by bucket.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"

_local = threading.local()
_options_lock, _options_held = threading.Lock(), {}


@contextmanager
def _while_writing(spark: SparkSession, **options: str) -> Iterator[None]:
    """Session options that hold during writes; the last of several at a time (threads of a daily run) puts the former values back."""
    options = {DROP_SHUFFLES: "true", **options}
    with _options_lock:
        for name, value in options.items():
            holders, former = _options_held.get(name, (0, None))
            _options_held[name] = holders + 1, former if holders else spark.conf.get(name, None)
            spark.conf.set(name, value)
    try:
        yield
    finally:
        with _options_lock:
            for name in options:
                holders, former = _options_held[name]
                _options_held[name] = holders - 1, former
                if holders == 1:
                    spark.conf.unset(name) if former is None else spark.conf.set(name, former)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialise`` writes inside are deleted at the end.

    For jobs that store their results inside the scope; a DataFrame that leaves it unread is lost.
    """
    scopes = _local.__dict__.setdefault("scopes", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def handed_on() -> None:
    """The table written last outlives the scope it was written in: it goes to the scope around, if there is one."""
    scopes = _local.scopes
    path = scopes[-1].pop()
    if len(scopes) > 1:
        scopes[-2].append(path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches read one expensive result. The table survives lost executors,
    unlike a cached one, and later reads still get column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/coverloom-stages/{name}-{uuid.uuid4().hex}"
    if scopes := getattr(_local, "scopes", None):
        scopes[-1].append(path)
    with _while_writing(spark):
        df.select("*").write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clustered(df: DataFrame, name: str, key: str, lying: bool = False) -> tuple[DataFrame, DataFrame]:
    """``materialise`` bucketed by ``key``: joins, groups and windows by it need no exchange of the rows.

    Rows that are not dealt by ``key`` already should be repartitioned by it before; with ``lying`` they are, and are written as they come, without a
    sort by bucket. Others are sorted by the number of their bucket, not by key within it: a bucket of several files has no order that Spark would use.
    Given twice: as the bucketed table, and as plain files for steps that must deal out a frequent key. The table is declared in the session's catalog only.
    """
    spark = df.sparkSession
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    path = f"{scratch_dir(spark)}/coverloom-stages/{table}"
    if scopes := getattr(_local, "scopes", None):
        scopes[-1].append(path)
    with _while_writing(spark, **({OPEN_FILES: "16"} if lying else {})):
        df.select("*").write.option("compression", "zstd").option("path", path).bucketBy(shuffle_partitions(spark), key).saveAsTable(table, format="parquet")
    return spark.table(table), spark.read.schema(df.schema).parquet(path)
