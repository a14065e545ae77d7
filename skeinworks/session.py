"""Session helpers: configuration, shared-folder tables and code shipping."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings of the C library's and Arrow's allocators in Python workers: what a batch has used goes back at once, so workers rest small.
WORKER_MEMORY = {"MALLOC_MMAP_THRESHOLD_": "8388608", "MALLOC_TRIM_THRESHOLD_": "33554432", "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def local_session(cpus: int | str = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    base = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = SparkSession.builder.master(f"local[{cpus}]").appName("skeinworks").config(map=base | conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver imported it.

    Workers started by the JVM do not inherit the driver's ``sys.path``. On a
    cluster the package is installed or sent with ``--py-files``; this setting
    is then an unused extra path.
    """
    env = spark.sparkContext.environment
    for name, value in WORKER_MEMORY.items():
        env.setdefault(name, value)
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


#: Rows and bytes in an Arrow batch: texts and sets may be long, so batches are smaller than Spark's defaults (10,000 rows, 64 MB).
BATCH_ROWS, ARROW_BYTES = 1000, 4 << 20


def short_batches(spark: SparkSession) -> SparkSession:
    """Lowers the limits of Arrow batches, so that what a Python worker holds does not follow the table.

    Spark reads the batch limits when a plan runs, which is after an operator has returned it, so they
    stay lowered in the session; they change how rows travel to Python and no result.
    """
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", ARROW_BYTES)):
        now = int(re.sub(r"\D", "", spark.conf.get(f"spark.sql.execution.arrow.{name}")) or 0)
        if not 0 < now <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``, or the checkpoint folder set on the context.

    In local mode, where every task is on this machine, a temporary one is made; a cluster must name its own.
    """
    sc = spark.sparkContext
    set_on_context = sc._jsc.sc().getCheckpointDir()
    path = sc.getConf().get("spark.checkpoint.dir", None) or (set_on_context.get() if set_on_context.isDefined() else None)
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="skeinworks-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        path = f"file://{own}"
    if not set_on_context.isDefined():
        sc.setCheckpointDir(path)
    return path.rstrip("/")


#: On local folders Hadoop starts a process for the mode of each file it makes, four times with checksum files and once without.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def materialise(df: DataFrame, name: str = "step", few: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    Cuts lineage: a lost executor costs no recomputation of ``df``, and a
    result that is read more than once is computed once. The table stays
    until ``discard``, ``forget`` or the owner of the shared folder removes it. Shuffle files of the
    write go when it ends; else they stay until the driver happens to collect its garbage.

    ``few`` is for results that are much smaller than what they are made from: tasks of the last stage
    are put together, some for each core, so that short ones do not each write a file. Not for
    functions that use the number of their task.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    if few:
        df = df.coalesce(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8))
    before = spark.conf.get(CLEANED, None)
    spark.conf.set(CLEANED, "true")
    try:
        writer = df.write.options(**PLAIN_FILES) if path.startswith("file:") else df.write
        writer.parquet(path)
    finally:
        spark.conf.unset(CLEANED) if before is None else spark.conf.set(CLEANED, before)
    return spark.read.schema(df.schema).parquet(path)


#: Lets Spark delete the shuffle files of a query when it ends.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_written: list[str] = []


def written() -> frozenset[str]:
    """The tables written so far, a mark for ``discard``."""
    return frozenset(_written)


def discard(spark: SparkSession, since: frozenset[str], *kept: DataFrame) -> None:
    """Deletes the tables written since the mark that none of ``kept`` reads: what is made from them must be in tables already."""
    read = {x.rsplit("/", 2)[-2] for df in kept for x in df.inputFiles()}
    for path in [p for p in _written if p not in since]:
        if path.rsplit("/", 1)[-1] not in read:
            _delete(spark, path)
            _written.remove(path)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget(spark: SparkSession) -> None:
    """Deletes the tables that this process has written to the shared folder. Results that still read them must have been saved."""
    while _written:
        _delete(spark, _written.pop())


#: Rows that one task is to hold where whole groups of rows meet, and those that it holds at most before there are more tasks than MAP_FILES.
TASK_ROWS, MOST_ROWS = 1 << 18, 1 << 22
#: Up to so many tasks (spark.shuffle.sort.bypassMergeThreshold) a map task writes a file for each; beyond, it holds its rows to sort them by task.
MAP_FILES = 200


def tasks_of(spark: SparkSession, rows: int) -> int:
    """Tasks among which rows are to be dealt, so that what one holds does not follow the size of the table.

    Adaptive execution sizes tasks by compressed bytes and gives them all the more rows the better these
    compress; a number that is asked for stays.
    """
    few = min(-(-rows // TASK_ROWS), MAP_FILES)
    return max(spark.sparkContext.defaultParallelism, few, -(-rows // MOST_ROWS))


def tasks_for(rows: DataFrame) -> int:
    """``tasks_of`` these rows, which are counted: of a file that takes its footers only."""
    return tasks_of(rows.sparkSession, rows.count())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
