"""Session helpers: local sessions for tests and benches, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_fallback: dict[str, str] = {}


def local_session(cores: int | str = 8, app: str = "feedloom", **conf: str) -> SparkSession:
    """A single-JVM session. On a cluster the caller brings its own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores if cores != "*" else 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> None:
    """Settings the typing of wide rows profits from, where the session has Spark's defaults.

    The JVM never compiles methods above 8000 bytes. Below Spark's own limit of 65535 such methods
    would run interpreted; with the lower limit Spark splits the work into smaller ones.
    """
    key, default, better = "spark.sql.codegen.hugeMethodLimit", "65535", "8000"
    if spark.conf.get(key) == default:
        spark.conf.set(key, better)


OPEN_FILES = "8"


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Writes to few folders without a sort, where the session has Spark's default.

    A task keeps a file open in each of up to ``OPEN_FILES`` folders. By default it sorts all its rows by
    folder first, which for wide rows spills several times what is written. Beyond that number the
    remaining rows are sorted by folder, so writers that rely on the order of their rows stay outside.
    """
    key, default = "spark.sql.maxConcurrentOutputFileWriters", "0"
    mine = spark.conf.get(key, default) == default
    if mine:
        spark.conf.set(key, OPEN_FILES)
    try:
        yield
    finally:
        if mine:
            spark.conf.unset(key)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset (tests, a laptop) a
    temporary folder of this machine is taken.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by the cluster")
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="feedloom-")
    return _fallback[app]


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Cuts the lineage in a way that survives lost executors, and turns parsed text into columnar
    files so that every later use reads only the columns it needs.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Folder for what one load writes on its way; the load removes it when it has ended."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path = spark, fresh_dir(spark, label)

    def staged(self, df: DataFrame, label: str) -> DataFrame:
        path = f"{self.path}/{label}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def together(*jobs: Callable[[], None]) -> None:
    """Submit independent writes at the same time; the first failure is raised when all have ended."""
    spark = SparkSession.active()
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for future in running:
        future.result()


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds anything Spark can list."""
    try:
        spark.read.format("binaryFile").load(path).schema
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
