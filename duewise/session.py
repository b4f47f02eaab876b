"""Session set-up and the written tables that cut lineage between stages."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "duewise", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches on one machine; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stage_dir(spark: SparkSession) -> str:
    """The shared folder for staged tables: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a temporary folder; on a cluster other hosts could not
    read it, so an unset folder is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="duewise-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_scopes: list[list[str]] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged within, at the end and on error. Write results elsewhere before it ends."""
    written: list[str] = []
    _scopes.append(written)
    try:
        yield
    finally:
        _scopes.pop()
        for folder in written:
            discard(spark, folder)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a staged folder that is read no more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def new_folder(spark: SparkSession, name: str) -> str:
    """Where to write next under the shared folder; deleted with the scope it is asked for in, if there is one."""
    path = f"{stage_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Within, each finished job's shuffle files go at once, rather than when the driver collects its garbage.

    For series of staged tables, whose jobs are never run again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


SHORT_METHODS = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """Within, Spark cuts generated methods that the JVM would not compile (8,000 bytes): for projections of a hundred columns."""
    before = spark.conf.get(SHORT_METHODS)
    spark.conf.set(SHORT_METHODS, "8000")
    try:
        yield
    finally:
        spark.conf.set(SHORT_METHODS, before)


def staged_folder(df: DataFrame, name: str, *by: str, **options: str | int) -> str:
    """Write ``df`` as parquet, in a folder per value of ``by``, under the shared folder; where it stands."""
    path = new_folder(df.sparkSession, name)
    with freeing(df.sparkSession):  # the job is never run again
        df.write.options(**options).partitionBy(*by).parquet(path)
    return path


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Used where a result is read several times. Unlike a cache it outlives executors, and unlike
    ``checkpoint()`` it stays columnar, so later reads prune columns and skip row groups.
    """
    path = staged_folder(df, name)
    return df.sparkSession.read.schema(df.schema).parquet(path)
