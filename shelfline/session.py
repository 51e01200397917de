"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Fixed value: codec of the files that are written for later stages.
COMPRESSION = "zstd"

_written: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("written", default=None)


def get_session(app_name: str = "shelfline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ANSI mode, UTC and adaptive execution on.

    Shuffle partitions stay at Spark's default unless given: adaptive execution
    coalesces small ones, and on a cluster the number belongs to the submit
    command, not to the library.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # the call site of every column expression costs milliseconds on the driver
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    A local master without the setting gets a new temporary folder; a cluster
    without it is an error, since no machine-local folder would do there.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            # executors of local-cluster are processes of their own
            if sc.master != "local" and not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="shelfline-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


@contextmanager
def scratch_scope() -> Iterator[None]:
    """Deletes, when it ends, what ``materialize`` wrote inside; also usable as a decorator.

    For work that has stored its results elsewhere by then: a frame that reads
    scratch folders of the scope can't be used after it.  It cleans up after a failure
    too, since such work is run again from its start.  An inner scope has its own
    folders; what a thread started inside writes belongs to no scope and stays.
    """
    written: list[tuple[SparkSession, str]] = []
    token = _written.set(written)
    try:
        yield
    finally:
        _written.reset(token)
        for spark, path in written:
            hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the jobs that run inside, put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _new_path(spark: SparkSession) -> str:
    path = f"{scratch_dir(spark)}/shelfline/{uuid.uuid4().hex}"
    written = _written.get()
    if written is not None:
        written.append((spark, path))
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches must see the very same rows (row numbers, model
    input) and where a long lineage should not be replayed when an executor is
    lost.  Zstandard files take about a quarter less than those of Parquet's usual codec.
    """
    path = _new_path(df.sparkSession)
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_in_buckets(df: DataFrame, buckets: int, by: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """``materialize`` for readers that group or order by at least ``by``: they need no shuffle.

    Rows that come dealt by ``by`` into as many parts are written where they are, sorted by ``order``.  Only the
    files stay: the table's name, which nobody else knows, is dropped.
    """
    spark = df.sparkSession
    name, path = f"buckets_{uuid.uuid4().hex}", _new_path(spark)
    writer = df.repartition(buckets, *by).write.format("parquet").option("compression", COMPRESSION).option("path", path)
    writer = writer.bucketBy(buckets, *by)
    (writer.sortBy(*order) if order else writer).saveAsTable(name)
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return rows
