"""Session set-up, and the shared folder for tables that cut a lineage."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

_run: ContextVar[str] = ContextVar("run", default="session")


# set only where neither the cluster nor the caller did
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "tallyhouse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on: AQE splits skewed joins and chooses the join strategy.

    ``master`` and ``conf`` (with ``__`` for a point) are for tests and the bench; a cluster brings its own.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary folder only for a local master without one."""
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tallyhouse-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def _scratch_folder(spark: SparkSession) -> str:
    return "/".join([scratch_root(spark), f"tallyhouse-{spark.sparkContext.applicationId}", _run.get()])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: a short lineage that outlives lost executors.

    Parquet instead of ``checkpoint()``, because later passes read only a few of the columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_run(spark: SparkSession):
    """Remove what ``write_through`` wrote in this block when it ends; its results must be written by then."""
    token = _run.set(f"run-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_scratch_folder(spark))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        _run.reset(token)
