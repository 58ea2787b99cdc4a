"""Session set-up and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import SparkSession


def local_session(cores: int = 8, **conf: str) -> SparkSession:
    """A small local session for tests and benchmarks; its workers find this package from any folder."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [home, os.environ.get("PYTHONPATH")]))
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("dossier")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true"))
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for tables that outlive a stage.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="dossier-"))
    return context.getCheckpointDir().rstrip("/")


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never handed out twice."""
    path = f"{work_dir(spark)}/dossier/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Removes at its end every scratch table named inside: for work whose results are written by then."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.pop()
        remove_scratch(spark, *made)


def leaves_no_scratch(job: Callable) -> Callable:
    """A job that reads none of its scratch tables once it has returned; its first argument is the session."""
    @wraps(job)
    def scoped(spark: SparkSession, *args, **kwargs):
        with scratch_scope(spark):
            return job(spark, *args, **kwargs)
    return scoped


def remove_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete tables that ``scratch_path`` named and nothing reads any more."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        if not path.startswith(f"{work_dir(spark)}/dossier/"):
            raise ValueError(f"{path} is no scratch table")
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)


ROWS_PER_RANGE = 10_000_000


def width(spark: SparkSession, rows: int = 0) -> int:
    """How many ranges to cut a global order of so many rows into."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_RANGE))
