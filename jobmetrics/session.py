"""Session settings the library relies on, and shared scratch storage for cutting lineage."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings; every one may be overridden by the caller after `configure`.
RUNTIME_CONF = {
    # Epoch columns become instants; month, weekday and date are read off in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


_scope: contextvars.ContextVar[str] = contextvars.ContextVar("scratch_scope", default="shared")


def build_session(app_name: str = "jobmetrics", master: str | None = None, **conf: str) -> SparkSession:
    """Session builder for scripts and tests; on a cluster `master` comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the one the cluster names in spark.checkpoint.dir.

    Only a local-mode session, whose executors share the driver's disk, may fall back to a
    temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="jobmetrics-")
        spark.conf.set("spark.checkpoint.dir", named)
    return f"{named.rstrip('/')}/jobmetrics-{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared scratch folder and read it back.

    This cuts lineage, survives the loss of executors, and gives the optimizer the real size of
    the data, so that a join against the result is broadcast only when it is actually small.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{_scope.get()}/{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what is materialised inside the block once it ends."""
    name = uuid.uuid4().hex
    token = _scope.set(name)
    try:
        yield
    finally:
        _scope.reset(token)
        remove_path(spark, f"{scratch_dir(spark)}/{name}")


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables this application wrote."""
    remove_path(spark, scratch_dir(spark))


def path_exists(spark: SparkSession, path: str) -> bool:
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below `path`, or none when it does not exist."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(fs_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(fs_path)]


def remove_path(spark: SparkSession, path: str) -> None:
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(fs_path, True)


def replace_path(spark: SparkSession, new: str, old: str) -> None:
    """Give `new` the name of `old`, which is deleted."""
    new_path, old_path = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (new, old))
    fs = new_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(old_path, True)
    if not fs.rename(new_path, old_path):
        raise OSError(f"{new} could not be renamed to {old}")
