"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Whether a query's shuffle files go once it has ended, and not when the driver next collects its garbage.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "affinia", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` overrides or adds settings.

    Dots in setting names are written as double underscores, e.g.
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a skewed join even if the next operator then needs a shuffle of its own.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary
    folder of its own. On a cluster a machine-local folder would be lost with
    its executor, so a missing setting is an error there.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        named = tempfile.mkdtemp(prefix="affinia-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named.rstrip("/")


_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


@contextmanager
def run_scratch(spark: SparkSession, name: str, remove: bool) -> Iterator[str]:
    """One folder for all scratch tables made inside; with ``remove`` it is deleted at the end.

    For runs whose results are stored elsewhere by then. Without ``remove`` the tables stay, as the
    results may still read them; the folder is then the caller's to expire. A run inside a run
    uses the outer folder.
    """
    outer = _run_folder.get()
    if outer:
        yield outer
        return
    folder = scratch_path(spark, name)
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        if remove:
            remove_path(spark, folder)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder of the current run, or else below the shared folder."""
    return f"{_run_folder.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as a table written to the shared folder, for plans that read it several times.

    Written once and read by column, it survives lost executors and gives the planner
    the true size. (``checkpoint()`` would run the last stage twice.) Inside ``run_scratch``
    the run removes it, otherwise the folder is the caller's to expire. Such a table, or columns and rows
    picked from it (``picked_from``), are not written again.
    """
    if getattr(df, "_cut", False):
        return df
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    write_table(df, path)
    return stored(df, path)


def write_table(df: DataFrame, path: str, mode: str = "error") -> None:
    """``df`` written as Parquet; nothing reads the shuffle files of the write again, and they go with its end."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP_CONF, None)
    conf.set(CLEANUP_CONF, "true")
    try:
        df.write.mode(mode).parquet(path)
    finally:
        conf.set(CLEANUP_CONF, before or "false")


def stored(df: DataFrame, path: str) -> DataFrame:
    """The table below ``path``, with the columns of ``df``."""
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut, out._path = True, path
    return out


def drop_table(df: DataFrame) -> None:
    """Remove a table made by ``cut_lineage`` that no later plan reads; any other frame is left alone."""
    path = getattr(df, "_path", None)
    if path:
        remove_path(df.sparkSession, path)


def picked_from(source: DataFrame, df: DataFrame) -> DataFrame:
    """``df``, made from ``source`` by filters and projections only: if that is stored, it need not be."""
    df._cut = getattr(source, "_cut", False)
    return df
