"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_shared_dir: str | None = None


def build_session(app_name: str = "tickloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    On a cluster, leave ``master`` unset and pass cluster settings to
    ``spark-submit``; explicit ``conf`` entries win over the defaults here.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_local_shared_dir(path: str) -> None:
    """Shared folder of sessions on this machine whose ``spark.checkpoint.dir`` is not set."""
    global _local_shared_dir
    _local_shared_dir = path.rstrip("/")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Where that is unset, a local session may be given a folder by
    ``use_local_shared_dir``; there is no other.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if _local_shared_dir is None or not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_shared_dir


_named: list[str] = []


def new_shared_path(spark: SparkSession, kind: str) -> str:
    path = f"{shared_dir(spark)}/tickloom/{kind}-{uuid.uuid4().hex}"
    _named.append(path)
    return path


@contextmanager
def removing_tables(spark: SparkSession) -> Iterator[None]:
    """Within, results are used up; what was written to the shared folder for them goes at the end.

    Only paths named within are removed, so results made before stay readable, and tables of
    other sessions are not touched.
    """
    before = len(_named)
    try:
        yield
    finally:
        named, _named[before:] = _named[before:], []
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in map(hadoop.Path, named):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    The result survives executor loss and is the same for every branch of a
    plan that uses it. As a file table it also has a measured size, so the
    optimizer broadcasts it only below ``spark.sql.autoBroadcastJoinThreshold``
    and uses a sort-merge join above it.
    """
    spark = df.sparkSession
    path = new_shared_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
