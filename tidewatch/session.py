"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Results depend on these two: dates are computed in UTC, and a rewrite of one
# day must leave the other days of a table alone.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Speed only. AQE sizes partitions, splits skewed join partitions and turns a
# sort-merge join into a broadcast once a side has been measured as small.
SPEED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state, a day of addresses, stays outside the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_LOCAL_DIRS: dict[str, str] = {}


def build_session(app: str = "tidewatch", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTIC_CONF, **SPEED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster
    a machine-local path would lose its data with the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        base = _LOCAL_DIRS.get(app)
        if base is None:
            base = _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, never used before."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, in place of a cache that somebody has to release."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class FileSystem:
    """The file system of a path, as Spark itself opens it: names, small files, and removal of folders."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        """What lies in a folder; nothing if it is not there."""
        at = self._path(folder)
        return [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """Write a small file under a name nobody has, so that it is there as a whole or not at all."""
        hidden = f"{path}.{uuid.uuid4().hex}.tmp"
        stream = self._fs.create(self._path(hidden), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        taken = self._fs.exists(self._path(path))
        if taken or not self._fs.rename(self._path(hidden), self._path(path)):
            self.remove(hidden)
            raise FileExistsError(path)

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


@contextmanager
def scoped_conf(spark: SparkSession, settings: dict[str, str]):
    """Apply session settings for one action and put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
