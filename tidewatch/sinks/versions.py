"""Tables whose partitions are replaced as a whole, or not at all.

A run writes its rows into a version folder of its own and then publishes: one small pointer file says which version holds
each partition. Readers resolve the newest pointer, so they see all of a run or nothing of it, and a run
that breaks between writing and publishing leaves the table as it was. A partition that lost all its rows is published as
empty. A pointer holds one line for each partition (a day, a month), never anything of the rows.

    table/data/version=<name>/<key>=<value>/part-*.parquet
    table/published/<number>.json

The pointer's number is taken by creating its file, which the file system lets one writer do; of two runs that
publish at once the second fails and can be run again. Versions no pointer kept refers to are removed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import FileSystem
from tidewatch.sinks.tables import write_table

#: Pointers, and with them versions, that stay readable for those who have just resolved them.
KEPT = 2


@dataclass
class Pointer:
    """What a table holds: the version of each partition (None: empty), its schema, and the run's own mark."""

    number: int = 0
    key: str = ""
    versions: dict[str, str | None] = field(default_factory=dict)
    schema: str = ""
    mark: str | None = None


def _numbers(files: FileSystem, path: str) -> list[int]:
    return sorted(int(name.removesuffix(".json")) for name in files.names(f"{path}/published") if name.endswith(".json"))


def _pointer(files: FileSystem, path: str, number: int) -> Pointer:
    return Pointer(**json.loads(files.read(f"{path}/published/{number:012d}.json")))


def published(spark: SparkSession, path: str) -> Pointer:
    """The newest pointer of a table, an empty one if nothing has been published."""
    files = FileSystem(spark, path)
    numbers = _numbers(files, path)
    return _pointer(files, path, numbers[-1]) if numbers else Pointer()


def write_version(df: DataFrame, path: str, key: str) -> str:
    """Write rows into a new version and return its name; nobody sees them yet."""
    version = uuid.uuid4().hex
    write_table(df.withColumn(key, F.col(f"`{key}`").cast("string")), f"{path}/data/version={version}", [key])
    return version


def version_rows(spark: SparkSession, path: str, version: str) -> int:
    """Rows of a version, published or not, as the footers of its files count them."""
    folder = f"{path}/data/version={version}"
    written = any("=" in name for name in FileSystem(spark, path).names(folder))
    return spark.read.parquet(folder).count() if written else 0


def publish_version(
    df: DataFrame, path: str, key: str, version: str, values: list[str] | None = None, mark: str | None = None
) -> Pointer:
    """Let a version written by `write_version` replace its partitions, and those of ``values`` that it has no rows for.

    ``df`` gives the schema only.
    """
    spark = df.sparkSession
    files = FileSystem(spark, path)
    before = published(spark, path)
    folders = files.names(f"{path}/data/version={version}")
    written = [name.partition("=")[2] for name in folders if name.startswith(f"{key}=")]
    versions = {**before.versions, **dict.fromkeys(values or []), **dict.fromkeys(written, version)}
    schema = T.StructType([f for f in df.schema if f.name != key]).json()
    pointer = Pointer(before.number + 1, key, versions, schema, before.mark if mark is None else mark)
    files.create(f"{path}/published/{pointer.number:012d}.json", json.dumps(pointer.__dict__))
    _prune(files, path)
    return pointer


def _prune(files: FileSystem, path: str) -> None:
    """Remove what only older pointers name. A version being written belongs to a run that has not published, and stays."""
    numbers = _numbers(files, path)
    kept = [_pointer(files, path, n) for n in numbers[-KEPT:]]
    used = {(v, n) for p in kept for v, n in p.versions.items() if n}
    live = {n for _, n in used}
    for number in numbers[:-KEPT]:
        old = _pointer(files, path, number)
        for value, version in old.versions.items():
            if version and (value, version) not in used:
                inside = f"/{old.key}={value}" if version in live else ""
                files.remove(f"{path}/data/version={version}{inside}")
        files.remove(f"{path}/published/{number:012d}.json")


def publish_partitions(
    df: DataFrame, path: str, key: str, values: list[str] | None = None, mark: str | None = None
) -> Pointer:
    """Replace the partitions ``df`` has rows for, and empty the others of ``values``, in one step that readers see."""
    return publish_version(df, path, key, write_version(df, path, key), values, mark)


def read_published(spark: SparkSession, path: str, values: list[str] | None = None) -> DataFrame:
    """The table as last published; ``values`` names the partitions wanted. The key is text, as in the folder names."""
    pointer = published(spark, path)
    if not pointer.number:
        raise ValueError(f"nothing has been published under {path}")
    wanted = {v: n for v, n in pointer.versions.items() if n is not None and (values is None or v in values)}
    fields = T.StructType.fromJson(json.loads(pointer.schema)).fields
    schema = T.StructType([*fields, T.StructField(pointer.key, T.StringType())])
    if not wanted:
        return spark.createDataFrame([], schema)
    base = f"{path}/data"
    paths = [f"{base}/version={n}/{pointer.key}={v}" for v, n in wanted.items()]
    # Partition values as they are written in folder names.
    whole = T.StructType([*fields, T.StructField("version", T.StringType()), T.StructField(pointer.key, T.StringType())])
    return spark.read.schema(whole).option("basePath", base).parquet(*paths).drop("version")
