"""Tables that are replaced as a whole or not at all.

Rows are written aside into a folder of their own, checked there, and only then named by a manifest; a
reader follows the newest manifest. So a job that is killed leaves the old rows, a table may be replaced
by rows read from itself, and of two writers at once the later one fails instead of undoing the first.
Where a table is partitioned, partitions can be replaced one by one; the others keep their folders.

    <path>/data/<name>/...        rows, never changed once written
    <path>/manifests/<n>.json     the folders that make up version n, one per partition
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.plans.staging import fingerprint


class Folder:
    """The few file operations a manifest needs, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark.sparkContext._jvm, path.rstrip("/")
        self.fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self._path(name))] if self.fs.exists(self._path(name)) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Writes a new file in one step; False if it is there already."""
        aside = self._path(f"manifests/.{uuid.uuid4().hex}")
        stream = self.fs.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.fs.exists(self._path(name)) or not self.fs.rename(aside, self._path(name)):
            self.fs.delete(aside, False)
            return False
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of a table that can be read, oldest first."""
    found = Folder(spark, path).names("manifests")
    return sorted(int(name[:-5]) for name in found if name.endswith(".json") and name[:-5].isdigit())


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"{path} has no version {version if version is not None else 'yet'}")
    return json.loads(Folder(spark, path).read(f"manifests/{known[-1] if version is None else version}.json"))


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a table's newest version, or of an older one that is still kept."""
    found = manifest(spark, path, version)
    folders = [f"{path.rstrip('/')}/data/{folder}" for folder in sorted(found["folders"].values())]
    return spark.read.schema(found["schema"]).parquet(*folders) if folders else spark.createDataFrame([], found["schema"])


def publish(df: DataFrame, path: str, keys: Sequence[str] = ("company", "dt"), partition_by: str | None = None,
            replace: bool = True, allow_empty: bool = False, made_from: str | None = None) -> int:
    """Make ``df`` the next version of the table at ``path`` and return its number.

    With ``partition_by``, a column whose values name folders, every partition has a folder of its own.
    With ``replace`` off, only the partitions that ``df`` has rows of are replaced. Nothing changes, and
    the reason is raised, if the rows are none (unless ``allow_empty``), if two of them share ``keys``
    (pass none for no such check), or if another writer was faster. ``made_from`` is kept in the manifest.
    """
    spark, folder = df.sparkSession, Folder(df.sparkSession, path)
    known = versions(spark, path)
    old = manifest(spark, path, known[-1])["folders"] if known else {}
    if not replace and partition_by is None:
        raise ValueError("only partitions can be replaced one by one")
    aside = uuid.uuid4().hex
    try:
        folders = _written(df, folder, aside, partition_by)
        rows = spark.read.schema(df.schema).parquet(*(f"{folder.root}/data/{name}" for name in folders.values())) if folders else df.limit(0)
        if not allow_empty and rows.isEmpty():
            raise ValueError("no rows to publish")
        if keys:
            twice = rows.groupBy(*keys).count().where("count > 1").limit(1).collect()
            if twice:
                raise ValueError(f"duplicate key: {[twice[0][k] for k in keys]}")
        version = known[-1] + 1 if known else 1
        named = folders if replace else {**old, **folders}
        text = json.dumps({"version": version, "folders": named, "partition_by": partition_by, "schema": _ddl(df), "made_from": made_from}, indent=1)
        if not folder.create(f"manifests/{version}.json", text):
            raise RuntimeError(f"{path} got a version {version} from elsewhere meanwhile")
    except BaseException:
        folder.delete(f"data/{aside}")
        raise
    return version


def publish_once(df: DataFrame, path: str, **options) -> int:
    """``publish``, unless the newest version was made by the same plan from the same files: then its number, and nothing is written."""
    made_from = fingerprint(df)
    known = versions(df.sparkSession, path)
    if known and manifest(df.sparkSession, path, known[-1]).get("made_from") == made_from:
        return known[-1]
    return publish(df, path, made_from=made_from, **options)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in df.schema.fields)


def _written(df: DataFrame, folder: Folder, aside: str, partition_by: str | None) -> dict[str, str]:
    """The rows, written under ``data/<aside>``: the folder of each partition, by its name."""
    folder.fs.mkdirs(folder._path("manifests"))
    if partition_by is None:
        df.write.parquet(f"{folder.root}/data/{aside}")
        return {"": aside}
    # The column stays inside the files as well, so a folder can be read on its own.
    named = df.withColumn("_part", F.coalesce(F.col(partition_by).cast("string"), F.lit("")))
    named.write.partitionBy("_part").parquet(f"{folder.root}/data/{aside}")
    return {name.removeprefix("_part="): f"{aside}/{name}" for name in folder.names(f"data/{aside}") if name.startswith("_part=")}


def clear_old(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete all but the newest ``keep`` versions and the folders that no kept version names; the number of those folders.

    Not to be run while a version is being written.
    """
    if keep < 1:
        raise ValueError("the newest version stays")
    folder, known = Folder(spark, path), versions(spark, path)
    named = {name for n in known[-keep:] for name in manifest(spark, path, n)["folders"].values()}
    for n in known[:-keep]:
        folder.delete(f"manifests/{n}.json")
    gone = 0
    for top in folder.names("data"):
        inside = [f"{top}/{name}" for name in folder.names(f"data/{top}") if name.startswith("_part=")] or [top]
        unnamed = [name for name in inside if name not in named]
        gone += len(unnamed)
        for name in [top] if len(unnamed) == len(inside) else unnamed:
            folder.delete(f"data/{name}")
    return gone
