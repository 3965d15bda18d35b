"""Atomic commits of tables: data first, then one manifest that only one writer can create.

A commit writes its data below a folder of its own name, which nothing reads yet, and becomes visible
with a numbered manifest (one line of JSON) that is created with its whole content and only if
no file of that number exists.  A writer that finds its number taken has lost the race: it
looks at what the winner committed and tries the next number.  A crash before the manifest leaves
data that no manifest names; readers keep to the manifests, so they see all of a commit or nothing.

The file system must be able to create a file or fail in one step: HDFS does by a rename that does not overwrite,
a local disk by a hard link.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from forgeline.session import path_exists

LOG = "_log"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of this writer's own."""
    _file_system(spark, path).delete(_path(spark, path), True)


def _is(error: Py4JJavaError, *names: str) -> bool:
    return error.java_exception.getClass().getSimpleName() in names


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with all of ``text``; False if there is one already.  Other failures raise."""
    jvm, fs, target = spark._jvm, _file_system(spark, path), _path(spark, path)
    fs.mkdirs(target.getParent())
    draft = _path(spark, f"{path.rsplit('/', 1)[0]}/.draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            local = jvm.java.nio.file.Files
            local.createLink(_local(jvm, target), _local(jvm, draft))
        else:
            _rename_once(spark, draft, target)
        return True
    except Py4JJavaError as e:
        if _is(e, "FileAlreadyExistsException"):
            return False
        raise
    finally:
        fs.delete(draft, False)


def _local(jvm, path):
    return jvm.java.io.File(path.toUri().getPath()).toPath()


def _rename_once(spark: SparkSession, draft, target) -> None:
    """Rename without overwriting, in one step where the file system has such a rename."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(kind, 1)
    options[0] = kind.NONE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, options)


def _manifest(log_path: str, number: int) -> str:
    return f"{log_path}/{number:020d}.json"


def numbers(spark: SparkSession, log_path: str) -> list[int]:
    """The committed numbers, rising; an empty list without a log.  A file that is no manifest is an error."""
    if not path_exists(spark, log_path):
        return []
    out = []
    for f in _file_system(spark, log_path).listStatus(_path(spark, log_path)):
        name = f.getPath().getName()
        if name.startswith((".", "_")):
            continue
        if not (name.endswith(".json") and name[:-5].isdigit()):
            spark.read.option("mode", "FAILFAST").schema("version long NOT NULL").json(f.getPath().toString()).collect()
            raise ValueError(f"{name} in {log_path} is no manifest")
        out.append(int(name[:-5]))
    return sorted(out)


def entry(spark: SparkSession, log_path: str, number: int) -> dict:
    """A manifest's content."""
    return json.loads(spark.read.text(_manifest(log_path, number), wholetext=True).first()[0])


def latest(spark: SparkSession, log_path: str) -> tuple[int, dict]:
    """The newest number and its manifest; (0, {}) without one."""
    found = numbers(spark, log_path)
    return (found[-1], entry(spark, log_path, found[-1])) if found else (0, {})


def commit(spark: SparkSession, log_path: str, make: Callable[[int, dict], dict], number: int | None = None) -> int | None:
    """Commit ``make(number, newest manifest)`` under the next free number and return that.

    ``make`` is called again with the winner's manifest when another writer took the number; it may
    raise to give up.  With a fixed ``number`` there is one attempt, None if it is taken.
    """
    while True:
        newest, before = latest(spark, log_path)
        n = number if number is not None else newest + 1
        if create_once(spark, _manifest(log_path, n), json.dumps({**make(n, before), "version": n}, sort_keys=True, default=str) + "\n"):
            return n
        if number is not None:
            return None


def is_committed(spark: SparkSession, log_path: str, number: int) -> bool:
    return path_exists(spark, _manifest(log_path, number))


# --- tables replaced as a whole ------------------------------------------------------
def publish(df: DataFrame, path: str) -> int:
    """Replace the rows that readers of ``path`` see by ``df``, in one step; returns the version."""
    spark = df.sparkSession
    folder = f"commit={uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    return commit(spark, f"{path}/{LOG}", lambda n, _: {"folder": folder})


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the newest (or a given) version."""
    log = f"{path}/{LOG}"
    found = latest(spark, log)[1] if version is None else entry(spark, log, version)
    if not found:
        raise FileNotFoundError(f"no version of {path} has been committed")
    return spark.read.parquet(f"{path}/{found['folder']}")


# --- tables upserted by partition --------------------------------------------------------
class PartitionedTable:
    """A table whose commits replace some of its partitions.

    A manifest names the folder of every live partition: partitions of a commit lie at
    ``commit=<id>/<column>=<value>``.  Rows in plain partition folders below ``path`` (a table from before
    its first commit) count as version 0.
    """

    def __init__(self, spark: SparkSession, path: str, column: str, schema: str):
        self.spark, self.path, self.column, self.log = spark, path.rstrip("/"), column, f"{path.rstrip('/')}/{LOG}"
        self.schema = spark.createDataFrame([], schema).schema

    def live(self) -> tuple[int, dict[str, str]]:
        """Version, and the folder (below ``path``) of each partition value."""
        version, found = latest(self.spark, self.log)
        if version or not path_exists(self.spark, self.path):
            return version, found.get("partitions", {})
        folders = [f.getPath().getName() for f in _file_system(self.spark, self.path).listStatus(_path(self.spark, self.path))]
        return 0, {f.split("=", 1)[1]: f for f in folders if f.startswith(f"{self.column}=")} or self._plain(folders)

    def _plain(self, folders: list[str]) -> dict[str, str]:
        files = [f for f in folders if not f.startswith((".", "_")) and not f.startswith("commit=")]
        if files:                                                # unreadable ones raise here
            self.spark.read.parquet(*[f"{self.path}/{f}" for f in files]).count()
            raise ValueError(f"{self.path} holds files outside of partitions")
        return {}

    def read(self, values: list[str] | None = None) -> DataFrame:
        """The rows of the newest version, of all partitions or of those in ``values``."""
        return self._of(self.live()[1], values)

    def _of(self, live: dict[str, str], values: list[str] | None) -> DataFrame:
        folders = [f for v, f in sorted(live.items()) if values is None or v in values]
        names = [f.name for f in self.schema]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        frames = []
        # the commit's folder is a partition column of its own: read those with one apart from those without
        for inside in (True, False):
            some = [f"{self.path}/{f}" for f in folders if f.startswith("commit=") is inside]
            if some:
                kind = StructType([*self.schema.fields, StructField("commit", StringType())]) if inside else self.schema
                frames.append(self.spark.read.schema(kind).option("basePath", self.path).parquet(*some).select(*names))
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def upsert(self, batch: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], batch_id: str | None = None) -> int | None:
        """Replace the partitions that ``batch`` touches by ``merge(their rows, batch)``.

        Another writer's commit in between is merged with anew, if it touched one of the same partitions;
        else only the manifest is written again.  A ``batch_id`` that is committed already does
        nothing, so a replayed batch has no effect.  Touched partition values are a bounded list (days).
        """
        touched = sorted(str(r[0]) for r in batch.select(F.col(self.column).cast("string")).distinct().collect())
        seen: dict[str, str] | None = None
        folder = ""

        def make(n: int, before: dict) -> dict:
            nonlocal seen, folder
            done = before.get("batches", [])
            if batch_id is not None and batch_id in done:
                raise _AlreadyDone
            live = self.live()[1]
            base = {v: live.get(v) for v in touched}
            if base != seen:
                if folder:
                    delete(self.spark, f"{self.path}/{folder}")
                seen, folder = base, f"commit={uuid.uuid4().hex}"
                rows = merge(self._of(live, touched), batch)
                rows.select(*[f.name for f in self.schema]).write.partitionBy(self.column).parquet(f"{self.path}/{folder}")
            kept = {v: f for v, f in live.items() if v not in touched}
            return {"partitions": {**kept, **{v: f"{folder}/{self.column}={v}" for v in touched}},
                    "batches": (done + [batch_id] if batch_id is not None else done)[-KEPT_BATCHES:]}

        if not touched:
            return None
        try:
            return commit(self.spark, self.log, make)
        except _AlreadyDone:
            return None


KEPT_BATCHES = 1000            # ids of the newest batches; a replay is of the last one


class _AlreadyDone(Exception):
    pass
