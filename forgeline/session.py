"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on; sized for local tests, overridable by the cluster.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # dimension tables derived from data are broadcast only when AQE measures
    # them below this size; above it Spark falls back to a shuffle join
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}

_collecting: list[list] = []


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "forgeline", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (a cluster supplies its own)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    for k, v in (extra or {}).items():
        conf[k] = v
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for intermediate tables and checkpoints.

    ``spark.checkpoint.dir`` names it on a cluster and is only read here.  Where it is
    unset, a plain local master (one machine, as in tests) gets a scratch folder of its
    own; any other master gets a folder below the warehouse, which all executors share.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
            current = tempfile.mkdtemp(prefix="forgeline-ckpt-")
        else:
            current = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_forgeline_scratch"
        spark.conf.set("spark.checkpoint.dir", current)
    sc.setCheckpointDir(current)
    return current


def configure_session(spark: SparkSession) -> None:
    """What the plans rely on in a session built elsewhere: a shared folder for intermediate tables."""
    ensure_checkpoint_dir(spark)


_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing_shuffles(spark: SparkSession):
    """Queries run meanwhile delete their shuffle files as they end, not when the driver next collects its garbage.

    For results that are kept: a frame that is run again shuffles again.
    """
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, before)


def materialize(df: DataFrame, name: str = "stage", partition_by: str | None = None, codec: str | None = None) -> DataFrame:
    """Cut lineage: write ``df`` as parquet under the shared checkpoint folder and read it back.

    Columnar and compressed (cheaper than an RDD checkpoint); a lost executor
    re-reads the files instead of re-running the upstream plan.  What was shuffled for it is deleted.
    ``codec`` (default: the session's) suits wide tables; files of another size are dealt to tasks in another way.
    """
    path = shared_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("overwrite")
    if codec:
        writer = writer.option("compression", codec)
    with passing_shuffles(df.sparkSession):
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.materialized_path = path
    if _collecting:
        _collecting[-1].append(out)
    return out


@contextmanager
def scratch_tables(kept: list):
    """Collect in ``kept`` the tables that ``materialize`` writes meanwhile, for a later ``release``."""
    _collecting.append(kept)
    try:
        yield kept
    finally:
        _collecting.pop()


def release(*frames: DataFrame) -> None:
    """Delete tables made by ``materialize`` that nothing will read again."""
    for df in frames:
        path = getattr(df, "materialized_path", None)
        if path:
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for lineage-cutting tables)."""
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), *parts])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists (on any file system Spark knows); other failures raise."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
