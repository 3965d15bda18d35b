"""Sinks: versioned dataset writes, the catalog, fan-out and exports.

A dataset version is data below a folder of its own and one catalog entry, which is also what commits it
(``commits``): the entry is created under the next free version number, whole or not at
all.  Two writers at once get two versions, and a crash before the entry leaves the versions as they were.
"""

from __future__ import annotations

import datetime as _dt
import logging
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgeline.session import materialize, path_exists
from forgeline.sources import commits

log = logging.getLogger(__name__)

CATALOG_SCHEMA = ("version int, dataset string, path string, row_count long, column_count int, "
                  "columns array<string>, run_stats string, created_at timestamp")


def read_catalog(spark: SparkSession, catalog_path: str) -> DataFrame:
    """The catalog's entries; empty where there are none yet, an error where they cannot be read."""
    if not path_exists(spark, catalog_path):
        return spark.createDataFrame([], CATALOG_SCHEMA)
    return spark.read.schema(CATALOG_SCHEMA).option("mode", "FAILFAST").json(catalog_path)


def next_version(spark: SparkSession, catalog_path: str) -> int:
    """The version after the newest (1 for an empty catalog); a writer may still lose it to another."""
    v = read_catalog(spark, catalog_path).agg(F.max("version")).first()[0]
    return int(v or 0) + 1


class VersionTaken(PySparkException):
    """The version asked for has been committed before."""


def write_version(df: DataFrame, base_path: str, catalog_path: str, dataset: str = "training_data",
                  run_stats: dict | None = None, version: int | None = None,
                  created_at: _dt.datetime | None = None) -> int:
    """Write ``df`` as a version and commit it with its catalog entry; returns the version.

    Row count is taken from the written files (one count over the output, no second pass over the input
    plan).  Without ``version`` it is the next free one, also with other writers at work; one
    that exists already is never written into.
    """
    spark = df.sparkSession
    path = f"{base_path}/data={uuid.uuid4().hex}"
    df.write.parquet(path)
    meta = {"dataset": dataset, "path": path, "row_count": spark.read.parquet(path).count(), "column_count": len(df.columns),
            "columns": list(df.columns), "run_stats": json_dumps(run_stats or {}),
            "created_at": (created_at or _dt.datetime.now(_dt.timezone.utc)).isoformat()}
    v = commits.commit(spark, catalog_path, lambda n, _: meta, version)
    if v is None:
        commits.delete(spark, path)
        raise VersionTaken(f"version {version} of {dataset} exists in {catalog_path}")
    return v


def json_dumps(d: dict) -> str:
    import json
    return json.dumps(d, sort_keys=True, default=str)


def catalog_entries(spark: SparkSession, catalog_path: str) -> DataFrame:
    """Latest entry per version plus an ``is_latest`` flag (small table)."""
    c = read_catalog(spark, catalog_path)
    w = Window.partitionBy("version").orderBy(F.desc("created_at"), F.desc("row_count"))
    last = c.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    mx = last.agg(F.max("version").alias("__mx"))
    from forgeline.operators.common import attach_row
    return attach_row(last, mx).withColumn("is_latest", F.col("version") == F.col("__mx")).drop("__mx")


def read_latest(spark: SparkSession, base_path: str, catalog_path: str) -> DataFrame:
    """The rows of the newest version, with its number."""
    newest = read_catalog(spark, catalog_path).agg(F.max_by(F.struct("version", "path"), "version").alias("r")).select("r.*").first()
    if newest is None or newest["version"] is None:
        raise FileNotFoundError(f"no version in {catalog_path}")
    return spark.read.parquet(newest["path"]).withColumn("version", F.lit(newest["version"]))


def fan_out(df: DataFrame, paths: list[str]) -> dict[str, bool]:
    """Publish one materialised frame at several consumer locations (``commits.read_published``).

    A copy replaces the one before it in one step; one that fails leaves it, and only warns.
    """
    ck = materialize(df, "fan-out")
    ok = {}
    for p in paths:
        try:
            commits.publish(ck, p)
            ok[p] = True
        except Exception as e:  # noqa: BLE001
            log.warning("copy to %s failed: %s", p, e)
            ok[p] = False
    return ok


def export_predictions(scored: DataFrame, path: str, model_version: str) -> None:
    """Holdout predictions next to actuals, partitioned by model version."""
    scored.withColumn("model_version", F.lit(model_version)).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("model_version").parquet(path)
