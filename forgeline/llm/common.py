"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.session import materialize, release

# the six ASCII white-space characters the contracts name: [\x20\x09-\x0D]
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col):
    """Lower-case A-Z only, as the contracts ask (other letters stay)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of a distinct, undirected edge list as (node, root), root the smallest node.

    Alternating large-star / small-star rounds: every round is two partial
    aggregations and two joins on the node, and writes the edges it leaves, so no
    task holds a component and a lost executor re-reads the last round.  Only nodes
    with an edge to another node are returned; an empty edge list gives no rows.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        # large: all neighbours, small: the smaller ones; each hangs its side on the smallest seen
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        hung = both.join(low, "u")
        if large:
            out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def seen(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = materialize(edges.where(f"{a} <> {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = seen(now)
    while mark[0]:
        after = materialize(star(star(now, True), False), "edges")
        mark_after = seen(after)
        release(now)
        now = after
        if mark_after == mark:
            break
        mark = mark_after
    roots = now.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
