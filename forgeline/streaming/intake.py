"""Incremental order intake with maintained state (T-S6).

A trigger reads its new orders and small state tables, never the orders before it.  The state is
what the batch ETL takes from all rows: counts of the distinct (process, value) pairs of the imputed wall
columns (their medians), sum and count of the hole diameters (their mean) and the first row of each
(part, process).  Every trigger appends its own share to each table and names its folder in one
manifest of its number (``commits``); a replayed trigger finds its number taken and changes nothing.

Verdicts: a new row is a duplicate if the state or its own batch has an earlier one of its key; if it comes
before the first row so far, that row's verdict changes, and it alone is written, as demoted.
``training_rows`` reads the kept rows, fills in the medians and mean of the state row by row and gives
the result of the batch ETL over all orders taken in so far.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forgeline.operators.common import join_null_safe
from forgeline.operators.labels import build_labels
from forgeline.operators.normalize import WALL_COLUMNS, clean_process, normalize
from forgeline.operators.quantiles import exact_medians_of_counts
from forgeline.operators.validate import annotate
from forgeline.session import materialize, release
from forgeline.sources import commits
from forgeline.streaming.monitors import finish

ORDER = ["completion_date", "order_id", "intake", "row"]       # which row of a key comes first
COMPACT_EVERY = 20                                             # triggers whose shares of the state are added up


class Intake:
    """The tables of one intake below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.log = spark, path.rstrip("/"), f"{path.rstrip('/')}/{commits.LOG}"

    def _read(self, manifests: list[dict], table: str) -> DataFrame | None:
        folders = [f"{self.path}/{m[table]}" for m in manifests if m.get(table)]
        return self.spark.read.parquet(*folders) if folders else None

    def manifests(self, below: int | None = None) -> list[dict]:
        return [commits.entry(self.spark, self.log, n) for n in commits.numbers(self.spark, self.log) if below is None or n < below]

    def _state(self, manifests: list[dict], table: str) -> DataFrame | None:
        """Shares of a state table from the last compaction on."""
        since = max((i for i, m in enumerate(manifests) if m["compacted"]), default=0)
        return self._read(manifests[since:], table)

    def take(self, batch: DataFrame, epoch_id: int, enrich: Callable[[DataFrame], DataFrame]) -> None:
        """One trigger: enrich the new orders, judge them against the state, commit rows and state together."""
        number, spark = epoch_id + 1, self.spark
        if commits.is_committed(spark, self.log, number):
            return
        before = self.manifests(number)
        folder = f"commit={uuid.uuid4().hex}"
        entry = {"compacted": bool(before) and number % COMPACT_EVERY == 0}

        def keep(df: DataFrame, table: str) -> DataFrame:
            entry[table] = f"{folder}/{table}"
            df.write.parquet(f"{self.path}/{entry[table]}")
            return spark.read.schema(df.schema).parquet(f"{self.path}/{entry[table]}")

        rows = materialize(enrich(batch).withColumn("intake", F.lit(epoch_id).cast("long")).withColumn("row", F.monotonically_increasing_id()), "intake-rows")
        key = ["part_id", "process"]
        keyed = rows.withColumn("process", clean_process(F.col("process_code")))
        # first rows: of the batch, of the state for its keys, and the earlier of both
        mine = keyed.groupBy(*key).agg(F.min(F.struct(*ORDER)).alias("first"))
        state = self._state(before, "first")
        if state is not None:
            known = join_null_safe(state, mine.select(*key), key, "left_semi").groupBy(*key).agg(F.min("first").alias("known"))
            mine = join_null_safe(mine, known, key, "left")
        else:
            mine = mine.withColumn("known", F.lit(None).cast(mine.schema["first"].dataType))
        mine = materialize(mine.withColumn("earlier", F.col("known").isNull() | (F.col("first") < F.col("known"))), "intake-first")
        winner = F.when(F.col("earlier"), F.col("first")).otherwise(F.col("known"))
        is_first = (F.col("winner.intake") == F.col("intake")) & (F.col("winner.row") == F.col("row"))
        keep(join_null_safe(keyed, mine.select(*key, winner.alias("winner")), key, "left").select(*rows.columns, (~is_first).alias("repeats")), "rows")
        keep(mine.where("earlier AND known IS NOT NULL").select("known.intake", "known.row"), "demoted")
        firsts = mine.where("earlier").select(*key, "first")
        # shares of the order statistics and of the mean
        counts = keyed.select("process", F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in WALL_COLUMNS])).alias("v")) \
            .select("process", "v.*").where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("process", "name", "value").agg(F.count(F.lit(1)).alias("n"))
        holes = keyed.agg(F.sum("hole_diameter_min").alias("total"), F.count("hole_diameter_min").alias("n"))
        if entry["compacted"]:
            firsts = self._state(before, "first").unionByName(firsts).groupBy(*key).agg(F.min("first").alias("first"))
            counts = self._state(before, "counts").unionByName(counts).groupBy("process", "name", "value").agg(F.sum("n").alias("n"))
            holes = self._state(before, "holes").unionByName(holes).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        for table, df in (("first", firsts), ("counts", counts), ("holes", holes)):
            keep(df, table)
        commits.commit(spark, self.log, lambda n, _: entry, number)
        release(rows, mine)

    def training_rows(self, upto: int | None = None) -> DataFrame:
        """Annotated rows of all orders taken in (or by the first ``upto`` triggers): the batch ETL's result."""
        manifests = self.manifests(None if upto is None else upto + 1)
        rows = self._read(manifests, "rows")
        if rows is None:
            raise FileNotFoundError(f"nothing has been taken in at {self.path}")
        demoted = self._read(manifests, "demoted").withColumn("demoted", F.lit(True))
        rows = rows.join(demoted, ["intake", "row"], "left").withColumn("repeats", F.col("repeats") | F.coalesce("demoted", F.lit(False))).drop("demoted")
        counts = self._state(manifests, "counts")
        of_process = exact_medians_of_counts(counts.groupBy("process", "name", "value").agg(F.sum("n").alias("n")), ["process"], "name", "value", "n", WALL_COLUMNS) \
            .withColumnRenamed("process", "process_code")
        of_all = exact_medians_of_counts(counts.groupBy("name", "value").agg(F.sum("n").alias("n")), [], "name", "value", "n", WALL_COLUMNS)
        mean = self._state(manifests, "holes").agg((F.sum("total") / F.sum("n")).alias("mean"))
        filled = normalize(rows.drop("intake", "row"), wall_medians=(of_process, of_all), hole_mean=mean)
        return annotate(build_labels(filled), duplicate_col="repeats")


def order_intake(orders: DataFrame, enrich: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                 timeout_s: float | None = None) -> StreamingQuery:
    """T-S6: run a stream of new orders on what is available now into the intake at ``path``."""
    spark = orders.sparkSession
    intake = Intake(spark, path)
    return finish(orders.writeStream.foreachBatch(lambda batch, epoch_id: intake.take(batch, epoch_id, enrich))
                  .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(), timeout_s)
