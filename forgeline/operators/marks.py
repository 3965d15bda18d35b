"""Yes-or-no columns brought to wide rows as bitmaps by row number, instead of the rows to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.session import materialize

BUCKET_BITS = 15               # rows of a bitmap, as a power of two
BUCKETS_AT_ONCE = 1024          # bitmaps of a column sent to all tasks at a time: 4 MB


def marked(df: DataFrame, marks: DataFrame, number: str, row_col: str, columns: dict[str, Column]) -> DataFrame:
    """Adds a column for each of ``columns``: whether its condition over ``marks`` holds in a row whose ``number`` is ``row_col``.

    Numbers come from ``monotonically_increasing_id``.  They become bitmaps, a bit for each row, of which up to
    ``BUCKETS_AT_ONCE`` are joined at a time, each time to the files that hold their numbers: ``df`` is not shuffled.
    """
    place = (1 << BUCKET_BITS) - 1
    at = F.col(number).bitwiseAND(F.lit(place))
    bits = materialize(marks.select(F.shiftright(number, BUCKET_BITS).alias("__bucket"), *[F.when(c, at).alias(f"__bits_{n}") for n, c in columns.items()])
                       .repartition("__bucket").groupBy("__bucket").agg(*[F.bitmap_construct_agg(f"__bits_{n}").alias(f"__bits_{n}") for n in columns]), "marks")
    # the upper part of a number is that of the task which wrote the row
    task = F.shiftright("__bucket", 33 - BUCKET_BITS)
    cuts, held = [], 0
    for r in bits.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).orderBy("task").collect():
        if held and held + r["n"] > BUCKETS_AT_ONCE:
            cuts.append(r["task"])
            held = 0
        held += r["n"]
    at = F.col(row_col).bitwiseAND(F.lit(place))
    power = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), at.bitwiseAND(F.lit(7)).cast("int") + 1)

    def bit(column: str) -> Column:
        byte = F.conv(F.hex(F.substring(F.col(column), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
        return F.coalesce(byte.bitwiseAND(power) != 0, F.lit(False))

    out = None
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        part, some = df, bits
        if lo is not None:
            part, some = part.where(F.col(row_col) >= lo << 33), some.where(task >= lo)
        if hi is not None:
            part, some = part.where(F.col(row_col) < hi << 33), some.where(task < hi)
        joined = part.join(F.broadcast(some), F.shiftright(row_col, BUCKET_BITS) == F.col("__bucket"), "left")
        joined = joined.select(*df.columns, *[bit(f"__bits_{n}").alias(n) for n in columns])
        out = joined if out is None else out.unionByName(joined)
    return out
