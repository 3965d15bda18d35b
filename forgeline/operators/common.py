"""Small join/attach helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (pandas groupby semantics).

    The right side's key columns are dropped from the result.  Spark still
    plans a hash / sort-merge join (null-safe equality is rewritten to a
    coalesce key), and AQE decides at run time whether the right side is
    small enough to broadcast.
    """
    if not keys:
        return attach_row(left, right)
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys])
    out = left.join(renamed, cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row of ``df``.

    The aggregate is used as an uncorrelated scalar subquery (computed once,
    its value inlined into the projection), so there is no join at all; an
    empty aggregate yields NULLs, like a left join would.
    """
    cols = one_row.columns
    packed = one_row.select(F.struct(*[F.col(c) for c in cols]).alias("__s")).scalar()
    out = df.withColumn("__s", packed)
    for c in cols:
        out = out.withColumn(c, F.col("__s").getField(c))
    return out.drop("__s")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row.

    The optimizer copies a named expression to the place of its use, so one used inside a lambda is computed
    again for each element there; an argument of an enclosing lambda is not.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def literal_map(mapping: dict) -> Column:
    """A literal MAP column from a small fixed Python dict."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def lookup(mapping: dict, key: Column) -> Column:
    """mapping[key] with NULL for a missing or NULL key (no join needed)."""
    return F.try_element_at(literal_map(mapping), key)


def together(batches, rows: int):
    """Batches joined into some of ``rows`` rows at least, but for the last."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if n:
        yield pa.concat_batches(held)
