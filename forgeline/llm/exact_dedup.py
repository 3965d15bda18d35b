"""Exact dedup by a Golomb-coded fingerprint exchange.

Every partition sends the sorted, Golomb-coded 64-bit fingerprints of its distinct
texts to the owners of the fingerprint ranges.  An owner answers each partition with a
bitmap of the fingerprints that occur elsewhere (or more than once in the partition).
Only the rows so marked, the suspects, are shuffled with their text, and equal texts
are found by grouping on the bytes themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.llm.common import ASCII_SPACE, materialize, release, table

ROWS_PER_OWNER = 500_000      # distinct fingerprints an owner handles at a time, on average


def rice_encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Golomb code with modulus 2**k of sorted distinct uint64: (k, unary quotients, k-bit remainders)."""
    gaps = np.diff(values, prepend=np.uint64(0))
    mean = int(values[-1]) // len(values) if len(values) else 0
    k = max(0, mean.bit_length() - 1)
    ends = np.cumsum((gaps >> np.uint64(k)).astype(np.int64) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, np.uint8)
    unary[ends] = 1
    rest = np.ascontiguousarray(gaps.astype(">u8")).view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(rest, axis=1)[:, 64 - k:] if k else np.zeros((len(values), 0), np.uint8)
    return k, np.packbits(unary).tobytes(), np.packbits(bits.ravel()).tobytes()


def rice_decode(n: int, k: int, unary: bytes, rest: bytes) -> np.ndarray:
    """The values that ``rice_encode`` was given."""
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    if k:
        bits = np.zeros((n, 64), np.uint8)
        bits[:, 64 - k:] = np.unpackbits(np.frombuffer(rest, np.uint8), count=n * k).reshape(n, k)
        gaps += np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def _owner_of(prints: np.ndarray, owners: int) -> np.ndarray:
    """Owner of each fingerprint: equal ranges of its upper 32 bits."""
    return ((prints >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)


def _unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64).view(np.uint64)


def _sender(owners: int):
    def send(rows: pa.Table) -> pa.Table:
        prints, counts = np.unique(_unsigned(rows["h"]), return_counts=True)
        part = rows["part"][0].as_py()
        out = {c: [] for c in ("owner", "part", "n", "k", "unary", "rest", "twice")}
        cuts = np.searchsorted(_owner_of(prints, owners), np.arange(owners + 1, dtype=np.uint64))
        for owner in np.flatnonzero(np.diff(cuts)):
            lo, hi = cuts[owner], cuts[owner + 1]
            k, unary, rest = rice_encode(prints[lo:hi])
            for c, v in zip(out, (int(owner), part, int(hi - lo), k, unary, rest, np.packbits(counts[lo:hi] > 1).tobytes())):
                out[c].append(v)
        return pa.table(out, SENT)
    return send


def _answer(rows: pa.Table) -> pa.Table:
    sent = rows.to_pylist()
    lists = [rice_decode(r["n"], r["k"], r["unary"], r["rest"]) for r in sent]
    prints = np.concatenate(lists)
    twice = np.concatenate([np.unpackbits(np.frombuffer(r["twice"], np.uint8), count=r["n"]) for r in sent])
    _, inverse, counts = np.unique(prints, return_inverse=True, return_counts=True)
    marked = counts > 1
    np.logical_or.at(marked, inverse, twice.astype(bool))
    marks = np.split(marked[inverse], np.cumsum([r["n"] for r in sent])[:-1])
    return pa.table({"part": [r["part"] for r in sent], "owner": [r["owner"] for r in sent],
                     "bitmap": [np.packbits(m).tobytes() for m in marks]}, ANSWER)


def _suspects(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """Rows of a partition whose fingerprint an owner marked; the order of the sent list is rebuilt here."""
    if not rows.num_rows:
        return pa.table({"row": []}, SUSPECT)
    h = _unsigned(rows["h"])
    prints, inverse = np.unique(h, return_inverse=True)
    answers = answers.sort_by("owner")
    owners_of_prints = answers.num_rows
    marks = []
    sizes = {}
    if owners_of_prints:
        total = answers["owners"][0].as_py()
        ids, n = np.unique(_owner_of(prints, total), return_counts=True)
        sizes = dict(zip(ids.tolist(), n.tolist()))
        for owner, bitmap in zip(answers["owner"].to_pylist(), answers["bitmap"].to_pylist()):
            marks.append(np.unpackbits(np.frombuffer(bitmap, np.uint8), count=sizes[owner]).astype(bool))
    marked = np.concatenate(marks) if marks else np.zeros(len(prints), bool)
    return pa.table({"row": rows["row"].filter(pa.array(marked[inverse]))}, SUSPECT)


SENT = pa.schema([("owner", pa.int64()), ("part", pa.int32()), ("n", pa.int64()), ("k", pa.int32()),
                  ("unary", pa.binary()), ("rest", pa.binary()), ("twice", pa.binary())])
ANSWER = pa.schema([("part", pa.int32()), ("owner", pa.int64()), ("bitmap", pa.binary())])
SUSPECT = pa.schema([("row", pa.int64())])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: src (all its columns), keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after the six ASCII white-space characters are
    deleted.  The row with the most code points in its original text stays, then the
    smallest id, then the first row as stored; so exactly one of fully repeated rows
    stays.  A null text counts as empty, a null id sorts after all others, an empty
    table gives no rows, and extra columns ride along inside ``src`` whatever their names.
    """
    text = F.coalesce(F.col(f"src.{text_col}"), F.lit(""))
    norm = F.translate(text, ASCII_SPACE, "")
    rows = materialize(
        docs.select(F.struct("*").alias("src"))
        .select("src", F.char_length(text).cast("long").alias("n"), F.xxhash64(norm).alias("h"),
                F.sha2(norm, 256).alias("sha"), F.spark_partition_id().alias("part"),
                F.monotonically_increasing_id().alias("row")), "exact-rows")
    owners = max(8, -(-rows.count() // ROWS_PER_OWNER))

    prints = rows.select("part", "row", "h")
    sent = prints.groupBy("part").applyInArrow(_sender(owners), "owner long, part int, n long, k int, unary binary, rest binary, twice binary")
    answers = (sent.groupBy("owner").applyInArrow(_answer, "part int, owner long, bitmap binary")
               .withColumn("owners", F.lit(owners)))
    suspects = materialize(
        prints.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_suspects, "row long"), "suspects")

    # byte verification: equal texts meet by their bytes, combined on the sending side first
    first = F.struct((-F.col("n")).alias("n"), F.col(f"src.{id_col}").isNull().alias("no_id"),
                     F.col(f"src.{id_col}").alias("id"), "row")
    groups = (rows.join(suspects, "row", "left_semi")
              .groupBy("sha", "h", norm.alias("norm"))
              .agg(F.min(first).alias("first"), F.count("*").alias("size"))
              .where("size > 1").select("sha", "h", "first", "size"))
    groups = materialize(groups, "exact-groups")
    release(suspects)
    return (rows.join(groups, ["sha", "h"], "left")
            .select("src",
                    F.when(F.col("first").isNull(), F.col(f"src.{id_col}")).otherwise(F.col("first.id")).alias("keep_id"),
                    F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
                    F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of every row of ``documents``."""
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        F.col("src.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


OP5_SQL = """
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t,
         translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""
