"""Token ids of documents as ORC files.

Ids are written in ascending document order, one file a range of documents: integer
run-length encoding, row indexes, and a Bloom filter and statistics on the document id,
so a reader splits by stripe and a lookup of a few documents skips the other stripes.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline.llm.common import table
from forgeline.llm.word_tokens import WORD_BPE, slices, word_encoder
from forgeline.session import shared_path

END_ID = 1
RUN_CHARS = 4_000_000         # texts encoded together
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def _encoder(tokenizer: str, end_id: int):
    def encode(batches):
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            done = 0
            for texts in slices(batch.column("text"), RUN_CHARS):
                ids, ends = word_encoder(tokenizer).encode_flat(texts)
                ends = ends + np.arange(1, len(texts) + 1)             # with an end id a text
                values = np.empty(ends[-1], "<i4")
                last = np.zeros(len(values), bool)
                last[ends - 1] = True
                values[last], values[~last] = end_id, ids
                offsets = np.concatenate(([0], ends))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(done, len(texts)),
                     pa.array(np.full(len(texts), part, np.int32)), pa.array(before + offsets[:-1].astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))],
                    ["doc_id", "part", "part_start", "ids"])
                before += int(ends[-1])
                done += len(texts)
    return encode


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                      tokenizer: str = WORD_BPE, end_id: int = END_ID) -> None:
    """Encode every whole text, append ``end_id`` and write ORC files in ascending id order at ``path``.

    Rows of the files: doc_id, part (the file's number in that order), part_start (ids in the file
    before the document) and ids.  A null text has the end id alone, a null id comes first, rows
    that share an id are ordered by their text's hash, an empty table gives readable files without
    rows, and other columns are not read.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("part", T.IntegerType()),
                           T.StructField("part_start", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    ordered.mapInArrow(_encoder(tokenizer, end_id), schema).write.options(**ORC_OPTIONS).mode("overwrite").orc(path)


def read_token_files(spark: SparkSession, path: str, doc_ids: list | None = None) -> DataFrame:
    """The rows of ``write_token_files``; with ``doc_ids`` only those, other stripes skipped by their metadata."""
    rows = spark.read.orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def _checksums(batches):
    for batch in batches:
        ids = batch.column("ids")
        values, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
        sums = [zlib.crc32(values[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), batch.column("part_start"),
             pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())],
            ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])


def document_index(files: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    spark = files.sparkSession
    schema = T.StructType([f for f in files.schema if f.name != "ids"]
                          + [T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    rows = files.select("doc_id", "part", "part_start", "ids").mapInArrow(_checksums, schema)
    # one row a file: the end of its last document; the running sum goes over files, not documents
    sizes = files.groupBy("part").agg(F.max(F.col("part_start") + F.size("ids")).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return rows.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of every row of ``documents``, indexed from what is read back."""
    path = shared_path(spark, f"token-files-{uuid.uuid4().hex}")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return document_index(read_token_files(spark, path))
