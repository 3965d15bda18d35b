"""Bounded-space online packing of token ids into fixed-length sequences.

Each partition keeps a fixed number of open windows.  A document's whole windows leave
at once; the rest goes to the open window it fits best.  When none fits, it tops up the
fullest, which leaves, and what remains is placed again.  What is open at the end of a
partition is joined into full windows; the last, part-filled one of each partition
travels with its ids to a merge over many partitions.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline.llm.common import materialize, table
from forgeline.llm.word_tokens import WORD_BPE, slices, word_encoder

SEQUENCE_TOKENS = 4096
END_ID = 2
OPEN_WINDOWS = 16
MERGED_PARTITIONS = 2048      # part-filled windows that one merge task joins (16 KB of ids each)

# a piece in a window: (doc_id, start, ids as bytes, doc_tokens)
Piece = tuple


class Packer:
    """Places pieces online; ``place`` and ``finish`` yield windows (lists of pieces) that are full."""

    def __init__(self, size: int, windows: int):
        self.size, self.limit = size, windows
        self.open: list[list[Piece]] = []
        self.room: list[int] = []

    def place(self, doc_id, ids: bytes):
        total, at = len(ids) // 4, 0
        while total - at >= self.size:
            yield [(doc_id, at, ids[4 * at:4 * (at + self.size)], total)]
            at += self.size
        while at < total:
            need = total - at
            fits = [(r, i) for i, r in enumerate(self.room) if r >= need]
            if fits:
                i = min(fits)[1]
            elif len(self.open) < self.limit:
                self.open.append([])
                self.room.append(self.size)
                i = len(self.open) - 1
            else:                                          # none fits: top up the fullest, which then leaves
                i = min(range(self.limit), key=self.room.__getitem__)
            take = min(need, self.room[i])
            self.open[i].append((doc_id, at, ids[4 * at:4 * (at + take)], total))
            self.room[i] -= take
            at += take
            if not self.room[i]:
                yield self.open.pop(i)
                self.room.pop(i)

    def finish(self):
        """Join the open windows, fullest first; the last may stay part-filled."""
        order = sorted(range(len(self.open)), key=self.room.__getitem__)
        yield from join_pieces((p for i in order for p in self.open[i]), self.size)


def join_pieces(pieces, size: int):
    """Pieces in a row, cut so that every window but the last is full."""
    window, room = [], size
    for doc_id, start, ids, total in pieces:
        while ids:
            take = min(room, len(ids) // 4)
            window.append((doc_id, start, ids[:4 * take], total))
            start, ids, room = start + take, ids[4 * take:], room - take
            if not room:
                yield window
                window, room = [], size
    if window:
        yield window


def _rows(windows, schema: pa.Schema, keep_open: bool, size: int, part: int) -> pa.RecordBatch:
    """One row a piece of (sequence_id, pieces) windows; part-filled ones keep their ids for the merge."""
    out = {f.name: [] for f in schema}
    for sequence, window in windows:
        offset = 0
        last = keep_open and sum(len(p[2]) for p in window) < 4 * size
        for doc_id, start, ids, total in window:
            n = len(ids) // 4
            for c, v in zip(out, (doc_id, start, n, zlib.crc32(ids), total, sequence, offset, part, ids if last else None)):
                out[c].append(v)
            offset += n
    return pa.RecordBatch.from_pydict(out, schema)


def _pack(tokenizer: str, end_id: int, size: int, windows: int, schema: pa.Schema):
    def pack(batches):
        part, end, packer, n = TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes(), Packer(size, windows), 0
        for batch in batches:
            done = 0
            for texts in slices(batch.column("text")):
                names = batch.column("doc_id").slice(done, len(texts)).to_pylist()
                done += len(texts)
                full = [w for name, ids in zip(names, word_encoder(tokenizer).encode(texts)) for w in packer.place(name, ids + end)]
                yield _rows([((part << 32) + n + i, w) for i, w in enumerate(full)], schema, False, size, part)
                n += len(full)
        yield _rows([((part << 32) + n + i, w) for i, w in enumerate(packer.finish())], schema, True, size, part)
    return pack


def _merge(size: int, schema: pa.Schema):
    def merge(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("part", "ascending"), ("offset", "ascending")])
        group = rows["part"][0].as_py() // MERGED_PARTITIONS
        columns = [rows[c].to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")]
        joined = enumerate(join_pieces(zip(*columns), size))
        return pa.Table.from_batches([_rows([((1 << 62) + (group << 32) + i, w) for i, w in joined], schema, False, size, -1)])
    return merge


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = WORD_BPE,
                   end_id: int = END_ID, size: int = SEQUENCE_TOKENS, windows: int = OPEN_WINDOWS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each id of a document (its end id included) lies in exactly one piece; pieces of a sequence
    follow one another from offset 0.  Only the last sequence of each merge group (up to
    MERGED_PARTITIONS input partitions) is part-filled.  A null or empty text is its end id
    alone, a null id stays null, rows that share an id are packed each for itself, an empty table
    gives no rows, and other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType
    spark_schema = T.StructType([T.StructField("doc_id", kind)] + [
        T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "part")
    ] + [T.StructField("ids", T.BinaryType())])
    arrow = pa.schema([("doc_id", pa_type(kind))] + [(f.name, pa.int64()) for f in spark_schema.fields[1:-1]] + [("ids", pa.binary())])
    pieces = materialize(rows.mapInArrow(_pack(tokenizer, end_id, size, windows, arrow), spark_schema), "pieces")
    columns = [f.name for f in spark_schema.fields[:7]]
    merged = (pieces.where("ids IS NOT NULL")
              .groupBy(F.expr(f"part div {MERGED_PARTITIONS}")).applyInArrow(_merge(size, arrow), spark_schema))
    return pieces.where("ids IS NULL").select(columns).union(merged.select(columns))


def pa_type(kind: T.DataType) -> pa.DataType:
    """The Arrow type of an id column."""
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every row of ``documents``."""
    return pack_documents(table(spark, sf_dir, "documents"))
