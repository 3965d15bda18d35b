"""Suffix-array dedup: repeated strings found by a blockwise, difference-cover construction.

A suffix matters here only as far as ``length`` bytes: two suffixes tie if those are equal.

1. Cover sample.  Suffixes that start at positions of a difference cover D modulo v are named by
   their first length-v+1 bytes, and the names that occur once are told from those that repeat
   (the sample's ranks, as far as ties need them).  For any two positions i and j there is a
   shift k < v with i+k and j+k both in D, so a suffix that ties with another over ``length``
   bytes starts at most v-1 bytes before a repeated sample name; all other suffixes are settled.
2. Suffix buckets.  The suffixes still open are named by their ``length`` bytes and dealt to buckets
   by name.  One bucket at a time is sent, sorted and answered, so disk and memory hold
   a share of the open suffixes, not all; inside a bucket, name ranges are sorted by separate tasks.
3. Spans.  The starts of suffixes whose name repeats give the bytes to remove.

Names are 64-bit polynomial hashes.  A false tie needs both a collision and, within v-1 bytes, a
repeated sample name, so it can only occur next to text that does repeat for length-v+1 bytes.
Texts travel in blocks of some megabytes; a block sends each name once, marked if it has it twice.
"""

from __future__ import annotations

import hashlib
import itertools
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline.llm.common import materialize, release, table

LENGTH = 400                  # bytes a string must have to count as repeated
SUFFIX_BUCKETS = 4            # open suffixes are sorted one bucket after another
BLOCK_BYTES = 1 << 20         # text of a block (a longer document is a block of its own)
NAMES_PER_TASK = 1 << 20      # names that one task sorts, on average
_RUN = 1 << 18                # windows hashed at a time
_BASE = 0x9E3779B97F4A7C15


def difference_cover(length: int) -> tuple[int, np.ndarray]:
    """(v, D): the largest perfect difference set of prime order whose modulus v is at most length / 2.

    Singer's construction: the exponents i < v for which x**i in GF(q**3) has no x**2 term.
    """
    for q in (19, 17, 13, 11, 7, 5, 3, 2):
        v = q * q + q + 1
        if v > max(length // 2, 7):
            continue
        for a, b, c in itertools.product(range(q), range(q), range(1, q)):      # x^3 = a x^2 + b x + c
            power, found = (1, 0, 0), []
            for i in range(v):
                if power[2] == 0:
                    found.append(i)
                lo, mid, hi = power
                power = (hi * c % q, (lo + hi * b) % q, (mid + hi * a) % q)
            if len(found) == q + 1 and len({(i - j) % v for i in found for j in found if i != j}) == v - 1:
                return v, np.array(found)
    raise ValueError("no difference cover")


@lru_cache(maxsize=1)
def _constants(span: int):
    """A random odd number per byte value, and powers of the base and of its inverse modulo 2**64."""
    letters = np.random.default_rng(400).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    powers = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(span + 1, base, np.uint64)
        p[0] = 1
        powers.append(np.cumprod(p))
    return letters, *powers


def window_names(data: np.ndarray, length: int) -> np.ndarray:
    """64-bit names of all windows of ``length`` bytes, hashed a bounded run at a time."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    letters, powers, inverse = _constants(max(_RUN, length) + length)
    out = np.empty(n, np.uint64)
    for at in range(0, n, _RUN):
        part = data[at:at + _RUN + length - 1]
        m = len(part) - length + 1
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(letters[part] * powers[:len(part)], out=sums[1:])
        h = (sums[length:] - sums[:m]) * inverse[:m]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        out[at:at + m] = h ^ (h >> np.uint64(32))
    return out


class Cover:
    """Positions, names and reach of the cover sample for strings of ``length`` bytes."""

    def __init__(self, length: int):
        self.length = length
        self.v, members = difference_cover(length)
        self.sample_length = length - self.v + 1
        self.inside = np.zeros(self.v, bool)
        self.inside[members] = True

    def positions(self, n_bytes: int) -> np.ndarray:
        return np.flatnonzero(np.resize(self.inside, max(0, n_bytes - self.sample_length + 1)))

    def names(self, data: np.ndarray) -> np.ndarray:
        return window_names(data, self.sample_length)[self.positions(len(data))]

    def open_runs(self, n_bytes: int, repeated: np.ndarray) -> list[tuple[int, int]]:
        """Runs [a, b) of suffixes not settled: at most v-1 bytes before a repeated sample name."""
        at = self.positions(n_bytes)[repeated]
        last = n_bytes - self.length
        if last < 0 or not len(at):
            return []
        mask = np.zeros(last + 2, np.int64)
        at = at[at - self.v + 1 <= last]
        np.add.at(mask, np.maximum(at - self.v + 1, 0), 1)
        np.add.at(mask, np.minimum(at, last) + 1, -1)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(mask[:-1]) > 0, [0])).astype(np.int8)))
        return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _each(rows):
    """Rows of an Arrow batch or table as dicts, one at a time: a batch holds many blocks."""
    for i in range(rows.num_rows):
        yield rows.slice(i, 1).to_pylist()[0]


def _packed(parts: list[bytes]) -> bytes:
    """Text as it is stored and shuffled."""
    return pa.compress(b"".join(parts), codec="zstd", asbytes=True)


def _unpacked(data: bytes, size: int) -> bytes:
    return pa.decompress(data, size, codec="zstd", asbytes=True) if size else b""


def _split(block: dict) -> list[np.ndarray]:
    """The documents of a block as byte arrays."""
    data = np.frombuffer(_unpacked(block["data"], sum(block["sizes"])), np.uint8)
    ends = np.cumsum(block["sizes"], dtype=np.int64)
    return [data[e - s:e] for s, e in zip(block["sizes"], ends.tolist())]


def _concat(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


# --- the exchange: which of a block's names occur elsewhere -------------------------------------

SENT = "owner long, block long, n long, names binary, twice binary"
ANSWER = "block long, owner long, n long, bitmap binary"


def _send(block: int, names: np.ndarray, owners: int, first: int, last: int) -> pa.RecordBatch:
    """A row for each owner in [first, last): its range of the block's sorted distinct names."""
    found, counts = np.unique(names, return_counts=True)
    owner = ((found >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
    cuts = np.searchsorted(owner, np.arange(first, last + 1, dtype=np.uint64))
    some = np.flatnonzero(np.diff(cuts))
    spans = [(cuts[i], cuts[i + 1]) for i in some]
    return pa.RecordBatch.from_arrays(
        [pa.array(some + first, pa.int64()), pa.array(np.full(len(some), block), pa.int64()),
         pa.array([int(b - a) for a, b in spans], pa.int64()), pa.array([found[a:b].tobytes() for a, b in spans], pa.binary()),
         pa.array([np.packbits(counts[a:b] > 1).tobytes() for a, b in spans], pa.binary())],
        ["owner", "block", "n", "names", "twice"])


def _answer(rows: pa.Table) -> pa.Table:
    """Sort an owner's names and tell each block which of its own occur more than once."""
    sizes = rows["n"].to_numpy()
    names = np.concatenate([np.frombuffer(b.as_py(), np.uint64) for b in rows["names"]])
    marked = np.concatenate([np.unpackbits(np.frombuffer(t.as_py(), np.uint8), count=n) for t, n in zip(rows["twice"], sizes)]).astype(bool)
    order = np.argsort(names)
    same = names[order[1:]] == names[order[:-1]]
    marked[order[1:][same]] = True
    marked[order[:-1][same]] = True
    # a name that is twice in one block and nowhere else is marked by that block itself
    parts = np.split(marked, np.cumsum(sizes)[:-1])
    return pa.table({"block": rows["block"], "owner": rows["owner"], "n": rows["n"],
                     "bitmap": pa.array([np.packbits(p).tobytes() for p in parts], pa.binary())})


def _marks(answers: pa.Table) -> np.ndarray:
    """Bitmaps of a block in owner order, which is the order of its sorted distinct names."""
    answers = answers.sort_by("owner")
    if not answers.num_rows:
        return np.zeros(0, bool)
    return np.concatenate([np.unpackbits(np.frombuffer(b.as_py(), np.uint8), count=n.as_py())
                           for b, n in zip(answers["bitmap"], answers["n"])]).astype(bool)


def _exchange(sent: DataFrame) -> DataFrame:
    return materialize(sent.groupBy("owner").applyInArrow(_answer, ANSWER), "suffix-answers")


# --- blocks -------------------------------------------------------------------------------------

def _blocks(batches):
    part, count = TaskContext.get().partitionId(), 0
    ids, sizes, data, held = [], [], [], 0

    def block():
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) + count], pa.int64()),
             pa.ListArray.from_arrays(pa.array([0, sum(map(len, ids))], pa.int32()), pa.concat_arrays(ids)),
             pa.array([sizes], pa.list_(pa.int64())), pa.array([_packed(data)], pa.binary())], ["block", "ids", "sizes", "data"])

    for batch in batches:
        texts, start = batch.column("text"), 0
        for i in range(batch.num_rows):
            raw = (texts[i].as_py() or "").encode("utf-8", "surrogatepass")
            if data and held + len(raw) > BLOCK_BYTES:
                ids.append(batch.column("id").slice(start, i - start))
                yield block()
                count, start = count + 1, i
                ids, sizes, data, held = [], [], [], 0
            sizes.append(len(raw))
            data.append(raw)
            held += len(raw)
        ids.append(batch.column("id").slice(start))
    if data:
        yield block()


def _send_samples(length: int, owners: int):
    def run(batches):
        cover = Cover(length)
        for batch in batches:
            for block in _each(batch):
                yield _send(block["block"], _concat([cover.names(d) for d in _split(block)]), owners, 0, owners)
    return run


def _open_suffixes(length: int, whole: bool):
    """Join a block with the answers on its sample: runs of open suffixes, and the texts that have any (``whole``: the others too)."""
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        cover = Cover(length)
        out = []
        for block in _each(blocks.drop(["ids"])):
            docs = _split(block)
            names = [cover.names(d) for d in docs]
            _, inverse = np.unique(_concat(names), return_inverse=True)
            repeated = np.split(_marks(answers)[inverse], np.cumsum([len(n) for n in names])[:-1]) if len(inverse) else [inverse.astype(bool)] * len(docs)
            runs = [cover.open_runs(len(d), r) for d, r in zip(docs, repeated)]
            out.append({"block": block["block"], "sizes": block["sizes"],
                        "runs": [[x for run in r for x in run] for r in runs],
                        "sha": [None if r else hashlib.sha256(d).hexdigest() for d, r in zip(docs, runs)],
                        "data": _packed([d.tobytes() for d, r in zip(docs, runs) if r]),
                        "rest": _packed([d.tobytes() for d, r in zip(docs, runs) if not r] if whole else []),
                        "open": sum(b - a for r in runs for a, b in r)})
        return pa.Table.from_arrays([blocks["ids"], *(pa.array([r[c] for r in out], t) for c, t in OPEN_ARROW)], ["ids", *(c for c, _ in OPEN_ARROW)])
    return run


OPEN_ARROW = [("block", pa.int64()), ("sizes", pa.list_(pa.int64())), ("runs", pa.list_(pa.list_(pa.int64()))),
              ("sha", pa.list_(pa.string())), ("data", pa.binary()), ("rest", pa.binary()), ("open", pa.int64())]
OPEN = [T.StructField("block", T.LongType()), T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("runs", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("sha", T.ArrayType(T.StringType())),
        T.StructField("data", T.BinaryType()), T.StructField("rest", T.BinaryType()), T.StructField("open", T.LongType())]


def _settled(whole: bool):
    """The documents of opened blocks that have no open suffix: nothing is removed."""
    def run(batches):
        for batch in batches:
            for i, row in enumerate(_each(batch.drop_columns(["ids"]))):
                ids, at, out = batch.column("ids").slice(i, 1).flatten(), 0, []
                rest = _unpacked(row["rest"], sum(n for n, runs in zip(row["sizes"], row["runs"]) if not runs)) if whole else b""
                for k, (size, runs, sha) in enumerate(zip(row["sizes"], row["runs"], row["sha"])):
                    if not runs:
                        out.append((k, size, sha, rest[at:at + size].decode() if whole else None))
                        at += size
                if out:
                    k, size, sha, text = zip(*out)
                    none = pa.array([0] * len(out), pa.int64())
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(k)), pa.array(size, pa.int64()), none, none, pa.array(sha, pa.string()),
                                                      pa.array(text, pa.string())], CUT)
    return run


CUT = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]


def _short_runs(data: np.ndarray, gone: np.ndarray, least_words: int) -> None:
    """Take runs of removed bytes with fewer words (between white space) back."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0])).astype(np.int8)))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if len(data[a:b].tobytes().split()) < least_words:
            gone[a:b] = False


def _open_texts(row: dict) -> list[tuple[np.ndarray | None, list[tuple[int, int]]]]:
    """(bytes, open runs) of a row's documents; settled ones have neither."""
    data = np.frombuffer(_unpacked(row["data"], sum(n for n, flat in zip(row["sizes"], row["runs"]) if flat)), np.uint8)
    at, out = 0, []
    for size, flat in zip(row["sizes"], row["runs"]):
        if flat:
            out.append((data[at:at + size], list(zip(flat[::2], flat[1::2]))))
            at += size
        else:
            out.append((None, []))
    return out


def _open_names(row: dict, length: int):
    """Names of the open suffixes of a row, run by run."""
    return (window_names(d[a:b + length - 1], length) for d, runs in _open_texts(row) for a, b in runs)


def _send_bucket(length: int, bucket: int, buckets: int, per_bucket: int):
    def run(batches):
        for batch in batches:
            for row in _each(batch):
                kept = [n[((n >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32) == bucket] for n in _open_names(row, length)]
                yield _send(row["block"], _concat(kept), buckets * per_bucket, bucket * per_bucket, (bucket + 1) * per_bucket)
    return run


def _cut(length: int, least_words: int, whole: bool):
    """Join a block with the answers of all buckets: each document that has open suffixes, without its repeated bytes."""
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        tables = []
        for i, row in enumerate(_each(blocks.drop(["ids"]))):
            names = list(_open_names(row, length))
            _, inverse = np.unique(_concat(names), return_inverse=True)
            repeated = iter(np.split(_marks(answers)[inverse], np.cumsum([len(n) for n in names])[:-1]) if names else [])
            out = []
            for k, (data, runs) in enumerate(_open_texts(row)):
                if data is None:
                    continue
                cover = np.zeros(len(data) + 1, np.int64)
                for a, _ in runs:
                    starts = np.flatnonzero(next(repeated)) + a
                    np.add.at(cover, starts, 1)
                    np.add.at(cover, starts + length, -1)
                gone = np.cumsum(cover[:-1]) > 0
                if least_words:
                    _short_runs(data, gone, least_words)
                left, removed = data[~gone].tobytes(), int(gone.sum())
                out.append((k, len(data), removed, int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)), hashlib.sha256(left).hexdigest(),
                            left.decode("utf-8", "ignore") if removed or whole else None))
            k, *columns = zip(*out) if out else [[]] * 6
            tables.append(pa.table([blocks["ids"].slice(i, 1).combine_chunks().flatten().take(pa.array(k, pa.int64())),
                                    *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())))], CUT))
        return pa.concat_tables(tables) if tables else None
    return run


def _nullable(kind: T.DataType) -> T.DataType:
    """An id's type as Arrow returns it: every field may be null."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind])
    return T.ArrayType(_nullable(kind.elementType)) if isinstance(kind, T.ArrayType) else kind


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 buckets: int = SUFFIX_BUCKETS, least_words: int = 0, whole: bool = False) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, kept_text.

    Every byte covered by a ``length``-byte string that also starts elsewhere, in the same or
    another document, is removed; strings are judged on the input.  With ``least_words`` only runs of
    removed bytes with so many words (between white space) go.  ``kept_text`` is null where the
    text stays as it is (with ``whole``: the text itself), else the remaining bytes as text, without those of a character that was
    cut through (the digest covers all of them).  A null text counts as empty, ids may be null, repeated or structs and come back unchanged, rows with equal long
    texts lose them all, an empty table gives no rows, and other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = _nullable(rows.schema["id"].dataType)
    ids = T.ArrayType(id_type)
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", ids),
                           T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("data", T.BinaryType())])
    blocks = materialize(rows.mapInArrow(_blocks, schema), "suffix-blocks")
    cover = Cover(length)
    total = blocks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0] or 0
    owners = max(16, -(-int(total * cover.inside.sum() / cover.v) // NAMES_PER_TASK))

    answers = _exchange(blocks.select("block", "sizes", "data").mapInArrow(_send_samples(length, owners), SENT))
    opened = materialize(blocks.groupBy("block").cogroup(answers.groupBy("block"))
                         .applyInArrow(_open_suffixes(length, whole), T.StructType([T.StructField("ids", ids), *OPEN])), "suffix-open")
    release(blocks, answers)
    left = opened.select(F.sum("open")).first()[0] or 0
    per_bucket = max(16, -(-left // (buckets * NAMES_PER_TASK)))
    sorted_buckets = [_exchange(opened.where("open > 0").select("block", "sizes", "runs", "data")
                                .mapInArrow(_send_bucket(length, b, buckets, per_bucket), SENT)) for b in range(buckets)]
    answers = sorted_buckets[0]
    for more in sorted_buckets[1:]:
        answers = answers.union(more)
    result = T.StructType([T.StructField("id", id_type), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()), T.StructField("kept_text", T.StringType())])
    cut = (opened.where("open > 0").select("block", "ids", "sizes", "runs", "data").groupBy("block")
           .cogroup(answers.groupBy("block")).applyInArrow(_cut(length, least_words, whole), result))
    return cut.union(opened.select("ids", "sizes", "runs", "sha", "rest").mapInArrow(_settled(whole), result))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 400-byte strings removed from every row of ``documents``; ``kept_text`` is what is left of each."""
    return suffix_dedup(table(spark, sf_dir, "documents"), whole=True).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")
