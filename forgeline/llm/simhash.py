"""SimHash near-dedup with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments.  Two fingerprints that differ in at
most two bits have, for one of the ordered segment pairs (1,2), (2,3), (3,1), no error in
the first segment and at most one in the second (pigeonhole).  The second segment, read
as a 23-bit word, is decoded by the perfect Golay code: the codeword indices nearest to
the word and to each word one bit away are its keys, and two segments at most one bit
apart share a key.  Fingerprints meet on (pair, first segment, key) and are verified.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.llm.common import components, materialize, release, table

SHINGLE_WORDS = 3
MAX_BITS = 2
# fixed values: generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1 of the (23,12) Golay code
GOLAY_POLYNOMIAL = 0b110001110101
# (shift, width) of the three segments of a fingerprint, lowest bits first
SEGMENTS = ((0, 21), (21, 21), (42, 22))
PAIRS = ((0, 1), (1, 2), (2, 0))
# a key shared by more fingerprints than this is split further by its members' one-bit balls
PAIRED_MEMBERS = 32

_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the word shingles, repeats included; 0 where there is no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: ASCII only, both times
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words_per_shingle, len(words))
    hashed = xxhash.xxh64_intdigest
    values = np.fromiter((hashed(joined[s:e], 42) for s, e in zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())),
                         np.uint64, len(words) - k + 1)
    ones = _bit_counts(values)
    return int(sum(1 << b for b in range(64) if 2 * int(ones[b]) > len(values)))


def _bit_counts(values: np.ndarray) -> np.ndarray:
    """How many values have each bit set: bytes of a word count up to 255 values at a time."""
    n = len(values)
    blocks = np.zeros((-(-n // 255), 255), np.uint64)
    blocks.ravel()[:n] = values
    out = np.empty(64, np.int64)
    for b in range(8):
        lanes = ((blocks >> np.uint64(b)) & _LANES).sum(axis=1, dtype=np.uint64)
        out[b::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out


def _fingerprints(batches):
    for batch in batches:
        texts = batch.column("text")
        prints = [fingerprint(t.as_py()) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(np.array(prints, np.uint64).view(np.int64))], ["row", "fp"])


@lru_cache(maxsize=1)
def golay_decoder() -> np.ndarray:
    """For each 23-bit word the 12-bit index of its nearest codeword (unique: the code is perfect)."""
    index = np.arange(4096, dtype=np.int64)
    rest = index << 11                                  # systematic: message bits, then the remainder
    for bit in range(22, 10, -1):
        rest ^= ((rest >> bit) & 1) * (GOLAY_POLYNOMIAL << (bit - 11))
    codewords = (index << 11) | rest
    one = np.concatenate(([0], 1 << np.arange(23)))
    errors = np.unique([a ^ b ^ c for i, a in enumerate(one) for j, b in enumerate(one[i:]) for c in one[i + j:]])
    errors = errors[np.array([bin(e).count("1") for e in errors.tolist()]) <= 3]
    out = np.empty(1 << 23, np.int16)
    for e in errors:
        out[codewords ^ e] = index
    return out


def golay_keys(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, key) pairs: the distinct codeword indices of each word and of its one-bit neighbours."""
    flips = np.concatenate(([0], 1 << np.arange(23))).astype(np.int64)
    keys = np.sort(golay_decoder()[segment[:, None] ^ flips[None, :]], axis=1)
    new = np.ones(keys.shape, bool)
    new[:, 1:] = keys[:, 1:] != keys[:, :-1]
    return np.nonzero(new)[0], keys[new]


def _keys(batches):
    for batch in batches:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        parts = [((fp >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in SEGMENTS]
        for t, (a, b) in enumerate(PAIRS):
            where, key = golay_keys(parts[b])
            bucket = (np.int64(t) << 34) | (parts[a][where] << 12) | key
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(fp[where].view(np.int64))], ["bucket", "fp"])


def near_links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints ``fp`` exactly as all links of <= 2 bits do.

    A key with up to PAIRED_MEMBERS members is paired and verified.  The members of a more
    common key take part once in the split by one-bit balls: two fingerprints are within two
    bits exactly if their balls (themselves and each one-bit change) meet, a ball point has
    at most 65 members, and its members are tied to the smallest of them; so a group of
    any size gives 65 rows a fingerprint and never all its pairs.
    """
    keys = materialize(prints.select("fp").mapInArrow(_keys, "bucket long, fp long"), "golay-keys")
    sizes = keys.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    met = keys.join(sizes, "bucket")
    paired = (met.where(F.col("members") <= PAIRED_MEMBERS)
              .groupBy("bucket").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
              .select(F.explode(F.expr(
                  "flatten(transform(fps, (x, i) -> transform(filter(slice(fps, i + 2, size(fps)), "
                  f"y -> bit_count(x ^ y) <= {MAX_BITS}), y -> struct(x AS a, y AS b))))")).alias("e"))
              .select("e.a", "e.b"))
    common = met.where(F.col("members") > PAIRED_MEMBERS).select("fp").distinct()
    balls = common.select("fp", F.explode(F.expr(
        "concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")).alias("point"))
    # every pair of a ball's members is within two bits, so this split needs no further check
    tied = (balls.groupBy("point").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1")
            .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b"))
    edges = materialize(paired.union(tied).distinct(), "simhash-links")
    release(keys)
    return edges


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: src (all its columns), fingerprint, component_id, kept.

    Words are the runs between the six ASCII white-space characters, A-Z lower-cased;
    a bit is set if over half of the shingles' XXH64 (seed 42) have it.  A text with fewer
    words than a shingle is one shingle; a null or empty one has fingerprint 0 and
    links like any other.  component_id is the smallest id reachable by links of at most
    two bits (null ids never name one; a component of null ids alone has null), and
    exactly one row of each component is kept: the first stored row of that id.
    """
    rows = materialize(docs.select(F.struct("*").alias("src"))
                       .select("src", F.monotonically_increasing_id().alias("row")), "simhash-rows")
    prints = materialize(
        rows.select("row", F.col(f"src.{text_col}").alias("text")).mapInArrow(_fingerprints, "row long, fp long"), "simhash-prints")
    prints = prints.join(rows.select("row", F.col(f"src.{id_col}").alias("id")), "row")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("first")
    distinct = materialize(prints.groupBy("fp").agg(first), "simhash-distinct")
    roots = components(near_links(distinct))
    named = (distinct.join(roots, distinct.fp == roots.node, "left")
             .select("fp", F.coalesce("root", "fp").alias("root"), "first"))
    heads = named.groupBy("root").agg(F.min("first").alias("head"))
    named = materialize(named.select("fp", "root").join(heads, "root").select("fp", "head"), "simhash-heads")
    out = prints.select("row", "fp").join(named, "fp")
    return (rows.join(out, "row")
            .select("src", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("head.id").alias("component_id"), (F.col("head.row") == F.col("row")).alias("kept")))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components over every row of ``documents``."""
    return simhash_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("src.doc_id").alias("doc_id"), "fingerprint", "component_id")
