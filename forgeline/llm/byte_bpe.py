"""Byte-level BPE encoding and decoding with a two-tier lookup.

A minimal perfect hash over the vocabulary resolves pre-tokens that are tokens as they
stand; the others are merged with a heap over their linked bytes.  Results are
remembered, within a bound, for the pre-tokens that come again.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import re
from functools import lru_cache
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline.llm.common import table
from forgeline.llm.word_tokens import slices

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CACHED_WORDS = 900_000        # pre-tokens a worker remembers (some 300 MB); beyond it only those of the texts at hand stay
CACHED_CHARS = 64             # longer ones are encoded each time
_UNEVEN = re.compile(r"(?:^|\s) | (?:\s|$)")     # a space that is not between two other characters
_EVEN_SPACE = re.compile(r"(?<=\S) (?=\S)")
SLOTS_PER_KEY = 2             # of a level of the perfect hash
_MASK = (1 << 64) - 1


class PerfectHash:
    """Minimal perfect hash of byte strings to their ids, by levels.

    A level has ``SLOTS_PER_KEY`` slots for each key that is left.  Keys that have a slot to themselves take it, the
    others go on to the next level.  A taken slot holds the key's place among all keys, so the places are
    0 .. n-1, and a lookup is one hash, one or two slots and one comparison.
    """

    def __init__(self, ids: dict[bytes, int]):
        hashes = np.array([xxhash.xxh64_intdigest(key) for key in ids], np.uint64)
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two tokens share a 64-bit hash")
        left, order = np.arange(len(hashes)), []
        self.levels: list[tuple[int, int, list[int]]] = []      # (factor, number of slots, place of the key of each slot or -1)
        while len(left):
            factor, size = 2 * len(self.levels) * 0x9E3779B97F4A7C15 % (1 << 64) | 1, SLOTS_PER_KEY * len(left) + 1
            with np.errstate(over="ignore"):
                slot = ((hashes[left] * np.uint64(factor)) >> np.uint64(32)) % np.uint64(size)
            alone = np.bincount(slot.astype(np.int64), minlength=size)[slot.astype(np.int64)] == 1
            places = np.full(size, -1)
            places[slot[alone].astype(np.int64)] = np.arange(len(order), len(order) + int(alone.sum()))
            order += left[alone].tolist()
            self.levels.append((factor, size, places.tolist()))
            left = left[~alone]
        keys, values = list(ids), list(ids.values())
        self.keys, self.ids = [keys[i] for i in order], [values[i] for i in order]

    def get(self, key: bytes) -> int | None:
        h = xxhash.xxh64_intdigest(key)
        for factor, size, places in self.levels:
            place = places[((h * factor & _MASK) >> 32) % size]
            if place >= 0:
                return self.ids[place] if self.keys[place] == key else None
        return None


def byte_pairs(ranks: dict[bytes, int]) -> list[int]:
    """Rank of every two bytes (first * 256 + second), -1 for none."""
    return [ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]


def merge_bytes(piece: bytes, ranks: dict[bytes, int], pairs: list[int] | None = None) -> list[int]:
    """Ids of a pre-token: the lowest-ranked neighbouring pair merges first, leftmost on ties.

    The heap holds (rank, start, end) of pairs as one number each.  A pair is out of date if no part starts
    there any more or the two parts at its start end elsewhere.
    """
    pairs = pairs or byte_pairs(ranks)
    n, rank = len(piece), ranks.get
    wide = n.bit_length()
    low, two = (1 << wide) - 1, 2 * wide
    end = list(range(1, n + 1))                   # end[i]: where the part that starts at i ends, 0 if none does
    before = list(range(-1, n - 1))               # start of the part before the one at i
    heap = [r << two | i << wide | i + 2 for i, (a, b) in enumerate(zip(piece, piece[1:])) if (r := pairs[a << 8 | b]) >= 0]
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        top = pop(heap)
        i, stop = top >> wide & low, top & low
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
            r = rank(piece[i:end[stop]])
            if r is not None:
                push(heap, r << two | i << wide | end[stop])
        i = before[i]
        if i >= 0:
            r = rank(piece[i:stop])
            if r is not None:
                push(heap, r << two | i << wide | stop)
    return [ranks[piece[i:stop]] for i, stop in enumerate(end) if stop]


class ByteBPE:
    """Encoder and decoder of a rank file; needs every single byte to be a token."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.hash = PerfectHash(self.ranks)
        self.pairs = byte_pairs(self.ranks)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            self.tokens[i] = token
        self.decimal = [str(i).encode() for i in range(len(self.tokens))]
        self.split = regex.compile(pattern).findall
        # (ids, their decimals joined by commas, decoded bytes) of pre-tokens
        self.words: dict[str, tuple[list[int], bytes, bytes]] = {}

    def pretoken(self, word: str) -> tuple[list[int], bytes, bytes]:
        piece = word.encode()
        whole = self.hash.get(piece)
        ids = [whole] if whole is not None else merge_bytes(piece, self.ranks, self.pairs)
        return ids, b",".join(map(self.decimal.__getitem__, ids)), self.decode(ids)

    def _pretokens(self, text: str) -> list[str]:
        """The matches of the pattern.

        A single space between two other characters always starts a match, so a text is cut there; a space
        and letters are one match as they stand, and only the other chunks go through the pattern.
        """
        chunks = _EVEN_SPACE.split(text) if _UNEVEN.search(text) else text.split(" ")
        out = self.split(chunks[0])
        add, more, split = out.append, out.extend, self.split
        for c in chunks[1:]:
            if c.isalpha():
                add(" " + c)
            else:
                more(split(" " + c))
        return out

    def encode_texts(self, texts: list[str | None]) -> list[list[tuple[list[int], bytes, bytes]]]:
        """The pre-tokens of each text in a row, each as its ids, decimals and decoded bytes."""
        split = [self._pretokens(t) if t else [] for t in texts]
        here = set().union(*split)
        unseen = here.difference(self.words)
        if len(self.words) + len(unseen) > CACHED_WORDS:
            self.words = {w: self.words[w] for w in here.difference(unseen)}
        for w in unseen:
            self.words[w] = self.pretoken(w)
        of = self.words.__getitem__
        out = [list(map(of, words)) for words in split]
        for w in unseen:
            if len(w) > CACHED_CHARS:
                del self.words[w]
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        return list(itertools.chain.from_iterable(map(itemgetter(0), self.encode_texts([text])[0])))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def byte_bpe(path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> ByteBPE:
    """The tokenizer of this worker process."""
    return ByteBPE(path, pattern)


def _round_trip(path: str, pattern: str):
    def run(batches):
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            done = 0
            for texts in slices(batch.column("text")):
                n, ids_sha, decoded_sha = [], [], []
                for words in bpe.encode_texts(texts):
                    n.append(sum(map(len, map(itemgetter(0), words))))
                    ids_sha.append(hashlib.sha256(b",".join(map(itemgetter(1), words))).hexdigest())
                    decoded_sha.append(hashlib.sha256(b"".join(map(itemgetter(2), words))).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(done, len(texts)), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                     pa.array(decoded_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                done += len(texts)
    return run


def _encode(path: str, pattern: str):
    def run(batches):
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            ids = pa.array([bpe.encode(t.as_py() or "") for t in batch.column("text")], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])
    return run


def _decode(path: str, pattern: str):
    def run(batches):
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            data = pa.array([bpe.decode(i.as_py() or []) for i in batch.column("ids")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), data], ["doc_id", "data"])
    return run


def _with_id(df: DataFrame, *rest: T.StructField) -> T.StructType:
    return T.StructType([T.StructField("doc_id", df.schema["doc_id"].dataType), *rest])


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS,
                     pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id and ids of each row; a null or empty text has none, other columns are not read."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_encode(ranks, pattern), _with_id(rows, T.StructField("ids", T.ArrayType(T.IntegerType()))))


def decode_documents(encoded: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id and the decoded bytes ``data`` of each row of ids; null ids give no bytes."""
    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(_decode(ranks, pattern), _with_id(rows, T.StructField("data", T.BinaryType())))


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS,
               pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    A null text counts as empty: no tokens and the digests of no bytes.  Null and repeated
    ids stay as they are, an empty table gives no rows, other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = _with_id(rows, T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                      T.StructField("decoded_sha256", T.StringType()))
    return rows.mapInArrow(_round_trip(ranks, pattern), schema)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding and decoding digests of every row of ``documents``."""
    return round_trip(table(spark, sf_dir, "documents"))
