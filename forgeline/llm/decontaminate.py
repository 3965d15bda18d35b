"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of the benchmark items.  A symbol is a word and a block is two of
them.  The shift table says how far the search may move on when a block stands at its end
(blocks of no pattern: by the pattern's length less one); a shift of zero leads to the bucket of
patterns with that suffix, which the hash of their first block thins out, and the words themselves
are compared.  Patterns of one length share their tables, so a short item does not shorten the shifts
of the others.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.llm.common import materialize, release, table

WINDOW_WORDS = 10
SHARD_BYTES = 2 * 1024 * 1024      # of item text, some 350,000 windows: a worker holds the tables of one shard, about 200 MB
PIECE_WORDS = 10_000               # longer items are cut into overlapping pieces of so many windows

# words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z are lowered: in UTF-8 the bytes 0-9, a-z and from 0x80 on
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

FOUND = "runs array<struct<start:bigint,end:bigint>>, items array<string>"
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class WuManber:
    """Tables of all patterns of one length: the windows of so many words that start in ``flat`` at ``starts``."""

    def __init__(self, length: int, flat: list[bytes], starts: list[int], items: list):
        self.length, self.flat, self.items = length, flat, items
        self.block = min(2, length)
        self.most = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, list[int]] = {}
        for which, start in enumerate(starts):
            words = tuple(flat[start:start + length])
            for at in range(self.most):                         # the block that starts at this word
                key, move = words[at:at + self.block], self.most - 1 - at
                if self.shift.get(key, self.most) > move:
                    self.shift[key] = move
            self.bucket.setdefault(words[-self.block:] + words[:self.block], []).append(which)
        self.starts = starts

    def search(self, words: list[bytes]):
        """(start, item) of every occurrence."""
        length, block, most, shift = self.length, self.block, self.most, self.shift.get
        end, n = length, len(words)
        while end <= n:
            suffix = (words[end - 2], words[end - 1]) if block == 2 else (words[end - 1],)
            move = shift(suffix, most)
            if move:
                end += move
                continue
            here = words[end - length:end]
            for which in self.bucket.get(suffix + tuple(here[:block]), ()):
                start = self.starts[which]
                if self.flat[start:start + length] == here:
                    yield end - length, self.items[which]
            end += 1


def tables_of(pieces: list[tuple], window: int) -> list[WuManber]:
    """Search tables of pieces (item, UTF-8 text); a piece of fewer than ``window`` words is one pattern."""
    same: dict[bytes, bytes] = {}                               # one object a word
    by_length: dict[int, tuple[list, list, list]] = {}
    for item, text in pieces:
        words = [same.setdefault(w, w) for w in words_of(text)]
        if not words:
            continue
        length = min(window, len(words))
        flat, starts, items = by_length.setdefault(length, ([], [], []))
        starts += range(len(flat), len(flat) + len(words) - length + 1)
        items += [item] * (len(words) - length + 1)
        flat += words
    return [WuManber(length, *of) for length, of in sorted(by_length.items())]


_tables: tuple[object, list[WuManber]] = (None, [])


def _load(shard: Broadcast, window: int) -> list[WuManber]:
    """The tables of a shard; a worker keeps those of the shard it works on."""
    global _tables
    name, pieces = shard.value
    if _tables[0] != (name, window):
        _tables = ((name, window), tables_of(pieces, window))
    return _tables[1]


def _cut_items(window: int):
    def cut(batches):
        for batch in batches:
            ids, texts = [], []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text or b"")
                for at in range(0, max(1, len(words) - window + 1) if words else 0, PIECE_WORDS):
                    ids.append(item)
                    texts.append(b" ".join(words[at:at + PIECE_WORDS + window - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column("item").type), pa.array(texts, pa.binary())], ["item", "piece"])
    return cut


def _scan(shard: Broadcast, window: int):
    """Rows (key columns, text) -> (key columns, n_words, covered runs of words, items found)."""
    def scan(batches):
        for batch in batches:
            tables = _load(shard, window)
            n, runs, found = [], [], []
            for text in batch.column("text"):
                words = words_of(text.as_py() or b"")
                spans, items = [], set()
                for t in tables:
                    for start, item in t.search(words):
                        spans.append((start, start + t.length))
                        if item is not None:
                            items.add(str(item))
                n.append(len(words))
                runs.append(joined(spans))
                found.append(sorted(items))
            keep = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(n, pa.int64()), pa.array(runs, RUNS), pa.array(found, pa.list_(pa.string()))],
                keep + ["n_words", "runs", "items"])
    return scan


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs that overlapping or touching (start, end) cover."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _merge(batches):
    """Lists of runs and items of one document, one of each shard -> its runs and distinct items."""
    for batch in batches:
        runs = [joined([(r["start"], r["end"]) for of_shard in doc for r in of_shard]) for doc in batch.column("runs").to_pylist()]
        items = [sorted({i for of_shard in doc for i in of_shard}) for doc in batch.column("items").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(runs, RUNS), pa.array(items, pa.list_(pa.string()))], ["row", "runs", "items"])


def shards_of(items: DataFrame, window: int, shard_bytes: int) -> list[Broadcast]:
    """The items, cut and dealt by hash into shards of about ``shard_bytes``, each broadcast by itself as (name, pieces)."""
    spark = items.sparkSession
    kind = items.schema["item"].dataType.simpleString()
    pieces = materialize(items.mapInArrow(_cut_items(window), f"item {kind}, piece binary").distinct(), "pieces")
    total = pieces.agg(F.sum(F.length("piece") + 16)).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("piece"), F.lit(shards)))
    out = [spark.sparkContext.broadcast((uuid.uuid4().hex, [(r["item"], bytes(r["piece"])) for r in dealt.where(F.col("shard") == s).collect()]))
           for s in range(shards)]
    release(pieces)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS, shard_bytes: int = SHARD_BYTES, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, runs (start and end of each covered run of words) and
    items (ids as text, distinct, sorted) whose windows occur in it.

    A window is ``window`` consecutive words of an item; an item of fewer words is one window and
    an item without words none.  Items are searched in shards of bounded size, each a broadcast of its own:
    one shard is one pass over the documents, with more of them every pass leaves a row for the
    documents it found something in.  Null texts have no words, repeated rows count each for
    itself, a null item id marks words but names no item, items that share an id are one item,
    ids of any type are kept, extra columns are not read, and empty tables give no rows or no hits.
    """
    spark = docs.sparkSession
    items = items.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("binary").alias("text"))
    shards = shards_of(items, window, shard_bytes)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = f"n_words long, {FOUND}"
    if len(shards) == 1:
        return rows.mapInArrow(_scan(shards[0], window), f"id {kind}, {found}")
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "decontaminate-rows")
    counted, hits = None, []
    for k, shard in enumerate(shards):
        passed = materialize(rows.select("id", "row", "text").mapInArrow(_scan(shard, window), f"id {kind}, row long, {found}")
                             .where(F.lit(k == 0) | (F.size("runs") > 0)), "decontaminate-pass")
        counted = passed if counted is None else counted
        hits.append(passed.where(F.size("runs") > 0).select("row", "runs", "items"))
        shard.unpersist()
    every = hits[0]
    for h in hits[1:]:
        every = every.unionByName(h)
    # a row a shard at most for each document
    merged = every.groupBy("row").agg(F.collect_list("runs").alias("runs"), F.collect_list("items").alias("items")) \
        .mapInArrow(_merge, f"row long, {FOUND}")
    return counted.select("id", "row", "n_words").join(merged, "row", "left").select("id", "n_words", *[
        F.coalesce(c, F.array().cast(merged.schema[c].dataType)).alias(c) for c in ("runs", "items")])


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all ``documents`` inside an occurrence of a window of ``benchmark``."""
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, run: n + run["end"] - run["start"])
    return out.select(F.col("id").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("runs") > 0).alias("contaminated"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, l, array_to_string(w[i : i + l - 1], ' ') AS words
  FROM (SELECT item_id, w, least(10, len(w)) AS l, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0) x),
lengths AS (SELECT DISTINCT l FROM windows),
places AS (SELECT row, l, i, array_to_string(w[i : i + l - 1], ' ') AS words
  FROM (SELECT row, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d JOIN lengths ON len(w) >= l) x),
hits AS (SELECT p.row, p.l, p.i, v.item_id FROM places p JOIN windows v ON p.l = v.l AND p.words = v.words),
covered AS (SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(i, i + l)) AS place FROM hits) x GROUP BY row),
found AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) x GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (row) LEFT JOIN found USING (row)
"""
