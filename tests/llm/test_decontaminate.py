"""Benchmark decontamination against a search for every window at every place."""

import random
import re

import pytest
from pyspark.sql import functions as F

from forgeline.llm import decontaminate as D

DOCS = "doc_id long, text string, row string, runs string, items string, n_words string, id string"
ITEMS = "item_id long, text string, item string, shard string"


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items, window=10):
    words, hit, found = words_of(text), set(), set()
    for item, t in items:
        w = words_of(t)
        n = min(window, len(w))
        for at in range(len(w) - n + 1 if n else 0):
            for i in range(len(words) - n + 1):
                if words[i:i + n] == w[at:at + n]:
                    hit.update(range(i, i + n))
                    if item is not None:
                        found.add(str(item))
    return len(words), len(hit), sorted(found)


def sample():
    rnd = random.Random(5)
    text = lambda n: " ".join(rnd.choice("ab cd é of the x1".split()) for _ in range(n))
    items = [(1, text(30)), (2, text(10)), (3, text(9)), (4, "Ab, CD."), (5, None), (6, " .. "), (7, "zebra"), (8, text(40)), (3, text(25)),
             (None, text(12)), (10, text(10)), (9, text(12)), (20, "É only É"), (21, "é only é"), (22, text(12))]
    items.append((11, items[0][1]))
    docs = [(i, text(rnd.randint(0, 60))) for i in range(20)]
    docs += [(30 + k, text(5) + " " + t.upper().replace("É", "é").replace(" ", "\n- ") + "! " + text(5)) for k, (_, t) in enumerate(items) if t]
    docs += [(50, None), (51, ""), (52, "zebra zebra, Zebra"), (52, "zebra zebra, Zebra"), (None, items[0][1]), (53, items[0][1] + " " + items[0][1]),
             (54, " ".join(f"w{i}" for i in range(50_000)) + " " + items[7][1]), (55, "the é only é"), (56, items[9][1])]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, "r", "s", None, "n", "z") for i, t in docs], DOCS).repartition(3),
            spark.createDataFrame([(i, t, "x", "s") for i, t in items], ITEMS).repartition(2))


@pytest.mark.parametrize("shard_bytes", [D.SHARD_BYTES, 300])
def test_equal_to_brute_force(spark, shard_bytes):
    docs, items = sample()
    got = D.decontaminate(*frames(spark, docs, items), shard_bytes=shard_bytes).collect()
    assert sorted(((r.id, r.n_words, sum(x.end - x.start for x in r["runs"]), r["items"]) for r in got), key=str) == \
        sorted(((i, *brute(t, items)) for i, t in docs), key=str)
    for r in got:                                                # runs are apart and in order
        ends = [x for run in r["runs"] for x in run]
        assert ends == sorted(set(ends))


def test_pieces_of_long_items_overlap(spark, monkeypatch):
    monkeypatch.setattr(D, "PIECE_WORDS", 7)
    rnd = random.Random(6)
    long = " ".join(f"v{rnd.randint(0, 9)}" for _ in range(200))
    docs = [(i, " ".join(long.split()[i:i + 14])) for i in range(0, 190, 3)]
    got = {r.id: sum(x.end - x.start for x in r["runs"]) for r in D.decontaminate(*frames(spark, docs, [(1, long)])).collect()}
    assert got == {i: brute(t, [(1, long)])[1] for i, t in docs}


def test_other_windows_ids_and_empty_tables(spark):
    docs, items = frames(spark, *sample())
    assert D.decontaminate(docs.limit(0), items).count() == 0
    none = D.decontaminate(docs, items.limit(0))
    assert none.where("size(items) > 0 OR size(runs) > 0").count() == 0 and none.count() == docs.count()
    got = D.decontaminate(docs.withColumn("doc_id", F.col("doc_id").cast("string")), items.withColumn("item_id", F.concat(F.lit("i"), "item_id")), window=3)
    want = sorted(((None if i is None else str(i), *brute(t, [(None if k is None else f"i{k}", u) for k, u in sample()[1]], 3)) for i, t in sample()[0]), key=str)
    assert sorted(((r.id, r.n_words, sum(x.end - x.start for x in r["runs"]), r["items"]) for r in got.collect()), key=str) == want


def test_shifts_skip_and_find_all():
    t = D.tables_of([(1, b"a b c d e f g h i j k"), (2, b"one two")], 10)
    assert [x.length for x in t] == [2, 10] and t[1].shift[(b"j", b"k")] == 0 and t[1].shift[(b"a", b"b")] == 8
    assert list(t[1].search(D.words_of(b"zz a b c d e f g h i j k"))) == [(1, 1), (2, 1)]
