"""Exact dedup and SimHash near-dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from forgeline.llm import exact_dedup, simhash
from forgeline.llm.common import components

SCHEMA = "doc_id long, text string, h string, row string, norm string, part int, src string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "x", None, "y", 1, None) for i, t in rows], SCHEMA).repartition(parts)


def test_rice_code_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000):
        v = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        k, unary, rest = exact_dedup.rice_encode(v)
        assert (exact_dedup.rice_decode(len(v), k, unary, rest) == v).all()
    v = np.array([0, 1, 2, 2**64 - 1], np.uint64)
    assert (exact_dedup.rice_decode(4, *exact_dedup.rice_encode(v)) == v).all()


def test_exact_dedup(spark):
    rows = [(5, "a b"), (3, "ab"), (7, "a\tb\n"), (9, "a  b"), (2, None), (4, ""), (6, " \x0b"), (8, "a b"), (10, "x" * 100_000),
            (11, "x" * 50_000 + " " + "x" * 50_000), (12, "only"), (13, "same"), (13, "same"), (None, "same"), (None, "null id"), (14, "A b")]
    got = exact_dedup.exact_dedup(frame(spark, rows)).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0, i))
    want = sorted(((i, min(groups[norm(t)])[3], len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows), key=str)
    assert sorted(((r.src.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    assert sum(r.kept for r in got) == len(groups)                        # one row of each group, repeats included
    assert all(r.kept is False or r.src.doc_id == r.keep_id for r in got)
    assert exact_dedup.exact_dedup(frame(spark, rows).limit(0)).count() == 0


def test_hot_group_of_copies(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'copy', concat('t', id)) AS text")
    out = exact_dedup.exact_dedup(docs.repartition(5))
    assert out.where("kept").count() == 4001 and out.where("group_size = 2000 AND keep_id = 0").count() == 2000


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def test_fingerprint():
    for t in [None, "", " \n", "One", "One two", "a b c", "É é A B c d e f", " ".join(map(str, range(2000))), "x " * 700]:
        assert simhash.fingerprint(t) == slow_fingerprint(t)


def test_golay_code_is_perfect_and_keys_meet():
    dec = simhash.golay_decoder()
    counts = np.bincount(dec, minlength=4096)
    assert len(dec) == 1 << 23 and (counts == 2048).all()                # every word within 3 bits of one codeword
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 300)
    def keys(w):
        return set(simhash.golay_keys(np.array([w]))[1].tolist())
    assert all(keys(w) & keys(w ^ (1 << b)) for w in words for b in range(23))


def brute_components(prints):
    root = {p: p for p in prints}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ps = list(root)
    for i, a in enumerate(ps):
        for b in ps[:i]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= 2:
                root[find(a)] = find(b)
    return {p: find(p) for p in ps}


@pytest.mark.parametrize("limit", [32, 2])
def test_links_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "PAIRED_MEMBERS", limit)
    rnd = random.Random(2)
    prints = set()
    for _ in range(25):                                                   # chains and clouds of near fingerprints
        p = rnd.getrandbits(64)
        for _ in range(12):
            prints.add(p)
            q = p if rnd.random() < .5 else rnd.choice(list(prints))
            p = q
            for _ in range(rnd.choice([1, 2, 2, 3])):
                p ^= 1 << rnd.randrange(64)
    prints |= {0, 2**64 - 1, 2**63, 3, 1 << 62}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    edges = simhash.near_links(df)
    assert all(bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= 2 for r in edges.collect())
    want = {}
    for p, r in brute_components(signed).items():
        want.setdefault(r, set()).add(p)
    got = {}
    for r in components(edges).collect():
        got.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_simhash_dedup(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(4, base), (2, base), (9, base.replace("w399", "zz")), (7, None), (1, "\t"), (8, "Alone it is"), (8, "alone IT is"), (None, "alone it is"), (None, "other words")]
    got = simhash.simhash_dedup(frame(spark, rows)).collect()
    by = {}
    for r in got:
        by.setdefault((r.src.doc_id, r.src.text), []).append(r)
    assert by[(4, base)][0].component_id == 2 and by[(7, None)][0].component_id == 1
    assert by[(7, None)][0].fingerprint == "0" * 16
    assert by[(None, "alone it is")][0].component_id == 8 and by[(None, "other words")][0].component_id is None
    heads = {}
    for r in got:
        heads.setdefault((r.component_id, r.fingerprint if r.component_id is None else ""), []).append(r.kept)
    assert all(sum(k) == 1 for k in heads.values())
    assert all(r.fingerprint == f"{slow_fingerprint(r.src.text):016x}" for r in got)
    assert simhash.simhash_dedup(frame(spark, rows).limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    assert {r.root for r in components(edges).collect()} == {0}
