"""Suffix-array dedup against brute force on whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from forgeline.llm import suffix_dedup as S


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        left = np.frombuffer(r, np.uint8)[~gone].tobytes()
        spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore") if gone.any() else None))
    return out


def corpus(seed, n, length):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rnd.randint(length // 6, length))) for _ in range(6)]
    texts = []
    for _ in range(n):
        t = " ".join(rnd.choice(passages) if rnd.random() < .25 else word() for _ in range(rnd.randint(0, 60)))
        texts.append(t)
        if rnd.random() < .3:
            k = rnd.randrange(len(t) + 1)
            texts.append(t[:k] + rnd.choice(["", "x", "é"]) + t[k:])
    return texts + ["", None, "a" * (3 * length), "ab" * length, texts[0], "short"]


@pytest.mark.parametrize("length", [7, 20, 64, 400])
def test_difference_cover(length):
    v, members = S.difference_cover(length)
    assert {(int(a) - int(b)) % v for a in members for b in members} == set(range(v)) and v <= max(7, length // 2)


def test_window_names_are_local(monkeypatch):
    data = np.frombuffer(random.Random(0).randbytes(5000), np.uint8)
    names = S.window_names(data, 100)
    assert (S.window_names(data[777:], 100) == names[777:]).all() and len(set(names.tolist())) == 4901
    monkeypatch.setattr(S, "_RUN", 512)
    assert (S.window_names(data, 100) == names).all()


@pytest.mark.parametrize("length,block,names", [(20, 300, 50), (64, 1 << 20, 1 << 20), (400, 5000, 2000)])
def test_equals_brute_force(spark, monkeypatch, length, block, names):
    monkeypatch.setattr(S, "BLOCK_BYTES", block)
    monkeypatch.setattr(S, "NAMES_PER_TASK", names)
    texts = corpus(length, 25, length)
    df = spark.createDataFrame([(i, t, 1, "b", None) for i, t in enumerate(texts)], "doc_id long, text string, block int, data string, ids string")
    rows = sorted(S.suffix_dedup(df.repartition(3), length=length).collect(), key=lambda r: r.id)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.kept_text) for r in rows] == brute(texts, length)
    assert any(0 < r.n_removed < r.n_bytes for r in rows)
    whole = sorted(S.suffix_dedup(df.repartition(3), length=length, whole=True).collect(), key=lambda r: r.id)
    assert [(r.n_removed, r.kept_sha256, r.kept_text) for r in whole] == \
        [(b[1], b[3], (t or "") if b[4] is None else b[4]) for t, b in zip(texts, brute(texts, length))]


def test_empty_null_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "y" * 500), (1, "z" * 300 + "q" * 300), (1, "z" * 300 + "q" * 300), (2, None)], "doc_id long, text string")
    rows = {(r.id, r.n_bytes, r.n_removed, r.n_spans) for r in S.suffix_dedup(df).collect()}
    assert rows == {(None, 500, 500, 1), (1, 600, 600, 1), (2, 0, 0, 0)}
    assert S.suffix_dedup(df.limit(0)).count() == 0
    assert S.suffix_dedup(df.where("doc_id = 2")).count() == 1
