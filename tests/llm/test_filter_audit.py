"""The filter audit against a brute-force count of every order and step."""

import re
from itertools import permutations

import numpy as np

from forgeline.llm import filter_audit as A

DOCS = "doc_id long, text string, source string, part string, bits string, good string, n string"
LABELS = "doc_id long, quality int, toxic int, salt string"


def verdicts(rows):
    for i, t, _ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        earlier = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)
        yield {f for f, bad in zip("ABCDE", (len(words) < 200, 100 * len(set(words)) < 50 * len(words),
                                             100 * len(re.findall("[A-Z]", t)) > 2 * len(t), re.search("[#$%&*|]", t), earlier)) if bad}


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    marked = [(s or "", i, fails) for (i, _, s), fails in zip(rows, verdicts(rows))]
    out = {}
    for part in {p for p, _, _ in marked}:
        mine = [(i, f) for p, i, f in marked if p == part]
        lost = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for step, f in enumerate(order):
                before = set(order[:step])
                here = [i for i, fails in mine if f in fails and not fails & before]
                lost[f] += len(here)
                out[part, "".join(order), step + 1] = [
                    sum(not fails & (before | {f}) for _, fails in mine), len(here), sum(f in fails and bool(fails & before) for _, fails in mine),
                    sum(fails == {f} for _, fails in mine), sum(i in good for i in here), sum(i in toxic for i in here)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(lost[order[step - 1]])
    return out


def sample():
    many = " ".join(f"w{i}" for i in range(250))
    rows = [(1, many, "a"), (2, many, "a"), (3, many, None), (4, many + " $", "b"), (5, None, "b"), (6, "", "a"), (7, " \t\n", "a"),
            (8, "x " * 300, "a"), (9, "ABC " * 300, "b"), (10, "A short # text", ""), (2, many, "a"), (1, many, "a"), (None, many, "a"),
            (None, "nobody", None), (11, "É é \x0b" * 120, "b"), (12, many.replace("w", "W"), "b"), (13, many.upper(), "b"), (None, None, None),
            (14, " ".join(f"v{i}" for i in range(60_000)), "a"), (0, "x " * 300, "c")]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, None, None), (5, 1, 1), (9, 0, 1), (None, 1, 1), (99, 1, 1), (10, 1, 0), (10, 1, 0), (8, 1, 1)]
    return rows, labels


def frames(spark, rows, labels):
    return (spark.createDataFrame([(i, t, s, "x", "y", "z", None) for i, t, s in rows], DOCS).repartition(3),
            spark.createDataFrame([(*r, "s") for r in labels], LABELS))


def test_equal_to_brute_force(spark):
    rows, labels = sample()
    got = A.filter_audit(*frames(spark, rows, labels)).collect()
    want = brute(rows, labels)
    assert len(got) == len(want) == 4 * 600
    assert {(r.part, r.filter_order, r.step): [r[m] for m in A.MEASURES] for r in got} == want


def test_empty_tables(spark):
    docs, labels = frames(spark, *sample())
    assert A.filter_audit(docs.limit(0), labels).count() == 0
    none = {(r.part, r.good_lost, r.toxic_lost) for r in A.filter_audit(docs, labels.limit(0)).collect()}
    assert none == {(p, 0, 0) for p in ("", "a", "b", "c")}


def test_hot_copies_and_hot_null_ids(spark):
    docs = spark.range(9000).selectExpr("CASE WHEN id % 3 = 1 THEN NULL ELSE id END AS doc_id",
                                        "if(id % 3 = 0, 'copy', concat('t', id)) AS text", "concat('s', id % 2) AS source").repartition(7)
    out = A.filter_audit(docs, spark.createDataFrame([(0, 1, 0, "s")], LABELS)).where("filter_order = 'EABCD' AND step = 1").collect()
    assert {(r.part, r.removed, r.kept, r.good_lost) for r in out} == {("s0", 1499, 3001, 0), ("s1", 1500, 3000, 0)}


def test_contraction_of_fewer_filters():
    rng = np.random.default_rng(0)
    tensor = rng.integers(0, 9, (3, 2, 2))
    out = A.measures(tensor, "AB")
    rows = A.selectors("AB")[0]
    assert rows == [("AB", 1), ("AB", 2), ("BA", 1), ("BA", 2)]
    t = tensor[0]
    assert out["removed"].tolist() == [t[1].sum(), t[0, 1], t[:, 1].sum(), t[1, 0]]
    assert out["kept"].tolist() == [t[0].sum(), t[0, 0], t[:, 0].sum(), t[0, 0]]
    assert out["redundant"].tolist() == [0, t[1, 1], 0, t[1, 1]] and out["unique_fails"].tolist() == [t[1, 0], t[0, 1], t[0, 1], t[1, 0]]
    assert out["shapley"].tolist() == [t[1].sum() + t[1, 0], t[0, 1] + t[:, 1].sum()] * 1 + [t[0, 1] + t[:, 1].sum(), t[1].sum() + t[1, 0]]
