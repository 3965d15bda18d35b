"""The corpus pipeline, stage by stage, against brute force."""

import itertools
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from forgeline.llm.langid import fit, held_out, predict
from tests.llm.test_dedup import brute_components, slow_fingerprint

WORDS = "the of and to in is that with from for house garden water stone river winter under over again"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    import random
    rnd = random.Random(3)
    text = lambda n: " ".join(rnd.choice(WORDS.split()) + rnd.choice("abcdefgh") for _ in range(n))
    passage = text(120)
    rows = [(i, text(rnd.randint(1, 300)), "en", "s", 0) for i in range(60)]
    rows += [(100 + i, text(50) + passage + text(50), "en", None, None) for i in range(4)]
    long = text(900)
    rows += [(200, long, "en", "s", 1), (201, long + " ", None, "s", 1), (202, long.replace(" ", "\n"), "en", "s", 1), (203, long + " end", "en", "s", 1)]
    rows += [(300, None, "en", "s", None), (301, "", None, None, 0), (302, "12 ?? 7", "en", "s", 1), (303, "same text here", "en", "s", 1), (303, "same text here", "en", "s", 1), (None, "no id at all", None, None, None)]
    base = str(tmp_path_factory.mktemp("pipe"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    path = os.path.join(base, "documents.parquet")
    docs.write.parquet(path)
    out = [spark.read.parquet(path)]
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, out[-1], base).write.parquet(os.path.join(base, str(k)))
        out.append(spark.read.parquet(os.path.join(base, str(k))))
    return base, [[tuple(r) for r in d.collect()] for d in out], [d.columns for d in out]


def test_columns(stages):
    assert all(c == ["doc_id", "text", "lang", "source", "n_chars"] for c in stages[2][:-1])
    assert [n for n, _ in P.STAGES] == ["language_id", "exact_dedup", "simhash_dedup", "suffix_dedup", "packing"]


def test_language_stage_keeps_text_in_a_language(spark, stages):
    before, after = stages[1][0], stages[1][1]
    gone = {r[0] for r in before} - {r[0] for r in after}
    assert gone == {300, 301, 302} and len(after) == len(before) - 3


def test_exact_stage(stages):
    before, after = stages[1][1], stages[1][2]
    norm = lambda t: "".join(c for c in t if c not in " \t\n\x0b\x0c\r")
    groups = {}
    for r in before:
        groups.setdefault(norm(r[1]), []).append((-len(r[1]), r[0] is None, r[0] or 0))
    assert len(after) == len(groups) and sorted(map(str, (min(g)[2] for g in groups.values()))) == sorted(str(r[0] or 0) for r in after)


def test_simhash_stage(stages):
    before, after = stages[1][2], stages[1][3]
    prints = {slow_fingerprint(r[1]) for r in before}
    assert len(after) == len(set(brute_components(sorted(prints)).values()))
    assert set(after) <= set(before)


def without_passages(texts, length=P.PASSAGE_BYTES, least_words=P.PASSAGE_WORDS):
    """Each text without the runs of bytes, covered by repeated strings, that hold so many words."""
    raw = [t.encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r) + 1)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        at, left = 0, b""
        for flag, run in itertools.groupby(gone[:-1]):
            n = len(list(run))
            if not flag or len(r[at:at + n].split()) < least_words:
                left += r[at:at + n]
            at += n
        out.append(left.decode("utf-8", "ignore"))
    return out


def test_suffix_stage(stages):
    before, after = stages[1][3], {r[0]: r for r in stages[1][4]}
    assert len(after) == len(before) == len(stages[1][4])
    for r, kept in zip(before, without_passages([r[1] for r in before])):
        assert after[r[0]][1] == kept
        assert after[r[0]][4] == (r[4] if kept == r[1] else len(kept)) and after[r[0]][2:4] == r[2:4]
    assert any(after[100 + i][1] != r[1] for i in range(4) for r in before if r[0] == 100 + i)


def test_suffix_stage_cuts_planted_passages_and_leaves_clean_texts(spark, tmp_path):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrst") for _ in range(rnd.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(n) for n in range(51, 61)]
    lines = [text(20) for _ in range(5)]                         # repeated, but not over 50 words
    rows = [(i, text(rnd.randint(30, 90)) + " " + passages[i % 10] + " " + text(20), "en", "s", 1) for i in range(60)]
    rows += [(100 + i, text(rnd.randint(1, 200)) + "\n" + lines[i % 5] + "\n" + text(9), "en", "s", 7) for i in range(60)]
    rows += [(300, None, None, None, None), (301, "", "en", None, 0), (302, "x " * 400, "en", "s", 800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    after = {r.doc_id: r for r in dict(P.STAGES)["suffix_dedup"](spark, docs, str(tmp_path)).collect()}
    assert len(after) == len(rows)
    caught = [passages[i % 10][5:-5] not in after[i].text for i in range(60)]
    assert all(caught) and all(len(after[i].text.split()) >= 49 for i in range(60))
    assert all(tuple(after[r[0]]) == r for r in rows if 100 <= r[0] <= 301)
    assert after[302].text.strip() == "" and after[302].n_chars == len(after[302].text)


def test_packing_stage(stages):
    before, pieces = stages[1][4], stages[1][5]
    assert {p[0] for p in pieces} == {r[0] for r in before}
    by = {}
    for p in pieces:
        by.setdefault(p[0], []).append(p)
    assert all(sum(p[2] for p in g) == g[0][4] for g in by.values())


def test_run_and_empty_table(spark, stages, tmp_path):
    assert P.run(spark, stages[0]).count() == len(stages[1][5])
    spark.read.parquet(stages[0] + "/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_stage_on_all_columns_null(spark, tmp_path):
    docs = spark.createDataFrame([(None, None, None, None, None)] * 3, "doc_id long, text string, lang string, source string, n_chars long")
    assert predict(docs.withColumn("x", F.lit(1)), fit(docs.where(~held_out()))).where("rejected").count() == 3
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / str(k)))
        assert spark.read.parquet(str(tmp_path / str(k))).count() == (0 if k == 0 else 1 if k in (1, 2) else 3)
