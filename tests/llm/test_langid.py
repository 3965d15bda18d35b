"""Language ID: held-out accuracy, rejection and edge cases."""

from forgeline.llm import langid
from forgeline.llm.common import table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = langid.op7_language_id(spark, SF)
    docs = table(spark, SF, "documents").selectExpr("doc_id", "lang")
    row = (out.where("held_out").join(docs, "doc_id")
           .selectExpr("avg(cast(lang_pred = lang as int)) AS right", "avg(cast(rejected as int)) AS rejected", "count(*) AS n",
                       "min(score) AS low", "max(score) AS high").first())
    assert row.n > 100 and row.right > 0.97 and row.rejected < 0.01 and 0 <= row.low <= row.high <= 1


def test_edge_cases(spark):
    docs = spark.createDataFrame([(i, f"the house and the garden number {i}", "en", "x") for i in range(40)]
                                 + [(100 + i, f"das Haus und der Garten Nummer {i}", "de", "x") for i in range(40)]
                                 + [(200, None, "en", None), (201, "", None, None), (202, "12 %% 7", "de", None), (203, "garten", None, "s"),
                                    (None, "garden", None, None), (203, "garten", None, "s"), (204, "das " * 300_000, None, "s")],
                                 "doc_id long, text string, lang string, row string")
    model = langid.fit(docs)
    rows = [r for r in langid.predict(docs, model).collect()]
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert all((by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True) for i in (200, 201, 202))
    assert by[203].lang_pred == "de" and by[204].lang_pred == "de" and by[None].lang_pred == "en"
    assert langid.predict(docs.limit(0), model).count() == 0
    nothing = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}


def test_same_words_same_result_whatever_the_batch():
    model = langid.train([("en", ["the", "and", "house"]), ("de", ["das", "und", "haus"])] * 20)
    assert model.languages == ["de", "en"] and 0 <= model.threshold <= langid.SURE


def test_every_label_is_learnt(spark):
    names = [f"l{i:03d}" for i in range(230)]
    docs = spark.createDataFrame([(i * 10 + j, f"{n}a {n}b word".replace("0", "o").replace("1", "i").replace("2", "z"), n)
                                  for i, n in enumerate(names) for j in range(2 if i % 3 else 1)], "doc_id long, text string, lang string")
    assert langid.fit(docs).languages == names


def test_a_rare_label_is_trained_on():
    model = langid.train([("en", ["the", "and", "house"])] * 40 + [("de", ["das", "und", "haus"])] * 40 + [("xx", ["qqqq", "zzzz"])])
    scores = langid.WordScores(model).total("qqqq zzzz")
    assert model.languages[scores[:3].argmax()] == "xx"


def test_long_runs_teach_all_their_parts():
    import pyarrow as pa
    run = "".join(chr(0x4E00 + i) for i in range(64 * 50))
    batch = pa.RecordBatch.from_arrays([pa.array(["zh"]), pa.array([run])], ["lang", "text"])
    words = next(iter(langid._sample_words([batch]))).column("words")[0].as_py()
    assert "".join(words) == run
