"""Commits: two writers at once, crashes between data and manifest, replays."""

import datetime as dt
import threading

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from forgeline.operators.joins import upsert_prices
from forgeline.sources import commits, sinks
from forgeline.streaming import monitors as mon


def test_create_once(spark, tmp_path):
    path = str(tmp_path / "log" / "1.json")
    assert commits.create_once(spark, path, "first") and not commits.create_once(spark, path, "second")
    assert (tmp_path / "log" / "1.json").read_text() == "first"
    assert [p.name for p in (tmp_path / "log").iterdir() if p.suffix != ".crc"] == ["1.json"]


def test_rename_that_does_not_overwrite(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).write_text(name)
    a, b, c = (commits._path(spark, f"file:{tmp_path}/{n}") for n in "abc")
    with pytest.raises(Py4JJavaError) as e:
        commits._rename_once(spark, a, b)
    assert commits._is(e.value, "FileAlreadyExistsException") and (tmp_path / "b").read_text() == "b"
    commits._rename_once(spark, a, c)
    assert (tmp_path / "c").read_text() == "a" and not (tmp_path / "a").exists()


def test_two_writers_at_once_get_two_versions(spark, tmp_path, monkeypatch):
    base, cat = str(tmp_path / "d"), str(tmp_path / "c")
    meet = threading.Barrier(2, timeout=60)
    real, seen = commits.latest, []

    def latest(s, log):                                          # both have looked before either commits
        out = real(s, log)
        if len(seen) < 2:
            seen.append(out)
            meet.wait()
        return out
    monkeypatch.setattr(commits, "latest", latest)
    versions = []
    writers = [threading.Thread(target=lambda n=n: versions.append((sinks.write_version(spark.range(n).toDF("x"), base, cat, run_stats={"n": n}), n))) for n in (3, 5)]
    [w.start() for w in writers], [w.join() for w in writers]
    assert [s[0] for s in seen] == [0, 0] and sorted(v for v, _ in versions) == [1, 2]
    entries = {r.version: r.row_count for r in sinks.catalog_entries(spark, cat).collect()}
    assert entries == dict(versions)
    assert sinks.read_latest(spark, base, cat).count() == entries[2] and sinks.next_version(spark, cat) == 3


def test_crash_before_the_manifest_leaves_the_old_version(spark, tmp_path, monkeypatch):
    base, cat, copy = str(tmp_path / "d"), str(tmp_path / "c"), str(tmp_path / "copy")
    assert sinks.write_version(spark.range(3).toDF("x"), base, cat) == 1
    assert sinks.fan_out(spark.range(3).toDF("x"), [copy]) == {copy: True}
    archive = mon.price_archive(spark, str(tmp_path / "archive"))
    day = dt.date(2024, 1, 1)
    batch = spark.createDataFrame([(day, "AL6061", 2.0, "live", 1)], mon.PRICE_ARCHIVE_SCHEMA)
    assert archive.upsert(batch, upsert_prices) == 1

    def crash(*_):
        raise RuntimeError("power cut")
    with monkeypatch.context() as m:
        m.setattr(commits, "create_once", crash)
        with pytest.raises(RuntimeError):
            sinks.write_version(spark.range(9).toDF("x"), base, cat)
        assert sinks.fan_out(spark.range(9).toDF("x"), [copy]) == {copy: False}
        with pytest.raises(RuntimeError):
            archive.upsert(batch.withColumn("price_usd_per_kg", F.lit(9.0)), upsert_prices)
    assert sinks.read_latest(spark, base, cat).count() == 3 and sinks.read_catalog(spark, cat).count() == 1
    assert commits.read_published(spark, copy).count() == 3
    assert [r.price_usd_per_kg for r in archive.read().collect()] == [2.0]
    assert sinks.write_version(spark.range(4).toDF("x"), base, cat) == 2 and sinks.read_latest(spark, base, cat).first().version == 2
    assert sinks.fan_out(spark.range(4).toDF("x"), [copy]) == {copy: True} and commits.read_published(spark, copy).count() == 4
    assert commits.read_published(spark, copy, 1).count() == 3
    with pytest.raises(FileNotFoundError):
        commits.read_published(spark, str(tmp_path / "nothing"))


def test_upserts_replace_partitions_and_merge_with_other_writers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "archive")
    rows = lambda *r: spark.createDataFrame([(dt.date(2024, 1, d), m, p, "live", 1) for d, m, p in r], mon.PRICE_ARCHIVE_SCHEMA)
    table = mon.price_archive(spark, path)
    assert table.read().count() == 0 and table.upsert(rows(), upsert_prices) is None
    assert table.upsert(rows((1, "A", 1.0), (2, "A", 2.0), (3, "A", 3.0)), upsert_prices, "b1") == 1
    assert table.upsert(rows((1, "A", 7.0)), upsert_prices, "b1") is None                  # a replayed batch
    real, once = commits.create_once, []

    def race(s, p, text):                                        # another writer commits the number first
        if not once:
            once.append(1)
            assert mon.price_archive(spark, path).upsert(rows((2, "B", 20.0), (3, "A", 30.0)), upsert_prices, "b2") == 2
        return real(s, p, text)
    monkeypatch.setattr(commits, "create_once", race)
    assert table.upsert(rows((2, "A", 2.5), (1, "C", 1.5)), upsert_prices, "b3") == 3
    got = sorted((r.date.day, r.material_code, r.price_usd_per_kg) for r in table.read().collect())
    assert got == [(1, "A", 1.0), (1, "C", 1.5), (2, "A", 2.5), (2, "B", 20.0), (3, "A", 30.0)]
    assert sorted(r.material_code for r in table.read(["2024-01-02"]).collect()) == ["A", "B"]


def test_plain_partitions_are_version_zero(spark, tmp_path):
    path = str(tmp_path / "archive")
    old = spark.createDataFrame([(dt.date(2024, 1, 1), "A", 1.0, "live", 1), (dt.date(2024, 1, 2), "A", 2.0, "live", 1)], mon.PRICE_ARCHIVE_SCHEMA)
    old.write.partitionBy("date").parquet(path)
    table = mon.price_archive(spark, path)
    assert table.read().count() == 2
    table.upsert(old.where("date = '2024-01-02'").withColumn("price_usd_per_kg", F.lit(5.0)), upsert_prices)
    assert sorted((r.date.day, r.price_usd_per_kg) for r in table.read().collect()) == [(1, 1.0), (2, 5.0)]


def test_a_foreign_file_in_a_log_is_an_error(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "notes.json").write_text('{"version": 1}')
    with pytest.raises(ValueError):
        commits.numbers(spark, str(tmp_path / "log"))
