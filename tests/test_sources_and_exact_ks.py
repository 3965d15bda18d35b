"""Quoted line breaks in CSV files, column differences, ordered vectors and the exact KS distribution."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from forgeline.functions.features import ordered_vector
from forgeline.plans import quality
from forgeline.sources import readers

HEADER = "facility_id,machine_id,process_code,week_start,effective_hourly_rate_usd,maintenance_notes"


def records(n):
    notes = ["plain", '"with, comma"', '"two\nlines"', '"a ""quote"" here"', '"three\n\nlines, ""q""\nend"', "", '"odd \n quote "" mark"']
    return [(f"F{i}", f"M{i}", "edm", "2024-01-01", float(i), notes[i % len(notes)]) for i in range(n)]


@pytest.mark.parametrize("block", [None, 64, 200])
def test_quoted_line_breaks_across_blocks(spark, tmp_path, block):
    rows = records(60)
    text = HEADER + "\n" + "\n".join(",".join(map(str, r)) for r in rows) + "\n"
    (tmp_path / "equipment_log_a.csv").write_text(text)
    (tmp_path / "equipment_log_b.csv").write_text("machine_id,facility_id,effective_hourly_rate_usd\nM,\"G\n1\",7\n")
    (tmp_path / "equipment_log_c.csv").write_text("﻿" + HEADER + "\nC,M,edm,2024-01-08,3,\"never closed\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        if block:
            spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        got = readers.scan_equipment_logs(spark, str(tmp_path)).orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [(r[0], r[4], r[5].strip('"').replace('""', '"') or None) for r in rows]
    assert [(r.facility_id, r.effective_hourly_rate_usd, r.maintenance_notes) for r in got[:60]] == want
    assert (got[60].facility_id, got[60].machine_id, got[60].effective_hourly_rate_usd, got[60].process_code) == ("G\n1", "M", 7.0, None)
    assert got[61].facility_id == "C" and len(got) == 62


def test_many_headers_take_one_pass(spark, tmp_path, monkeypatch):
    names = HEADER.split(",")
    for i in range(25):
        order = names[i % 6:] + names[:i % 6]
        values = dict(zip(names, (f"F{i}", "M", "edm", "2024-01-01", str(i), "n")))
        (tmp_path / f"equipment_log_{i:02d}.csv").write_text(",".join(order) + f",extra{i}\n" + ",".join(values[c] for c in order) + ",x\n")
    reads = []
    real = spark.read.__class__.text
    monkeypatch.setattr(spark.read.__class__, "text", lambda self, *a, **k: reads.append(1) or real(self, *a, **k))
    got = readers.scan_equipment_logs(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r.facility_id, r.effective_hourly_rate_usd) for r in got] == [(f"F{i}", float(i)) for i in range(25)] and len(reads) == 1
    assert readers.scan_equipment_logs(spark, str(tmp_path), ["F3"]).count() == 1


def test_no_files(spark, tmp_path):
    assert readers.scan_equipment_logs(spark, str(tmp_path)).count() == 0


def test_column_differences_and_vectors(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 3.0, None)], "a int, b double, `odd name` string")
    assert [tuple(r) for r in readers.column_differences(df, ["b", "c", "a"]).collect()] == [
        ("b", True, True, 1), ("c", True, False, None), ("a", True, True, 2), ("odd name", False, True, 1)]
    assert [r.n_values for r in readers.column_differences(df.limit(0), ["a"]).collect()] == [0, 0, 0]
    v = [r.features for r in ordered_vector(df.withColumn("n", F.lit(float("nan"))), ["b", "z", "a", "n"]).collect()]
    assert math.isnan(v[0][0]) and math.isnan(v[0][1]) and v[0][2] == 1.0 and v[1][0] == 3.0 and math.isnan(v[1][3])
    assert [r.features for r in ordered_vector(df, ["b", "z", "a"], 0.0).collect()] == [[0.0, 0.0, 1.0], [3.0, 0.0, 2.0]]


def statistic(path, n, m):
    i = j = top = 0
    for left in path:
        i, j = i + left, j + 1 - left
        top = max(top, abs(i * m - j * n))
    return top


@pytest.mark.parametrize("n,m", [(1, 1), (1, 5), (3, 3), (4, 6), (5, 8), (8, 8), (7, 2)])
def test_exact_ks_equals_enumeration(n, m):
    paths = [[k in chosen for k in range(n + m)] for chosen in map(set, itertools.combinations(range(n + m), n))]
    tops = [statistic(p, n, m) for p in paths]
    for top in sorted({0, *tops}):
        want = sum(t >= top for t in tops) / len(tops)
        assert abs(quality.ks_exact_pvalue(n, m, top / (n * m)) - want) < 1e-12


def test_exact_ks_is_used_up_to_a_size(spark):
    base = spark.range(40).select(*[(F.col("id") * 1.0).alias(c) for c in quality.DRIFT_NUMERIC_COLUMNS])
    new = spark.range(30).select(*[(F.col("id") * 1.5 + 0.25).alias(c) for c in quality.DRIFT_NUMERIC_COLUMNS])
    rough = {r.feature: r for r in quality.ks_two_sample(base, new).collect()}
    for r in quality.ks_two_sample(base, new, exact_rows=100).collect():
        assert r.ks_stat == rough[r.feature].ks_stat and r.ks_pval == quality.ks_exact_pvalue(40, 30, r.ks_stat) != rough[r.feature].ks_pval
    assert [r.ks_pval for r in quality.ks_two_sample(base, new, exact_rows=39).collect()] == [r.ks_pval for r in rough.values()]
    assert abs(quality.ks_exact_pvalue(2000, 1500, 0.05) - 0.026) < 0.01
