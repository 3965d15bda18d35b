"""Literal cases for normalisation, labels, validation and the temporal joins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from forgeline.operators import joins, labels, normalize as nz, validate


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_surface_finish_tolerance_and_logs(spark):
    df = spark.createDataFrame([("as_machined", "it8", 0), (" Fine", "IT12", -5), ("1.6", "IT13", 9),
                                ("bogus", None, 9), (None, "x", 9)], "f string, t string, q int")
    out = df.select(nz.surface_finish_ra(F.col("f")).alias("ra"),
                    nz.tolerance_index(nz.clean_upper(F.col("t"))).alias("ti"),
                    nz.safe_log1p(F.col("q").cast("double")).alias("lq")).collect()
    assert [r.ra for r in out] == [3.2, 1.6, 1.6, 3.2, 3.2]
    assert [r.ti for r in out] == [5.0, 9.0, 5.0, 5.0, 5.0]
    assert out[0].lq == 0.0 and out[1].lq == 0.0 and abs(out[2].lq - 2.302585093) < 1e-9


def test_cost_model_encodings(spark):
    from forgeline.constants import COST_MATERIAL_FAMILY, COST_PROCESS_CODE
    df = spark.createDataFrame([("cnc_milling", "AL6061"), ("cnc_turning", "SS316L"), ("edm", "INCONEL625")],
                               "p string, m string")
    out = df.select(nz.encode(COST_PROCESS_CODE, F.col("p")).alias("pe"),
                    nz.encode(COST_MATERIAL_FAMILY, F.col("m")).alias("me")).collect()
    assert [(r.pe, r.me) for r in out] == [(1, 1), (2, 2), (0, 0)]


def test_label_builder_exact_decomposed_untouched(spark):
    schema = ("process_code string, cost_total double, cost_machine_time double, cost_setup double, "
              "cost_tooling double, cost_raw_material double, cost_finishing double, cost_label_source string")
    df = spark.createDataFrame([
        ("cnc_milling", 100.0, 40.0, 20.0, 10.0, 25.0, 5.0, "decomposed"),   # complete -> exact
        ("injection_molding", 200.0, 80.0, None, 10.0, 20.0, 5.0, None),     # partial -> ratios
        ("unknown", 10.0, None, None, None, None, None, None),               # default ratios
        ("cnc_milling", -5.0, None, None, None, None, None, "x"),            # untouched
        ("cnc_milling", None, None, None, None, None, None, None),           # untouched
    ], schema)
    out = labels.build_labels(df).collect()
    assert out[0].cost_label_source == "exact" and out[0].cost_machine_time == 40.0
    assert (out[1].cost_machine_time, out[1].cost_tooling, out[1].cost_label_source) == (40.0, 100.0, "estimated")
    assert (out[2].cost_machine_time, out[2].cost_tooling) == (4.0, 1.5)
    assert out[3].cost_label_source == "x" and out[3].cost_machine_time is None
    assert out[4].cost_label_source is None


def _training_row(**kw):
    base = dict(part_id="P1", bounding_box_x=100.0, bounding_box_y=50.0, bounding_box_z=20.0, volume=5000.0,
                surface_area=2000.0, wall_thickness_min=2.0, wall_thickness_avg=3.0, aspect_ratio=5.0,
                hole_count=2, hole_diameter_min=5.0, undercut_flag=0, thin_wall_flag=0,
                curvature_complexity=0.2, symmetry_score=0.5, process_code="cnc_milling", material_code="AL6061",
                quantity=10, material_price_per_kg=2.8, cost_machine_time=40.0, cost_setup=15.0,
                cost_tooling=10.0, cost_raw_material=25.0, cost_finishing=10.0, cost_total=100.0,
                cost_label_source="exact", completion_date=dt.date(2026, 6, 1), order_id="O1")
    base.update(kw)
    return base


def test_validation_reasons_and_duplicates(spark):
    data = [_training_row(order_id="O1", part_id="P1"),
            _training_row(order_id="O2", part_id="P2", cost_total=-5.0),
            _training_row(order_id="O3", part_id="P3", process_code="weaving_socks"),
            _training_row(order_id="O4", part_id="P4", quantity=None, material_code=None),
            # first copy invalid, second valid: the valid twin is still a duplicate
            _training_row(order_id="O5", part_id="P5", cost_total=-1.0, completion_date=dt.date(2026, 6, 1)),
            _training_row(order_id="O6", part_id="P5", completion_date=dt.date(2026, 6, 2))]
    df = spark.createDataFrame(data)
    a = validate.annotate(df)
    got = {r.order_id: (r.reject_bucket, r.reject_column) for r in a.collect()}
    assert got["O1"] == (None, None)
    assert got["O2"] == ("Column 'cost_total'", "cost_total")
    assert got["O3"] == ("Column 'process_code'", "process_code")
    # quantity NULL: Null reason, then the cast fills 0 and the range rule wins (last failing rule)
    assert got["O4"] == ("Column 'quantity'", "quantity")
    assert got["O5"][0] == "Column 'cost_total'"
    assert got["O6"][0] == "Duplicate combination of part_id and process_code"
    clean, rejected = validate.split_valid(a)
    assert clean.count() == 1 and rejected.count() == 5
    summary = {r.reject_bucket: r.rows for r in validate.drop_summary(a).collect()}
    assert summary["Column 'cost_total'"] == 2
    a2 = validate.annotate(df, dedupe_after_rules=True)
    assert {r.order_id for r in validate.split_valid(a2)[0].collect()} == {"O1", "O6"}


def test_missing_required_column(spark):
    df = spark.createDataFrame([_training_row()]).drop("volume")
    with pytest.raises(validate.MissingRequiredColumn):
        validate.annotate(df)


def test_joiner_literal_case(spark):
    orders = spark.createDataFrame([("O1", "P1", "cnc_milling", "AL6061", dt.date(2026, 6, 1), "FACILITY_01")],
                                   "order_id string, part_id string, process_code string, material_code string, "
                                   "order_date date, facility_id string")
    geo = spark.createDataFrame([("P1", 120.0, 5000.0)], "part_id string, bounding_box_x double, volume double")
    prices = spark.createDataFrame([(dt.date(2026, 6, 1), "AL6061", 2.80, 1)],
                                   "date date, material_code string, price_usd_per_kg double, seq long")
    equip = spark.createDataFrame([("FACILITY_01", "cnc_milling", dt.date(2026, 5, 25), 75.0, 1)],
                                  "facility_id string, process_code string, week_start date, "
                                  "effective_hourly_rate_usd double, seq long")
    j = joins.join_geometry(orders, geo)
    j = joins.rate_as_of(j, equip)
    j = joins.price_at_date(j, prices)
    r = j.collect()
    assert len(r) == 1 and r[0].volume == 5000.0 and r[0].material_price_per_kg == 2.80
    assert r[0].effective_hourly_rate == 75.0
    assert joins.join_geometry(orders, geo.where("false")).count() == 0


def test_price_window_edges(spark):
    d0 = dt.date(2024, 1, 10)
    prices = spark.createDataFrame([
        (d0 - dt.timedelta(days=7), "A", 1.0, 1), (d0 + dt.timedelta(days=3), "A", 2.0, 2),   # latest wins, future ok
        (d0 - dt.timedelta(days=8), "B", 3.0, 3),                                               # 8 days: too far
        (d0, "C", 4.0, 5), (d0, "C", 5.0, 4), (d0 + dt.timedelta(days=1), "C", 9.0, 6),       # exact: lowest seq
    ], "date date, material_code string, price_usd_per_kg double, seq long")
    orders = spark.createDataFrame([(m, d0) for m in "ABCD"] + [("AL6061", d0)], "material_code string, order_date date")
    out = {r.material_code: r.material_price_per_kg for r in joins.price_at_date(orders, prices).collect()}
    assert out == {"A": 2.0, "B": None, "C": 5.0, "D": None, "AL6061": 2.80}
    near = {r.material_code: r.material_price_per_kg
            for r in joins.price_at_date(orders, prices, direction="nearest").collect()}
    assert near["A"] == 2.0 and near["C"] == 5.0
    back = {r.material_code: r.material_price_per_kg
            for r in joins.price_at_date(orders, prices, direction="backward").collect()}
    assert back["A"] == 1.0


def test_rate_as_of_edges(spark):
    equip = spark.createDataFrame([
        ("F1", "p", dt.date(2024, 1, 8), 10.0, 1), ("F1", "p", dt.date(2024, 1, 8), 11.0, 2),  # same week
        ("F1", "p", dt.date(2024, 1, 22), 20.0, 3)],
        "facility_id string, process_code string, week_start date, effective_hourly_rate_usd double, seq long")
    orders = spark.createDataFrame([("F1", "p", dt.date(2024, 1, 1)), ("F1", "p", dt.date(2024, 1, 8)),
                                    ("F1", "p", dt.date(2024, 1, 21)), ("F1", "p", dt.date(2024, 3, 1)),
                                    ("F2", "p", dt.date(2024, 3, 1)), ("F1", " P", dt.date(2024, 3, 1))],
                                   "facility_id string, process_code string, order_date date")
    out = [r.effective_hourly_rate for r in joins.rate_as_of(orders, equip).orderBy("order_date", "facility_id",
                                                                                     "process_code").collect()]
    assert out == [None, 11.0, 11.0, None, 20.0, None]


def test_price_upsert(spark):
    existing = spark.createDataFrame([(dt.date(2024, 1, 1), "A", 1.0, "live"), (dt.date(2024, 1, 1), "B", 2.0, "live"),
                                      (dt.date(2024, 1, 2), "A", 3.0, "live")],
                                     "date date, material_code string, price_usd_per_kg double, source string")
    batch = spark.createDataFrame([(dt.date(2024, 1, 1), "A", 9.0)], "date date, material_code string, "
                                  "price_usd_per_kg double")
    out = sorted(rows(joins.upsert_prices(existing, batch, "fallback"), "date", "material_code", "price_usd_per_kg",
                      "source"))
    assert out == [(dt.date(2024, 1, 1), "A", 9.0, "fallback"), (dt.date(2024, 1, 1), "B", 2.0, "live"),
                   (dt.date(2024, 1, 2), "A", 3.0, "live")]


def test_wall_imputation_groups(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", None, None), ("a", 3.0, 4.0), ("b", None, None),
                                (None, 10.0, 10.0), (None, None, None)],
                               "process_code string, wall_thickness_min double, wall_thickness_avg double")
    out = nz.impute_walls(df).collect()
    vals = [(r.process_code, r.wall_thickness_min, r.wall_thickness_min_imputed) for r in out]
    assert ("a", 2.0, 1) in vals                         # own-process median
    assert ("b", 3.0, 1) in vals                         # overall median of 1, 3, 10
    assert (None, 10.0, 1) in vals                       # NULL process forms its own group


def test_dedupe_with_hot_key_and_identical_copies(spark):
    # one (part, process) key holds most rows, including two identical copies of its first row
    base = dt.date(2026, 1, 1)
    rows = [("HOT", "cnc_milling", base + dt.timedelta(days=i % 50), f"O{i:05d}", 1.0) for i in range(2000)]
    rows += [("HOT", "cnc_milling", base, "O00000", 1.0)]                # identical copy of the first row
    rows += [("P1", "cnc_milling", base, "X1", 2.0), ("P2", None, base, "X2", 3.0), ("P2", None, base, "X3", 3.0)]
    df = spark.createDataFrame(rows, "part_id string, process_code string, completion_date date, order_id string, "
                                     "v double")
    flagged = validate.flag_duplicates(df)
    kept = [(r.part_id, r.order_id) for r in flagged.where("NOT __dup").collect()]
    assert sorted(kept) == [("HOT", "O00000"), ("P1", "X1"), ("P2", "X2")]
    assert flagged.count() == len(rows)


def test_label_methods_stay_short_enough_to_compile(spark, tmp_path):
    """The JVM compiles no method over 8,000 bytes, and the ETL adds more to the same loop: decomposing is kept out of it."""
    from forgeline.constants import COST_COMPONENT_COLUMNS, DECOMPOSITION_RATIOS, DEFAULT_RATIOS
    from forgeline.operators.labels import build_labels
    kinds = ", ".join(f"{c} double" for c in COST_COMPONENT_COLUMNS)
    rows = [("cnc_milling", 101.35, "x", 1.0, 2.0, None, 1.0, 1.0), (None, 7.77, "x", *[None] * 5), ("weaving", 10.0, "x", *[1.0] * 5),
            ("cnc_milling", -1.0, "x", 3.0, *[None] * 4), ("cnc_milling", None, "x", 4.0, *[None] * 4), ("other", 3.333, "x", -1.0, *[1.0] * 4)]
    spark.createDataFrame(rows, f"process_code string, cost_total double, cost_label_source string, {kinds}").coalesce(1).write.parquet(str(tmp_path / "t"))
    out = build_labels(spark.read.parquet(str(tmp_path / "t")))
    stages = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$").__getattr__("MODULE$").codegenStringSeq(
        out._jdf.queryExecution().executedPlan())
    assert max([stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())], default=0) < 2000
    got = [tuple(r[c] for c in COST_COMPONENT_COLUMNS) for r in out.collect()]

    def parts(process, total):
        return tuple(spark.sql(f"SELECT round({total}D * {r}D, 2)").first()[0] for r in DECOMPOSITION_RATIOS.get(process, DEFAULT_RATIOS))
    assert got == [parts("cnc_milling", 101.35), parts(None, 7.77), (1.0,) * 5, (3.0, *[None] * 4), (4.0, *[None] * 4), parts("other", 3.333)]
    assert [r.cost_label_source for r in out.collect()] == ["estimated", "estimated", "exact", "x", "x", "estimated"]


def test_failures_are_compiled_and_keep_rule_order(spark):
    from pyspark.sql import functions as F
    from forgeline.operators import validate
    fails = [validate._failure(F.concat(F.lit(f"over {i}: "), F.col("v").cast("string")), f"b{i}", f"c{i}" if i else None, F.col("v") > i) for i in range(4)]
    df = spark.createDataFrame([(v,) for v in (None, 0, 1, 2, 3, 4)], "v int")
    rows = df.select("v", validate.failing(fails).alias("got"), F.array_compact(F.array(*fails)).alias("want")).collect()
    assert all(r.got == r.want for r in rows) and [len(r.got) for r in rows] == [0, 0, 1, 2, 3, 4]
    assert df.select(validate.failing([]).alias("got")).first().got == []
    interpreted = df.select(validate.failing(fails).alias("got"))._jdf.queryExecution().optimizedPlan().toString().split("filter(")[1:]
    assert len(interpreted) == 1 and "over 0" not in interpreted[0]
