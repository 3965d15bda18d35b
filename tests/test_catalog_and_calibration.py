"""Process catalog parsing (ragged rows), catalog feasibility and Platt calibration."""

from pyspark.sql import functions as F

from forgeline.functions.catalog import catalog_feasible, parse_process_catalog
from forgeline.plans import ml

LINES = [
    "process_code,display_name,category,wall_min_mm,wall_max_mm,hole_dia_min_mm,hole_dia_max_mm,min_quantity,"
    "geometry_constraint,notes",
    'mill,Milling,subtractive,0.5,3000,0.5,3000,1.0,any,"General, three axis"',
    "bend,Bending,forming,0.5,4.0,0.5,4.0,any,Brake press bending",
    "mold,Molding,forming,1.0,4.0,1.0,4.0,>=10000,Thermoplastics",
    "sand,Sand Casting,casting,3.0,any,3.0,any,any,Large castings",
]


def test_ragged_catalog(spark):
    cat = parse_process_catalog(spark.createDataFrame([(x,) for x in LINES], "value string"))
    rows = {r.process_code: r for r in cat.collect()}
    assert rows["mill"].geometry_constraint == "any" and rows["mill"].notes == "General, three axis"
    assert rows["bend"].geometry_constraint is None and rows["bend"].notes == "Brake press bending"
    assert rows["bend"].min_quantity is None and rows["mold"].min_quantity == 10000.0
    assert rows["sand"].wall_max_mm is None and rows["sand"].wall_min_mm == 3.0
    parts = spark.createDataFrame([("P1", 2.0, 2.0, 50), ("P2", 5.0, None, 20000)],
                                  "part_id string, wall_thickness_min double, hole_diameter_min double, quantity int")
    f = {r.part_id: set(r.catalog_feasible) for r in catalog_feasible(parts, [tuple(r) for r in cat.select(
        "process_code", "wall_min_mm", "wall_max_mm", "hole_dia_min_mm", "hole_dia_max_mm", "min_quantity").collect()]).collect()}
    assert f["P1"] == {"mill", "bend"}
    assert f["P2"] == {"mill", "sand"}


def test_platt_calibration_normalises(spark):
    rows = [(f"r{i}", i % 3, [0.6, 0.3, 0.1] if i % 3 == 0 else [0.2, 0.5, 0.3]) for i in range(60)]
    oof = spark.createDataFrame(rows, "row_id string, true_idx int, proba array<double>")
    models, cal = ml.calibrate_platt(oof, 3)
    assert len(models) == 3
    sums = [r.s for r in cal.select(F.aggregate("proba", F.lit(0.0), lambda a, b: a + b).alias("s")).collect()]
    assert all(abs(s - 1.0) < 1e-9 for s in sums)


def test_reference_part_check(spark):
    from forgeline.constants import FEATURE_COLUMNS
    base = {c: 1.0 for c in FEATURE_COLUMNS}
    rows = []
    for i in range(40):
        r = dict(base, bounding_box_x=10.0 + i % 3, bounding_box_y=10.0, bounding_box_z=10.0,
                 volume=100.0 if i % 2 else 900.0, aspect_ratio=2.0,
                 thin_wall_flag=0.0, wall_thickness_min=2.0)
        rows.append((f"P{i}", "cnc_milling" if i % 2 else "sand_casting", *[float(r[c]) for c in FEATURE_COLUMNS]))
    cols = "part_id string, expected_process string, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    parts = spark.createDataFrame(rows, cols)
    train = ml.prepare_classifier_rows(parts.withColumn("process_code", F.col("expected_process")))
    model = ml.classifier_pipeline(num_trees=5, max_depth=3).fit(train)
    r = ml.reference_part_check(model, parts).first()
    assert r.top_1_accuracy == 1.0 and r.n_invalid == 0
