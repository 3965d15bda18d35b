"""T-S6: the feed's files are bounded in rows, and the stream still takes in every order in four triggers."""

from forgeline.plans.registry import load_all
from forgeline.sources.tables import Domain

from conftest import SMALL


def test_files_grow_in_number_not_in_size(spark, monkeypatch):
    load_all()
    from forgeline.plans import queries_stream
    seen = []
    real = queries_stream.order_intake

    def spy(stream, enrich, path, checkpoint):
        files = [p for p in spark.read.parquet(path.rsplit("/", 1)[0] + "/in").inputFiles()]
        seen.append(max(spark.read.parquet(f).count() for f in files))
        query = real(stream, enrich, path, checkpoint)
        seen.append((len(files), len(queries_stream.Intake(spark, path).manifests())))
        return query

    monkeypatch.setattr(queries_stream, "order_intake", spy)
    monkeypatch.setattr(queries_stream, "INTAKE_FILE_ROWS", 500, raising=False)
    d = Domain(spark, SMALL)
    n = d.orders.count()
    out = queries_stream.ts6_incremental_intake(d)
    completed = d.orders.where("status = 'completed'").join(d.geometry.where("bounding_box_x IS NOT NULL"), "part_id").count()
    assert n > 4 * 500 and seen[0] <= 510 and seen[1] == (4 * -(-n // 2000), 4)
    assert out.count() == completed
