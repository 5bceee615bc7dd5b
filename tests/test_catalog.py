"""Every catalog query against its SQL twin would take minutes; these cover each operator family at sf0.001."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.contract import CLASSES
from emberline.fixtures import TABLES, view
from emberline.operators import spatial
from emberline.operators import clusters, history
from emberline.plans import alerts, catalog, labels, model, offshore, readers, reconcile, reports, validation  # noqa: F401
from emberline import storage
from emberline.streaming import feeds

SF = "/root/testdata/sf0.001"


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 6) if isinstance(v, float) else str(v)


@pytest.mark.parametrize(
    "name",
    ["coverage_segments", "detection_keys", "project_points", "zone_of", "assign_state", "causal_recurrence", "anomaly_baselines",
     "neighbourhood_active_days", "near_critical_site", "asof_scenes", "build_labels",
     "detail_shards", "temporal_split", "spatial_block_split", "pre_split_features", "classification_report", "burn_severity",
     "industrial_subtype", "period_over_period", "months_table", "facility_group_counts", "new_unmapped_source", "map_points", "content_hash", "check_manifest", "check_consistency", "classification_report", "late_data", "publish_alerts", "landcover_point", "assign_state",
     "offshore_columns", "offshore_recurrence", "offshore_clusters", "large_fire_events", "isolated_points", "compare_locations", "hot_pixels", "control_points", "offshore_validation", "stratified_sample",
     "read_geojson", "extract_context", "nested_json", "contract_projection", "label_fingerprint", "landcover_majority", "relabel_industrial", "gold_wilson",
     "feature_matrix", "prepare_training", "stream_alert_once", "stream_site_state", "build_alerts", "label_reason", "apply_offshore_rules", "dnbr", "typed_facilities", "check_alerts"],
)
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    twin = con.sql(catalog.ORACLE_SQL[name])
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    assert columns == sorted(twin.columns)
    order = [list(twin.columns).index(c) for c in columns]
    want = sorted(repr([norm(r[i]) for i in order]) for r in twin.fetchall())
    assert sorted(repr([norm(r[c]) for c in columns]) for r in df.collect()) == want


def test_bucket_sizes_agree(spark):
    points = labels.places(labels.detections(spark, SF))
    sides = spatial.box_segments(labels.context(spark, SF), "feature_id")
    read = lambda df: {(tuple(r.pid), round(r.dist, 6), r.fid) for r in df.collect()}
    all_at_once = read(spatial.nearest(points, sides, bucket=1e7))
    assert len(all_at_once) == points.count() and read(spatial.nearest(points, sides)) == all_at_once == read(spatial.nearest(points, sides, bucket=900.0))


def test_empty_side(spark):
    points = labels.places(labels.detections(spark, SF))
    none = spatial.box_segments(labels.context(spark, SF).limit(0), "feature_id")
    assert spatial.nearest(points, none).count() == 0
    assert spatial.containing(points, none).count() == 0


def test_numbering_and_cutoff_of_no_rows(spark):
    rows = labels.detections(spark, SF).limit(0)
    assert reports.numbered(rows, "acq_date", "det_id").count() == 0
    assert reports.cutoff_of(rows).count() == 0


def test_clusters_of_cores_and_borders(spark):
    # Five cores in a row, a border point at each end, one point alone, and the same places on another day with too few points.
    rows = [("d1", i, float(i), 0.0) for i in range(7)] + [("d1", 50, 50.0, 0.0), ("d2", 60, 0.0, 0.0), ("d2", 61, 1.0, 0.0)]
    points = spark.createDataFrame(rows, "day string, pid int, x double, y double")
    got = {r.pid: r.cluster for r in clusters.density_clusters(points, "day", 1.0, 3).collect()}
    assert got == {i: 1 for i in range(7)}
    assert clusters.density_clusters(points.limit(0), "day", 1.0, 3).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "u int, v int")
    assert {r.node: r.root for r in clusters.components(edges).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_scenes_are_used_once(spark):
    import datetime as dt

    day = lambda n: dt.date(2024, 1, n)
    anchors = spark.createDataFrame([(1, day(10)), (1, day(11)), (1, day(25)), (2, day(10))], "point_id int, anchor date")
    scenes = spark.createDataFrame([(1, day(9), 1.0), (1, day(11), 0.9), (1, day(10), 0.1), (1, day(28), 1.0), (2, day(14), 1.0)], "point_id int, scene_date date, clear double")
    got = {(r.point_id, r.anchor.day, r.scene_date.day) for r in validation.scene_selection(anchors, scenes).collect()}
    assert got == {(1, 10, 9), (1, 11, 11), (1, 25, 28)}


def test_model_refuses_other_features_and_learns(spark):
    accuracy = model.train_evaluate(spark, SF).first()
    assert accuracy.n > 0 and accuracy.accuracy > 0.6
    trained = model.train_model(model._training(spark, SF))
    with pytest.raises(ValueError):
        model.score_model(labels.labelled(spark, SF).select("det_id"), trained)
    with pytest.raises(ValueError):  # the same columns in another order
        model.score_model(model.feature_matrix(labels.labelled(spark, SF)).select(*reversed(model.FEATURES)), trained)
    trained.save(spark, f"{storage.shared_folder(spark)}/models/test")
    again = model.BoostedTrees.load(spark, f"{storage.shared_folder(spark)}/models/test")
    matrix = model.feature_matrix(labels.labelled(spark, SF), "det_id")
    told = lambda m: sorted((r.det_id, r.model_label, round(sum(r.probabilities.values()), 9)) for r in model.score_model(matrix, m).collect())
    assert told(again) == told(trained) and {p for *_, p in told(again)} == {1.0}
    row = labels.labelled(spark, SF).orderBy("det_id").limit(1)
    one, batch = model.feature_matrix(row, "det_id").first(), model.feature_matrix(labels.labelled(spark, SF), "det_id").orderBy("det_id").first()
    assert one == batch and one.asDict().keys() == {"det_id", *model.FEATURES}
    ruled = {r.det_id: r for r in labels.labelled(spark, SF).collect()}
    for r in model.classify_query(spark, SF).collect():
        assert (r.label_source == "model") == (ruled[r.det_id].label == "unknown") and (r.label_source == "model" or r.label == ruled[r.det_id].label)


def test_model_without_rows_to_learn_from(spark, monkeypatch):
    few = model._training(spark, SF)
    one = model.train_model(few.limit(1))  # one class, and no row left to stop by
    assert len(one.classes) == 1 and model.score_model(few.select("det_id", *model.FEATURES).limit(3), one).select("model_label").distinct().count() == 1
    monkeypatch.setattr(model, "_training", lambda s, d: few.limit(0))  # gold cells may cover all
    monkeypatch.setattr(model, "_trained", {})
    monkeypatch.setattr(storage, "_written", {k: v for k, v in storage._written.items() if k[2] != "scored"})
    assert model.train_model_query(spark, SF).count() == 0
    assert {(r.model_label, len(r.probabilities)) for r in model.score_model_query(spark, SF).collect()} == {(None, 0)}
    ruled = {tuple(r) for r in labels.labelled(spark, SF).select("det_id", "label", "label_source").collect()}
    assert {tuple(r) for r in model.classify_query(spark, SF).collect()} == ruled
    assert {(r.precision, r.recall, r.f1, r.support) for r in model.evaluate_split(spark, SF).collect()} <= {(0.0, 0.0, 0.0, 0), (0.0, 0.0, 0.0, None)}
    assert tuple(model.train_evaluate(spark, SF).first()) == (0, None)


def test_manifest_differences(spark):
    schema = "name string, size long, sha256 string"
    now = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("c", 3, "x"), ("d", 4, "x")], schema)
    then = spark.createDataFrame([("a", 1, "x"), ("b", 9, "x"), ("c", 3, "y"), ("e", 5, "x")], schema)
    assert {tuple(r) for r in readers.compare_manifest(now, then).collect()} == {("a", "ok"), ("b", "size"), ("c", "checksum"), ("d", "extra"), ("e", "missing")}


def test_live_run_equals_bulk_for_new_rows(spark):
    got = {r.det_id: (r.is_anomalous, r.recurrence_count) for r in feeds.run_ingest_query(spark, SF).collect()}
    rows = history.with_grid(view(spark, SF, "detections"))
    bulk = {r.det_id: r.recurrence_count for r in rows.join(history.causal_recurrence(rows, 90), ["gi", "gj", "acq_date"]).collect()}
    judged = {r.det_id: r.is_anomalous for r in labels.labelled(spark, SF).collect()}
    assert got and all(flag == judged[i] and n == bulk[i] for i, (flag, n) in got.items())


def test_alert_faults(spark):
    good = ("a", "large_fire", "2024-01-05", 21.5, 70.5)
    rows = [good, ("b", "other", "2024-01-05", 21.5, 70.5), ("c", "new_source", "2024-13-05", 91.0, 70.5), ("d", *good[1:]), ("d", *good[1:]), ("e", None, None, None, 70.5)]
    table = spark.createDataFrame(rows, "alert_id string, alert_type string, acq_date string, latitude double, longitude double")
    read = lambda df: {r.alert_id: r.faults for r in alerts.alert_faults(df).collect()}
    assert read(table) == {"a": "", "b": "unknown type", "c": "bad date,bad coordinates", "d": "repeated id", "e": "unknown type,bad date,bad coordinates"}
    assert read(table.where("alert_id = 'a'").drop("longitude")) == {"a": "no longitude,bad coordinates"}
    assert read(table.limit(0)) == {}


def test_cloudy_scenes_and_low_tail(spark, tmp_path):
    rows = [(1, n, q, "1995-03-01", 1) for n, q in enumerate((10, 20, 30, 40), 1)] + [(1, 5, 50, "1995-03-02", 1), (1, 6, 50, "1995-03-02", 4)]
    scl = {1: 4, 4: 8}  # the second date has one clear pixel of two
    table = spark.createDataFrame([(o, n, q * 64.0 / 10, 0.5, dt, scl[p]) for o, n, q, dt, p in rows], "l_orderkey long, l_linenumber int, l_quantity double, l_discount double, l_shipdate string, l_partkey int")
    table.write.parquet(f"{tmp_path}/lineitem.parquet")
    (r,) = catalog._scene_stats(spark, str(tmp_path)).collect()
    ratios = [(q - 0.5) / (q + 0.5) for q in (1, 2, 3, 4)]
    assert str(r.scene_date) == "1995-03-01" and r.clear == 1.0
    assert r.nbr == pytest.approx(sum(ratios) / 4) and r.p10 == pytest.approx(ratios[0] + 0.3 * (ratios[1] - ratios[0])) and r.p50 == pytest.approx((ratios[1] + ratios[2]) / 2)
    assert catalog._scene_stats(spark, str(tmp_path), least=0.0).count() == 2


def test_digests_see_every_change_and_no_order(spark):
    rows = [(1, "a", 1.5, None), (2, "b", None, "x"), (2, "b", None, "x"), (3, "ab", 2.0, "")]
    table = lambda r: spark.createDataFrame([("p", *x) for x in r], "part string, n int, t string, frp double, u string")
    digest = lambda r: reconcile.digests(table(r), "part", ["n", "t", "frp", "u"]).first()
    plain = digest(rows)
    assert digest(rows[::-1]) == plain and plain.n == 4
    changed = [[(1, "a", 1.5, ""), *rows[1:]], [(1, "a", 1.501, None), *rows[1:]], rows[:3], [*rows, rows[0]], [(1, "a1", 1.5, None), *rows[1:]], [rows[0], rows[1], rows[3], rows[3]]]
    assert len({plain.digest, *(digest(r).digest for r in changed)}) == 7


def test_reconcile_reports_each_difference(spark):
    table = lambda *r: spark.createDataFrame(list(r), "metric string, key string, n long")
    got = reconcile.reconcile(table(("day", "a", 1), ("day", "b", 2), ("day", "c", 3)), table(("day", "a", 1), ("day", "b", 5), ("day", "d", 4))).collect()
    assert {(r.key, r.differs) for r in got} == {("a", False), ("b", True), ("c", True), ("d", True)}


def test_geojson_of_all_kinds(spark, tmp_path):
    import json

    square = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]
    hole = [[1.0, 1.0], [2.0, 1.0], [2.0, 2.0], [1.0, 2.0], [1.0, 1.0]]
    island = [[x + 10, y] for x, y in square]
    shapes = {"Point": [1.0, 2.0], "MultiPoint": [[1.0, 2.0], [3.0, 4.0]], "LineString": square[:3], "MultiLineString": [square[:3], hole[:2]], "Polygon": [square, hole], "MultiPolygon": [[square, hole], [island]]}
    features = [{"type": "Feature", "properties": {"fid": k}, "geometry": {"type": k, "coordinates": v}} for k, v in shapes.items()]
    features.append({"type": "Feature", "properties": {"fid": "none"}, "geometry": None})
    (tmp_path / "a.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    found = readers.read_geojson(spark, f"file://{tmp_path}/a.json", "fid:string")
    sides = readers.geojson_sides(found, "fid")
    assert {r.fid: r.n for r in sides.groupBy("fid").agg(F.count("*").alias("n")).collect()} == {"Point": 1, "MultiPoint": 2, "LineString": 2, "MultiLineString": 3, "Polygon": 8, "MultiPolygon": 12}
    points = spark.createDataFrame([(1, 3.0, 3.0), (2, 1.5, 1.5), (3, 13.0, 3.0), (4, 9.0, 9.0)], "pid long, x double, y double")
    inside = spatial.containing(points, sides.where(F.col("fid").isin("Polygon", "MultiPolygon")), cell=1.0)
    assert {(r.pid, r.fid) for r in inside.collect()} == {(1, "Polygon"), (1, "MultiPolygon"), (3, "MultiPolygon")}


def test_facility_columns_under_other_names(spark):
    rows = spark.createDataFrame([(1, 2.0, 3.0, None), (2, None, 3.0, "x")], "id int, LAT double, Long double, type string")
    assert [tuple(r) for r in catalog.load_facilities(rows).select("id", "latitude", "longitude", "facility_type").collect()] == [(1, 2.0, 3.0, "industrial")]
    with pytest.raises(ValueError):
        catalog.load_facilities(rows.drop("Long"))


def test_map_points_in_draw_order(spark, monkeypatch):
    rows = [
        (7, "2023-12-25", 22.1, 69.1, "industrial", True), (9, "2023-12-22", 22.2, 69.2, "gas flare", False), (8, "2023-12-22", 30.123456789, 75.5, "wildfire", False),
        (3, "2024-02-10", 30.5, 75.5, "agricultural burning", False), (2, "2024-02-10", 30.5, 75.6, "unknown", True), (1, None, 30.5, 75.7, "unknown", False),
        (4, "2023-12-25", 22.3, 69.3, "wildfire", False), (4, "2023-12-25", 22.3, 69.2, "wildfire", False), (5, None, 22.4, 69.4, "industrial", False),
    ]
    table = spark.createDataFrame(rows, "det_id long, acq_date string, latitude double, longitude double, label string, is_anomalous boolean")
    single = lambda x: float(np.float32(x))
    want = [
        (0, 5, single(75.6), single(30.5), 50, "unknown", 1), (1, 7, single(75.7), single(30.5), None, "unknown", 0), (2, 6, single(75.5), single(30.5), 50, "agricultural burning", 0),
        (3, 0, single(75.5), single(30.123456789), 0, "wildfire", 0), (4, 2, single(69.2), single(22.3), 3, "wildfire", 0), (5, 3, single(69.3), single(22.3), 3, "wildfire", 0),
        (6, 4, single(69.1), single(22.1), 3, "industrial", 1), (7, 8, single(69.4), single(22.4), None, "industrial", 0), (8, 1, single(69.2), single(22.2), 0, "gas flare", 0),
    ]
    for some in (table, table.repartition(7), table.orderBy(F.desc("det_id"))):  # whatever the rows' layout
        monkeypatch.setattr(labels, "labelled", lambda s, d: some)
        got = catalog.map_points(spark, "").collect()
        assert [(r.point, r.row_id, r.longitude, r.latitude, r.day, CLASSES[r.class_id], r.anomaly) for r in got] == want
    monkeypatch.setattr(labels, "labelled", lambda s, d: table.limit(0))
    assert catalog.map_points(spark, "").count() == 0
