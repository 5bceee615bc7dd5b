"""Readers and writers of files: features, elements, nested JSON, alert history, contract, manifest; and small text operators."""

from __future__ import annotations

from functools import reduce

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..contract import CLASSES, CONTRACT_COLUMNS
from ..fixtures import view
from ..functions import rules, scalars as S
from ..operators import history as H
from ..operators.raster import DEGREE, Raster
from ..storage import shared_folder
from . import alerts as A, labels as L
from .catalog import BATCH, det, query
from .oracle import sql_list

# Tag keys that make an element industrial, in the order in which they are tried.
TARGET_KEYS = ["industrial", "landuse", "power", "man_made"]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/files/{name}-{uuid.uuid4().hex}"


def read_geojson(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """A row for each feature of a FeatureCollection: its ``properties`` (a DDL schema), geom_type and points (the outermost
    coordinates, one for a point). Features without geometry have null there."""
    geometry = "struct<type:string,coordinates:string>"
    schema = f"type string, features array<struct<type:string,properties:struct<{properties}>,geometry:{geometry}>>"
    features = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    pair = "array<double>"
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    as_ = lambda depth: F.from_json(text, "array<" * depth + pair + ">" * depth)
    parts = (
        F.when(kind == "Point", F.array(F.array(F.from_json(text, pair)))).when(kind == "MultiPoint", F.transform(as_(1), lambda p: F.array(p)))
        .when(kind == "LineString", F.array(as_(1))).when(kind.isin("Polygon", "MultiLineString"), as_(2)).when(kind == "MultiPolygon", F.flatten(as_(3)))
    )
    return features.select("f.properties.*", kind.alias("geom_type"), parts.alias("parts"))


def geojson_sides(features: DataFrame, fid: str) -> DataFrame:
    """Segments (fid, x1, y1, x2, y2) of all parts of ``read_geojson``'s features: rings of polygons, also holes; a point gives one of length 0."""
    parts = features.select(F.col(fid).alias("fid"), F.explode("parts").alias("p"))
    ends = F.when(F.size("p") == 1, F.array(F.struct(F.col("p")[0].alias("a"), F.col("p")[0].alias("b")))).otherwise(F.zip_with(F.slice("p", 1, F.size("p") - 1), F.slice("p", 2, F.size("p") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
    sides = parts.select("fid", F.explode(ends).alias("s"))
    return sides.select("fid", *[F.col(f"s.{p}")[i].alias(f"{c}{n}") for n, p in ((1, "a"), (2, "b")) for i, c in enumerate("xy")])


@query("read_geojson", "SELECT feature_id, industrial, geom_type, round(min_x, 6) AS min_x, round(max_y, 6) AS max_y FROM (SELECT feature_id, industrial, geom_type, west AS min_x, north AS max_y FROM context_boxes) t")
def read_geojson_query(s, d):
    """The mapped features, written as a collection of each part file and read back."""
    at = lambda *p: F.array(*[F.col(c) for c in p])
    ring = F.array(at("west", "south"), at("east", "south"), at("east", "north"), at("west", "north"), at("west", "south"))
    coordinates = F.when(F.col("geom_type") == "Point", F.to_json(at("west", "south"))).otherwise(F.to_json(F.array(ring)))
    feature = F.concat(
        F.lit('{"type":"Feature","properties":'), F.to_json(F.struct("feature_id", "industrial")), F.lit(',"geometry":{"type":"'), "geom_type", F.lit('","coordinates":'), coordinates, F.lit("}}")
    )
    folder = new_folder(s, "features")
    grouped = view(s, d, "context_boxes").select(F.floor(F.col("feature_id") / 5_000).alias("part"), feature.alias("f")).groupBy("part").agg(F.concat_ws(",", F.collect_list("f")).alias("all"))
    grouped.select("part", F.concat(F.lit('{"type":"FeatureCollection","features":['), "all", F.lit("]}")).alias("value")).write.partitionBy("part").text(folder)
    found = read_geojson(s, folder, "feature_id:long,industrial:string")
    edge = lambda f, i: F.round(f(F.transform(F.flatten("parts"), lambda p: F.get(p, F.lit(i)))), 6)
    return found.select("feature_id", "industrial", "geom_type", edge(F.array_min, 0).alias("min_x"), edge(F.array_max, 1).alias("max_y"))


def elements(s, d) -> DataFrame:
    """(osm_type, osm_id, tags, coords) as an extract has them; every fifth outline is left open."""
    pairs = [x for k in TARGET_KEYS for x in (F.lit(k), F.col(k))]
    tags = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())
    at = lambda x, y: F.struct(F.col(x).alias("lon"), F.col(y).alias("lat"))
    outline = F.array(at("west", "south"), at("east", "south"), at("east", "north"), at("west", "north"))
    closed = F.concat(outline, F.array(at("west", "south")))
    point = F.col("geom_type") == "Point"
    coords = F.when(point, F.slice(outline, 1, 1)).when(F.col("feature_id") % 50 == 10, outline).otherwise(closed)
    return view(s, d, "context_boxes").select(F.when(point, "node").otherwise("way").alias("osm_type"), F.col("feature_id").alias("osm_id"), tags.alias("tags"), coords.alias("coords"))


def extract_context(rows: DataFrame, keys: list[str], west: float, south: float, east: float, north: float) -> DataFrame:
    """Elements with a target tag that reach into the box: osm_id, the first key that matches, and their shape. A way that ends
    where it starts, of four coordinates at least, is a polygon; other ways are lines."""
    key = F.coalesce(*[F.when(F.map_contains_key("tags", k), k) for k in keys])
    n = F.size("coords")
    polygon = (n >= 4) & F.get("coords", F.lit(0)).eqNullSafe(F.get("coords", n - 1))
    shape = F.when(F.col("osm_type") == "node", "Point").when(polygon, "Polygon").otherwise("LineString")
    lon, lat = F.transform("coords", lambda c: c["lon"]), F.transform("coords", lambda c: c["lat"])
    reaches = (F.array_max(lon) >= west) & (F.array_min(lon) <= east) & (F.array_max(lat) >= south) & (F.array_min(lat) <= north)
    return rows.where(key.isNotNull() & reaches).select("osm_id", key.alias("matched_key"), shape.alias("geom_type"))


_BOX = (70.5, 21.2, 71.3, 22.1)


@query("extract_context", f"""SELECT feature_id AS osm_id, CASE {' '.join(f"WHEN {k} IS NOT NULL THEN '{k}'" for k in TARGET_KEYS)} END AS matched_key, CASE WHEN geom_type = 'Point' THEN 'Point' WHEN feature_id % 50 = 10 THEN 'LineString' ELSE 'Polygon' END AS geom_type
  FROM context_boxes WHERE coalesce({', '.join(TARGET_KEYS)}) IS NOT NULL AND east >= {_BOX[0]} AND north >= {_BOX[1]} AND west <= {_BOX[2]} AND south <= {_BOX[3]}""")
def extract_context_query(s, d):
    return extract_context(elements(s, d), TARGET_KEYS, *_BOX)


def upgrade_alerts(rows: DataFrame) -> DataFrame:
    """An alert history of any age with the columns alert_id, alert_type, cell, acq_date, frp: absent types are anomalies at
    industry, absent ids are made of type, cell and date."""
    of = lambda c, kind: F.col(c) if c in rows.columns else F.lit(None).cast(kind)
    kind = F.coalesce(of("alert_type", "string"), F.lit("industrial_anomaly"))
    made = F.concat_ws("|", kind, "cell", "acq_date")
    return rows.select(F.coalesce(of("alert_id", "string"), made).alias("alert_id"), kind.alias("alert_type"), "cell", "acq_date", of("frp", "double").alias("frp"))


@query("alert_history_upgrade", "SELECT 'industrial_anomaly|' || cell || '|' || acq_date AS alert_id, 'industrial_anomaly' AS alert_type, cell, acq_date, max(frp) AS frp FROM lab WHERE is_anomalous GROUP BY cell, acq_date")
def alert_history_upgrade(s, d):
    old = L.labelled(s, d).where("is_anomalous").groupBy("cell", "acq_date").agg(F.max("frp").alias("frp"))
    return upgrade_alerts(old)


@query("hotspot_records", "SELECT det_id, latitude, longitude, acq_date, frp, bright_ti4, confidence FROM detections WHERE daynight = 'N'")
def hotspot_records(s, d):
    number = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    return view(s, d, "detections").where("daynight = 'N'").select("det_id", "latitude", "longitude", "acq_date", number("frp"), number("bright_ti4"), "confidence")


NESTED = "struct<point:long,scenes:array<struct<date:date,pixels:array<struct<px:int,scl:int>>>>>"


def flatten_scenes(text: DataFrame) -> DataFrame:
    """(point_id, scene_date, px, scl) from ``value``: JSON of a point's scenes with their pixels. Points without scenes and scenes
    without pixels keep a row."""
    points = text.select(F.from_json("value", NESTED).alias("p")).select(F.col("p.point").alias("point_id"), F.explode_outer("p.scenes").alias("s"))
    return points.select("point_id", F.col("s.date").alias("scene_date"), F.explode_outer("s.pixels").alias("x")).select("point_id", "scene_date", "x.px", "x.scl")


@query("nested_json", "SELECT point_id, scene_date, px::INT AS px, scl FROM scenes")
def nested_json(s, d):
    pixels = view(s, d, "scenes").groupBy("point_id", "scene_date").agg(F.collect_list(F.struct(F.col("px").cast("int").alias("px"), "scl")).alias("pixels"))
    points = pixels.groupBy("point_id").agg(F.collect_list(F.struct(F.col("scene_date").alias("date"), "pixels")).alias("scenes"))
    return flatten_scenes(points.select(F.to_json(F.struct(F.col("point_id").alias("point"), "scenes")).alias("value")))


_KEPT = ["latitude", "longitude", "acq_date", "acq_time", "satellite", "frp", "landcover_class", "recurrence_count", "is_anomalous", "label", "label_source"]


@query("contract_projection", f"SELECT {', '.join(_KEPT)} FROM lab")
def contract_projection(s, d):
    """The labelled table written in the contract's columns, order and types, older dates as CSV, the others as Parquet by month, and read back."""
    folder, rows = new_folder(s, "contract"), L.contract(L.labelled(s, d))
    rows.where(F.col("acq_date") < BATCH).write.option("header", True).csv(f"{folder}/old")
    rows.where(F.col("acq_date") >= BATCH).withColumn("month", F.substring("acq_date", 1, 7)).write.partitionBy("month").parquet(f"{folder}/new")
    old, new = s.read.schema(rows.schema).option("header", True).csv(f"{folder}/old"), s.read.schema(rows.schema).parquet(f"{folder}/new").drop("month")
    assert old.columns == new.columns == CONTRACT_COLUMNS
    return old.unionByName(new).select(*_KEPT)


@query("map_meta", """SELECT count(*) AS points, min(acq_date) AS base_date, max(acq_date) AS last_date, """ + ", ".join(f"count(*) FILTER (WHERE label = '{c}') AS \"{c}\"" for c in CLASSES) + ", " + ", ".join(
    f"count(*) FILTER (WHERE label_source = '{c}') AS \"from_{c}\"" for c in ("rule", "conflict", "unknown")) + " FROM lab")
def map_meta(s, d):
    sources = [F.count_if(F.col("label_source") == c).alias(f"from_{c}") for c in ("rule", "conflict", "unknown")]
    return L.labelled(s, d).agg(F.count("*").alias("points"), F.min("acq_date").alias("base_date"), F.max("acq_date").alias("last_date"), *[F.count_if(F.col("label") == c).alias(c) for c in CLASSES], *sources)


def compare_manifest(now: DataFrame, manifest: DataFrame) -> DataFrame:
    """(name, status) of the files of either side; both have name, size and sha256."""
    a, b = now.alias("a"), manifest.alias("b")
    status = (
        F.when(F.col("a.name").isNull(), "missing").when(F.col("b.name").isNull(), "extra").when(F.col("a.size") != F.col("b.size"), "size")
        .when(F.col("a.sha256") != F.col("b.sha256"), "checksum").otherwise("ok")
    )
    return a.join(b, F.col("a.name") == F.col("b.name"), "full").select(F.coalesce("a.name", "b.name").alias("name"), status.alias("status"))


# Texts, labels and rules one by one


@query("clean_text", "SELECT feature_id, CASE WHEN lower(trim(coalesce(industrial, ''))) = 'nan' THEN '' ELSE lower(trim(coalesce(industrial, ''))) END AS tag FROM context_boxes")
def clean_text(s, d):
    odd = F.when(F.col("feature_id") % 20 == 0, F.concat(F.lit("  "), F.upper("industrial"), F.lit(" "))).otherwise(F.col("industrial"))
    nan = F.when(F.col("industrial").isNull() & (F.col("feature_id") % 40 == 10), " NaN").otherwise(odd)
    return view(s, d, "context_boxes").select("feature_id", S.clean_text(nan).alias("tag"))


for _name, _rule, _flag in (("rule_gas_flare", rules.gas_flare, "is_flare"), ("rule_industrial", rules.industrial, "is_industrial")):
    query(_name, f"SELECT det_id, {_flag} AS matches FROM ruled")(lambda s, d, rule=_rule: L.labelled(s, d).select("det_id", rule().alias("matches")))


@query("rule_natural", "SELECT det_id, is_crop AS burning, is_wild AS wildfire FROM ruled")
def rule_natural(s, d):
    return L.labelled(s, d).select("det_id", rules.agricultural_burning().alias("burning"), rules.wildfire().alias("wildfire"))


@query("class_lookup", f"SELECT label, list_position([{sql_list(CLASSES)}], label) - 1 AS display_order, count(*) AS n FROM lab GROUP BY label")
def class_lookup(s, d):
    order = s.createDataFrame(list(enumerate(CLASSES)), "display_order int, label string")
    return L.labelled(s, d).groupBy("label").agg(F.count("*").alias("n")).join(F.broadcast(order), "label").select("label", "display_order", "n")


_LISTED = "SELECT acq_date, floor(det_id / 1000) AS part, sha256(string_agg(label, chr(10) ORDER BY det_id)) AS hash FROM {rows} GROUP BY ALL"
_FINGERPRINT = "SELECT acq_date, sha256(string_agg(hash, chr(10) ORDER BY part)) AS fingerprint FROM ({}) t GROUP BY acq_date"


def label_fingerprint(rows: DataFrame) -> DataFrame:
    """(acq_date, fingerprint): the hash of the hashes of a day's labels in the order of det_id, a thousand ids at most in each."""
    in_order = lambda key, value: F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct(key, value))), lambda p: p[value]))
    parts = rows.groupBy("acq_date", F.floor(F.col("det_id") / 1000).alias("part")).agg(F.sha2(in_order("det_id", "label"), 256).alias("hash"))
    return parts.groupBy("acq_date").agg(F.sha2(in_order("part", "hash"), 256).alias("fingerprint"))


@query("label_fingerprint", _FINGERPRINT.format(_LISTED.format(rows="lab")))
def label_fingerprint_query(s, d):
    return label_fingerprint(L.labelled(s, d))


@query("label_invariance", f"SELECT acq_date, a.fingerprint = b.fingerprint AS same FROM ({_FINGERPRINT.format(_LISTED.format(rows='lab'))}) a JOIN ({_FINGERPRINT.format(_LISTED.format(rows='lab_s'))}) b USING (acq_date)")
def label_invariance(s, d):
    """Whether joining regions to the detections left every day's labels as they were."""
    before, after = label_fingerprint(L.labelled(s, d)), label_fingerprint(L.labelled_by_region(s, d))
    return before.join(after.withColumnRenamed("fingerprint", "after"), "acq_date", "full").select("acq_date", F.col("fingerprint").eqNullSafe(F.col("after")).alias("same"))


@query("alert_list", f"""SELECT alert_id, alert_type, try_cast(b.acq_date AS DATE) AS day, latitude, longitude FROM ({A._BUILT}) b
  WHERE alert_type IN ('industrial_anomaly', 'critical_site') AND isfinite(latitude) AND isfinite(longitude)""")
def alert_list(s, d):
    """What a list of alerts shows: two types, with a date and finite coordinates, newest first."""
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    rows = A.build_alerts(s, d).where(F.col("alert_type").isin("industrial_anomaly", "critical_site")).where(finite("latitude") & finite("longitude"))
    return rows.select("alert_id", "alert_type", F.col("acq_date").try_cast("date").alias("day"), "latitude", "longitude").orderBy(F.desc("day"), "alert_id")


@query("sample_context_join", "SELECT sample_id, round(dist_to_industrial_m, 2) AS dist_to_industrial_m, osm_industrial_tag FROM gold LEFT JOIN around USING (latitude, longitude)")
def sample_context_join(s, d):
    around = L.add_context(s, d).select("latitude", "longitude", "dist_to_industrial_m", "osm_industrial_tag").distinct()
    return view(s, d, "gold").join(around, ["latitude", "longitude"], "left").select("sample_id", F.round("dist_to_industrial_m", 2).alias("dist_to_industrial_m"), "osm_industrial_tag")


@query("median_mad", "SELECT cell, med, median(abs(frp - med)) AS mad FROM (SELECT cell, frp, median(frp) OVER (PARTITION BY cell) AS med FROM det WHERE frp IS NOT NULL) t GROUP BY cell, med")
def median_mad(s, d):
    rows = det(s, d).where("frp IS NOT NULL").select("cell", "frp")
    middle = rows.groupBy("cell").agg(F.percentile("frp", F.lit(0.5)).alias("med"))
    return rows.join(middle, "cell").groupBy("cell", "med").agg(F.percentile(F.abs(F.col("frp") - F.col("med")), F.lit(0.5)).alias("mad"))


def landcover_raster(s, d) -> Raster:
    """Pixels of half a grid cell in tiles of 100 by 100, written once for an application and input folder."""
    key = (s.sparkContext.applicationId, d)
    if key not in _rasters:
        _rasters[key] = Raster(s, new_folder(s, "landcover"), 0.0017, 100)
        _rasters[key].write(view(s, d, "landcover_pixels"))
    return _rasters[key]


_rasters: dict[tuple[str, str], Raster] = {}
_PIXEL = "CAST(floor(round({} / 0.0017::DOUBLE, 9)) AS BIGINT)"


def _positions(rows: DataFrame) -> DataFrame:
    return rows.select(F.struct("latitude", "longitude").alias("pid"), "latitude", "longitude").distinct()


@query("landcover_point", f"""SELECT det_id, CASE WHEN value <> 0 THEN value END AS landcover_class FROM detections
  LEFT JOIN landcover_pixels ON row = {_PIXEL.format('latitude')} AND col = {_PIXEL.format('longitude')}""")
def landcover_point(s, d):
    """The class of each detection's own pixel; null without data."""
    rows = view(s, d, "detections").select("det_id", "latitude", "longitude")
    found = landcover_raster(s, d).at(_positions(rows))
    return rows.join(L._by_place(found), ["latitude", "longitude"], "left").select("det_id", F.col("value").alias("landcover_class"))


#: Metres around a position whose most frequent class is taken.
BUFFER = 375.0
_HIGH, _WIDE = f"cos(radians(latitude)) * {BUFFER} / {DEGREE}", f"{BUFFER} / {DEGREE}"


@query("landcover_majority", f"""SELECT latitude, longitude, arg_min(value, (-n) * 1000 + value) AS majority FROM (SELECT p.latitude, p.longitude, l.value, count(*) AS n FROM (SELECT DISTINCT latitude, longitude FROM detections) p
  JOIN landcover_pixels l ON l.row BETWEEN {_PIXEL.format(f'(latitude - {_HIGH})')} AND {_PIXEL.format(f'(latitude + {_HIGH})')}
  AND l.col BETWEEN {_PIXEL.format(f'(longitude - {_WIDE})')} AND {_PIXEL.format(f'(longitude + {_WIDE})')} WHERE l.value <> 0 GROUP BY ALL) t GROUP BY ALL""")
def landcover_majority(s, d):
    """The most frequent class around each position, ties to the smaller code; pixels without data don't count."""
    found = landcover_raster(s, d).majority(_positions(view(s, d, "detections")), BUFFER)
    return L._by_place(found).select("latitude", "longitude", F.col("value").alias("majority"))


SWEEP = [("recurrence_count", 2.0), ("recurrence_count", 5.0), ("recurrence_count", 10.0), ("frp", 5.0), ("frp", 20.0), ("prior_active_days", 5.0)]


@query("threshold_sweep", " UNION ALL ".join(f"SELECT '{c}' AS signal, {t}::DOUBLE AS threshold, label, count(*) FILTER (WHERE {c} >= {t}) AS hits, count(*) AS n FROM lab GROUP BY label" for c, t in SWEEP))
def threshold_sweep(s, d):
    tried = F.inline(F.array(*[F.struct(F.lit(c).alias("signal"), F.lit(t).alias("threshold"), F.coalesce(F.col(c) >= t, F.lit(False)).alias("hit")) for c, t in SWEEP]))
    rows = L.labelled(s, d).select("label", tried)
    return rows.groupBy("signal", "threshold", "label").agg(F.count_if("hit").alias("hits"), F.count("*").alias("n"))


def moved(before: DataFrame, after: DataFrame) -> DataFrame:
    """(det_id, old_label, ...): ``after`` with the label that each row had before."""
    return after.join(before.select("det_id", F.col("label").alias("old_label")), "det_id")


@query("relabel_coal", "SELECT det_id, label AS old_label, label, label_source, round(dist_to_coal_mine_m, 2) AS dist_to_coal_mine_m FROM lab")
def relabel_coal(s, d):
    """The coal columns of stored rows, computed anew, and the rules applied again; everything else is kept."""
    stored = L.labelled(s, d).drop("dist_to_coal_mine_m", "nearest_coal_source", "label", "label_source")
    coal = L._by_place(L.nearest_coal(L.places(stored), L.facilities(s, d), L.context(s, d)))
    again = moved(L.labelled(s, d), rules.apply_rules(stored.join(coal, ["latitude", "longitude"], "left")))
    return again.select("det_id", "old_label", "label", "label_source", F.round("dist_to_coal_mine_m", 2).alias("dist_to_coal_mine_m"))


_STALE = "CASE WHEN is_industrial AND det_id % 3 = 0 THEN 'unknown' ELSE label END"


@query("relabel_industrial", f"SELECT {_STALE} AS old_label, label, count(*) AS n FROM lab GROUP BY ALL")
def relabel_industrial(s, d):
    """Rows by the label that was stored (of every third industrial one a stale one) and the one that its new distance and tag give: off the diagonal are the moved ones."""
    rows = L.labelled(s, d)
    stale = rows.withColumn("label", F.when(rules.industrial() & (F.col("det_id") % 3 == 0), "unknown").otherwise(F.col("label")))
    stored = stale.drop("dist_to_industrial_m", "osm_industrial_tag", "label", "label_source")
    points = L.places(stored)
    near, tag = L._by_place(L.feature_distance(points, L.context(s, d), "dist_to_industrial_m")), L._by_place(L.polygon_tag(points, L.context(s, d)))
    again = rules.apply_rules(stored.join(near, ["latitude", "longitude"], "left").join(tag, ["latitude", "longitude"], "left"))
    return moved(stale, again).groupBy("old_label", "label").agg(F.count("*").alias("n"))


@query("reevaluate_alerts", f"""SELECT cell, acq_date, max(frp) AS frp FROM lab WHERE is_anomalous AND label IN ('industrial', 'gas flare') AND acq_date >= '{BATCH}' AND frp >= 3 * baseline_frp GROUP BY ALL""")
def reevaluate_alerts(s, d):
    """Alerts of the stored window by a stricter definition: baselines still come from strictly earlier days of all rows."""
    rows = det(s, d)
    judged = H.with_anomaly(rows.where(F.col("acq_date") >= BATCH), rows).join(L.labelled(s, d).select("det_id", "label"), "det_id")
    hot = F.col("is_anomalous") & F.col("label").isin("industrial", "gas flare") & (F.col("frp") >= 3 * F.col("baseline_frp"))
    return judged.where(hot).groupBy("cell", "acq_date").agg(F.max("frp").alias("frp"))


@query("pilot_report", "SELECT state, label, n, round(100.0 * n / sum(n) OVER (PARTITION BY state), 3)::DOUBLE AS share FROM (SELECT coalesce(state, 'outside') AS state, label, count(*) AS n FROM lab_s GROUP BY ALL) t")
def pilot_report(s, d):
    counts = L.labelled_by_region(s, d).groupBy(F.coalesce("state", F.lit("outside")).alias("state"), "label").agg(F.count("*").alias("n"))
    totals = counts.groupBy("state").agg(F.sum("n").alias("total"))
    return counts.join(totals, "state").select("state", "label", "n", F.round(F.lit(100.0) * F.col("n") / F.col("total"), 3).alias("share"))


@query("export_tables", "SELECT 'points' AS name, count(*) AS n FROM lab_s UNION ALL SELECT 'cube', count(*) FROM (SELECT DISTINCT acq_date, label, state FROM lab_s) a UNION ALL SELECT 'facilities', count(*) FROM facilities")
def export_tables(s, d):
    """The site's tables, each written by itself; what is stored is counted."""
    rows = L.labelled_by_region(s, d)
    tables = {
        "points": rows.select("det_id", "latitude", "longitude", "acq_date", "label", "is_anomalous", "state"),
        "cube": rows.groupBy("acq_date", "label", "state").agg(F.count("*").alias("n"), F.count_if("is_anomalous").alias("anomalous")),
        "facilities": view(s, d, "facilities"),
    }
    stored = []
    for name, table in tables.items():
        folder = new_folder(s, f"export-{name}")
        table.write.parquet(folder)
        stored.append(s.read.schema(table.schema).parquet(folder).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n"))
    return reduce(DataFrame.unionByName, stored)


@query("burn_evidence", """SELECT sample_id, coalesce(trim(osm_industrial_tag), '') = '' AND coalesce(dist_to_flare_capable_m > 1000, true) AND coalesce(dist_to_heat_industry_m > 2000, true) AS dnbr_informative
  FROM gold LEFT JOIN around USING (latitude, longitude)""")
def burn_evidence(s, d):
    """Which samples a burn index can tell anything about."""
    around = L.add_context(s, d).select("latitude", "longitude", "osm_industrial_tag", "dist_to_flare_capable_m", "dist_to_heat_industry_m").distinct()
    beyond = lambda c, m: F.coalesce(F.col(c) > m, F.lit(True))
    informative = (F.coalesce(F.trim("osm_industrial_tag"), F.lit("")) == "") & beyond("dist_to_flare_capable_m", 1_000) & beyond("dist_to_heat_industry_m", 2_000)
    return view(s, d, "gold").join(around, ["latitude", "longitude"], "left").select("sample_id", informative.alias("dnbr_informative"))


def wilson(hits: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of the 95 % interval of hits / n; null for no rows."""
    size = F.when(n > 0, n.cast("double"))
    p = hits / size
    middle, spread = p + z * z / (2 * size), z * F.sqrt(p * (1 - p) / size + z * z / (4 * size * size))
    return (middle - spread) / (1 + z * z / size), (middle + spread) / (1 + z * z / size)


_W = "(h::DOUBLE / n + 1.9208 / n {sign} 1.96 * sqrt(h::DOUBLE / n * (1 - h::DOUBLE / n) / n + 0.9604 / n / n)) / (1 + 3.8416 / n)"


@query("gold_wilson", f"SELECT label, n, h AS hits, round({_W.format(sign='-')}, 6)::DOUBLE AS low, round({_W.format(sign='+')}, 6)::DOUBLE AS high FROM (SELECT label, count(*) AS n, count(*) FILTER (WHERE label = verified_label) AS h FROM gold WHERE verified_label <> 'uncertain' GROUP BY label) t")
def gold_wilson(s, d):
    rows = view(s, d, "gold").where("verified_label <> 'uncertain'").groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.col("label") == F.col("verified_label")).alias("hits"))
    low, high = wilson(F.col("hits"), F.col("n"))
    return rows.select("label", "n", "hits", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))
