"""Registered queries and, for each, SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..contract import CLASSES, CONFIDENCE_ORDINAL, DRAW_ORDER, FACILITY_SUBTYPE, FLARE_TYPES, HEAT_TYPES, LANDCOVER_NAMES, NEVER_DUG, REQUIRED_COLUMNS
from ..fixtures import view
from ..functions import scalars as S
from ..operators import history as H, spatial
from ..stores import new_folder
from . import labels as L
from .oracle import oracle, sql_list

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = oracle(sql)
        return f

    return add


def det(spark, d):
    return H.with_grid(view(spark, d, "detections"))


def numbered(rows: DataFrame, date: str, *order: str) -> DataFrame:
    """``rows`` with ``row_id``, gapless from 0 by date and ``order``: dates are counted first, so that each date
    is numbered by itself."""
    dates = rows.groupBy(date).agg(F.count("*").alias("rows_of_date"))
    before = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    offsets = dates.select(date, F.coalesce(F.sum("rows_of_date").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy(date).orderBy(*order))
    return rows.join(offsets, date).withColumn("row_id", F.col("offset") + within - 1).drop("offset")


BATCH = "2024-01-25"
R2 = lambda c: F.round(F.col(c), 2).alias(c)
CASE_CODE = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(CLASSES))
DRAW_CODE = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(DRAW_ORDER))

# Scans, sources and sinks


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    """Detections from CSV or Parquet, by the path's extension."""
    kinds = {"bright_ti4": "double", "bright_ti5": "double", "frp": "double", "latitude": "double", "longitude": "double"}
    schema = "det_id long, " + ", ".join(f"{c} {kinds.get(c, 'string')}" for c in REQUIRED_COLUMNS)
    if path.endswith(".csv"):
        return spark.read.schema(schema).option("header", True).csv(path)
    return spark.read.schema(schema).parquet(path)


@query("scan_detections", f"SELECT {', '.join(['det_id', *REQUIRED_COLUMNS])} FROM detections")
def scan_detections(s, d):
    """The detections, landed in two files of different kinds and read by their extension."""
    rows, folder = view(s, d, "detections").select("det_id", *REQUIRED_COLUMNS), new_folder(s, "pull")
    rows.where(F.col("acq_date") < BATCH).write.option("header", True).csv(f"{folder}/old.csv")
    rows.where(F.col("acq_date") >= BATCH).write.parquet(f"{folder}/new.parquet")
    return read_detections(s, f"{folder}/old.csv").unionByName(read_detections(s, f"{folder}/new.parquet"))


@query("bbox_filter", "SELECT det_id, latitude, longitude FROM detections WHERE latitude BETWEEN 21.3 AND 22.0 AND longitude BETWEEN 70.6 AND 71.2")
def bbox_filter(s, d):
    return view(s, d, "detections").where(F.col("latitude").between(21.3, 22.0) & F.col("longitude").between(70.6, 71.2)).select("det_id", "latitude", "longitude")


@query("normalize_raw", "SELECT det_id, substr(acq_date, 1, 10) AS acq_date, lpad(acq_time, 4, '0') AS acq_time FROM detections")
def normalize_raw(s, d):
    raw = view(s, d, "detections").withColumn("acq_time", F.concat(F.col("acq_time").cast("int").cast("string"), F.lit(".0")))
    return raw.select("det_id", F.substring("acq_date", 1, 10).alias("acq_date"), S.clean_time(F.col("acq_time")).alias("acq_time"))


@query("finalize_pull", f"SELECT DISTINCT {', '.join(REQUIRED_COLUMNS)} FROM detections WHERE acq_date BETWEEN '2024-01-05' AND '2024-01-20'")
def finalize_pull(s, d):
    pull = view(s, d, "detections").select(*REQUIRED_COLUMNS)
    return pull.unionByName(pull.where("satellite = 'N'")).where(F.col("acq_date").between("2024-01-05", "2024-01-20")).distinct().orderBy("acq_date", "acq_time", "satellite")


_COVER = "SELECT satellite, source, pref, unnest(generate_series(min_date, max_date, INTERVAL 1 DAY))::DATE AS day FROM availability"
_PICK = f"SELECT satellite, day, arg_min(source, pref) AS source FROM ({_COVER}) t GROUP BY ALL"


def _coverage(s, d):
    days = view(s, d, "availability").withColumn("day", F.explode(F.sequence("min_date", "max_date")))
    return days.groupBy("satellite", "day").agg(F.min_by("source", "pref").alias("source"))


@query("coverage_segments", f"""SELECT satellite, source, min(day) AS first_day, max(day) AS last_day FROM (
  SELECT *, day - row_number() OVER (PARTITION BY satellite, source ORDER BY day)::INT AS run FROM ({_PICK}) p) q GROUP BY satellite, source, run""")
def coverage_segments(s, d):
    run = F.date_sub("day", F.row_number().over(Window.partitionBy("satellite", "source").orderBy("day")))
    return _coverage(s, d).withColumn("run", run).groupBy("satellite", "source", "run").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day")).drop("run")


@query("coverage_gaps", f"SELECT satellite, count(*) AS days_covered, 31 AS days_requested FROM ({_PICK}) p GROUP BY satellite HAVING count(*) < 31")
def coverage_gaps(s, d):
    return _coverage(s, d).groupBy("satellite").agg(F.count("*").alias("days_covered")).withColumn("days_requested", F.lit(31)).where("days_covered < days_requested")


#: Names under which tables give a facility's place.
ALIASES = {"latitude": ["latitude", "lat"], "longitude": ["longitude", "lon", "lng", "long"]}


def load_facilities(rows: DataFrame) -> DataFrame:
    """``rows`` with latitude and longitude under their own names, those without a place dropped; the type is facility_type, else type, else industrial."""
    by_name = {c.strip().lower(): c for c in rows.columns}
    for name, aliases in ALIASES.items():
        found = next((by_name[a] for a in aliases if a in by_name), None)
        if found is None:
            raise ValueError(f"no column for {name} among {rows.columns}")
        rows = rows.withColumnRenamed(found, name)
    types = [F.col(by_name[c]) for c in ("facility_type", "type") if c in by_name]
    return rows.dropna(subset=["latitude", "longitude"]).withColumn("facility_type", F.coalesce(*types, F.lit("industrial")))


@query("load_facilities", "SELECT facility_id, coalesce(CASE WHEN facility_id % 5 <> 0 THEN facility_type END, 'industrial') AS facility_type, latitude, longitude FROM facilities WHERE facility_id % 7 <> 0")
def load_facilities_query(s, d):
    """Facilities from a table with other column names, places and types missing."""
    rows = view(s, d, "facilities").select("facility_id", F.when(F.col("facility_id") % 7 != 0, F.col("latitude")).alias("Lat"), F.col("longitude").alias("lng"), F.when(F.col("facility_id") % 5 != 0, F.col("facility_type")).alias("type"))
    return load_facilities(rows).select("facility_id", "facility_type", "latitude", "longitude")


@query("coal_mine_points", f"SELECT facility_id, status, area_km2 FROM facilities WHERE facility_type = 'coal_mine' AND NOT coalesce(lower(status) IN ({sql_list(NEVER_DUG)}), false)")
def coal_mine_points(s, d):
    return L.coal_mines(view(s, d, "facilities")).select("facility_id", "status", "area_km2")


@query("context_subsets", """SELECT feature_id, 'mine' AS subset FROM context_boxes WHERE industrial = 'mine'
  UNION ALL SELECT feature_id, 'brick_kiln' FROM context_boxes WHERE industrial = 'brickyard' OR man_made = 'kiln'""")
def context_subsets(s, d):
    c = view(s, d, "context_boxes")
    return c.where("industrial = 'mine'").select("feature_id", F.lit("mine").alias("subset")).unionByName(L.brick_kilns(c).select("feature_id", F.lit("brick_kiln").alias("subset")))


@query("exclude_renewables", "SELECT feature_id, power, plant_source FROM ctx")
def exclude_renewables(s, d):
    return L.context(s, d).select("feature_id", "power", "plant_source")


HISTORY = ["det_id", "latitude", "longitude", "acq_date", "acq_time", "satellite", "frp", "daynight"]


def load_history(spark: SparkSession, historical: str, live: str) -> DataFrame:
    """HISTORY of the historical files and the live monthly partitions, which may lack some columns and have others."""
    return spark.read.option("mergeSchema", True).parquet(historical).select(*HISTORY).unionByName(spark.read.option("mergeSchema", True).parquet(live).select(*HISTORY))


@query("load_history", f"SELECT {', '.join(HISTORY)} FROM detections")
def load_history_query(s, d):
    """Both stores as files of several schemas, read as one table."""
    rows, folder = view(s, d, "detections"), new_folder(s, "history")
    rows.where(F.col("acq_date") < "2024-01-10").drop("bright_ti5").write.parquet(f"{folder}/old/file=1")
    rows.where(F.col("acq_date").between("2024-01-10", "2024-01-24")).write.parquet(f"{folder}/old/file=2")
    live = rows.where(F.col("acq_date") > "2024-01-24").withColumn("label", F.lit("unknown")).withColumn("month", F.substring("acq_date", 1, 7))
    live.write.partitionBy("month").parquet(f"{folder}/live")
    return load_history(s, f"{folder}/old", f"{folder}/live")


@query("union_by_name", """SELECT facility_id AS id, facility_type AS kind, NULL::VARCHAR AS geom_type FROM facilities UNION ALL SELECT feature_id, NULL, geom_type FROM context_boxes""")
def union_by_name(s, d):
    a = view(s, d, "facilities").select(F.col("facility_id").alias("id"), F.col("facility_type").alias("kind"))
    return a.unionByName(view(s, d, "context_boxes").select(F.col("feature_id").alias("id"), "geom_type"), allowMissingColumns=True)


@query("unknown_labels", f"SELECT verified_label AS label, count(*) AS n FROM gold WHERE verified_label NOT IN ({sql_list(CLASSES)}) GROUP BY 1")
def unknown_labels(s, d):
    known = s.createDataFrame([(c,) for c in CLASSES], "label string")
    return view(s, d, "gold").select(F.col("verified_label").alias("label")).join(F.broadcast(known), "label", "left_anti").groupBy("label").agg(F.count("*").alias("n"))


@query("dictionary_encode", "SELECT value, row_number() OVER (ORDER BY value) - 1 AS code FROM (SELECT DISTINCT confidence AS value FROM detections) t")
def dictionary_encode(s, d):
    return view(s, d, "detections").select(F.col("confidence").alias("value")).distinct().withColumn("code", (F.row_number().over(Window.orderBy("value")) - 1).cast("long"))


@query("region_bbox", "SELECT name, min(south) AS south, max(north) AS north, min(west) AS west, max(east) AS east FROM regions GROUP BY name")
def region_bbox(s, d):
    return view(s, d, "regions").groupBy("name").agg(F.min("south").alias("south"), F.max("north").alias("north"), F.min("west").alias("west"), F.max("east").alias("east"))




# Scalar functions


@query("grid_keys", "SELECT det_id, gi, gj FROM det")
def grid_keys(s, d):
    return det(s, d).select("det_id", "gi", "gj")


@query("cell_ids", "SELECT det_id, cell FROM det")
def cell_ids(s, d):
    return det(s, d).select("det_id", "cell")


@query("detection_keys", "SELECT det_id, concat_ws('|', printf('%.5f', round(latitude, 5)), printf('%.5f', round(longitude, 5)), acq_date, acq_time, satellite) AS detection_key FROM detections")
def detection_keys(s, d):
    return view(s, d, "detections").select("det_id", S.detection_key().alias("detection_key"))


@query("project_points", "SELECT det_id, round(x, 2) AS x, round(y, 2) AS y FROM det")
def project_points(s, d):
    return L.projected(view(s, d, "detections")).select("det_id", R2("x"), R2("y"))


@query("haversine", f"SELECT det_id, round({S.haversine_sql('latitude', 'longitude', '21.5::DOUBLE', '71.0::DOUBLE')}, 3) AS km FROM detections")
def haversine(s, d):
    return view(s, d, "detections").select("det_id", F.round(S.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(21.5), F.lit(71.0)), 3).alias("km"))


@query("zone_of", """SELECT det_id, max(zone) AS zone FROM detections LEFT JOIN zones ON latitude BETWEEN south AND north AND longitude BETWEEN west AND east GROUP BY det_id""")
def zone_of(s, d):
    z = view(s, d, "zones")
    inside = F.col("latitude").between(F.col("south"), F.col("north")) & F.col("longitude").between(F.col("west"), F.col("east"))
    return view(s, d, "detections").select("det_id", "latitude", "longitude").join(F.broadcast(z), inside, "left").groupBy("det_id").agg(F.max("zone").alias("zone"))


@query("bbox_around", "SELECT det_id, round(latitude - 250 / 111320.0::DOUBLE, 6) AS south, round(longitude - 250 / (111320.0::DOUBLE * greatest(cos(radians(latitude)), 1e-6)), 6) AS west FROM detections")
def bbox_around(s, d):
    lat, lon = F.col("latitude"), F.col("longitude")
    west = lon - 250 / (F.lit(111320.0) * F.greatest(F.cos(F.radians(lat)), F.lit(1e-6)))
    return view(s, d, "detections").select("det_id", F.round(lat - 250 / 111320.0, 6).alias("south"), F.round(west, 6).alias("west"))


@query("landcover_code", "SELECT gi, gj, class_code AS code FROM landcover_cells")
def landcover_code(s, d):
    text = F.when(F.col("gi") % 2 == 0, F.concat(F.col("class_code").cast("string"), F.lit(".0"))).otherwise(F.col("class_code").cast("string"))
    return view(s, d, "landcover_cells").select("gi", "gj", S.landcover_code(text).alias("code"))


@query("multivalue_any", "SELECT feature_id, coalesce(len(list_filter(string_split(plant_source, ';'), lambda v: trim(v) IN ('coal', 'gas', 'oil', 'diesel', 'nuclear'))) > 0, false) AS thermal FROM context_boxes")
def multivalue_any(s, d):
    return view(s, d, "context_boxes").select("feature_id", S.any_of(F.col("plant_source"), ["coal", "gas", "oil", "diesel", "nuclear"]).alias("thermal"))


@query("first_status", f"SELECT facility_id, lower(trim(string_split(status, ';')[1])) AS status, lower(trim(string_split(status, ';')[1])) IN ({sql_list(NEVER_DUG)}) AS excluded FROM facilities")
def first_status(s, d):
    return view(s, d, "facilities").select("facility_id", S.first_of(F.col("status")).alias("status"), S.first_of(F.col("status")).isin(NEVER_DUG).alias("excluded"))


_KINDS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FACILITY_SUBTYPE.items())


@query("subtype_mapping", f"SELECT facility_id, CASE facility_type {_KINDS} END AS subtype FROM facilities")
def subtype_mapping(s, d):
    return view(s, d, "facilities").select("facility_id", S.lookup(F.col("facility_type"), FACILITY_SUBTYPE).alias("subtype"))


@query("facility_kind", "SELECT facility_id, replace(facility_type, '_', ' ') AS kind FROM facilities")
def facility_kind(s, d):
    return view(s, d, "facilities").select("facility_id", F.replace("facility_type", F.lit("_"), F.lit(" ")).alias("kind"))


@query("shift_dates", "SELECT det_id, CAST(acq_date AS DATE) - 30 AS day FROM detections")
def shift_dates(s, d):
    return view(s, d, "detections").select("det_id", F.date_add(F.col("acq_date").cast("date"), -30).alias("day"))


@query("complete_days", "SELECT DISTINCT acq_date FROM detections WHERE acq_date BETWEEN '2024-01-20' AND '2024-01-27'")
def complete_days(s, d):
    return view(s, d, "detections").select("acq_date").where(F.col("acq_date").between("2024-01-20", "2024-01-27") & (F.col("acq_date") < "2024-01-28")).distinct()


@query("latest_detection", "SELECT max(CAST(acq_date || ' ' || substr(acq_time, 1, 2) || ':' || substr(acq_time, 3, 2) AS TIMESTAMP)) AS latest FROM detections")
def latest_detection(s, d):
    return view(s, d, "detections").agg(F.max(S.sighted(F.col("acq_date"), F.col("acq_time"))).alias("latest"))


@query("ist_time", "SELECT det_id, CAST(acq_date || ' ' || substr(acq_time, 1, 2) || ':' || substr(acq_time, 3, 2) AS TIMESTAMP) + INTERVAL 330 MINUTE AS ist FROM detections")
def ist_time(s, d):
    return view(s, d, "detections").select("det_id", (S.sighted(F.col("acq_date"), F.col("acq_time")) + F.expr("INTERVAL 330 MINUTES")).alias("ist"))


@query("confidence_ordinal", "SELECT det_id, CASE confidence WHEN 'l' THEN 0 WHEN 'n' THEN 1 WHEN 'h' THEN 2 WHEN 'high' THEN 2 ELSE 1 END AS confidence_ordinal FROM detections")
def confidence_ordinal(s, d):
    return view(s, d, "detections").select("det_id", F.coalesce(S.lookup(F.col("confidence"), CONFIDENCE_ORDINAL), F.lit(1)).alias("confidence_ordinal"))


@query("numeric_sentinel", "SELECT det_id, coalesce(frp, -1) AS frp, (frp IS NULL)::INT::DOUBLE AS frp_missing, coalesce(bright_ti4, -1) AS bright_ti4, (bright_ti4 IS NULL)::INT::DOUBLE AS bright_ti4_missing FROM detections")
def numeric_sentinel(s, d):
    pairs = [x for c in ("frp", "bright_ti4") for x in (F.coalesce(c, F.lit(-1.0)).alias(c), F.col(c).isNull().cast("int").cast("double").alias(f"{c}_missing"))]
    return view(s, d, "detections").select("det_id", *pairs)


@query("nbr_index", "SELECT point_id, scene_date, px, scl IN (4, 5, 6, 7) AS valid, round(CASE WHEN b08 + b12 = 0 THEN 0 ELSE (b08 - b12) / (b08 + b12) END, 6) AS nbr FROM scenes")
def nbr_index(s, d):
    total = F.col("b08") + F.col("b12")
    nbr = F.when(total == 0, 0.0).otherwise((F.col("b08") - F.col("b12")) / F.when(total != 0, total))
    return view(s, d, "scenes").select("point_id", "scene_date", "px", F.col("scl").isin(4, 5, 6, 7).alias("valid"), F.round(nbr, 6).alias("nbr"))


@query("maps_link", "SELECT sample_id, 'https://www.google.com/maps?q=' || printf('%.5f', latitude) || ',' || printf('%.5f', longitude) || '&t=k' AS maps_link FROM gold")
def maps_link(s, d):
    return view(s, d, "gold").select("sample_id", F.concat(F.lit("https://www.google.com/maps?q="), S.five_decimals(F.col("latitude")), F.lit(","), S.five_decimals(F.col("longitude")), F.lit("&t=k")).alias("maps_link"))


@query("landcover_name", "SELECT gi, gj, CASE class_code " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in LANDCOVER_NAMES.items()) + " END AS name FROM landcover_cells")
def landcover_name(s, d):
    return view(s, d, "landcover_cells").select("gi", "gj", S.lookup(F.col("class_code"), LANDCOVER_NAMES).alias("name"))


# Spatial joins


@query("polygon_tag", "SELECT det_id, tag AS osm_industrial_tag FROM det JOIN n_tag USING (latitude, longitude)")
def polygon_tag(s, d):
    rows = L.detections(s, d)
    return rows.join(L._by_place(L.polygon_tag(L.places(rows), L.context(s, d))), ["latitude", "longitude"]).select("det_id", "osm_industrial_tag")


@query("assign_state", "SELECT det_id, state FROM detections LEFT JOIN placed USING (latitude, longitude)")
def assign_state(s, d):
    return L.with_region(view(s, d, "detections"), L.boundary(s, d)).select("det_id", "state")


@query("clip_boundary", f"""SELECT det_id, CASE WHEN state IS NULL THEN 'offshore' ELSE 'land' END AS side, zone FROM detections LEFT JOIN placed USING (latitude, longitude) LEFT JOIN (
  SELECT det_id, max(zone) AS zone FROM detections JOIN zones ON latitude BETWEEN south AND north AND longitude BETWEEN west AND east GROUP BY det_id) z USING (det_id)
  WHERE state IS NOT NULL OR zone IS NOT NULL""")
def clip_boundary(s, d):
    """Rows within the boundary, and rows outside of it that are in a zone at sea, which are tagged."""
    rows = L.with_region(view(s, d, "detections"), L.boundary(s, d))
    inside = F.col("latitude").between(F.col("south"), F.col("north")) & F.col("longitude").between(F.col("west"), F.col("east"))
    zoned = view(s, d, "detections").join(F.broadcast(view(s, d, "zones")), inside).groupBy("det_id").agg(F.max("zone").alias("zone"))
    side = F.when(F.col("state").isNull(), "offshore").otherwise("land").alias("side")
    return rows.join(zoned, "det_id", "left").where("state IS NOT NULL OR zone IS NOT NULL").select("det_id", side, "zone")


def _placed(name, column, sql):
    def add(f):
        def run(s, d):
            rows = L.detections(s, d)
            found = L._by_place(f(L.places(rows), L.facilities(s, d), L.context(s, d)))
            texts = [c for c, t in found.dtypes if t == "string"]
            return rows.join(found, ["latitude", "longitude"]).select("det_id", R2(column), *texts)

        return query(name, sql)(run)

    return add


_placed("nearest_industrial", "dist_to_industrial_m", "SELECT det_id, round(d, 2) AS dist_to_industrial_m FROM det JOIN n_ind USING (latitude, longitude)")(
    lambda p, sites, c: L.feature_distance(p, c, "dist_to_industrial_m")
)
_placed("nearest_feature", "dist_to_brick_kiln_m", "SELECT det_id, round(d, 2) AS dist_to_brick_kiln_m FROM det JOIN n_kiln USING (latitude, longitude)")(
    lambda p, sites, c: L.feature_distance(p, L.brick_kilns(c), "dist_to_brick_kiln_m")
)
_placed("nearest_facility_flare", "dist_to_flare_capable_m", "SELECT det_id, round(d, 2) AS dist_to_flare_capable_m, kind AS nearest_flare_facility_type FROM det JOIN n_flare USING (latitude, longitude)")(
    lambda p, sites, c: L.nearest_facility(p, sites, FLARE_TYPES, "dist_to_flare_capable_m", "nearest_flare_facility_type")
)
_placed("nearest_facility_heat", "dist_to_heat_industry_m", "SELECT det_id, round(d, 2) AS dist_to_heat_industry_m, kind AS nearest_heat_facility_type FROM det JOIN n_heat USING (latitude, longitude)")(
    lambda p, sites, c: L.nearest_facility(p, sites, HEAT_TYPES, "dist_to_heat_industry_m", "nearest_heat_facility_type")
)
_placed("nearest_coal", "dist_to_coal_mine_m", "SELECT det_id, round(dist_to_coal_mine_m, 2) AS dist_to_coal_mine_m, nearest_coal_source FROM det JOIN around USING (latitude, longitude)")(
    lambda p, sites, c: L.nearest_coal(p, sites, c)
)


@query("tile_for_point", "SELECT det_id, (floor(longitude / 3) * 3)::INT AS tile_lon, (floor(latitude / 3) * 3)::INT AS tile_lat FROM detections")
def tile_for_point(s, d):
    return view(s, d, "detections").select("det_id", (F.floor(F.col("longitude") / 3) * 3).cast("int").alias("tile_lon"), (F.floor(F.col("latitude") / 3) * 3).cast("int").alias("tile_lat"))


_KEY = ["latitude", "longitude", "acq_date", "acq_time", "satellite"]


@query("dedupe_against_store", f"SELECT det_id FROM detections n WHERE acq_date >= '2024-01-24' AND NOT EXISTS (SELECT 1 FROM detections o WHERE o.acq_date < '{BATCH}' AND {' AND '.join(f'o.{k} = n.{k}' for k in _KEY)})")
def dedupe_against_store(s, d):
    rows = view(s, d, "detections")
    stored = rows.where((F.col("acq_date") < BATCH) & (F.col("acq_date") >= "2024-01-24")).select(*_KEY)
    return rows.where(F.col("acq_date") >= "2024-01-24").join(stored, _KEY, "left_anti").select("det_id")


@query("dedupe_first", f"SELECT det_id FROM (SELECT det_id, row_number() OVER (PARTITION BY {', '.join(_KEY)} ORDER BY det_id) AS n FROM detections) t WHERE n = 1")
def dedupe_first(s, d):
    return view(s, d, "detections").withColumn("n", F.row_number().over(Window.partitionBy(*_KEY).orderBy("det_id"))).where("n = 1").select("det_id")


@query("semi_join_cells", f"SELECT det_id FROM det WHERE (gi, gj) IN (SELECT (gi, gj) FROM det WHERE acq_date >= '{BATCH}')")
def semi_join_cells(s, d):
    rows = det(s, d)
    return rows.join(rows.where(F.col("acq_date") >= BATCH).select("gi", "gj").distinct(), ["gi", "gj"], "left_semi").select("det_id")


_GC = "round_even(latitude / 0.0034::DOUBLE, 0)::BIGINT || '_' || round_even(longitude / 0.0034::DOUBLE, 0)::BIGINT"


@query("exclude_gold_cells", f"SELECT det_id FROM det WHERE cell NOT IN (SELECT {_GC} FROM gold)")
def exclude_gold_cells(s, d):
    return det(s, d).join(H.with_grid(view(s, d, "gold")).select("cell").distinct(), "cell", "left_anti").select("det_id")


@query("gold_join", "SELECT sample_id, label, verified_label, label = verified_label AS agrees FROM gold")
def gold_join(s, d):
    g = view(s, d, "gold")
    return g.select("sample_id", "label").join(g.select("sample_id", "verified_label"), "sample_id").withColumn("agrees", F.col("label") == F.col("verified_label"))


# History


@query("recurrence", "SELECT det_id, recurrence_count, first_seen, last_seen FROM det JOIN rec USING (gi, gj)")
def recurrence(s, d):
    return H.with_recurrence(det(s, d)).select("det_id", "recurrence_count", "first_seen", "last_seen")


@query("causal_recurrence", """SELECT a.det_id, count(DISTINCT b.acq_date) AS recurrence_count, min(b.acq_date) AS first_seen, a.acq_date AS last_seen FROM det a JOIN det b ON a.gi = b.gi AND a.gj = b.gj
  AND b.acq_date <= a.acq_date AND CAST(b.acq_date AS DATE) >= CAST(a.acq_date AS DATE) - 7 GROUP BY a.det_id, a.acq_date""")
def causal_recurrence(s, d):
    rows = det(s, d)
    return rows.join(H.causal_recurrence(rows, 7), ["gi", "gj", "acq_date"]).select("det_id", "recurrence_count", "first_seen", "last_seen")


@query("daily_max_frp", "SELECT * FROM daily")
def daily_max_frp(s, d):
    return H.daily_max(det(s, d))


@query("anomaly_baselines", "SELECT det_id, is_anomalous, baseline_frp, prior_active_days FROM feat")
def anomaly_baselines(s, d):
    return H.with_anomaly(det(s, d)).select("det_id", "is_anomalous", "baseline_frp", "prior_active_days")


@query("is_anomalous", "SELECT det_id FROM feat WHERE is_anomalous")
def is_anomalous(s, d):
    return H.with_anomaly(det(s, d)).where("is_anomalous").select("det_id")


_NB = """SELECT a.det_id, count(DISTINCT b.acq_date) AS active_days FROM det a LEFT JOIN det b ON abs(a.gi - b.gi) <= 1 AND abs(a.gj - b.gj) <= 1
  AND CAST(b.acq_date AS DATE) BETWEEN CAST(a.acq_date AS DATE) - {lo} AND CAST(a.acq_date AS DATE) - {hi} GROUP BY a.det_id"""


@query("neighbourhood_active_days", _NB.format(lo=7, hi=0))
def neighbourhood_active_days(s, d):
    rows = det(s, d)
    return H.neighbourhood_days(rows, rows, -7, 0).select("det_id", F.col("n").alias("active_days"))


@query("persistent_mask", f"SELECT det_id, active_days > 5 AS persistent FROM ({_NB.format(lo=30, hi=1)}) t")
def persistent_mask(s, d):
    rows = det(s, d)
    return H.neighbourhood_days(rows, rows, -30, -1).select("det_id", (F.col("n") > 5).alias("persistent"))


@query("distinct_cell_days", "SELECT DISTINCT gi, gj, acq_date FROM det")
def distinct_cell_days(s, d):
    return H.distinct_cell_days(det(s, d))


@query("neighbourhood_spread", "SELECT DISTINCT gi + i AS gi, gj + j AS gj, acq_date FROM det, (SELECT unnest([-1, 0, 1]) AS i) a, (SELECT unnest([-1, 0, 1]) AS j) b")
def neighbourhood_spread(s, d):
    return H.spread(H.distinct_cell_days(det(s, d)))


@query("cell_profile", """SELECT cell, round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude, max(zone) AS zone, count(*) AS detections, count(DISTINCT acq_date) AS active_days, round(avg((daynight = 'N')::INT), 4) AS night_share,
  median(frp) AS frp_median, string_agg(DISTINCT acq_date, ',' ORDER BY acq_date) AS dates FROM det LEFT JOIN (SELECT det_id, max(zone) AS zone FROM detections JOIN zones ON latitude BETWEEN south AND north AND longitude BETWEEN west AND east GROUP BY det_id) z USING (det_id) GROUP BY cell""")
def cell_profile(s, d):
    inside = F.col("latitude").between(F.col("south"), F.col("north")) & F.col("longitude").between(F.col("west"), F.col("east"))
    zoned = det(s, d).join(F.broadcast(view(s, d, "zones")), inside).groupBy("det_id").agg(F.max("zone").alias("zone"))
    return det(s, d).join(zoned, "det_id", "left").groupBy("cell").agg(
        F.round(F.avg("latitude"), 6).alias("latitude"), F.round(F.avg("longitude"), 6).alias("longitude"), F.max("zone").alias("zone"),
        F.count("*").alias("detections"), F.countDistinct("acq_date").alias("active_days"), F.round(F.avg((F.col("daynight") == "N").cast("int")), 4).alias("night_share"),
        F.percentile("frp", F.lit(0.5)).alias("frp_median"), F.concat_ws(",", F.array_sort(F.collect_set("acq_date"))).alias("dates"),
    )


# Labels and what is counted over them


@query("apply_rules", "SELECT det_id, label, label_source FROM lab")
def apply_rules(s, d):
    return L.labelled(s, d).select("det_id", "label", "label_source")


_DISTANCES = [c for c in ("dist_to_industrial_m", "dist_to_flare_capable_m", "dist_to_heat_industry_m", "dist_to_coal_mine_m", "dist_to_brick_kiln_m")]
_REST = ["osm_industrial_tag", "nearest_flare_facility_type", "nearest_heat_facility_type", "nearest_coal_source", "landcover_class"]


@query("add_context_features", f"SELECT det_id, {', '.join(f'round({c}, 2) AS {c}' for c in _DISTANCES)}, {', '.join(_REST)} FROM feat")
def add_context_features(s, d):
    return L.add_context(s, d).select("det_id", *map(R2, _DISTANCES), *_REST)


@query("build_labels", f"SELECT latitude, longitude, acq_date, acq_time, satellite, {', '.join(f'round({c}, 2) AS {c}' for c in _DISTANCES)}, {', '.join(_REST)}, recurrence_count, first_seen, last_seen, is_anomalous, label, label_source FROM lab")
def build_labels(s, d):
    rows = L.contract(L.labelled(s, d))
    keep = ["latitude", "longitude", "acq_date", "acq_time", "satellite", *_DISTANCES, *_REST, "recurrence_count", "first_seen", "last_seen", "is_anomalous", "label", "label_source"]
    return rows.select(*[R2(c) if c in _DISTANCES else F.col(c) for c in keep])


@query("label_mix", "SELECT label, label_source, count(*) AS n FROM lab GROUP BY ALL")
def label_mix(s, d):
    return L.labelled(s, d).groupBy("label", "label_source").agg(F.count("*").alias("n"))


_PIVOT = ", ".join(f"count(*) FILTER (WHERE label = '{c}') AS \"{c}\"" for c in CLASSES)


@query("label_mix_by_state", f"SELECT coalesce(state, 'outside') AS state, {_PIVOT}, count(*) AS total FROM lab_s GROUP BY 1")
def label_mix_by_state(s, d):
    counts = L.labelled_by_region(s, d).groupBy(F.coalesce("state", F.lit("outside")).alias("state"))
    return counts.agg(*[F.count_if(F.col("label") == c).alias(c) for c in CLASSES], F.count("*").alias("total")).orderBy(F.desc("total"), "state")


@query("stats_cube", "SELECT acq_date, label, state, count(*) AS n, count(*) FILTER (WHERE is_anomalous) AS anomalous FROM lab_s GROUP BY ALL")
def stats_cube(s, d):
    return L.labelled_by_region(s, d).groupBy("acq_date", "label", "state").agg(F.count("*").alias("n"), F.count_if("is_anomalous").alias("anomalous"))


_SETS = "GROUP BY GROUPING SETS ((), (label), (state, label))"


@query("source_counts", f"""SELECT label, state, count(*) AS n, count(*) FILTER (WHERE is_anomalous) AS anomalous, max(acq_date) AS latest,
  count(*) FILTER (WHERE substr(acq_date, 1, 7) = (SELECT max(substr(acq_date, 1, 7)) FROM detections)) AS latest_month FROM lab_s {_SETS}""")
def source_counts(s, d):
    """In all, by class, and by class and state: rows, anomalous ones, the latest date, and rows of the latest month of all."""
    month = F.substring("acq_date", 1, 7)
    last = view(s, d, "detections").agg(F.max(month).alias("last_month"))
    rows = L.labelled_by_region(s, d).join(F.broadcast(last)).select("label", "state", "acq_date", "is_anomalous", (month == F.col("last_month")).alias("is_last"))
    counts = rows.groupingSets([[], ["label"], ["state", "label"]], "label", "state").agg(F.count("*").alias("n"), F.count_if("is_anomalous").alias("anomalous"), F.max("acq_date").alias("latest"), F.count_if("is_last").alias("latest_month"))
    return counts.select("label", "state", "n", "anomalous", "latest", "latest_month")


@query("top_states", "SELECT state, count(*) AS n FROM lab_s WHERE state IS NOT NULL GROUP BY state ORDER BY n DESC, state LIMIT 7")
def top_states(s, d):
    return L.labelled_by_region(s, d).where("state IS NOT NULL").groupBy("state").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "state").limit(7)


@query("daily_timeline", f"SELECT acq_date, {_PIVOT} FROM lab GROUP BY acq_date")
def daily_timeline(s, d):
    return L.labelled(s, d).groupBy("acq_date").agg(*[F.count_if(F.col("label") == c).alias(c) for c in CLASSES])


@query("class_mix", "SELECT label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4)::DOUBLE AS share FROM lab GROUP BY label")
def class_mix(s, d):
    mix = L.labelled(s, d).groupBy("label").agg(F.count("*").alias("n"))
    return mix.withColumn("share", F.round(F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))


@query("landcover_share", """SELECT coalesce(state, 'outside') AS state, label, landcover_class, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY coalesce(state, 'outside'), label)::DOUBLE, 6) AS share FROM lab_s GROUP BY 1, 2, 3
  UNION ALL SELECT 'all', label, landcover_class, count(*), round(count(*) / sum(count(*)) OVER (PARTITION BY label)::DOUBLE, 6) FROM lab_s GROUP BY 1, 2, 3""")
def landcover_share(s, d):
    """How the rows of each class are divided among landcovers, in each state and in all."""
    by_state = L.labelled_by_region(s, d).groupBy(F.coalesce("state", F.lit("outside")).alias("state"), "label", "landcover_class").agg(F.count("*").alias("n"))
    everywhere = by_state.groupBy("label", "landcover_class").agg(F.sum("n").alias("n")).withColumn("state", F.lit("all"))
    counts = by_state.unionByName(everywhere)
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("state", "label")), 6))


@query("industrial_anomaly_alerts", """SELECT det_id, label, frp, baseline_frp, round(frp / nullif(baseline_frp, 0), 3) AS frp_vs_normal, prior_active_days, state, CASE WHEN state IS NULL THEN 'Industrial site' ELSE 'Industrial site · ' || state END AS site
  FROM lab_s WHERE is_anomalous AND label IN ('industrial', 'gas flare') AND frp >= 2 * baseline_frp""")
def industrial_anomaly_alerts(s, d):
    hot = F.col("is_anomalous") & F.col("label").isin("industrial", "gas flare") & (F.col("frp") >= 2 * F.col("baseline_frp"))
    site = F.when(F.col("state").isNull(), "Industrial site").otherwise(F.concat(F.lit("Industrial site · "), "state"))
    ratio = F.round(F.try_divide(F.col("frp"), F.col("baseline_frp")), 3)
    return L.labelled_by_region(s, d).where(hot).select("det_id", "label", "frp", "baseline_frp", ratio.alias("frp_vs_normal"), "prior_active_days", "state", site.alias("site"))


@query("map_points", f"""SELECT row_number() OVER (ORDER BY priority, row_id) - 1 AS point, row_id, longitude::FLOAT::DOUBLE AS longitude, latitude::FLOAT::DOUBLE AS latitude,
  CAST(acq_date AS DATE) - min(CAST(acq_date AS DATE)) OVER () AS day, class_id, anomaly FROM (SELECT *, row_number() OVER (ORDER BY acq_date, det_id) - 1 AS row_id, CASE label {CASE_CODE} END AS class_id,
  CASE label {DRAW_CODE} END AS priority, is_anomalous::INT AS anomaly FROM lab) t""")
def map_points(s, d):
    """All points in the order in which a map draws them, rare classes last: ``point`` is a row's place in it, ``row_id`` its place by date and id, ``day`` counts from the first
    date of all. Positions have single precision. Dates and their classes are counted first, so that each date is numbered by itself; rows without a date are its last."""
    code = lambda values: S.lookup(F.col("label"), {c: i for i, c in enumerate(values)})
    single = lambda c: F.col(c).cast("float").cast("double").alias(c)
    last = lambda *keys: [F.col(k).asc_nulls_last() for k in keys]
    rows = L.labelled(s, d).select("det_id", "acq_date", single("longitude"), single("latitude"), code(CLASSES).alias("class_id"), code(DRAW_ORDER).alias("priority"), F.col("is_anomalous").cast("int").alias("anomaly"))
    before = lambda *keys: F.coalesce(F.sum("n").over(Window.orderBy(*last(*keys)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = rows.groupBy(F.col("acq_date").alias("date"), F.col("priority").alias("class")).agg(F.count("*").alias("n"))
    counts = counts.select("date", "class", before("date", "class").alias("older"), before("class", "date").alias("drawn"), F.min(F.col("date").cast("date")).over(Window.partitionBy()).alias("first"))
    offsets = counts.withColumn("older", F.min("older").over(Window.partitionBy("date")))  # a few rows for each date
    within = lambda keys, *order: F.row_number().over(Window.partitionBy(*keys).orderBy(*last(*order))) - 1
    placed = rows.join(F.broadcast(offsets), F.col("acq_date").eqNullSafe(F.col("date")) & F.col("priority").eqNullSafe(F.col("class")))
    placed = placed.withColumn("row_id", F.col("older") + within(["acq_date"], "det_id", "longitude", "latitude", "priority", "anomaly"))
    placed = placed.withColumn("point", F.col("drawn") + within(["acq_date", "priority"], "row_id"))
    day = F.datediff(F.col("acq_date").cast("date"), F.col("first")).cast("long").alias("day")
    return placed.select("point", "row_id", "longitude", "latitude", day, "class_id", "anomaly").orderBy("point")


@query("training_rows", f"SELECT det_id, label FROM lab WHERE label <> 'unknown' AND cell NOT IN (SELECT {_GC} FROM gold)")
def training_rows(s, d):
    gold = H.with_grid(view(s, d, "gold")).select("cell").distinct()
    return L.labelled(s, d).where("label <> 'unknown'").join(gold, "cell", "left_anti").select("det_id", "label")


@query("gold_agreement", "SELECT count(*) AS n, count(*) FILTER (WHERE verified_label <> 'uncertain') AS decided, count(*) FILTER (WHERE label = verified_label) AS hits FROM gold")
def gold_agreement(s, d):
    return view(s, d, "gold").agg(F.count("*").alias("n"), F.count_if(F.col("verified_label") != "uncertain").alias("decided"), F.count_if(F.col("label") == F.col("verified_label")).alias("hits"))


# Scenes


#: Scenes with a smaller share of clear pixels are left out.
CLEAR = 0.8
_NBR = f"""SELECT point_id, scene_date, avg((scl IN (4, 5, 6, 7))::INT) AS clear, avg(n) FILTER (WHERE scl IN (4, 5, 6, 7)) AS nbr, quantile_cont(n, 0.1) FILTER (WHERE scl IN (4, 5, 6, 7)) AS p10,
  quantile_cont(n, 0.5) FILTER (WHERE scl IN (4, 5, 6, 7)) AS p50 FROM (SELECT *, CASE WHEN b08 + b12 = 0 THEN 0 ELSE (b08 - b12) / (b08 + b12) END::DOUBLE AS n FROM scenes) t GROUP BY ALL HAVING clear >= {CLEAR}"""


def _scene_stats(s, d, least: float = CLEAR):
    """Per point and date: share of clear pixels and, over these, the burn ratio's mean, 10 % and 50 % points; scenes less clear than ``least`` are left out."""
    total, ok = F.col("b08") + F.col("b12"), F.col("scl").isin(4, 5, 6, 7)
    nbr = F.when(total == 0, 0.0).otherwise((F.col("b08") - F.col("b12")) / F.when(total != 0, total))
    return view(s, d, "scenes").groupBy("point_id", "scene_date").agg(
        F.avg(ok.cast("int")).alias("clear"), F.avg(F.when(ok, nbr)).alias("nbr"), F.percentile(F.when(ok, nbr.cast("double")), F.array(F.lit(0.1), F.lit(0.5))).alias("p")
    ).where((F.col("clear") >= least) & F.col("nbr").isNotNull()).select("point_id", "scene_date", "clear", "nbr", F.col("p")[0].alias("p10"), F.col("p")[1].alias("p50"))


@query("scene_stats", f"SELECT point_id, scene_date, round(clear, 6) AS clear, round(nbr, 6) AS nbr, round(p10, 6) AS p10, round(p50, 6) AS p50 FROM ({_NBR}) t WHERE nbr IS NOT NULL")
def scene_stats(s, d):
    return _scene_stats(s, d).select("point_id", "scene_date", *[F.round(c, 6).alias(c) for c in ("clear", "nbr", "p10", "p50")])


@query("asof_scenes", f"""SELECT p.point_id, p.acq_date, max(scene_date) FILTER (WHERE scene_date < acq_date) AS date_before, min(scene_date) FILTER (WHERE scene_date >= acq_date) AS date_after
  FROM burn_points p JOIN ({_NBR}) t ON t.point_id = p.point_id AND nbr IS NOT NULL AND scene_date BETWEEN acq_date - 30 AND acq_date + 30 GROUP BY ALL""")
def asof_scenes(s, d):
    near = F.col("scene_date").between(F.date_add("acq_date", -30), F.date_add("acq_date", 30))
    before = F.col("scene_date") < F.col("acq_date")
    return view(s, d, "burn_points").join(_scene_stats(s, d), "point_id").where(near).groupBy("point_id", "acq_date").agg(
        F.max(F.when(before, F.col("scene_date"))).alias("date_before"), F.min(F.when(~before, F.col("scene_date"))).alias("date_after")
    )
