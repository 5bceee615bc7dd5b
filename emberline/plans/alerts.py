"""Sub-types of industrial detections, alerts, and what dashboards slice from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..contract import CLASSES, CRITICAL_TYPES, FACILITY_SUBTYPE, NEVER_DUG, SUBTYPES, TAG_SUBTYPE, THERMAL_FUELS
from ..fixtures import view
from ..functions import scalars as S
from ..operators import history as H, spatial
from ..storage import save
from ..stores import Store, new_folder
from . import labels as L
from .catalog import BATCH, det, query
from .offshore import labelled_offshore, large_fire_events, offshore, UNITS, _AT_SEA, _SEA_LABEL
from .oracle import sql_list

SUBTYPE_RADIUS, SITE_RADIUS, UNMAPPED = 1_000.0, 2_000.0, 2_000.0
NOT_IDENTIFIED = SUBTYPES[-1]
PERIOD = ("2024-01-05", "2024-01-20")
_DISTANCES = ["dist_to_industrial_m", "dist_to_flare_capable_m", "dist_to_heat_industry_m", "dist_to_coal_mine_m", "dist_to_brick_kiln_m"]

_when = lambda values: " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())


def near_any(points: DataFrame, sites: DataFrame, boxes: DataFrame, radius: float) -> DataFrame:
    """(pid, dist, source, fid) of the nearest point of ``sites`` or shape of ``boxes`` up to ``radius``, 0 inside a
    polygon; on equal distance sites come first, then the smaller id."""
    side = lambda found, source: found.select("pid", F.struct("dist", F.lit(source).alias("source"), F.col("fid").cast("long").alias("fid")).alias("best"))
    inside = spatial.containing(points, spatial.box_segments(boxes.where("geom_type = 'Polygon'"), "feature_id")).withColumn("dist", F.lit(0.0))
    found = [
        side(spatial.within(points, spatial.point_segments(sites, "facility_id"), radius), 0),
        side(spatial.within(points, spatial.box_segments(boxes, "feature_id"), radius), 1),
        side(inside, 1),
    ]
    return reduce(DataFrame.unionByName, found).groupBy("pid").agg(F.min("best").alias("best")).select("pid", "best.*")


def typed(s, d) -> tuple[DataFrame, DataFrame]:
    """Facilities and mapped features of a known sub-type; facilities that were never built are left out."""
    never = F.coalesce(F.lower(F.trim(F.split("status", ";")[0])).isin(NEVER_DUG), F.lit(False))
    sites = L.facilities(s, d).where(~never).withColumn("subtype", S.lookup(F.col("facility_type"), FACILITY_SUBTYPE))
    thermal = (F.col("power") == "plant") & S.any_of(F.col("plant_source"), THERMAL_FUELS)
    kind = F.when(thermal, "Thermal power plant").otherwise(S.lookup(F.lower("industrial"), TAG_SUBTYPE))
    return sites.where("subtype IS NOT NULL"), L.context(s, d).withColumn("subtype", kind).where("subtype IS NOT NULL")


def with_subtype(s, d) -> DataFrame:
    """Labelled detections with ``subtype`` and its distance; both are null outside the class industrial."""
    sites, boxes = typed(s, d)
    boxes = L.alike(boxes, "subtype")
    best = near_any(L.places(L.detections(s, d)), sites, boxes, SUBTYPE_RADIUS)
    kinds = sites.select(F.lit(0).alias("source"), F.col("facility_id").cast("long").alias("fid"), "subtype").unionByName(
        boxes.select(F.lit(1).alias("source"), F.col("feature_id").cast("long").alias("fid"), "subtype")
    )
    near = best.join(kinds, ["source", "fid"]).select("pid.latitude", "pid.longitude", F.col("subtype").alias("near_subtype"), F.col("dist").alias("near_dist"))
    rows, industrial = L.labelled_by_region(s, d).join(near, ["latitude", "longitude"], "left"), F.col("label") == "industrial"
    return rows.withColumn("subtype", F.when(industrial, F.coalesce("near_subtype", F.lit(NOT_IDENTIFIED)))).withColumn("subtype_dist_m", F.when(industrial, F.col("near_dist")))


_FUELS = f"len(list_filter(string_split(plant_source, ';'), lambda v: trim(v) IN ({sql_list(THERMAL_FUELS)}))) > 0"
_SUB = f"""SELECT lab_s.*, CASE WHEN label = 'industrial' THEN coalesce(near.subtype, '{NOT_IDENTIFIED}') END AS subtype, CASE WHEN label = 'industrial' THEN near.d END AS subtype_dist_m
  FROM lab_s LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY latitude, longitude ORDER BY d, source, fid) AS nth FROM (
    SELECT l.latitude, l.longitude, CASE f.facility_type {_when(FACILITY_SUBTYPE)} END AS subtype, 0 AS source, f.facility_id AS fid, sqrt(pow(l.x - f.x, 2) + pow(l.y - f.y, 2)) AS d
    FROM loc l CROSS JOIN fac f WHERE NOT coalesce(lower(trim(string_split(f.status, ';')[1])) IN ({sql_list(NEVER_DUG)}), false)
    UNION ALL SELECT p.latitude, p.longitude, CASE WHEN coalesce(power = 'plant' AND {_FUELS}, false) THEN 'Thermal power plant' ELSE CASE lower(industrial) {_when(TAG_SUBTYPE)} END END, 1, p.fid, p.d
    FROM pairs p JOIN ctx ON p.fid = feature_id) c WHERE subtype IS NOT NULL AND d <= {SUBTYPE_RADIUS}) q WHERE nth = 1) near USING (latitude, longitude)"""
_CODE = "CASE subtype " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(SUBTYPES, 1)) + " ELSE 0 END"


def subtype_code():
    """1.. in the fixed order of the sub-types, 0 for rows that aren't industrial."""
    return F.coalesce(S.lookup(F.col("subtype"), {v: i for i, v in enumerate(SUBTYPES, 1)}), F.lit(0))


@query("industrial_subtype", f"SELECT det_id, subtype, round(subtype_dist_m, 2) AS subtype_dist_m FROM ({_SUB}) t WHERE label = 'industrial'")
def industrial_subtype(s, d):
    return with_subtype(s, d).where("label = 'industrial'").select("det_id", "subtype", F.round("subtype_dist_m", 2).alias("subtype_dist_m"))


@query("subtype_code", f"SELECT det_id, {_CODE} AS code FROM ({_SUB}) t")
def subtype_codes(s, d):
    return with_subtype(s, d).select("det_id", subtype_code().alias("code"))


@query("subtype_cube", f"SELECT acq_date, {_CODE} AS code, state, count(*) AS n FROM ({_SUB}) t WHERE label = 'industrial' GROUP BY ALL")
def subtype_cube(s, d):
    return with_subtype(s, d).where("label = 'industrial'").groupBy("acq_date", subtype_code().alias("code"), "state").agg(F.count("*").alias("n"))


def split_table(rows: DataFrame) -> DataFrame:
    """(subtype, n, share in %) over the fixed list; sub-types without rows keep 0."""
    every = rows.sparkSession.createDataFrame([(v,) for v in SUBTYPES], "subtype string")
    counts = rows.where("subtype IS NOT NULL").groupBy("subtype").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    share = F.coalesce(F.try_divide(100.0 * n, F.sum(n).over(Window.partitionBy())), F.lit(0.0))
    return F.broadcast(every).join(counts, "subtype", "left").select("subtype", n.alias("n"), F.round(share, 4).alias("share"))


_SPLIT = """SELECT subtype, n, round(coalesce(100.0 * n / nullif(sum(n) OVER (), 0), 0), 4)::DOUBLE AS share FROM (SELECT v.subtype, count(t.det_id) AS n
  FROM (SELECT unnest([{names}]) AS subtype) v LEFT JOIN (SELECT * FROM ({rows}) r WHERE {where}) t USING (subtype) GROUP BY v.subtype) u"""


@query("subtype_split", _SPLIT.format(names=sql_list(SUBTYPES), rows=_SUB, where="true"))
def subtype_split(s, d):
    return split_table(with_subtype(s, d))


@query("subtype_mix", _SPLIT.format(names=sql_list(SUBTYPES), rows=_SUB, where=f"acq_date BETWEEN '{PERIOD[0]}' AND '{PERIOD[1]}'"))
def subtype_mix(s, d):
    return split_table(with_subtype(s, d).where(F.col("acq_date").between(*PERIOD)))


@query("subtype_subtract", f"SELECT acq_date, count(*) FILTER (WHERE label = 'industrial') - count(*) FILTER (WHERE {_CODE} IN (1, 2)) AS shown FROM ({_SUB}) t GROUP BY acq_date")
def subtype_subtract(s, d):
    return with_subtype(s, d).groupBy("acq_date").agg((F.count_if(F.col("label") == "industrial") - F.count_if(subtype_code().isin(1, 2))).alias("shown"))


@query("check_subtypes", f"SELECT state, count(*) FILTER (WHERE label <> 'industrial' AND subtype IS NOT NULL) AS misplaced, count(subtype) AS typed, count(*) FILTER (WHERE label = 'industrial') AS industrial FROM ({_SUB}) t GROUP BY state")
def check_subtypes(s, d):
    industrial = F.col("label") == "industrial"
    return with_subtype(s, d).groupBy("state").agg(
        F.count_if(~industrial & F.col("subtype").isNotNull()).alias("misplaced"), F.count("subtype").alias("typed"), F.count_if(industrial).alias("industrial")
    )


# Slices over periods


@query("period_aggregate", f"SELECT label, count(*) AS n, count(*) FILTER (WHERE is_anomalous) AS anomalous, count(DISTINCT acq_date) AS days FROM lab_s WHERE acq_date BETWEEN '{PERIOD[0]}' AND '{PERIOD[1]}' AND state IS NOT NULL GROUP BY label")
def period_aggregate(s, d):
    rows = L.labelled_by_region(s, d).where(F.col("acq_date").between(*PERIOD) & F.col("state").isNotNull())
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_anomalous").alias("anomalous"), F.countDistinct("acq_date").alias("days"))


@query("expected_display", f"""SELECT v.name, count(*) AS total, count(*) FILTER (WHERE is_anomalous) AS anomalous FROM lab_s JOIN (SELECT * FROM (VALUES ('all', '', '9'), ('period', '{PERIOD[0]}', '{PERIOD[1]}'),
  ('batch', '{BATCH}', '9')) q(name, first, last)) v ON acq_date BETWEEN v.first AND v.last GROUP BY v.name""")
def expected_display(s, d):
    views = s.createDataFrame([("all", "", "9"), ("period", *PERIOD), ("batch", BATCH, "9")], "name string, first string, last string")
    daily = L.labelled(s, d).groupBy("acq_date").agg(F.count("*").alias("n"), F.count_if("is_anomalous").alias("a"))
    shown = daily.join(F.broadcast(views), F.col("acq_date").between(F.col("first"), F.col("last")))
    return shown.groupBy("name").agg(F.sum("n").alias("total"), F.sum("a").alias("anomalous"))


@query("period_over_period", """SELECT week, n, days, round(n / days::DOUBLE, 4) AS per_day, round(lag(n / days::DOUBLE) OVER (ORDER BY week), 4) AS previous_per_day, days < 7 AS partial
  FROM (SELECT strftime(date_trunc('week', CAST(acq_date AS DATE)), '%Y-%m-%d') AS week, count(*) AS n, count(DISTINCT acq_date) AS days FROM detections GROUP BY 1) t""")
def period_over_period(s, d):
    week = F.date_format(F.date_trunc("week", F.col("acq_date").cast("date")), "yyyy-MM-dd")
    weeks = view(s, d, "detections").groupBy(week.alias("week")).agg(F.count("*").alias("n"), F.countDistinct("acq_date").alias("days"))
    rate = F.col("n") / F.col("days")
    return weeks.select("week", "n", "days", F.round(rate, 4).alias("per_day"), F.round(F.lag(rate).over(Window.orderBy("week")), 4).alias("previous_per_day"), (F.col("days") < 7).alias("partial"))


@query("months_table", """SELECT strftime(m, '%Y-%m') AS month, greatest(m, first)::DATE AS first_day, least(m + INTERVAL 1 MONTH - INTERVAL 1 DAY, last)::DATE AS last_day, day(last_day(m)) AS full_days
  FROM (SELECT first, last, unnest(generate_series(date_trunc('month', first), last, INTERVAL 1 MONTH)) AS m FROM (SELECT min(acq_date)::DATE AS first, max(acq_date)::DATE AS last FROM detections) a) b""")
def months_table(s, d):
    span = view(s, d, "detections").agg(F.min("acq_date").cast("date").alias("first"), F.max("acq_date").cast("date").alias("last"))
    months = span.select("first", "last", F.explode(F.sequence(F.trunc("first", "month"), F.col("last"), F.expr("INTERVAL 1 MONTH"))).alias("m"))
    return months.select(
        F.date_format("m", "yyyy-MM").alias("month"), F.greatest("m", "first").alias("first_day"), F.least(F.last_day("m"), "last").alias("last_day"), F.day(F.last_day("m")).alias("full_days")
    )


# Facilities on display

_GROUPED = """SELECT facility_id AS id, 0 AS display_group, replace(facility_type, '_', ' ') AS kind, latitude, longitude FROM facilities
  UNION ALL SELECT feature_id, CASE WHEN industrial = 'refinery' THEN 1 ELSE 2 END, coalesce(industrial, power, landuse, man_made), (south + north) / 2, (west + east) / 2 FROM ctx"""


def facility_layer(s, d) -> DataFrame:
    sites = view(s, d, "facilities").select(F.col("facility_id").alias("id"), F.lit(0).alias("display_group"), F.replace("facility_type", F.lit("_"), F.lit(" ")).alias("kind"), "latitude", "longitude")
    middle = lambda a, b, name: ((F.col(a) + F.col(b)) / 2).alias(name)
    mapped = L.context(s, d).select(
        F.col("feature_id").alias("id"), F.when(F.col("industrial") == "refinery", 1).otherwise(2).alias("display_group"),
        F.coalesce("industrial", "power", "landuse", "man_made").alias("kind"), middle("south", "north", "latitude"), middle("west", "east", "longitude"),
    )
    return sites.unionByName(mapped)


@query("facility_layer", f"SELECT id, display_group, kind, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM ({_GROUPED}) t")
def facility_layer_rounded(s, d):
    return facility_layer(s, d).withColumns({c: F.round(c, 6) for c in ("latitude", "longitude")})


@query("facility_group_counts", f"SELECT g.display_group, count(t.id) AS n FROM (SELECT unnest([0, 1, 2]) AS display_group) g LEFT JOIN ({_GROUPED}) t USING (display_group) GROUP BY ALL")
def facility_group_counts(s, d):
    groups = s.createDataFrame([(0,), (1,), (2,)], "display_group int")
    counts = facility_layer(s, d).groupBy("display_group").agg(F.count("*").alias("n"))
    return groups.join(counts, "display_group", "left").na.fill(0, ["n"])


# Evidence and alerts


@query("site_evidence", """SELECT det_id, CASE WHEN label = 'gas flare' THEN coalesce(nearest_flare_facility_type, 'flare-capable facility') WHEN dist_to_heat_industry_m <= 2000 THEN coalesce(nearest_heat_facility_type, 'heat industry')
  WHEN dist_to_flare_capable_m <= 1000 THEN coalesce(nearest_flare_facility_type, 'flare-capable facility') WHEN osm_industrial_tag <> '' THEN 'OSM industrial=' || osm_industrial_tag
  WHEN nearest_coal_source <> '' THEN 'coal mine (' || nearest_coal_source || ')' ELSE 'OSM industrial area' END AS evidence FROM lab WHERE label IN ('industrial', 'gas flare')""")
def site_evidence(s, d):
    return evidence(L.labelled(s, d).where(F.col("label").isin("industrial", "gas flare"))).select("det_id", "evidence")


def evidence(rows: DataFrame) -> DataFrame:
    """``rows`` with ``evidence``: the facility that makes a place a site, the first that applies."""
    flare = F.coalesce("nearest_flare_facility_type", F.lit("flare-capable facility"))
    text = (
        F.when(F.col("label") == "gas flare", flare)
        .when(F.col("dist_to_heat_industry_m") <= 2_000, F.coalesce("nearest_heat_facility_type", F.lit("heat industry")))
        .when(F.col("dist_to_flare_capable_m") <= 1_000, flare)
        .when(F.col("osm_industrial_tag") != "", F.concat(F.lit("OSM industrial="), "osm_industrial_tag"))
        .when(F.col("nearest_coal_source") != "", F.concat(F.lit("coal mine ("), "nearest_coal_source", F.lit(")")))
        .otherwise("OSM industrial area")
    )
    return rows.withColumn("evidence", text)


# Why a detection has its label.
REASONS = {
    "gas flare": "Rule match: within 1 km of a flare-capable GEM facility, active on 5+ days",
    "industrial": "Rule match: at or near mapped heavy industry, an OSM industrial site, or a coal mine",
    "agricultural burning": "Rule match: WorldCover cropland, more than 2 km from mapped industry",
    "wildfire": "Rule match: WorldCover tree cover / shrubland / grassland, more than 2 km from mapped industry",
}
SOURCE_REASONS = {"unknown": "Needs review: no labelling rule matched", "conflict": "Needs review: more than one labelling rule matched", "model": "Model prediction"}
# The same at sea, of kilometres and active days.
SEA_REASONS = {
    "offshore_persistent": "Persistent %s heat %d km offshore, active %s",
    "offshore_unconfirmed": "Offshore heat %d km out, active %s. KG basin flares are unconfirmed (hot pixel at 1 of 4 checked cells), so it is not labelled a flare",
    "unknown": "Offshore heat %d km out, active %s: a flare needs 5+",
}


_ACTIVE = "days || ' day' || CASE WHEN days = 1 THEN '' ELSE 's' END"
_KM = "floor(dist_m / 1000 + 0.5)::BIGINT"


@query("label_reason", f"""SELECT lab.det_id, CASE WHEN sea.det_id IS NULL THEN CASE WHEN lab.label_source = 'rule' THEN CASE lab.label {_when(REASONS)} END ELSE CASE lab.label_source {_when(SOURCE_REASONS)} END END
  WHEN sea.label_source = 'offshore_persistent' THEN format('{SEA_REASONS["offshore_persistent"].replace("%s", "{}").replace("%d", "{}")}', CASE WHEN daynight = 'D' THEN 'daytime' ELSE 'night-time' END, {_KM}, {_ACTIVE})
  WHEN sea.label_source = 'offshore_unconfirmed' THEN format('{SEA_REASONS["offshore_unconfirmed"].replace("%d", "{}").replace("%s", "{}")}', {_KM}, {_ACTIVE})
  ELSE format('{SEA_REASONS["unknown"].replace("%d", "{}").replace("%s", "{}")}', {_KM}, {_ACTIVE}) END AS reason FROM lab LEFT JOIN ({_SEA_LABEL}) sea USING (det_id)""")
def label_reason(s, d):
    """Why a detection has its label; at sea where it is and how persistent."""
    on_land = F.when(F.col("label_source") == "rule", S.lookup(F.col("label"), REASONS)).otherwise(S.lookup(F.col("label_source"), SOURCE_REASONS))
    sea = labelled_offshore(s, d).select("det_id", F.col("label_source").alias("sea"), F.floor(F.col("dist_m") / 1_000 + 0.5).alias("km"), "days")
    active = F.concat(F.col("days").cast("string"), F.when(F.col("days") == 1, " day").otherwise(" days"))
    when = F.when(F.col("daynight") == "D", "daytime").otherwise("night-time")
    reason = (
        F.when(F.col("sea").isNull(), on_land)
        .when(F.col("sea") == "offshore_persistent", F.format_string(SEA_REASONS["offshore_persistent"], when, "km", active))
        .when(F.col("sea") == "offshore_unconfirmed", F.format_string(SEA_REASONS["offshore_unconfirmed"], F.col("km"), active))
        .otherwise(F.format_string(SEA_REASONS["unknown"], F.col("km"), active))
    )
    return L.labelled(s, d).join(sea, "det_id", "left").select("det_id", reason.alias("reason"))


def critical_sites(s, d) -> tuple[DataFrame, DataFrame]:
    """Critical facilities, and mapped refineries and thermal power plants; both with ``kind`` and ``name``."""
    sites = L.facilities(s, d).where(F.col("facility_type").isin(CRITICAL_TYPES))
    boxes = L.context(s, d)
    thermal = F.coalesce((F.col("power") == "plant") & S.any_of(F.col("plant_source"), THERMAL_FUELS), F.lit(False))
    kind = F.when(thermal, F.concat(F.lit("power plant ("), "plant_source", F.lit(")"))).when(F.col("industrial") == "refinery", "refinery")
    named = lambda c: F.coalesce(F.col(c), F.lit("unnamed")).alias("name")
    return sites.select("*", F.col("facility_type").alias("kind"), named("facility_name")), boxes.drop("name").join(boxes.select("feature_id", named("name")), "feature_id").withColumn("kind", kind).where("kind IS NOT NULL")


_SITES = f"""SELECT 0 AS source, facility_id AS id, facility_type AS kind, coalesce(facility_name, 'unnamed') AS name FROM facilities WHERE facility_type IN ({sql_list(CRITICAL_TYPES)})
  UNION ALL SELECT 1, feature_id, kind, name FROM (SELECT feature_id, CASE WHEN coalesce(power = 'plant' AND {_FUELS}, false) THEN 'power plant (' || plant_source || ')' WHEN industrial = 'refinery' THEN 'refinery' END AS kind,
    coalesce(name, 'unnamed') AS name FROM ctx) c WHERE kind IS NOT NULL"""
_NEAR_SITE = f"""SELECT latitude, longitude, source, id, d AS dist_m FROM (SELECT *, row_number() OVER (PARTITION BY latitude, longitude ORDER BY d, source, id) AS nth FROM (
  SELECT l.latitude, l.longitude, 0 AS source, f.facility_id AS id, sqrt(pow(l.x - f.x, 2) + pow(l.y - f.y, 2)) AS d FROM loc l CROSS JOIN fac f WHERE f.facility_type IN ({sql_list(CRITICAL_TYPES)})
  UNION ALL SELECT p.latitude, p.longitude, 1, p.fid, p.d FROM pairs p JOIN ({_SITES}) k ON k.source = 1 AND k.id = p.fid) c WHERE d <= {SITE_RADIUS}) t WHERE nth = 1"""


@query("critical_sites", _SITES)
def critical_sites_rows(s, d):
    sites, boxes = critical_sites(s, d)
    return sites.select(F.lit(0).alias("source"), F.col("facility_id").alias("id"), "kind", "name").unionByName(boxes.select(F.lit(1).alias("source"), F.col("feature_id").alias("id"), "kind", "name"))


def near_critical_site(s, d) -> DataFrame:
    """(latitude, longitude, source, id, dist_m): the nearest critical site of each position that has one within SITE_RADIUS."""
    near = L._by_place(near_any(L.places(L.detections(s, d)), *critical_sites(s, d), SITE_RADIUS))
    return near.select("latitude", "longitude", "source", F.col("fid").alias("id"), F.col("dist").alias("dist_m"))


@query("near_critical_site", f"SELECT det_id, kind, name, source, id, round(dist_m, 2) AS dist_m FROM det JOIN ({_NEAR_SITE}) n USING (latitude, longitude) JOIN ({_SITES}) k USING (source, id)")
def near_critical_site_rows(s, d):
    found = det(s, d).select("det_id", "latitude", "longitude").join(near_critical_site(s, d), ["latitude", "longitude"])
    return found.join(critical_sites_rows(s, d), ["source", "id"]).select("det_id", "kind", "name", "source", "id", F.round("dist_m", 2).alias("dist_m"))


def critical_site_alerts(s, d) -> DataFrame:
    """(det_id, cell, acq_date, frp, latitude, longitude, dist_m): near a critical site whose neighbourhood was quiet, at most one active day in 90."""
    rows = L.detections(s, d)
    quiet = H.neighbourhood_days(rows.join(near_critical_site(s, d), ["latitude", "longitude"]), rows, -89, 0).where("n <= 1")
    return quiet.select("det_id", "cell", "acq_date", "frp", "latitude", "longitude", "dist_m")


_CRITICAL = f"""SELECT det_id, cell, acq_date, frp, latitude, longitude, dist_m FROM (SELECT t.det_id, t.cell, t.acq_date, t.frp, t.latitude, t.longitude, t.dist_m, count(DISTINCT b.acq_date) AS n FROM (
  SELECT det.*, dist_m FROM det JOIN ({_NEAR_SITE}) near USING (latitude, longitude)) t
  JOIN det b ON b.gi BETWEEN t.gi - 1 AND t.gi + 1 AND b.gj BETWEEN t.gj - 1 AND t.gj + 1 AND CAST(b.acq_date AS DATE) BETWEEN CAST(t.acq_date AS DATE) - 89 AND CAST(t.acq_date AS DATE) GROUP BY ALL) u WHERE n <= 1"""


@query("critical_site_alerts", f"SELECT det_id, acq_date, round(dist_m, 2) AS dist_m FROM ({_CRITICAL}) v")
def critical_site_alerts_rounded(s, d):
    return critical_site_alerts(s, d).select("det_id", "acq_date", F.round("dist_m", 2).alias("dist_m"))


def new_unmapped_source(s, d) -> DataFrame:
    """One row a cell: its first detection on land, far from every facility, that has five active days in the trailing 30 and at
    most one before them; with mean and largest frp and the commonest label (ties by name) of the cell's detections in
    these 30 days, and the first day on which the cell was ever active."""
    days = Window.partitionBy("gi", "gj").orderBy("day")
    bare = det(s, d)
    active = H.distinct_cell_days(bare).withColumn("day", H.day_number()).select(
        "gi", "gj", "acq_date", F.count("*").over(days.rangeBetween(-29, 0)).alias("active_days"),
        F.count("*").over(days.rangeBetween(Window.unboundedPreceding, -30)).alias("earlier_days"),
    )
    hot = active.where("active_days >= 5 AND earlier_days <= 1")
    far = reduce(lambda a, b: a & b, [F.coalesce(F.col(c) > UNMAPPED, F.lit(True)) for c in _DISTANCES])
    found = L.add_context(s, d).where(far).join(hot, ["gi", "gj", "acq_date"]).join(offshore(s, d).where("offshore").select("det_id"), "det_id", "left_anti")
    first = F.min(F.struct("acq_date", "det_id", "active_days", "frp", "latitude", "longitude")).alias("f")
    found = found.groupBy("cell").agg(first).select("cell", "f.*")
    rows = L.labelled(s, d).select("cell", F.col("acq_date").alias("day"), "label", F.col("frp").alias("heat"))
    recent = F.col("day").cast("date") >= F.date_sub(F.col("acq_date").cast("date"), 29)
    past = found.select("cell", "acq_date").join(rows, "cell").where("day <= acq_date").groupBy("cell", "label").agg(
        F.min("day").alias("day"), F.count_if(recent).alias("n"), F.sum(F.when(recent, F.rint(F.col("heat") * UNITS).cast("long"))).alias("total"), F.count(F.when(recent, F.col("heat"))).alias("known"), F.max(F.when(recent, F.col("heat"))).alias("most")
    )
    about = past.groupBy("cell").agg(
        F.min("day").alias("first_day"), (F.floor(F.try_divide(F.sum("total"), F.sum("known")) + 0.5) / UNITS).alias("mean_frp"), F.max("most").alias("max_frp"), F.min_by("label", F.struct(-F.col("n"), "label")).alias("mode_label")
    )
    return found.join(about, "cell")


_FAR = " AND ".join(f"coalesce({c} > {UNMAPPED}, true)" for c in _DISTANCES)
_UNMAPPED = f"""SELECT cell, acq_date, det_id, active_days, frp, latitude, longitude FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY acq_date, det_id) AS nth FROM (
  SELECT a.det_id, a.cell, a.acq_date, a.frp, a.latitude, a.longitude, count(DISTINCT b.acq_date) FILTER (WHERE CAST(b.acq_date AS DATE) >= CAST(a.acq_date AS DATE) - 29) AS active_days,
  count(DISTINCT b.acq_date) FILTER (WHERE CAST(b.acq_date AS DATE) < CAST(a.acq_date AS DATE) - 29) AS earlier
  FROM (SELECT * FROM feat WHERE {_FAR} AND det_id NOT IN (SELECT det_id FROM ({_AT_SEA}) o)) a JOIN det b ON a.gi = b.gi AND a.gj = b.gj AND b.acq_date <= a.acq_date GROUP BY ALL) t WHERE active_days >= 5 AND earlier <= 1) u WHERE nth = 1"""


@query("new_unmapped_source", f"""SELECT cell, u.acq_date, u.det_id, u.active_days, min(l.acq_date) AS first_day, floor(sum(round_even(l.frp * 100000, 0)::BIGINT) FILTER (WHERE CAST(l.acq_date AS DATE) >= CAST(u.acq_date AS DATE) - 29)::DOUBLE
  / count(l.frp) FILTER (WHERE CAST(l.acq_date AS DATE) >= CAST(u.acq_date AS DATE) - 29) + 0.5) / 100000 AS mean_frp,
  max(l.frp) FILTER (WHERE CAST(l.acq_date AS DATE) >= CAST(u.acq_date AS DATE) - 29) AS max_frp, any_value(m.mode_label) AS mode_label FROM ({_UNMAPPED}) u JOIN lab l USING (cell) JOIN (
  SELECT cell, first(label ORDER BY n DESC, label) AS mode_label FROM (SELECT cell, l.label, count(*) AS n FROM ({_UNMAPPED}) v JOIN lab l USING (cell)
    WHERE CAST(l.acq_date AS DATE) BETWEEN CAST(v.acq_date AS DATE) - 29 AND CAST(v.acq_date AS DATE) GROUP BY ALL) c GROUP BY cell) m USING (cell)
  WHERE l.acq_date <= u.acq_date GROUP BY cell, u.acq_date, u.det_id, u.active_days""")
def new_unmapped_source_rows(s, d):
    return new_unmapped_source(s, d).drop("frp", "latitude", "longitude")


def build_alerts(s, d) -> DataFrame:
    """Alerts of all four kinds, aligned by name. A fire stands at its mean place and is named by the least of its core detections."""
    hot = L.labelled(s, d).where(F.col("is_anomalous") & F.col("label").isin("industrial", "gas flare") & (F.col("frp") >= 2 * F.col("baseline_frp")))
    fires = large_fire_events(s, d).select(F.col("cluster").alias("det_id"), "acq_date", F.round("total_frp", 6).alias("frp"), "label", "latitude", "longitude")
    kinds = {
        "industrial_anomaly": hot.select("det_id", "cell", "acq_date", "frp", "label", "latitude", "longitude"), "critical_site": critical_site_alerts(s, d),
        "new_source": new_unmapped_source(s, d).select("det_id", "cell", "acq_date", "frp", "latitude", "longitude"), "large_fire": fires,
    }
    frames = [rows.withColumn("alert_type", F.lit(kind)) for kind, rows in kinds.items()]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return every.select("alert_type", F.concat_ws("|", "alert_type", "cell", "acq_date", "det_id").alias("alert_id"), "det_id", "acq_date", "frp", "label", *[F.round(c, n).alias(c) for c, n in (("latitude", 5), ("longitude", 5), ("dist_m", 2))])


_BUILT = f"""SELECT alert_type, concat_ws('|', alert_type, cell, acq_date, det_id) AS alert_id, det_id, acq_date, frp, label, round(latitude, 5) AS latitude, round(longitude, 5) AS longitude, round(dist_m, 2) AS dist_m FROM (
  SELECT 'industrial_anomaly' AS alert_type, det_id, cell, acq_date, frp, label, latitude, longitude, NULL::DOUBLE AS dist_m FROM lab WHERE is_anomalous AND label IN ('industrial', 'gas flare') AND frp >= 2 * baseline_frp
  UNION ALL SELECT 'critical_site', det_id, cell, acq_date, frp, NULL, latitude, longitude, dist_m FROM ({_CRITICAL}) c1 UNION ALL SELECT 'new_source', det_id, cell, acq_date, frp, NULL, latitude, longitude, NULL FROM ({_UNMAPPED}) c2
  UNION ALL SELECT 'large_fire', cluster, NULL, acq_date, round(total_frp, 6), label, latitude, longitude, NULL FROM fires) w"""


@query("build_alerts", _BUILT)
def build_alerts_rows(s, d):
    return build_alerts(s, d)


@query("alerts_by_type", f"SELECT alert_type, count(*) AS n FROM ({_BUILT}) x GROUP BY alert_type")
def alerts_by_type(s, d):
    return build_alerts(s, d).groupBy("alert_type").agg(F.count("*").alias("n"))


@query("alerts_sorted", f"SELECT alert_id, acq_date FROM ({_BUILT}) x")
def alerts_sorted(s, d):
    return build_alerts(s, d).select("alert_id", "acq_date").orderBy(F.desc("acq_date"), "alert_id")


ALERT_COLUMNS = ["alert_id", "alert_type", "acq_date", "latitude", "longitude"]
ALERT_TYPES = ["industrial_anomaly", "critical_site", "new_source", "large_fire"]


def alert_faults(alerts: DataFrame) -> DataFrame:
    """One row per alert_id: alert_id, faults (comma-joined in this order: missing columns, repeated id, unknown type, bad date,
    bad coordinates; empty if there are none). A column that is missing counts as null."""
    absent = [c for c in ALERT_COLUMNS if c not in alerts.columns]
    rows = alerts.withColumns({c: F.lit(None).cast("string") for c in absent})
    degrees = lambda c, most: F.coalesce(F.abs(F.col(c).try_cast("double")) <= most, F.lit(False))
    faults = [F.when(F.lit(c in absent), f"no {c}") for c in ALERT_COLUMNS] + [
        F.when(F.count("*") > 1, "repeated id"), F.when(F.bool_or(~F.coalesce(F.col("alert_type").isin(ALERT_TYPES), F.lit(False))), "unknown type"),
        F.when(F.bool_or(F.col("acq_date").try_cast("date").isNull()), "bad date"), F.when(F.bool_or(~(degrees("latitude", 90) & degrees("longitude", 180))), "bad coordinates"),
    ]
    return rows.groupBy("alert_id").agg(F.concat_ws(",", *faults).alias("faults"))


@query("check_alerts", f"""SELECT alert_id, concat_ws(',', CASE WHEN count(*) > 1 THEN 'repeated id' END, CASE WHEN bool_or(alert_type NOT IN ({sql_list(ALERT_TYPES)})) THEN 'unknown type' END,
  CASE WHEN bool_or(try_cast(acq_date AS DATE) IS NULL) THEN 'bad date' END, CASE WHEN bool_or(NOT coalesce(abs(latitude) <= 90 AND abs(longitude) <= 180, false)) THEN 'bad coordinates' END) AS faults
  FROM ({_BUILT}) x GROUP BY alert_id""")
def check_alerts(s, d):
    return alert_faults(build_alerts(s, d))


@query("publish_alerts", f"SELECT alert_id, acq_date, acq_date >= '{BATCH}' AS appended FROM ({_BUILT}) x")
def publish_alerts(s, d):
    """The alert store after two runs, of which the second sees the first one's alerts again and is run twice."""
    alerts = save(build_alerts(s, d).select("alert_id", "acq_date"), "alerts")
    store = Store(s, new_folder(s, "alerts"), alerts.schema)
    for number, found in ((0, alerts.where(F.col("acq_date") < BATCH)), (1, alerts), (1, alerts)):
        store.append(found, number, ["alert_id"])
    return store.rows().select("alert_id", "acq_date", (F.col("batch") == 1).alias("appended"))


@query("store_union", f"SELECT det_id, CASE WHEN acq_date < '{BATCH}' THEN 'history' ELSE 'batch' END AS origin FROM detections")
def store_union(s, d):
    rows, old = view(s, d, "detections"), F.col("acq_date") < BATCH
    return rows.where(old).select("det_id", F.lit("history").alias("origin")).unionByName(rows.where(~old).select("det_id", F.lit("batch").alias("origin")))
