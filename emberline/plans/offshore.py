"""Detections at sea: zones and distance to the land boundary, recurrence, clusters, scenes and their validation; fires on land."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..fixtures import view
from ..functions.rules import apply_rules
from ..functions.scalars import project_sql
from ..operators import clusters, history as H, spatial
from ..storage import once, save
from . import labels as L
from .catalog import det, query
from .oracle import TABLES, sql_list, _DX, _DY, _T

#: Metres beyond the boundary at which a detection in a zone counts as offshore.
FLOOR = 10_000.0
#: Fires: how near rows of a cluster stand, how many make one, and kilometres to an event that is known already.
FIRE_REACH, FIRE_LEAST, KNOWN_KM = 5_000.0, 10, 5.0
#: A neighbourhood that was active on more days of so many before is persistent.
FIRE_DAYS, FIRE_ACTIVE = 30, 5
#: Heat at sea: how near cells of a cluster stand, and how many active days make a cell persistent.
SEA_REACH, SEA_DAYS = 2_000.0, 5
#: Metres off land up to which heat outside the zones is looked at.
COAST = 250_000.0
#: Metres that a sample point keeps from every detection.
ISOLATED = 5_000.0
#: Zones whose persistent heat isn't confirmed to be flares.
UNCONFIRMED = ("Zone B",)


def distance_to_land(points: DataFrame, regions: DataFrame) -> DataFrame:
    """(latitude, longitude, dist_m) of each place: metres to the nearest region, 0 within one."""
    points, sides = save(points, "points"), spatial.box_segments(regions, "name")
    shore = spatial.nearest(points, sides, bucket=20_000.0, which=False).select("pid", "dist")
    land = spatial.containing(points, sides, cell=20_000.0).select("pid").distinct().withColumn("on_land", F.lit(True))
    return L._by_place(shore.join(land, "pid", "left").select("pid", F.when(F.col("on_land"), 0.0).otherwise(F.col("dist")).alias("dist_m")))


def offshore_columns(rows: DataFrame, zones: DataFrame, regions: DataFrame, floor: float = FLOOR) -> DataFrame:
    """``rows`` (det_id, latitude, longitude, x, y) in a zone with ``zone``, ``dist_m`` to the nearest region (0 within one) and
    ``offshore``. Only rows in a zone are measured; of zones that overlap the last by name counts."""
    inside = F.col("latitude").between(F.col("south"), F.col("north")) & F.col("longitude").between(F.col("west"), F.col("east"))
    at_sea = rows.join(F.broadcast(zones), inside).groupBy("det_id", "latitude", "longitude", "x", "y").agg(F.max("zone").alias("zone"))
    dist = distance_to_land(L.places(at_sea), regions)
    out = at_sea.drop("x", "y").join(dist, ["latitude", "longitude"], "left")
    return out.withColumn("offshore", F.coalesce(F.col("dist_m") >= floor, F.lit(True)))


def offshore(s, d) -> DataFrame:
    return once(s, d, "offshore", lambda: offshore_columns(L.detections(s, d), view(s, d, "zones"), view(s, d, "regions")))


def _shore_side(a: str, b: str, c: str, d: str) -> str:
    (x1, y1), (x2, y2) = project_sql(b, a), project_sql(d, c)
    return f"SELECT {x1} AS x1, {y1} AS y1, {x2} AS x2, {y2} AS y2 FROM regions"


_SHORE = " UNION ALL ".join(_shore_side(*c) for c in (("west", "south", "east", "south"), ("east", "south", "east", "north"), ("east", "north", "west", "north"), ("west", "north", "west", "south")))
_SEA = f"""SELECT det_id, latitude, longitude, zone, dist_m, dist_m >= {FLOOR} AS offshore FROM (SELECT z.det_id, z.latitude, z.longitude, z.zone,
  CASE WHEN EXISTS (SELECT 1 FROM regions r WHERE z.latitude BETWEEN r.south AND r.north AND z.longitude > r.west AND z.longitude < r.east) THEN 0.0::DOUBLE ELSE m.dist END AS dist_m FROM (
  SELECT det_id, det.latitude, det.longitude, max(zone) AS zone FROM det JOIN zones ON latitude BETWEEN south AND north AND longitude BETWEEN west AND east GROUP BY ALL) z
  JOIN (SELECT latitude, longitude, min(sqrt(pow(x - x1 - {_T} * {_DX}, 2) + pow(y - y1 - {_T} * {_DY}, 2))) AS dist FROM (
    SELECT loc.* FROM loc WHERE EXISTS (SELECT 1 FROM zones WHERE latitude BETWEEN south AND north AND longitude BETWEEN west AND east)) l CROSS JOIN ({_SHORE}) g GROUP BY ALL) m USING (latitude, longitude)) t"""

_AT_SEA = f"SELECT det_id, zone, dist_m FROM ({_SEA}) sea WHERE offshore"


@query("offshore_columns", f"SELECT det_id, zone, round(dist_m, 2) AS dist_m, offshore FROM ({_SEA}) u")
def offshore_columns_rounded(s, d):
    return offshore(s, d).select("det_id", "zone", F.round("dist_m", 2).alias("dist_m"), "offshore")


@query("check_offshore", f"""SELECT zone, count(*) FILTER (WHERE offshore) AS offshore, count(*) FILTER (WHERE offshore AND dist_m < {FLOOR}) AS too_near,
  count(*) FILTER (WHERE NOT offshore) AS near_shore FROM ({_SEA}) u GROUP BY zone""")
def check_offshore(s, d):
    return offshore(s, d).groupBy("zone").agg(
        F.count_if("offshore").alias("offshore"), F.count_if(F.col("offshore") & (F.col("dist_m") < FLOOR)).alias("too_near"), F.count_if(~F.col("offshore")).alias("near_shore")
    )


@query("offshore_recurrence", f"""SELECT o.det_id, recurrence_count, first_seen, last_seen FROM ({_SEA}) o JOIN det USING (det_id) JOIN (
  SELECT gi, gj, count(DISTINCT acq_date) AS recurrence_count, min(acq_date) AS first_seen, max(acq_date) AS last_seen FROM det WHERE det_id IN (SELECT det_id FROM ({_SEA}) p WHERE offshore)
  GROUP BY gi, gj) r USING (gi, gj) WHERE o.offshore""")
def offshore_recurrence(s, d):
    """A cell has the same count in bulk and in a batch: all of its days count, also later ones."""
    rows = det(s, d).join(offshore(s, d).where("offshore").select("det_id"), "det_id", "left_semi")
    return H.with_recurrence(rows).select("det_id", "recurrence_count", "first_seen", "last_seen")


_SEA_LABEL = f"""SELECT *, CASE WHEN days >= 5 AND NOT doubtful THEN 'gas flare' ELSE 'unknown' END AS label,
  CASE WHEN doubtful THEN 'offshore_unconfirmed' WHEN days >= 5 THEN 'offshore_persistent' ELSE 'unknown' END AS label_source FROM (
  SELECT o.det_id, o.zone, o.dist_m, zone IN ({sql_list(UNCONFIRMED)}) AS doubtful, r.n AS days FROM ({_AT_SEA}) o JOIN det USING (det_id) JOIN (SELECT gi, gj, count(DISTINCT acq_date) AS n FROM det
  WHERE det_id IN (SELECT det_id FROM ({_AT_SEA}) p) GROUP BY gi, gj) r USING (gi, gj)) t"""


def labelled_offshore(s, d) -> DataFrame:
    """(det_id, label, label_source, zone, dist_m, days) of the rows at sea, which follow the persistence rule alone."""
    at_sea = offshore(s, d).where("offshore").select("det_id", F.col("zone").alias("offshore_zone"), "dist_m")
    rows = H.with_recurrence(det(s, d).join(at_sea, "det_id")).withColumn("region", F.lit("offshore"))
    blank = {c: F.lit(None).cast("double") for c in ("dist_to_industrial_m", "dist_to_flare_capable_m", "dist_to_heat_industry_m", "dist_to_coal_mine_m")}
    texts = {c: F.lit(None).cast("string") for c in ("osm_industrial_tag", "nearest_coal_source", "landcover_class")}
    labels = apply_rules(rows.withColumns(blank | texts), offshore=True, unconfirmed=UNCONFIRMED)
    return labels.select("det_id", "label", "label_source", F.col("offshore_zone").alias("zone"), "dist_m", F.col("recurrence_count").alias("days"))


@query("label_offshore", f"SELECT det_id, label, label_source, zone FROM ({_SEA_LABEL}) u")
def label_offshore(s, d):
    return labelled_offshore(s, d).select("det_id", "label", "label_source", "zone")


# Clusters


def unzoned_sea(s, d) -> DataFrame:
    """Detections outside every zone, from FLOOR to COAST metres off land, with ``dist_m``."""
    inside = F.col("latitude").between(F.col("south"), F.col("north")) & F.col("longitude").between(F.col("west"), F.col("east"))
    rows = L.projected(det(s, d)).join(F.broadcast(view(s, d, "zones")), inside, "left_anti")
    dist = once(s, d, "unzoned_distances", lambda: distance_to_land(L.places(rows), view(s, d, "regions")))
    return rows.join(dist, ["latitude", "longitude"]).where(F.col("dist_m").between(FLOOR, COAST))


def offshore_clusters(s, d) -> DataFrame:
    """(cluster, cell, detections, active_days): cells of ``unzoned_sea`` with SEA_DAYS active days or more at their mean position, linked up to
    SEA_REACH apart."""
    cells = unzoned_sea(s, d).groupBy("cell").agg(F.count("*").alias("detections"), F.countDistinct("acq_date").alias("active_days"), F.avg("x").alias("x"), F.avg("y").alias("y"))
    cells = cells.where(F.col("active_days") >= SEA_DAYS)
    found = clusters.density_clusters(cells.select(F.lit(0).alias("g"), F.col("cell").alias("pid"), "x", "y"), "g", SEA_REACH, 1)
    return cells.join(found.withColumnRenamed("pid", "cell"), "cell")


TABLES |= {
    "unzoned": f"""SELECT det.*, dist_m FROM det JOIN (SELECT latitude, longitude, CASE WHEN EXISTS (SELECT 1 FROM regions r WHERE m.latitude BETWEEN r.south AND r.north AND m.longitude > r.west AND m.longitude < r.east)
  THEN 0.0::DOUBLE ELSE dist END AS dist_m FROM (SELECT latitude, longitude, min(sqrt(pow(x - x1 - {_T} * {_DX}, 2) + pow(y - y1 - {_T} * {_DY}, 2))) AS dist FROM loc CROSS JOIN ({_SHORE}) g GROUP BY ALL) m) u USING (latitude, longitude)
  WHERE dist_m BETWEEN {FLOOR} AND {COAST} AND NOT EXISTS (SELECT 1 FROM zones z WHERE det.latitude BETWEEN z.south AND z.north AND det.longitude BETWEEN z.west AND z.east)""",
    "sea_cells": f"SELECT cell, count(*) AS detections, count(DISTINCT acq_date) AS active_days, avg(x) AS x, avg(y) AS y FROM unzoned GROUP BY cell HAVING count(DISTINCT acq_date) >= {SEA_DAYS}",
    "sea_links": f"SELECT a.cell AS u, b.cell AS v FROM sea_cells a JOIN sea_cells b ON sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= {SEA_REACH}",
    "sea_reach": "SELECT u AS node, v AS other FROM sea_links UNION SELECT r.node, l.v FROM sea_reach r JOIN sea_links l ON r.other = l.u",
    "sea_clusters": "SELECT c.*, r.cluster FROM sea_cells c JOIN (SELECT node, min(other) AS cluster FROM sea_reach GROUP BY node) r ON c.cell = r.node",
    "zone_cells": f"SELECT cell, avg(det.x) AS x, avg(det.y) AS y FROM det JOIN ({_AT_SEA}) o USING (det_id) GROUP BY cell HAVING count(DISTINCT acq_date) >= {SEA_DAYS}",
}


@query("offshore_clusters", "SELECT cluster, cell, detections, active_days FROM sea_clusters")
def offshore_clusters_rows(s, d):
    return offshore_clusters(s, d).select("cluster", "cell", "detections", "active_days")


@query("cluster_summary", """SELECT cluster, count(DISTINCT cell) AS cells, count(*) AS detections, count(DISTINCT acq_date) AS active_days, min(acq_date) AS first_seen, max(acq_date) AS last_seen, round(avg(latitude), 3) AS latitude, round(avg(longitude), 3) AS longitude,
  round(avg((daynight = 'N')::INT), 4) AS night_share, median(frp) AS frp_median, max(frp) AS frp_max, round(avg(dist_m) / 1000, 1) AS coast_km, round(min(dist_m) / 1000, 1) AS nearest_land_km FROM unzoned JOIN (SELECT cell, cluster FROM sea_clusters) c USING (cell) GROUP BY cluster""")
def cluster_summary(s, d):
    rows = unzoned_sea(s, d).join(offshore_clusters(s, d).select("cell", "cluster"), "cell")
    km = lambda f, name: F.round(f("dist_m") / 1_000, 1).alias(name)
    return rows.groupBy("cluster").agg(
        F.countDistinct("cell").alias("cells"), F.count("*").alias("detections"), F.countDistinct("acq_date").alias("active_days"), F.min("acq_date").alias("first_seen"),
        F.max("acq_date").alias("last_seen"), F.round(F.avg("latitude"), 3).alias("latitude"), F.round(F.avg("longitude"), 3).alias("longitude"),
        F.round(F.avg((F.col("daynight") == "N").cast("int")), 4).alias("night_share"),
        F.percentile("frp", F.lit(0.5)).alias("frp_median"), F.max("frp").alias("frp_max"), km(F.avg, "coast_km"), km(F.min, "nearest_land_km"),
    )


@query("compare_locations", """SELECT cell, round(min(sqrt(pow(c.x - f.x, 2) + pow(c.y - f.y, 2))) FILTER (WHERE facility_type = 'lng_terminal') / 1000, 3) AS platform_km,
  round(min(sqrt(pow(c.x - f.x, 2) + pow(c.y - f.y, 2))) FILTER (WHERE facility_type = 'oil_gas_field') / 1000, 3) AS field_km FROM zone_cells c CROSS JOIN fac f GROUP BY cell""")
def compare_locations(s, d):
    """Kilometres from each persistent cell of the zones to the nearest terminal and to the nearest field."""
    rows = L.projected(det(s, d)).join(offshore(s, d).where("offshore").select("det_id"), "det_id", "left_semi")
    cells = rows.groupBy("cell").agg(F.countDistinct("acq_date").alias("active_days"), F.avg("x").alias("x"), F.avg("y").alias("y")).where(F.col("active_days") >= SEA_DAYS)
    points = cells.select(F.col("cell").alias("pid"), "x", "y")
    role = F.when(F.col("facility_type") == "lng_terminal", "platform").when(F.col("facility_type") == "oil_gas_field", "field")
    spots = L.facilities(s, d).withColumn("role", role).where("role IS NOT NULL")
    found = spatial.nearest_by_role(points, spots.select(F.col("facility_id").alias("fid"), F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("x").alias("x2"), F.col("y").alias("y2"), "role"), ["platform", "field"], which=False)
    km = lambda r: F.round(F.max(F.when(F.col("role") == r, F.col("dist"))) / 1_000, 3).alias(f"{r}_km")
    return found.groupBy(F.col("pid").alias("cell")).agg(km("platform"), km("field"))


#: Positions have five decimals; sums of whole units don't depend on their order.
UNITS = 100_000


def large_fire_events(s, d) -> DataFrame:
    """One row a cluster: acq_date, cluster, detections, total_frp, label (the most frequent, ties by name), x, y, latitude and longitude (means), of
    agricultural burning and wildfire rows of a complete day (one before the last) that stand densely. Rows whose neighbourhood was active on
    more than FIRE_ACTIVE of the FIRE_DAYS days before don't count: industry and coal seams burn there every day."""
    last = det(s, d).agg(F.max("acq_date").alias("last"))
    rows = L.labelled(s, d).where(F.col("label").isin("agricultural burning", "wildfire")).join(F.broadcast(last), F.col("acq_date") < F.col("last"))
    kept = H.neighbourhood_days(rows.select("det_id", "gi", "gj", "acq_date"), det(s, d), -FIRE_DAYS, -1).where(F.col("n") <= FIRE_ACTIVE).select("det_id")
    rows = rows.join(kept, "det_id", "left_semi").select("det_id", "acq_date", "label", "frp", "x", "y", *[F.rint(F.col(c) * UNITS).cast("long").alias(c) for c in ("latitude", "longitude")])
    found = clusters.density_clusters(rows.select("acq_date", F.col("det_id").alias("pid"), "x", "y"), "acq_date", FIRE_REACH, FIRE_LEAST)
    rows = rows.join(found.withColumnRenamed("pid", "det_id"), "det_id")
    each = rows.groupBy("acq_date", "cluster", "label").agg(F.count("*").alias("n"), F.sum("frp").alias("frp"), *[F.sum(c).alias(c) for c in ("x", "y", "latitude", "longitude")])
    total = F.sum("n")
    return each.groupBy("acq_date", "cluster").agg(
        total.alias("detections"), F.sum("frp").alias("total_frp"), F.min_by("label", F.struct(-F.col("n"), "label")).alias("label"), *[(F.sum(c) / total).alias(c) for c in ("x", "y")],
        *[(F.floor(F.sum(c) / total + 0.5) / UNITS).alias(c) for c in ("latitude", "longitude")],
    )


TABLES |= {
    "fire_rows": f"""SELECT det_id, acq_date, label, frp, x, y, latitude, longitude FROM lab a WHERE label IN ('agricultural burning', 'wildfire') AND acq_date < (SELECT max(acq_date) FROM det)
  AND (SELECT count(DISTINCT b.acq_date) FROM det b WHERE abs(a.gi - b.gi) <= 1 AND abs(a.gj - b.gj) <= 1 AND CAST(b.acq_date AS DATE) BETWEEN CAST(a.acq_date AS DATE) - {FIRE_DAYS} AND CAST(a.acq_date AS DATE) - 1) <= {FIRE_ACTIVE}""",
    "fire_pairs": f"SELECT a.det_id AS u, b.det_id AS v FROM fire_rows a JOIN fire_rows b ON a.acq_date = b.acq_date AND sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= {FIRE_REACH}",
    "fire_cores": f"SELECT u FROM fire_pairs GROUP BY u HAVING count(*) >= {FIRE_LEAST}",
    "fire_reach": "SELECT u AS node, u AS other FROM fire_cores UNION SELECT r.node, p.v FROM fire_reach r JOIN fire_pairs p ON r.other = p.u WHERE p.v IN (SELECT u FROM fire_cores)",
    "fire_of": "SELECT node, min(other) AS cluster FROM fire_reach GROUP BY node",
    "fire_members": "SELECT v AS det_id, coalesce(min(cluster) FILTER (WHERE u = v), min(cluster)) AS cluster FROM fire_pairs JOIN fire_of ON u = node GROUP BY v",
    "fires": """SELECT acq_date, cluster, sum(n)::BIGINT AS detections, sum(frp) AS total_frp, first(label ORDER BY n DESC, label) AS label, sum(x) / sum(n) AS x, sum(y) / sum(n) AS y,
  floor(sum(latitude)::DOUBLE / sum(n)::DOUBLE + 0.5) / 100000 AS latitude, floor(sum(longitude)::DOUBLE / sum(n)::DOUBLE + 0.5) / 100000 AS longitude FROM (SELECT acq_date, cluster, label, count(*) AS n, sum(frp) AS frp, sum(x) AS x, sum(y) AS y, sum(round_even(latitude * 100000, 0)::BIGINT) AS latitude, sum(round_even(longitude * 100000, 0)::BIGINT) AS longitude FROM fire_rows JOIN fire_members USING (det_id) GROUP BY ALL) t GROUP BY acq_date, cluster""",
}


@query("large_fire_events", "SELECT acq_date, cluster, detections, round(total_frp, 6) AS total_frp, label FROM fires")
def large_fire_events_rows(s, d):
    return large_fire_events(s, d).select("acq_date", "cluster", "detections", F.round("total_frp", 6).alias("total_frp"), "label")


@query("drop_known_events", f"""SELECT acq_date, cluster FROM fires f WHERE NOT EXISTS (SELECT 1 FROM fires k WHERE k.acq_date = f.acq_date AND k.label = 'wildfire' AND k.cluster <> f.cluster
  AND sqrt(pow(k.x - f.x, 2) + pow(k.y - f.y, 2)) <= {KNOWN_KM * 1000})""")
def drop_known_events(s, d):
    """Fires without another one of the same day within KNOWN_KM that is known (here: a wildfire)."""
    fires = large_fire_events(s, d)
    known = fires.where("label = 'wildfire'").select(F.col("acq_date").alias("day"), F.col("cluster").alias("known"), F.col("x").alias("kx"), F.col("y").alias("ky"))
    apart = F.sqrt(F.pow(F.col("x") - F.col("kx"), 2) + F.pow(F.col("y") - F.col("ky"), 2))
    same = (F.col("acq_date") == F.col("day")) & (F.col("cluster") != F.col("known")) & (apart <= KNOWN_KM * 1_000)
    return fires.join(known, same, "left_anti").select("acq_date", "cluster")


TABLES["gold_xy"] = "SELECT *, " + ", ".join(f"{c} AS {n}" for n, c in zip("xy", project_sql("latitude", "longitude"))) + " FROM gold"


@query("isolated_points", f"""SELECT g.sample_id FROM gold_xy g WHERE NOT EXISTS (SELECT 1 FROM loc WHERE sqrt(pow(loc.x - g.x, 2) + pow(loc.y - g.y, 2)) < {ISOLATED})""")
def isolated_points(s, d):
    """Sample points at least ISOLATED metres from every detection."""
    sample = L.projected(view(s, d, "gold")).select("sample_id", "latitude", "longitude", "x", "y")
    found = L.places(L.detections(s, d)).select(F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("x").alias("x2"), F.col("y").alias("y2"), F.lit(0).cast("long").alias("fid"))
    near = spatial.within(L.places(sample), found, ISOLATED).where(F.col("dist") < ISOLATED)
    return sample.join(L._by_place(near), ["latitude", "longitude"], "left_anti").select("sample_id")




# Samples


_MIXED = "md5(concat(cell, '|7'))"


@query("seeded_sample", f"SELECT cell FROM (SELECT DISTINCT cell FROM det) t ORDER BY {_MIXED}, cell LIMIT 30")
def seeded_sample(s, d):
    """Thirty cells by a hash of cell and seed: the same ones whatever the partitioning."""
    return det(s, d).select("cell").distinct().orderBy(F.md5(F.concat("cell", F.lit("|7"))), "cell").limit(30)


@query("stratified_sample", f"""SELECT det_id, label, is_anomalous FROM (SELECT *, row_number() OVER (PARTITION BY label, is_anomalous ORDER BY {_MIXED}, cell) AS n FROM (
  SELECT det_id, cell, label, is_anomalous, row_number() OVER (PARTITION BY cell ORDER BY is_anomalous DESC, det_id) AS nth FROM lab) t WHERE nth = 1) u WHERE n <= CASE WHEN is_anomalous THEN 10 ELSE 20 END""")
def stratified_sample(s, d):
    """Of each class up to 10 anomalous and 20 other detections, one of a cell at most."""
    one = L.labelled(s, d).groupBy("cell").agg(F.min(F.struct(~F.col("is_anomalous"), "det_id", "label", "is_anomalous")).alias("r")).select("cell", "r.det_id", "r.label", "r.is_anomalous")
    nth = F.row_number().over(Window.partitionBy("label", "is_anomalous").orderBy(F.md5(F.concat("cell", F.lit("|7"))), "cell"))
    return one.withColumn("n", nth).where(F.col("n") <= F.when(F.col("is_anomalous"), 10).otherwise(20)).select("det_id", "label", "is_anomalous")
