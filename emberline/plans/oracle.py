"""The same results as plain SQL for DuckDB, written over cross joins: common tables that oracles build on."""

from __future__ import annotations

from ..contract import FLARE_TYPES, HEAT_TYPES, NEVER_DUG
from ..fixtures import with_views
from ..functions.scalars import project_sql


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


_X, _Y = project_sql("latitude", "longitude")


def _side(a: str, b: str, c: str, d: str) -> str:
    (x1, y1), (x2, y2) = project_sql(b, a), project_sql(d, c)
    return f"SELECT feature_id AS fid, {x1} AS x1, {y1} AS y1, {x2} AS x2, {y2} AS y2 FROM ctx"


_DX, _DY = "(x2 - x1)", "(y2 - y1)"
_T = f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(((x - x1) * {_DX} + (y - y1) * {_DY}) / nullif({_DX} * {_DX} + {_DY} * {_DY}, 0), 0)))"
_NEAR = "SELECT latitude, longitude, min(d) AS d FROM pairs JOIN ctx ON fid = feature_id {where} GROUP BY ALL"
_SITE = """SELECT * FROM (SELECT l.latitude, l.longitude, sqrt(pow(l.x - f.x, 2) + pow(l.y - f.y, 2)) AS d, f.facility_type AS kind, f.area_km2,
  row_number() OVER (PARTITION BY l.latitude, l.longitude ORDER BY sqrt(pow(l.x - f.x, 2) + pow(l.y - f.y, 2)), f.facility_id) AS n
  FROM loc l CROSS JOIN fac f WHERE {where}) t WHERE n = 1"""

TABLES = {
    "det": f"SELECT *, gi || '_' || gj AS cell FROM (SELECT *, round_even(latitude / 0.0034::DOUBLE, 0)::BIGINT AS gi, round_even(longitude / 0.0034::DOUBLE, 0)::BIGINT AS gj, {_X} AS x, {_Y} AS y FROM detections) t",
    "loc": "SELECT DISTINCT latitude, longitude, x, y FROM det",
    "fac": f"SELECT *, {_X} AS x, {_Y} AS y FROM facilities",
    "ctx": "SELECT * FROM context_boxes WHERE NOT coalesce(power = 'plant' AND plant_source IN ('solar', 'wind'), false)",
    "segs": _side("west", "south", "east", "south") + " UNION ALL " + " UNION ALL ".join(
        _side(*s) + " WHERE geom_type = 'Polygon'" for s in (("east", "south", "east", "north"), ("east", "north", "west", "north"), ("west", "north", "west", "south"))
    ),
    "sided": f"""SELECT latitude, longitude, fid, x, y, x1, y1, x2, y2,
  sqrt(pow(x - x1 - {_T} * {_DX}, 2) + pow(y - y1 - {_T} * {_DY}, 2)) AS d FROM loc CROSS JOIN segs""",
    "pairs": """SELECT latitude, longitude, fid, CASE WHEN sum(CASE WHEN (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / nullif(y2 - y1, 0) + x1 THEN 1 ELSE 0 END) % 2 = 1
  THEN 0.0::DOUBLE ELSE min(d) END AS d FROM sided GROUP BY latitude, longitude, fid""",
    "n_ind": _NEAR.format(where=""),
    "n_tag": """SELECT latitude, longitude, arg_min(coalesce(industrial, 'yes'), CASE WHEN industrial = 'refinery' THEN '' ELSE coalesce(industrial, 'yes') END) AS tag
  FROM pairs JOIN ctx ON fid = feature_id WHERE d = 0 AND geom_type = 'Polygon' GROUP BY ALL""",
    "n_kiln": _NEAR.format(where="WHERE industrial = 'brickyard' OR man_made = 'kiln'"),
    "n_mine": _NEAR.format(where="WHERE industrial = 'mine'"),
    "n_flare": _SITE.format(where=f"f.facility_type IN ({sql_list(FLARE_TYPES)})"),
    "n_heat": _SITE.format(where=f"f.facility_type IN ({sql_list(HEAT_TYPES)})"),
    "n_coal": _SITE.format(where=f"f.facility_type = 'coal_mine' AND NOT coalesce(lower(f.status) IN ({sql_list(NEVER_DUG)}), false)"),
    "around": """SELECT loc.latitude, loc.longitude, n_ind.d AS dist_to_industrial_m, n_tag.tag AS osm_industrial_tag,
  n_flare.d AS dist_to_flare_capable_m, n_flare.kind AS nearest_flare_facility_type, n_heat.d AS dist_to_heat_industry_m, n_heat.kind AS nearest_heat_facility_type,
  coalesce(greatest(0.0::DOUBLE, n_coal.d - sqrt(coalesce(n_coal.area_km2, 0) * 1000000 / pi())), n_mine.d) AS dist_to_coal_mine_m,
  CASE WHEN n_coal.d IS NOT NULL THEN 'gem' WHEN n_mine.d IS NOT NULL THEN 'osm' END AS nearest_coal_source, n_kiln.d AS dist_to_brick_kiln_m
  FROM loc LEFT JOIN n_ind USING (latitude, longitude) LEFT JOIN n_tag USING (latitude, longitude) LEFT JOIN n_flare USING (latitude, longitude)
  LEFT JOIN n_heat USING (latitude, longitude) LEFT JOIN n_coal USING (latitude, longitude) LEFT JOIN n_mine USING (latitude, longitude) LEFT JOIN n_kiln USING (latitude, longitude)""",
    "rec": "SELECT gi, gj, count(DISTINCT acq_date) AS recurrence_count, min(acq_date) AS first_seen, max(acq_date) AS last_seen FROM det GROUP BY gi, gj",
    "daily": "SELECT gi, gj, daynight, acq_date, max(frp) AS max_frp FROM det WHERE daynight IS NOT NULL GROUP BY ALL",
    "prior": """SELECT gi, gj, daynight, acq_date, count(*) OVER w AS n, count(max_frp) OVER w AS n_known,
  median(max_frp) OVER w AS med, list(max_frp) OVER w AS days FROM daily
  WINDOW w AS (PARTITION BY gi, gj, daynight ORDER BY acq_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "base": """SELECT gi, gj, daynight, acq_date, n, CASE WHEN n >= 5 AND n = n_known THEN med END AS med,
  CASE WHEN n >= 5 AND n = n_known THEN list_aggregate(list_transform(days, lambda v: abs(v - med)), 'median') END AS mad FROM prior""",
    "feat": """SELECT det.*, around.* EXCLUDE (latitude, longitude), CASE WHEN c.class_code <> 0 THEN c.class_code END AS landcover_class,
  rec.recurrence_count, rec.first_seen, rec.last_seen,
  coalesce(CASE WHEN base.mad = 0 THEN frp > 3 * base.med ELSE 0.6745 * (frp - base.med) / base.mad > 3.5 END, false) AS is_anomalous,
  base.med AS baseline_frp, coalesce(base.n, 0) AS prior_active_days
  FROM det JOIN around USING (latitude, longitude) LEFT JOIN landcover_cells c ON c.gi = det.gi AND c.gj = det.gj
  JOIN rec ON rec.gi = det.gi AND rec.gj = det.gj
  LEFT JOIN base ON base.gi = det.gi AND base.gj = det.gj AND base.daynight = det.daynight AND base.acq_date = det.acq_date""",
    "atoms": """SELECT *, coalesce(dist_to_flare_capable_m <= 1000, false) AS near_flare, coalesce(dist_to_heat_industry_m, 1e12) AS heat,
  coalesce(dist_to_industrial_m, 1e12) AS ind, coalesce(dist_to_coal_mine_m, 1e12) AS coal, recurrence_count AS r FROM feat""",
    "ruled": """SELECT *, near_flare AND r >= 5 AS is_flare,
  (heat <= 2000 AND NOT near_flare AND r >= 2) OR (r = 1 AND (ind <= 1 OR heat <= 500)) OR (r >= 2 AND osm_industrial_tag IS NOT NULL AND NOT (near_flare AND r >= 5))
  OR (nearest_coal_source = 'gem' AND coal <= 3000 AND r >= 2) OR (nearest_coal_source = 'osm' AND coal <= 1000 AND r >= 3) AS is_industrial,
  coalesce(landcover_class = 40, false) AND ind > 2000 AS is_crop, coalesce(landcover_class IN (10, 20, 30), false) AND ind > 2000 AS is_wild FROM atoms""",
    "lab": """SELECT *, CASE WHEN m <> 1 THEN 'unknown' WHEN is_flare THEN 'gas flare' WHEN is_industrial THEN 'industrial' WHEN is_crop THEN 'agricultural burning' ELSE 'wildfire' END AS label,
  CASE WHEN m = 1 THEN 'rule' WHEN m > 1 THEN 'conflict' ELSE 'unknown' END AS label_source
  FROM (SELECT *, is_flare::INT + is_industrial::INT + is_crop::INT + is_wild::INT AS m FROM ruled) t""",
    "placed": """SELECT latitude, longitude, min(fid) AS state FROM (SELECT p.latitude, p.longitude, fid FROM (SELECT DISTINCT latitude, longitude FROM detections) p JOIN boundary_sides b
  ON (b.y1 > p.latitude) <> (b.y2 > p.latitude) AND p.longitude < (b.x2 - b.x1) * (p.latitude - b.y1) / (b.y2 - b.y1) + b.x1 GROUP BY ALL HAVING count(*) % 2 = 1) t GROUP BY ALL""",
    "lab_s": "SELECT lab.*, s.state FROM lab LEFT JOIN placed s USING (latitude, longitude)",
}


def oracle(query: str, more: dict[str, str] | None = None) -> str:
    return with_views(query, TABLES | (more or {}))
