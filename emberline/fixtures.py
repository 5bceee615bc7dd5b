"""The engine's inputs, derived from the driver's tables by SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings"]

VIEWS = {
    "detections": """
SELECT event_id AS det_id,
  round((6200 + (k * 17) % 400 + burst) * CAST(0.0034 AS DOUBLE) + ((event_id % 3) - 1) * CAST(0.0008 AS DOUBLE), 5) AS latitude,
  round((20700 + (k * 29) % 397) * CAST(0.0034 AS DOUBLE) + ((event_id % 5) - 2) * CAST(0.0006 AS DOUBLE), 5) AS longitude,
  CAST(CAST(ts AS DATE) AS STRING) AS acq_date,
  lpad(CAST(hour(ts) * 100 + minute(ts) AS STRING), 4, '0') AS acq_time,
  CASE event_id % 3 WHEN 0 THEN 'N' WHEN 1 THEN '1' ELSE '2' END AS satellite,
  CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(300 + event_id % 67 AS DOUBLE) END AS bright_ti4,
  CAST(280 + event_id % 31 AS DOUBLE) AS bright_ti5,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE value / 8 END AS frp,
  CASE event_id % 4 WHEN 0 THEN 'l' WHEN 1 THEN 'n' WHEN 2 THEN 'h' ELSE 'high' END AS confidence,
  CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN 'D' ELSE 'N' END AS daynight
FROM (SELECT *, CASE WHEN event_id % 8 = 3 THEN CAST(floor(event_id / 8) AS BIGINT) % 9 ELSE 0 END AS burst,
                CASE WHEN event_id % 4 < 2 THEN user_id % 40
                     WHEN event_id % 4 = 2 THEN 100 + event_id % 401
                     WHEN event_id % 8 = 3 THEN 40000 + dayofmonth(ts) * 13
                     ELSE 1000 + (event_id * 7919) % 30011 END AS k FROM events) e
""",
    "facilities": """
SELECT s_suppkey AS facility_id, s_name AS facility_name,
  CASE s_suppkey % 8 WHEN 0 THEN 'oil_gas_power_plant' WHEN 1 THEN 'cement_plant' WHEN 2 THEN 'oil_gas_field' WHEN 3 THEN 'steel_plant'
    WHEN 4 THEN 'lng_terminal' WHEN 5 THEN 'coal_power_plant' WHEN 6 THEN 'chemical_plant' ELSE 'coal_mine' END AS facility_type,
  CASE s_suppkey % 6 WHEN 0 THEN 'operating' WHEN 1 THEN 'closed' WHEN 2 THEN 'mothballed; 2019' WHEN 3 THEN 'Proposed'
    WHEN 4 THEN 'retired' ELSE 'cancelled; shelved' END AS status,
  (s_suppkey % 5) * CAST(0.5 AS DOUBLE) AS area_km2,
  round((6200 + (s_suppkey * 17 + s_suppkey % 6) % 400) * CAST(0.0034 AS DOUBLE), 5) AS latitude,
  round((20700 + (s_suppkey * 29) % 397) * CAST(0.0034 AS DOUBLE), 5) AS longitude
FROM supplier
""",
    "context_boxes": """
SELECT 10 * g AS feature_id, CASE WHEN g % 3 = 0 THEN 'Point' ELSE 'Polygon' END AS geom_type,
  clat - h AS south, clat + h AS north, clon - h AS west, clon + h AS east,
  CASE g % 8 WHEN 0 THEN 'refinery' WHEN 2 THEN 'mine' WHEN 3 THEN 'brickyard' WHEN 4 THEN 'Steel' WHEN 6 THEN 'cement' END AS industrial,
  CASE WHEN g % 8 IN (1, 7) THEN 'industrial' END AS landuse,
  CASE WHEN g % 8 = 5 THEN 'plant' END AS power,
  CASE WHEN g % 8 = 5 THEN CASE cast(floor(g / 8) AS BIGINT) % 4 WHEN 0 THEN 'coal' WHEN 1 THEN 'solar' WHEN 2 THEN 'gas; oil' ELSE 'wind' END END AS plant_source,
  CASE WHEN g % 16 = 7 THEN 'kiln' END AS man_made, CASE WHEN g % 3 = 0 THEN NULL ELSE name END AS name
FROM (SELECT g, name, CASE WHEN g % 3 = 0 THEN CAST(0.0 AS DOUBLE) ELSE CAST(0.002 AS DOUBLE) + (10 * g + parts) % 40 * CAST(0.0002 AS DOUBLE) END AS h,
    (6200 + (k * 17) % 400) * CAST(0.0034 AS DOUBLE) AS clat, (20700 + (k * 29) % 397) * CAST(0.0034 AS DOUBLE) AS clon
  FROM (SELECT g, name, parts, CASE WHEN g % 2 = 0 THEN g ELSE 100 + (g * 70) % 401 END AS k
    FROM (SELECT CAST(floor(p_partkey / 10) AS BIGINT) AS g, min(p_name) AS name, count(*) AS parts FROM part GROUP BY CAST(floor(p_partkey / 10) AS BIGINT)) a) b) c
""",
    "regions": """
SELECT n_name AS name,
  CAST(21.08 AS DOUBLE) + CAST(floor(n_nationkey / 5) AS BIGINT) * CAST(0.25 AS DOUBLE) AS south, CAST(21.33 AS DOUBLE) + CAST(floor(n_nationkey / 5) AS BIGINT) * CAST(0.25 AS DOUBLE) AS north,
  CAST(70.38 AS DOUBLE) + (n_nationkey % 5) * CAST(0.2 AS DOUBLE) AS west, CAST(70.58 AS DOUBLE) + (n_nationkey % 5) * CAST(0.2 AS DOUBLE) AS east
FROM nation
""",
    "boundary_points": """
SELECT name, ring, i,
  round(CAST(70.48 AS DOUBLE) + (k % 5) * CAST(0.2 AS DOUBLE) + CASE ring WHEN 0 THEN CAST(0.08 AS DOUBLE) * (1 + CAST(0.2 AS DOUBLE) * sin(7 * turn)) * cos(turn)
    WHEN 1 THEN CAST(0.03 AS DOUBLE) * cos(turn) ELSE CAST(0.085 AS DOUBLE) + CAST(0.01 AS DOUBLE) * cos(turn) END, 7) AS longitude,
  round(CAST(21.205 AS DOUBLE) + CAST(floor(k / 5) AS BIGINT) * CAST(0.25 AS DOUBLE) + CASE ring WHEN 0 THEN CAST(0.1 AS DOUBLE) * (1 + CAST(0.2 AS DOUBLE) * sin(7 * turn)) * sin(turn)
    WHEN 1 THEN CAST(0.03 AS DOUBLE) * sin(turn) ELSE CAST(0.11 AS DOUBLE) + CAST(0.01 AS DOUBLE) * sin(turn) END, 7) AS latitude
FROM (SELECT n_name AS name, k, ring, i, i * CAST(6.283185307179586 AS DOUBLE) / n AS turn FROM nation JOIN (
  SELECT k, ring, row_number() OVER (PARTITION BY k, ring ORDER BY o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY k, ring) AS n FROM (
    SELECT o_orderkey, (o_orderkey * 7) % 25 AS k, CASE CAST(floor(o_orderkey / 25) AS BIGINT) % 10 WHEN 0 THEN 1 WHEN 5 THEN 2 ELSE 0 END AS ring FROM orders) a) b
  ON n_nationkey = k) c
""",
    "boundary_sides": """
SELECT name AS fid, ring, longitude AS x1, latitude AS y1, coalesce(lead(longitude) OVER w, first_value(longitude) OVER w) AS x2,
  coalesce(lead(latitude) OVER w, first_value(latitude) OVER w) AS y2 FROM boundary_points WINDOW w AS (PARTITION BY name, ring ORDER BY i)
""",
    "zones": """
SELECT 'Zone A' AS zone, CAST(71.38 AS DOUBLE) AS west, CAST(21.08 AS DOUBLE) AS south, CAST(71.80 AS DOUBLE) AS east, CAST(21.80 AS DOUBLE) AS north
UNION ALL SELECT 'Zone B', CAST(71.38 AS DOUBLE), CAST(21.80 AS DOUBLE), CAST(71.80 AS DOUBLE), CAST(22.05 AS DOUBLE)
""",
    "landcover_cells": """
SELECT gi, gj, CASE (gi * 7 + gj * 3) % 10 WHEN 0 THEN 10 WHEN 1 THEN 20 WHEN 2 THEN 30 WHEN 3 THEN 40 WHEN 4 THEN 40 WHEN 5 THEN 40
    WHEN 6 THEN 50 WHEN 7 THEN 60 WHEN 8 THEN 100 ELSE 0 END AS class_code
FROM (SELECT DISTINCT a.gi + o.di AS gi, a.gj + p.di AS gj FROM
  (SELECT DISTINCT CAST(floor(latitude / CAST(0.0034 AS DOUBLE) + 0.5) AS BIGINT) AS gi, CAST(floor(longitude / CAST(0.0034 AS DOUBLE) + 0.5) AS BIGINT) AS gj FROM detections) a
  CROSS JOIN (SELECT -1 AS di UNION ALL SELECT 0 UNION ALL SELECT 1) o CROSS JOIN (SELECT -1 AS di UNION ALL SELECT 0 UNION ALL SELECT 1) p) t
""",
    "landcover_pixels": """
SELECT row, col, CASE (row * 7 + col * 3) % 10 WHEN 0 THEN 10 WHEN 1 THEN 20 WHEN 2 THEN 30 WHEN 3 THEN 40 WHEN 4 THEN 40 WHEN 5 THEN 40
    WHEN 6 THEN 50 WHEN 7 THEN 60 WHEN 8 THEN 100 ELSE 0 END AS value
FROM (SELECT DISTINCT a.r + o.i AS row, a.c + p.i AS col FROM
  (SELECT DISTINCT CAST(floor(round(latitude / CAST(0.0017 AS DOUBLE), 9)) AS BIGINT) AS r, CAST(floor(round(longitude / CAST(0.0017 AS DOUBLE), 9)) AS BIGINT) AS c FROM detections WHERE det_id % 50 <> 7) a
  CROSS JOIN (SELECT -2 AS i UNION ALL SELECT -1 UNION ALL SELECT 0 UNION ALL SELECT 1 UNION ALL SELECT 2) o
  CROSS JOIN (SELECT -2 AS i UNION ALL SELECT -1 UNION ALL SELECT 0 UNION ALL SELECT 1 UNION ALL SELECT 2) p) t
""",
    "scenes": """
SELECT l_orderkey AS point_id, CAST(l_shipdate AS DATE) AS scene_date, l_linenumber AS px,
  l_quantity / 64 AS b08, l_discount AS b12, CAST(l_partkey % 12 AS INT) AS scl FROM lineitem
""",
    "box_pixels": """
SELECT vec_id % 60 AS point_id, vec_id AS scene_id, DATE '2024-01-01' + CAST((CAST(floor(vec_id / 60) AS BIGINT) * 7 + vec_id % 60) % 37 AS INT) AS scene_date, label, embedding FROM embeddings
""",
    "gold": """
SELECT concat('G', lpad(CAST(c_custkey AS STRING), 9, '0')) AS sample_id,
  round((6200 + (c_custkey * 17) % 400) * CAST(0.0034 AS DOUBLE), 5) AS latitude, round((20700 + (c_custkey * 29) % 397) * CAST(0.0034 AS DOUBLE), 5) AS longitude,
  CASE c_nationkey % 5 WHEN 0 THEN 'gas flare' WHEN 1 THEN 'industrial' WHEN 2 THEN 'agricultural burning' WHEN 3 THEN 'wildfire' ELSE 'unknown' END AS label,
  CASE WHEN c_custkey % 7 = 0 THEN 'uncertain' WHEN c_custkey % 4 = 0 THEN 'industrial' ELSE
    CASE c_nationkey % 5 WHEN 0 THEN 'gas flare' WHEN 1 THEN 'industrial' WHEN 2 THEN 'agricultural burning' WHEN 3 THEN 'wildfire' ELSE 'unknown' END END AS verified_label
FROM customer
""",
    "availability": """
SELECT satellite, concat(satellite, CASE WHEN standard THEN '_SP' ELSE '_NRT' END) AS source, CASE WHEN standard THEN 1 ELSE 2 END AS pref,
  min(day) AS min_date, max(day) AS max_date
FROM (SELECT satellite, day, n < 12 AS standard FROM (SELECT CASE event_id % 3 WHEN 0 THEN 'NOAA20' WHEN 1 THEN 'NOAA21' ELSE 'SNPP' END AS satellite,
    CAST(ts AS DATE) AS day, dayofmonth(ts) + event_id % 3 * 2 AS n, event_id FROM events) e WHERE n < 12 OR n > 10 + event_id % 5) f
GROUP BY satellite, standard
""",
    "burn_points": """
SELECT o_orderkey AS point_id, CAST(o_orderdate AS DATE) AS acq_date FROM orders
""",
}


def _uses(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b{n}\b", sql)]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view over ``{sf_dir}/*.parquet``; only columns and rows that a query needs are read."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = VIEWS[name]
    needs = [n for n in _uses(sql, [*TABLES, *VIEWS]) if n != name and re.search(rf"\bFROM\s+{n}\b", sql)]
    for n in needs:
        sql = re.sub(rf"\bFROM\s+{n}\b", f"FROM {{{n}}}", sql)
    return spark.sql(sql, **{n: view(spark, sf_dir, n) for n in needs})


def with_views(query: str, more: dict[str, str] | None = None) -> str:
    """``query`` with the views (and ``more``: later common tables in order) it uses as a WITH prefix, for DuckDB."""
    tables = VIEWS | (more or {})
    wanted, todo = set(), [query]
    while todo:
        for n in _uses(todo.pop(), tables):
            if n not in wanted:  # a recursive table names itself
                wanted.add(n)
                todo.append(tables[n])
    parts = ",\n".join(f"{n} AS ({s.strip()})" for n, s in tables.items() if n in wanted)
    return f"WITH RECURSIVE {parts}\n{query.strip()}" if parts else query
