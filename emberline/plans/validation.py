"""Validation of persistent heat at sea: a seeded draw of cells and of random control points, the clear scenes near their anchor dates,
hot pixels in these, and the verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..fixtures import view
from ..operators import history as H, spatial
from ..storage import once
from . import labels as L
from .catalog import det, query
from .offshore import FLOOR, ISOLATED, SEA_DAYS, _AT_SEA, _SHORE, offshore, offshore_columns
from .oracle import TABLES, _DX, _DY, _T
from ..functions.scalars import project_sql

SEED = 7
#: Cells drawn; control points needed, held with spares, and places tried for them; anchor dates of a point.
CELLS, CONTROLS, POOL, TRIES, ANCHORS = 30, 15, 40, 50_000, 3
#: Days from an anchor to its scene; share of clear pixels of a clear scene; clear scenes of a point that can be judged.
DAYS, CLEAR, SCENES = 3, 0.8, 2
#: A hot pixel's least value, and how many MADs over the median; metres from the centre to a hit; metres of a pixel.
HOT_LEAST, HOT_MADS, HIT, PIXEL = 0.30, 4.0, 200.0, 60.0
#: The rule passes with this share of cells hit, and so many controls at most.
PASS_RATE, PASS_CONTROLS = 0.40, 1


def hashed(*parts: str | Column) -> Column:
    """A number in [0, 1) of the seed and ``parts``: the same whatever the partitioning. It has 32 bits, so that it is exact in both engines."""
    text = F.concat_ws("|", F.lit(str(SEED)), *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def _hashed_sql(*parts: str) -> str:
    text = " || '|' || ".join([f"'{SEED}'", *[f"CAST({p} AS VARCHAR)" for p in parts]])
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


# The draw


def control_points(zones: DataFrame, detections: DataFrame, regions: DataFrame, pool: int = POOL, tries: int = TRIES, gap: float = ISOLATED, floor: float = FLOOR) -> DataFrame:
    """(n, id, zone, latitude, longitude, gap_m): the first ``pool`` of ``tries`` random points that keep ``gap`` metres from every
    detection (zone-shaped: latitude, longitude, x, y) and ``floor`` metres from every region.

    Try n's hash chooses the zone by inverse cumulative area and the place within it. Tries are independent, so all are made at once
    and rejected by joins; fewer than ``pool`` may be left."""
    area = (F.col("east") - F.col("west")) * (F.col("north") - F.col("south"))
    upto = Window.orderBy("zone")  # over the zones alone, of which there are a few
    shares = zones.withColumn("area", area).withColumn("till", F.sum("area").over(upto)).withColumn("from", F.col("till") - F.col("area"))
    shares = shares.withColumn("total", F.sum("area").over(Window.partitionBy()))
    tried = zones.sparkSession.range(tries).select(F.col("id").alias("n"), *[hashed("control", F.col("id"), k).alias(k) for k in ("zone_at", "lon_at", "lat_at")])
    hit = (F.col("zone_at") * F.col("total") >= F.col("from")) & (F.col("zone_at") * F.col("total") < F.col("till"))
    at = lambda share, lo, hi: F.col(lo) + F.col(share) * (F.col(hi) - F.col(lo))
    points = L.projected(tried.join(F.broadcast(shares), hit).select("n", at("lon_at", "west", "east").alias("longitude"), at("lat_at", "south", "north").alias("latitude")))
    spots = L.places(detections).select(F.lit(0).cast("long").alias("fid"), F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    pid = points.select(F.col("n").alias("pid"), "x", "y")
    near = spatial.within(pid, spots, gap).where(F.col("dist") < gap).select(F.col("pid").alias("n"))
    left = points.join(near, "n", "left_anti").withColumnRenamed("n", "det_id")
    at_sea = offshore_columns(left, zones, regions, floor).where("offshore")
    kept = at_sea.orderBy("det_id").limit(pool).select(F.col("det_id").alias("n"), "zone", "latitude", "longitude")
    away = spatial.nearest(L.projected(kept).select(F.col("n").alias("pid"), "x", "y"), spots, bucket=20_000.0, which=False).select(F.col("pid").alias("n"), F.col("dist").alias("gap_m"))
    number = F.row_number().over(Window.orderBy("n"))  # over the pool alone
    return kept.join(away, "n", "left").withColumn("id", F.concat(F.lit("C"), F.lpad(number.cast("string"), 2, "0")))


def drawn_cells(rows: DataFrame, count: int = CELLS, days: int = SEA_DAYS) -> DataFrame:
    """(id, cell, zone, latitude, longitude, active_days): up to ``count`` cells with ``days`` active days or more, by their hash. ``rows``: cell,
    zone, acq_date, latitude and longitude of detections at sea."""
    cells = rows.groupBy("cell").agg(F.min("zone").alias("zone"), F.countDistinct("acq_date").alias("active_days"), F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))
    kept = cells.where(F.col("active_days") >= days).orderBy(hashed("cell", F.col("cell")), "cell").limit(count)
    number = F.row_number().over(Window.orderBy("cell"))  # over the drawn cells alone
    return kept.withColumn("id", F.concat(F.lit("O"), F.lpad(number.cast("string"), 2, "0")))


def anchor_dates(points: DataFrame, dates: DataFrame, by: str, count: int = ANCHORS) -> DataFrame:
    """(id, anchor): up to ``count`` of the dates (``by``, acq_date) of each point's ``by``, by their hash."""
    offered = points.select("id", by).join(dates.select(by, "acq_date").distinct(), by)
    nth = F.row_number().over(Window.partitionBy("id").orderBy(hashed("anchor", F.col("id"), F.col("acq_date")), "acq_date"))
    return offered.withColumn("nth", nth).where(F.col("nth") <= count).select("id", F.col("acq_date").cast("date").alias("anchor"))


def sea_rows(s: SparkSession, d: str) -> DataFrame:
    return det(s, d).join(offshore(s, d).where("offshore").select("det_id", "zone"), "det_id").select("det_id", "cell", "zone", "acq_date", "latitude", "longitude")


def draw(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cells, controls, and the anchors (id, anchor) of both."""
    rows = sea_rows(s, d)
    controls = once(s, d, "control_points", lambda: control_points(view(s, d, "zones"), L.detections(s, d), view(s, d, "regions")))
    cells = once(s, d, "drawn_cells", lambda: drawn_cells(rows))
    return cells, controls, anchor_dates(cells, rows, "cell").unionByName(anchor_dates(controls, rows, "zone"))


_TRIED = f"""SELECT t.n, t.longitude, t.latitude, {project_sql('t.latitude', 't.longitude')[0]} AS x, {project_sql('t.latitude', 't.longitude')[1]} AS y FROM (
  SELECT n, west + {_hashed_sql("'control'", "n", "'lon_at'")} * (east - west) AS longitude, south + {_hashed_sql("'control'", "n", "'lat_at'")} * (north - south) AS latitude
  FROM range({TRIES}) r(n) JOIN (SELECT *, sum((east - west) * (north - south)) OVER (ORDER BY zone) AS till, (east - west) * (north - south) AS area, sum((east - west) * (north - south)) OVER () AS total FROM zones) z
  ON {_hashed_sql("'control'", "n", "'zone_at'")} * total >= till - area AND {_hashed_sql("'control'", "n", "'zone_at'")} * total < till) t"""
TABLES |= {
    "tried": _TRIED,
    "tried_sea": f"""SELECT t.n, t.longitude, t.latitude, t.x, t.y, max(z.zone) AS zone FROM tried t JOIN zones z ON t.latitude BETWEEN z.south AND z.north AND t.longitude BETWEEN z.west AND z.east
  WHERE NOT EXISTS (SELECT 1 FROM regions r WHERE t.latitude BETWEEN r.south AND r.north AND t.longitude > r.west AND t.longitude < r.east) GROUP BY ALL""",
    "tried_far": f"""SELECT n, zone, longitude, latitude, x, y FROM tried_sea CROSS JOIN ({_SHORE}) g GROUP BY ALL HAVING min(sqrt(pow(x - x1 - {_T} * {_DX}, 2) + pow(y - y1 - {_T} * {_DY}, 2))) >= {FLOOR}""",
    "tried_gap": """SELECT n, zone, t.longitude, t.latitude, min(sqrt(pow(loc.x - t.x, 2) + pow(loc.y - t.y, 2))) AS gap_m FROM tried_far t CROSS JOIN loc
  GROUP BY ALL""",
    "controls": f"""SELECT 'C' || lpad(CAST(row_number() OVER (ORDER BY n) AS VARCHAR), 2, '0') AS id, * FROM (SELECT * FROM tried_gap WHERE gap_m >= {ISOLATED} ORDER BY n LIMIT {POOL}) t""",
    "sea_rows": f"SELECT det.det_id, det.cell, o.zone, det.acq_date, det.latitude, det.longitude FROM det JOIN ({_AT_SEA}) o USING (det_id)",
    "drawn": f"""SELECT 'O' || lpad(CAST(row_number() OVER (ORDER BY cell) AS VARCHAR), 2, '0') AS id, * FROM (
  SELECT cell, min(zone) AS zone, count(DISTINCT acq_date) AS active_days, avg(latitude) AS latitude, avg(longitude) AS longitude FROM sea_rows GROUP BY cell
  HAVING count(DISTINCT acq_date) >= {SEA_DAYS} ORDER BY {_hashed_sql("'cell'", "cell")}, cell LIMIT {CELLS}) t""",
    "anchors": f"""SELECT id, CAST(acq_date AS DATE) AS anchor FROM (SELECT id, acq_date, row_number() OVER (PARTITION BY id ORDER BY {_hashed_sql("'anchor'", "id", "acq_date")}, acq_date) AS nth FROM (
  SELECT DISTINCT id, acq_date FROM drawn JOIN sea_rows USING (cell) UNION SELECT DISTINCT id, acq_date FROM controls JOIN sea_rows USING (zone)) u) t WHERE nth <= {ANCHORS}""",
}


@query("control_points", """SELECT id, zone, round(latitude, 5) AS latitude, round(longitude, 5) AS longitude, round(gap_m / 1000, 1) AS nearest_detection_km,
  (SELECT string_agg(CAST(anchor AS VARCHAR), ',' ORDER BY anchor) FROM anchors a WHERE a.id = c.id) AS anchor_dates FROM controls c""")
def control_points_rows(s, d):
    _, controls, anchors = draw(s, d)
    dates = anchors.groupBy("id").agg(F.concat_ws(",", F.array_sort(F.collect_list(F.col("anchor").cast("string")))).alias("anchor_dates"))
    r = lambda c, n: F.round(c, n).alias(c)
    return controls.join(dates, "id", "left").select("id", "zone", r("latitude", 5), r("longitude", 5), F.round(F.col("gap_m") / 1_000, 1).alias("nearest_detection_km"), "anchor_dates")


# Scenes and pixels


_PIX = f"""SELECT point_id, scene_id, scene_date, i, abs(v)::DOUBLE * 2 AS b12, (scene_id + i) % 9 <> 0 AND NOT (scene_id % 4 = 0 AND i < 24) AS clear, {PIXEL} * sqrt(pow(floor(i / 8) - 3.5, 2) + pow(i % 8 - 3.5, 2)) AS off
  FROM (SELECT point_id, scene_id, scene_date, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM box_pixels) e"""
_IS_HOT = f"clear AND b12 > {HOT_LEAST} AND b12 > s.med + {HOT_MADS} * s.mad"
_HOT = f"""SELECT p.point_id, p.scene_id, p.scene_date, count(*) AS pixels, count(*) FILTER (WHERE clear) AS n_clear, count(*) FILTER (WHERE clear) / count(*)::DOUBLE AS clear_frac, any_value(s.med) AS med, any_value(s.mad) AS mad, max(b12) FILTER (WHERE clear) AS max_b12,
  count(*) FILTER (WHERE {_IS_HOT}) AS hot, min(off) FILTER (WHERE {_IS_HOT}) AS hot_off, arg_min(b12, (off, i)) FILTER (WHERE {_IS_HOT}) AS hot_b12 FROM ({_PIX}) p JOIN (
  SELECT scene_id, any_value(med) AS med, median(abs(b12 - med)) AS mad FROM (SELECT scene_id, b12, median(b12) OVER (PARTITION BY scene_id) AS med FROM ({_PIX}) q WHERE clear) r GROUP BY scene_id) s USING (scene_id) GROUP BY ALL"""


def hot_pixels(s, d) -> DataFrame:
    """Per scene: clear pixels, their median and MAD, the largest value, hot pixels, and of the nearest to the centre its metres and value."""
    pixels = view(s, d, "box_pixels").select("point_id", "scene_id", "scene_date", F.posexplode("embedding").alias("i", "v"))
    k = F.col("scene_id") + F.col("i")
    clear = (k % 9 != 0) & ~((F.col("scene_id") % 4 == 0) & (F.col("i") < 24))
    pixels = pixels.select("point_id", "scene_id", "scene_date", "i", (F.abs(F.col("v")).cast("double") * 2).alias("b12"), clear.alias("clear"))
    middle = pixels.where("clear").groupBy("scene_id").agg(F.percentile("b12", F.lit(0.5)).alias("med"))
    away = pixels.where("clear").join(middle, "scene_id").groupBy("scene_id").agg(F.max("med").alias("med"), F.percentile(F.abs(F.col("b12") - F.col("med")), F.lit(0.5)).alias("mad"))
    off = F.lit(PIXEL) * F.sqrt(F.pow(F.floor(F.col("i") / 8) - 3.5, 2) + F.pow(F.col("i") % 8 - 3.5, 2))
    hot = F.col("clear") & (F.col("b12") > HOT_LEAST) & (F.col("b12") > F.col("med") + HOT_MADS * F.col("mad"))
    nearest = F.min(F.when(hot, F.struct(off.alias("off"), "i", "b12")))
    return pixels.join(away, "scene_id").groupBy("point_id", "scene_id", "scene_date").agg(
        F.count("*").alias("pixels"), F.count_if("clear").alias("n_clear"), (F.count_if("clear") / F.count("*")).alias("clear_frac"), F.max("med").alias("med"), F.max("mad").alias("mad"),
        F.max(F.when(F.col("clear"), F.col("b12"))).alias("max_b12"), F.count_if(hot).alias("hot"), nearest["off"].alias("hot_off"), nearest["b12"].alias("hot_b12"),
    )


@query("hot_pixels", f"""SELECT point_id, scene_id, pixels, n_clear, round(clear_frac, 3) AS clear_frac, round(med, 5) AS med, round(mad, 5) AS mad, round(max_b12, 5) AS max_b12, hot,
  round(hot_off, 1) AS hot_off, round(hot_b12, 3) AS hot_b12 FROM ({_HOT}) t""")
def hot_pixels_rounded(s, d):
    r = lambda c, n: F.round(c, n).alias(c)
    return hot_pixels(s, d).select("point_id", "scene_id", "pixels", "n_clear", r("clear_frac", 3), r("med", 5), r("mad", 5), r("max_b12", 5), "hot", r("hot_off", 1), r("hot_b12", 3))


def scene_selection(anchors: DataFrame, scenes: DataFrame, days: int = DAYS, clear: float = CLEAR) -> DataFrame:
    """(point_id, anchor, scene_date): of each point's anchors in turn, the nearest scene within ``days`` days that is clear
    enough and that no earlier anchor took; ties go to the earlier date. A point's scenes are a small group."""
    near = anchors.join(scenes.where(F.col("clear") >= clear), "point_id").where(F.abs(F.datediff("scene_date", "anchor")) <= days)
    choice = F.struct(F.abs(F.datediff("scene_date", "anchor")).alias("apart"), "scene_date")
    offers = near.groupBy("point_id", "anchor").agg(F.array_sort(F.collect_set(choice)).alias("offers"))
    turns = offers.groupBy("point_id").agg(F.array_sort(F.collect_list(F.struct("anchor", "offers"))).alias("turns"))
    start = F.array().cast("array<struct<anchor:date,scene_date:date>>")

    def take(taken, turn):
        free = F.filter(turn["offers"], lambda o: ~F.exists(taken, lambda t: t["scene_date"] == o["scene_date"]))
        one = F.array(F.struct(turn["anchor"].alias("anchor"), F.get(free, F.lit(0))["scene_date"].alias("scene_date")))
        return F.when(F.size(free) > 0, F.concat(taken, one)).otherwise(taken)

    return turns.select("point_id", F.inline(F.aggregate("turns", start, take)))


#: The fixtures' pixel boxes belong to 60 places; a drawn point sees the scenes of the place that its id is hashed to.
PLACES = 60
_PLACE = f"CAST(floor({_hashed_sql(chr(39) + 'place' + chr(39), 'id')} * {PLACES}) AS BIGINT)"


def judged_points(s, d) -> DataFrame:
    """(id, zone, scenes, evaluable, hit) of every drawn cell and control: its selected scenes, and whether one has a hot pixel near the centre.
    Of several scenes of one day the clearest counts."""
    cells, controls, anchors = draw(s, d)
    points = cells.select("id", "zone").unionByName(controls.select("id", "zone"))
    place = F.floor(hashed("place", F.col("id")) * PLACES).cast("long")
    best = F.max_by(F.struct("clear_frac", "hot_off"), F.struct("clear_frac", -F.col("scene_id")))
    scenes = hot_pixels(s, d).groupBy("point_id", "scene_date").agg(best.alias("b")).select(F.col("point_id").alias("place"), "scene_date", F.col("b.clear_frac").alias("clear"), "b.hot_off")
    seen = points.select("id", place.alias("place")).join(scenes, "place").select(F.col("id").alias("point_id"), "scene_date", "clear", "hot_off")
    taken = scene_selection(anchors.withColumnRenamed("id", "point_id"), seen).join(seen, ["point_id", "scene_date"])
    verdict = taken.groupBy(F.col("point_id").alias("id")).agg(F.count("*").alias("scenes"), F.max(F.coalesce(F.col("hot_off") <= HIT, F.lit(False))).alias("hit"))
    out = points.join(verdict, "id", "left").select("id", "zone", F.coalesce("scenes", F.lit(0)).cast("long").alias("scenes"), F.coalesce("hit", F.lit(False)).alias("hit"))
    return out.withColumn("evaluable", F.col("scenes") >= SCENES)


_CLEAR_SCENES = f"SELECT point_id AS place, scene_date, first(clear_frac ORDER BY clear_frac DESC, scene_id) AS clear, first(hot_off ORDER BY clear_frac DESC, scene_id) AS hot_off FROM ({_HOT}) h GROUP BY ALL"
_NTH = "SELECT {n} AS nth, * FROM (SELECT o.*, row_number() OVER (PARTITION BY o.id ORDER BY apart, o.scene_date) AS choice FROM offers o WHERE turn = {n} {free}) t WHERE choice = 1"
TABLES |= {
    "clear_scenes": f"SELECT * FROM ({_CLEAR_SCENES}) t WHERE clear >= {CLEAR}",
    "drawn_points": f"SELECT id, zone, {_PLACE} AS place FROM (SELECT id, zone FROM drawn UNION ALL SELECT id, zone FROM controls) t",
    "turns": f"SELECT a.id, a.anchor, c.scene_date, c.hot_off, abs(c.scene_date - a.anchor) AS apart FROM anchors a JOIN drawn_points USING (id) JOIN clear_scenes c USING (place) WHERE abs(c.scene_date - a.anchor) <= {DAYS}",
    "offers": "SELECT *, dense_rank() OVER (PARTITION BY id ORDER BY anchor) AS turn FROM turns",
    "pick1": _NTH.format(n=1, free=""),
    "pick2": _NTH.format(n=2, free="AND NOT EXISTS (SELECT 1 FROM pick1 p WHERE p.id = o.id AND p.scene_date = o.scene_date)"),
    "pick3": _NTH.format(n=3, free="AND NOT EXISTS (SELECT 1 FROM (FROM pick1 UNION ALL FROM pick2) p WHERE p.id = o.id AND p.scene_date = o.scene_date)"),
    "picks": "FROM pick1 UNION ALL FROM pick2 UNION ALL FROM pick3",
    "judged": f"""SELECT id, zone, coalesce(scenes, 0) AS scenes, coalesce(hit, false) AS hit, coalesce(scenes, 0) >= {SCENES} AS evaluable FROM drawn_points LEFT JOIN (
  SELECT id, count(*) AS scenes, bool_or(coalesce(hot_off <= {HIT}, false)) AS hit FROM picks GROUP BY id) v USING (id)""",
    "used_controls": f"SELECT *, row_number() OVER (ORDER BY id) AS nth FROM judged WHERE id LIKE 'C%' AND evaluable QUALIFY nth <= {CONTROLS}",
}


@query("scene_selection", "SELECT id, CAST(anchor AS VARCHAR) AS anchor, CAST(scene_date AS VARCHAR) AS scene_date FROM picks")
def scene_selection_rows(s, d):
    """The scene taken for each anchor date of the drawn cells and controls."""
    cells, controls, anchors = draw(s, d)
    points = cells.select("id").unionByName(controls.select("id"))
    scenes = hot_pixels(s, d).groupBy("point_id", "scene_date").agg(F.max("clear_frac").alias("clear")).withColumnRenamed("point_id", "place")
    seen = points.select(F.col("id").alias("point_id"), F.floor(hashed("place", F.col("id")) * PLACES).cast("long").alias("place")).join(scenes, "place")
    taken = scene_selection(anchors.withColumnRenamed("id", "point_id"), seen.select("point_id", "scene_date", "clear"))
    return taken.select(F.col("point_id").alias("id"), F.col("anchor").cast("string").alias("anchor"), F.col("scene_date").cast("string").alias("scene_date"))


@query("first_n_evaluable", "SELECT id, hit FROM used_controls")
def first_n_evaluable(s, d):
    """The first controls that can be judged; spares take the place of those that cannot."""
    return judged_points(s, d).where(F.col("id").startswith("C") & F.col("evaluable")).orderBy("id").limit(CONTROLS).select("id", "hit")


@query("validation_summary", f"""SELECT zone, count(*) AS drawn, count(*) FILTER (WHERE evaluable) AS evaluable, count(*) FILTER (WHERE evaluable AND hit) AS hits,
  round(count(*) FILTER (WHERE evaluable AND hit) / nullif(count(*) FILTER (WHERE evaluable), 0)::DOUBLE, 3) AS rate,
  coalesce(count(*) FILTER (WHERE evaluable AND hit) / nullif(count(*) FILTER (WHERE evaluable), 0)::DOUBLE >= {PASS_RATE}, false) AS passed FROM judged WHERE id LIKE 'O%' GROUP BY zone""")
def validation_summary(s, d):
    """Of the drawn cells of each zone: how many can be judged, are hit, and whether their share passes."""
    good, able = F.count_if(F.col("evaluable") & F.col("hit")), F.count_if("evaluable")
    rate = F.try_divide(good.cast("double"), able)
    return judged_points(s, d).where(F.col("id").startswith("O")).groupBy("zone").agg(
        F.count("*").alias("drawn"), able.alias("evaluable"), good.alias("hits"), F.round(rate, 3).alias("rate"), F.coalesce(rate >= PASS_RATE, F.lit(False)).alias("passed")
    )


@query("offshore_validation", f"""SELECT *, cell_pass AND control_pass AND controls_evaluated = {CONTROLS} AS passed FROM (SELECT cells_drawn, cells_evaluable, cells_with_hit, round(coalesce(cells_with_hit / nullif(cells_evaluable, 0)::DOUBLE, 0), 3) AS cell_hit_rate,
  coalesce(cells_with_hit / nullif(cells_evaluable, 0)::DOUBLE >= {PASS_RATE}, false) AS cell_pass, controls_evaluated, controls_seen - controls_evaluated AS controls_replaced, controls_with_hit, controls_with_hit <= {PASS_CONTROLS} AS control_pass FROM (
  SELECT count(*) AS cells_drawn, count(*) FILTER (WHERE evaluable) AS cells_evaluable, count(*) FILTER (WHERE evaluable AND hit) AS cells_with_hit FROM judged WHERE id LIKE 'O%') c CROSS JOIN (
  SELECT count(*) AS controls_evaluated, count(*) FILTER (WHERE hit) AS controls_with_hit FROM used_controls) u CROSS JOIN (
  SELECT count(*) AS controls_seen FROM judged WHERE id LIKE 'C%' AND ((SELECT count(*) FROM used_controls) < {CONTROLS} OR id <= (SELECT max(id) FROM used_controls))) n) t""")
def offshore_validation(s, d):
    """One row: cells drawn, judged and hit; controls judged in order until enough are, those replaced on the way, and hits; the verdict."""
    points = judged_points(s, d)
    is_cell, evaluable, hit = F.col("id").startswith("O"), F.col("evaluable"), F.col("evaluable") & F.col("hit")
    before = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, -1)  # over the pool alone
    seen = points.where(~is_cell).withColumn("had", F.coalesce(F.sum(F.col("evaluable").cast("int")).over(before), F.lit(0))).where(F.col("had") < CONTROLS)
    controls = seen.agg(F.count_if("evaluable").alias("controls_evaluated"), F.count_if(~evaluable).alias("controls_replaced"), F.count_if(hit).alias("controls_with_hit"))
    cells = points.where(is_cell).agg(F.count("*").alias("cells_drawn"), F.count_if("evaluable").alias("cells_evaluable"), F.count_if(hit).alias("cells_with_hit"))
    rate = F.try_divide(F.col("cells_with_hit").cast("double"), F.col("cells_evaluable"))
    both = cells.crossJoin(controls).select(  # one row each
        "*", F.round(F.coalesce(rate, F.lit(0.0)), 3).alias("cell_hit_rate"), F.coalesce(rate >= PASS_RATE, F.lit(False)).alias("cell_pass"), (F.col("controls_with_hit") <= PASS_CONTROLS).alias("control_pass")
    )
    return both.withColumn("passed", F.col("cell_pass") & F.col("control_pass") & (F.col("controls_evaluated") == CONTROLS))
