"""More of the catalog: numbering, splits, alert upkeep, exports and checks over the labelled detections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..contract import CLASSES, CONFIDENCE_ORDINAL, DRAW_ORDER, FACILITY_SUBTYPE, NEVER_DUG, REQUIRED_COLUMNS, TAG_SUBTYPE
from ..fixtures import view
from ..functions import scalars as S
from ..functions.rules import apply_rules as label_rules
from ..operators import history as H
from ..storage import save
from ..stores import Store, new_folder
from . import labels as L
from .alerts import typed, _FUELS
from .catalog import _GC, _KEY, _NBR, _scene_stats, BATCH, det, numbered, query
from .offshore import UNCONFIRMED, offshore, _AT_SEA
from .oracle import sql_list

TEST_SHARE = 0.2
#: Detections in one file of the exported details.
SHARD_ROWS = 10_000


def cutoff_of(rows: DataFrame, share: float = TEST_SHARE) -> DataFrame:
    """One row (cutoff): the date on which the last ``share`` of the rows begins; no row for an empty table."""
    dates = rows.groupBy("acq_date").agg(F.count("*").alias("n"))
    wanted = F.greatest(F.lit(1), F.rint(F.sum("n").over(Window.partitionBy()) * share))
    tail = F.sum("n").over(Window.orderBy(F.desc("acq_date")))
    return dates.withColumn("wanted", wanted).withColumn("tail", tail).where("tail >= wanted").agg(F.max("acq_date").alias("cutoff")).where("cutoff IS NOT NULL")


_CUTOFF = f"""SELECT max(acq_date) AS cutoff FROM (SELECT acq_date, sum(n) OVER (ORDER BY acq_date DESC) AS tail,
  greatest(1, round_even(sum(n) OVER () * {TEST_SHARE}::DOUBLE, 0)) AS wanted FROM (SELECT acq_date, count(*) AS n FROM det GROUP BY acq_date) c) t WHERE tail >= wanted"""


@query("validate_columns", " UNION ALL ".join(f"SELECT '{c}' AS name, count(*) FILTER (WHERE {c} IS NULL) AS missing FROM detections" for c in REQUIRED_COLUMNS))
def validate_columns(s, d):
    rows = view(s, d, "detections")
    missing = [F.struct(F.lit(c).alias("name"), (F.count_if(F.col(c).isNull()) if c in rows.columns else F.count("*")).alias("missing")) for c in REQUIRED_COLUMNS]
    return rows.agg(F.array(*missing).alias("all")).select(F.inline("all"))


@query("tile_bounds", """SELECT tile, lon::INT AS west, lat::INT AS south, lon::INT + 3 AS east, lat::INT + 3 AS north FROM (
  SELECT DISTINCT floor(latitude / 3) * 3 AS lat, floor(longitude / 3) * 3 AS lon, printf('N%02dE%03d', (floor(latitude / 3) * 3)::INT, (floor(longitude / 3) * 3)::INT) AS tile FROM detections) t""")
def tile_bounds(s, d):
    corner = lambda c: (F.floor(F.col(c) / 3) * 3).cast("int")
    tiles = view(s, d, "detections").select(F.format_string("N%02dE%03d", corner("latitude"), corner("longitude")).alias("tile")).distinct()
    part = lambda i: F.regexp_extract("tile", r"^([NS])([0-9]{2})([EW])([0-9]{3})", i)
    south = part(2).cast("int") * F.when(part(1) == "S", -1).otherwise(1)
    west = part(4).cast("int") * F.when(part(3) == "W", -1).otherwise(1)
    return tiles.select("tile", west.alias("west"), south.alias("south"), (west + 3).alias("east"), (south + 3).alias("north"))


@query("append_partitions", f"SELECT substr(acq_date, 1, 7) AS month, (acq_date >= '{BATCH}')::INT AS batch, acq_date, count(*) AS n FROM (SELECT DISTINCT {', '.join(_KEY)} FROM detections) t GROUP BY ALL")
def append_partitions(s, d):
    """Rows a day as the monthly store has them after two appends, of which the second overlaps the first and is run twice."""
    rows = view(s, d, "detections")
    store = Store(s, new_folder(s, "store"), rows.schema)
    pulls = rows.where(F.col("acq_date") < BATCH), rows.where(F.col("acq_date") >= "2024-01-20")
    for number, pull in ((0, pulls[0]), (1, pulls[1]), (1, pulls[1])):
        store.append(pull, number, _KEY)
    return store.rows().groupBy(F.substring("acq_date", 1, 7).alias("month"), "batch", "acq_date").agg(F.count("*").alias("n"))


_CODES = " ".join(f"WHEN '{k}' THEN {v}" for k, v in CONFIDENCE_ORDINAL.items())


@query("detail_shards", f"""SELECT row_id, row_id // {SHARD_ROWS} AS shard, round_even(latitude * 100000, 0)::BIGINT AS lat, round_even(longitude * 100000, 0)::BIGINT AS lon,
  round_even(frp * 100, 0)::BIGINT AS frp, coalesce(CASE confidence {_CODES} END, -1) AS confidence, dense_rank() OVER (ORDER BY satellite) - 1 AS satellite, dense_rank() OVER (ORDER BY label) - 1 AS label
  FROM (SELECT *, row_number() OVER (ORDER BY acq_date, det_id) - 1 AS row_id FROM lab) t""")
def detail_shards(s, d):
    """The details of all detections, written in shards of SHARD_ROWS rows and read back: whole numbers, and codes of the values in their order, -1 for none."""
    rows = numbered(L.labelled(s, d).select("det_id", "acq_date", "latitude", "longitude", "frp", "confidence", "satellite", "label"), "acq_date", "det_id")
    for c in ("satellite", "label"):  # a few values each
        codes = rows.select(c).where(F.col(c).isNotNull()).distinct().withColumn("code", F.row_number().over(Window.orderBy(c)) - 1)
        rows = rows.join(F.broadcast(codes), c, "left").withColumn(c, F.coalesce("code", F.lit(-1)).cast("long")).drop("code")
    scaled = lambda c, by: F.rint(F.col(c) * by).cast("long").alias(c[:3])
    shards = rows.select(
        "row_id", F.floor(F.col("row_id") / SHARD_ROWS).alias("shard"), scaled("latitude", 100_000), scaled("longitude", 100_000), scaled("frp", 100),
        F.coalesce(S.lookup(F.col("confidence"), CONFIDENCE_ORDINAL), F.lit(-1)).alias("confidence"), "satellite", "label",
    )
    folder = new_folder(s, "details")
    shards.write.partitionBy("shard").parquet(folder)
    return s.read.schema(shards.schema).parquet(folder)


@query("detection_lookup", """SELECT acq_date AS file, row_number() OVER (PARTITION BY acq_date ORDER BY det_id) - 1 AS row_in_file, det_id FROM detections
  QUALIFY row_number() OVER (ORDER BY acq_date, det_id) - 1 IN (0, 17, 500)""")
def detection_lookup(s, d):
    rows = numbered(view(s, d, "detections").select("acq_date", "det_id"), "acq_date", "det_id")
    place = F.row_number().over(Window.partitionBy("acq_date").orderBy("det_id")) - 1
    found = rows.withColumn("row_in_file", place.cast("long")).where(F.col("row_id").isin(0, 17, 500))
    return found.select(F.col("acq_date").alias("file"), "row_in_file", "det_id")


@query("bool_recurrence_features", "SELECT det_id, coalesce(recurrence_count, 1)::DOUBLE AS recurrence_count, (lower(trim(is_anomalous::VARCHAR)) = 'true')::INT AS is_anomalous FROM feat")
def bool_recurrence_features(s, d):
    rows = H.with_anomaly(H.with_recurrence(det(s, d)))
    flag = F.lower(F.trim(F.col("is_anomalous").cast("string"))) == "true"
    return rows.select("det_id", F.coalesce(F.col("recurrence_count").cast("double"), F.lit(1.0)).alias("recurrence_count"), F.coalesce(flag, F.lit(False)).cast("int").alias("is_anomalous"))


@query("dnbr_informative", "SELECT det_id, coalesce(trim(osm_industrial_tag), '') = '' AND coalesce(dist_to_flare_capable_m > 1000, true) AND coalesce(dist_to_heat_industry_m > 2000, true) AS informative FROM feat")
def dnbr_informative(s, d):
    outside = F.coalesce(F.trim("osm_industrial_tag"), F.lit("")) == ""
    beyond = lambda c, m: F.coalesce(F.col(c) > m, F.lit(True))
    return L.add_context(s, d).select("det_id", (outside & beyond("dist_to_flare_capable_m", 1_000) & beyond("dist_to_heat_industry_m", 2_000)).alias("informative"))


_DNBR = f"""SELECT p.point_id, round(arg_max(nbr, scene_date) FILTER (WHERE scene_date < acq_date) - arg_min(nbr, scene_date) FILTER (WHERE scene_date >= acq_date), 6) AS dnbr,
  round(arg_max(p50, scene_date) FILTER (WHERE scene_date < acq_date) - arg_min(p10, scene_date) FILTER (WHERE scene_date >= acq_date), 6) AS dnbr_p10
  FROM burn_points p JOIN ({_NBR}) t ON t.point_id = p.point_id AND nbr IS NOT NULL AND scene_date BETWEEN acq_date - 30 AND acq_date + 30 GROUP BY p.point_id, p.acq_date"""


def _dnbr(s, d):
    """Burn ratio of the last clear scene before minus that of the first one after: of the means, and of the median before and the low tail after."""
    near = F.col("scene_date").between(F.date_add("acq_date", -30), F.date_add("acq_date", 30))
    before = F.col("scene_date") < F.col("acq_date")
    last = lambda c: F.max_by(F.when(before, F.col(c)), F.when(before, F.col("scene_date")))
    first = lambda c: F.min_by(F.when(~before, F.col(c)), F.when(~before, F.col("scene_date")))
    pairs = view(s, d, "burn_points").join(_scene_stats(s, d), "point_id").where(near)
    return pairs.groupBy("point_id", "acq_date").agg(
        F.round(last("nbr") - first("nbr"), 6).alias("dnbr"), F.round(last("p50") - first("p10"), 6).alias("dnbr_p10")
    ).drop("acq_date")


@query("dnbr", _DNBR)
def dnbr(s, d):
    return _dnbr(s, d)


@query("burn_severity", f"""SELECT *, CASE WHEN dnbr < 0.10 THEN 'no burn detected' WHEN dnbr < 0.27 THEN 'low severity' WHEN dnbr < 0.66 THEN 'moderate severity'
  WHEN dnbr IS NOT NULL THEN 'high severity' ELSE '' END AS severity FROM ({_DNBR}) t""")
def burn_severity(s, d):
    x = F.col("dnbr")
    band = F.when(x < 0.10, "no burn detected").when(x < 0.27, "low severity").when(x < 0.66, "moderate severity").when(x.isNotNull(), "high severity").otherwise("")
    return _dnbr(s, d).withColumn("severity", band)


_ZONED = f"SELECT lab.*, z.zone, z.zone IN ({sql_list(UNCONFIRMED)}) AS doubtful FROM lab LEFT JOIN ({_AT_SEA}) z USING (det_id)"


@query("apply_offshore_rules", f"""SELECT det_id, CASE WHEN zone IS NULL THEN label WHEN recurrence_count >= 5 AND NOT doubtful THEN 'gas flare' ELSE 'unknown' END AS label,
  CASE WHEN zone IS NULL THEN label_source WHEN doubtful THEN 'offshore_unconfirmed' WHEN recurrence_count >= 5 THEN 'offshore_persistent' ELSE 'unknown' END AS label_source FROM ({_ZONED}) t""")
def apply_offshore_rules(s, d):
    """Rows at sea, by zone and distance to the shore, follow the persistence rule; all others keep their labels."""
    at_sea = offshore(s, d).where("offshore").select("det_id", F.col("zone").alias("offshore_zone"))
    rows = L.labelled(s, d).join(at_sea, "det_id", "left").withColumn("region", F.when(F.col("offshore_zone").isNotNull(), "offshore").otherwise("onshore"))
    return label_rules(rows, offshore=True, unconfirmed=UNCONFIRMED).select("det_id", "label", "label_source")


@query("map_filter", "SELECT det_id, acq_date, label, state FROM lab_s WHERE acq_date BETWEEN '2024-01-05' AND '2024-01-20' AND state < 'P' AND label IN ('industrial', 'gas flare')")
def map_filter(s, d):
    wanted = F.col("acq_date").between("2024-01-05", "2024-01-20") & (F.col("state") < "P") & F.col("label").isin("industrial", "gas flare")
    return L.labelled_by_region(s, d).where(wanted).select("det_id", "acq_date", "label", "state")


_when = lambda values: " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())


@query("typed_facilities", f"""SELECT * FROM (SELECT 'facility' AS source, facility_id AS id, CASE facility_type {_when(FACILITY_SUBTYPE)} END AS subtype FROM facilities
  WHERE NOT coalesce(lower(trim(string_split(status, ';')[1])) IN ({sql_list(NEVER_DUG)}), false) UNION ALL
  SELECT 'context', feature_id, CASE WHEN coalesce(power = 'plant' AND {_FUELS}, false) THEN 'Thermal power plant' ELSE CASE lower(industrial) {_when(TAG_SUBTYPE)} END END FROM ctx) t WHERE subtype IS NOT NULL""")
def typed_facilities(s, d):
    sites, mapped = typed(s, d)
    side = lambda rows, source, key: rows.select(F.lit(source).alias("source"), F.col(key).alias("id"), "subtype")
    return side(sites, "facility", "facility_id").unionByName(side(mapped, "context", "feature_id"))


_ALERTS = "SELECT cell || '|' || acq_date AS alert_id, acq_date, label, max(frp) AS frp FROM lab WHERE is_anomalous AND label IN ('industrial', 'gas flare') GROUP BY ALL"


def _alerts(s, d):
    hot = L.labelled(s, d).where(F.col("is_anomalous") & F.col("label").isin("industrial", "gas flare"))
    return hot.groupBy(F.concat_ws("|", "cell", "acq_date").alias("alert_id"), "acq_date", "label").agg(F.max("frp").alias("frp"))


@query("drop_known_ids", f"SELECT * FROM ({_ALERTS}) n WHERE alert_id NOT IN (SELECT alert_id FROM ({_ALERTS}) o WHERE acq_date < '{BATCH}')")
def drop_known_ids(s, d):
    alerts = _alerts(s, d)
    return alerts.join(alerts.where(F.col("acq_date") < BATCH).select("alert_id"), "alert_id", "left_anti")


@query("rescore_window", f"SELECT *, acq_date >= '{BATCH}' AS rescored FROM ({_ALERTS}) t")
def rescore_window(s, d):
    """The alert store after the window from BATCH on was replaced, twice: what is read back."""
    alerts = save(_alerts(s, d), "alerts")
    store = Store(s, new_folder(s, "alerts"), alerts.schema)
    store.write(alerts.where(F.col("acq_date") != "2024-01-27"), 0)
    for _ in range(2):
        store.replace(BATCH, "2024-01-31", alerts.where(F.col("acq_date") >= BATCH), 1)
    return store.rows().select(*alerts.columns, (F.col("batch") == 1).alias("rescored"))


@query("mode_label", "SELECT cell, label FROM (SELECT cell, label, row_number() OVER (PARTITION BY cell ORDER BY count(*) DESC, label) AS n FROM lab GROUP BY cell, label) t WHERE n = 1")
def mode_label(s, d):
    counts = L.labelled(s, d).groupBy("cell", "label").agg(F.count("*").alias("n"))
    return counts.groupBy("cell").agg(F.min_by("label", F.struct(-F.col("n"), "label")).alias("label"))


_NEW = f"acq_date >= '{BATCH}'"
_STRONG = "is_anomalous AND label IN ('industrial', 'gas flare') AND frp >= 2 * baseline_frp"


@query("run_summary", f"""SELECT acq_date, count(*) AS fetched, count(*) FILTER (WHERE NOT {_NEW}) AS skipped, count(*) FILTER (WHERE {_NEW}) AS added, """ + ", ".join(f"count(*) FILTER (WHERE {_NEW} AND label = '{c}') AS \"{c}\"" for c in CLASSES) + f""",
  count(*) FILTER (WHERE {_NEW} AND is_anomalous) AS anomalous, count(*) FILTER (WHERE {_NEW} AND {_STRONG}) AS alerts FROM lab WHERE acq_date >= '2024-01-23' GROUP BY 1""")
def run_summary(s, d):
    """What a run fetched, skipped as known and added a day, with the labels of the added rows and the alerts among them."""
    rows, new = L.labelled(s, d).where("acq_date >= '2024-01-23'"), F.col("acq_date") >= BATCH
    return rows.groupBy("acq_date").agg(
        F.count("*").alias("fetched"), F.count_if(~new).alias("skipped"), F.count_if(new).alias("added"), *[F.count_if(new & (F.col("label") == c)).alias(c) for c in CLASSES],
        F.count_if(new & F.col("is_anomalous")).alias("anomalous"), F.count_if(new & F.expr(_STRONG)).alias("alerts"),
    )


_TAGS = ["industrial", "landuse", "power", "man_made"]


@query("tag_count_report", "SELECT tag, value, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{t}' AS tag, {t} AS value FROM context_boxes" for t in _TAGS) + ") t WHERE value IS NOT NULL GROUP BY ALL")
def tag_count_report(s, d):
    tags = F.create_map(*[x for t in _TAGS for x in (F.lit(t), F.col(t))])
    rows = view(s, d, "context_boxes").select(F.explode(tags).alias("tag", "value")).where("value IS NOT NULL")
    return rows.groupBy("tag", "value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "tag", "value")


@query("split_cutoff", _CUTOFF)
def split_cutoff(s, d):
    return cutoff_of(view(s, d, "detections"))


@query("temporal_split", f"SELECT det_id, acq_date >= (SELECT cutoff FROM ({_CUTOFF}) c) AS is_test FROM detections")
def temporal_split(s, d):
    rows = view(s, d, "detections")
    return rows.join(F.broadcast(cutoff_of(rows))).select("det_id", (F.col("acq_date") >= F.col("cutoff")).alias("is_test"))


@query("split_class_counts", f"SELECT label, count(*) FILTER (WHERE acq_date < cutoff) AS train, count(*) FILTER (WHERE acq_date >= cutoff) AS test FROM lab, ({_CUTOFF}) c GROUP BY label")
def split_class_counts(s, d):
    rows, test = L.labelled(s, d).join(F.broadcast(cutoff_of(view(s, d, "detections")))), F.col("acq_date") >= F.col("cutoff")
    return rows.groupBy("label").agg(F.count_if(~test).alias("train"), F.count_if(test).alias("test"))


@query("spatial_block_split", f"""SELECT cell, row_number() OVER (ORDER BY first_seen DESC, cell DESC) <= greatest(1, round_even(count(*) OVER () * {TEST_SHARE}::DOUBLE, 0)) AS is_test
  FROM (SELECT cell, min(acq_date) AS first_seen FROM det GROUP BY cell) t""")
def spatial_block_split(s, d):
    cells = det(s, d).groupBy("cell").agg(F.min("acq_date").alias("first_seen"))
    placed = numbered(cells, "first_seen", "cell")
    total = cells.agg(F.count("*").alias("total"))
    cut = F.col("total") - F.greatest(F.lit(1), F.rint(F.col("total") * TEST_SHARE))
    return placed.join(F.broadcast(total)).select("cell", (F.col("row_id") >= cut).alias("is_test"))


@query("pre_split_features", f"""SELECT det_id, coalesce(n, 0) AS recurrence_count, p.first_seen, p.last_seen, acq_date < '{BATCH}' AND is_anomalous AS is_anomalous FROM lab LEFT JOIN (SELECT gi, gj, count(DISTINCT acq_date) AS n,
  min(acq_date) AS first_seen, max(acq_date) AS last_seen FROM det WHERE acq_date < '{BATCH}' GROUP BY gi, gj) p USING (gi, gj)""")
def pre_split_features(s, d):
    """Features that don't look past the split: history of the rows before it, and anomaly judged among these alone."""
    rows, old = det(s, d), F.col("acq_date") < BATCH
    past = H.recurrence(rows.where(old))
    judged = H.with_anomaly(rows.where(old)).select("det_id", "is_anomalous")
    out = rows.join(past, ["gi", "gj"], "left").join(judged, "det_id", "left")
    return out.select("det_id", F.coalesce("recurrence_count", F.lit(0)).alias("recurrence_count"), "first_seen", "last_seen", F.coalesce("is_anomalous", F.lit(False)).alias("is_anomalous"))


@query("key_except", f"SELECT DISTINCT 'gone' AS side, cell FROM det WHERE cell NOT IN (SELECT cell FROM det WHERE acq_date >= '{BATCH}') UNION ALL SELECT DISTINCT 'new', cell FROM det WHERE cell NOT IN (SELECT cell FROM det WHERE acq_date < '{BATCH}')")
def key_except(s, d):
    rows = det(s, d)
    old, new = rows.where(F.col("acq_date") < BATCH).select("cell").distinct(), rows.where(F.col("acq_date") >= BATCH).select("cell").distinct()
    side = lambda a, b, name: a.join(b, "cell", "left_anti").select(F.lit(name).alias("side"), "cell")
    return side(old, new, "gone").unionByName(side(new, old, "new"))


@query("draw_order", f"SELECT det_id, CASE label {' '.join(f'''WHEN '{c}' THEN {i}''' for i, c in enumerate(DRAW_ORDER))} END AS priority FROM lab")
def draw_order(s, d):
    rank = S.lookup(F.col("label"), {c: i for i, c in enumerate(DRAW_ORDER)})
    return L.labelled(s, d).select("det_id", rank.alias("priority")).orderBy("priority", "det_id")


@query("facility_dictionary", """SELECT kind, name, source, row_number() OVER (ORDER BY kind, name, source) - 1 AS code FROM (SELECT DISTINCT facility_type AS kind, facility_name AS name, 'facility' AS source FROM facilities
  UNION SELECT DISTINCT coalesce(industrial, power, landuse, man_made), coalesce(name, 'unnamed'), 'map' FROM ctx) t""")
def facility_dictionary(s, d):
    """A gapless code for each facility on display, in order of kind, name and source; kinds are numbered by themselves."""
    names = view(s, d, "facilities").select(F.col("facility_type").alias("kind"), F.col("facility_name").alias("name"), F.lit("facility").alias("source"))
    mapped = L.context(s, d).select(F.coalesce("industrial", "power", "landuse", "man_made").alias("kind"), F.coalesce("name", F.lit("unnamed")).alias("name"), F.lit("map").alias("source"))
    return numbered(names.unionByName(mapped).distinct(), "kind", "name", "source").select("kind", "name", "source", F.col("row_id").alias("code"))


@query("stale_feed", "SELECT satellite, max(acq_date || ' ' || acq_time) AS newest, max(acq_date || ' ' || acq_time) < '2024-01-30 1200' AS stale FROM detections GROUP BY satellite")
def stale_feed(s, d):
    newest = F.max(F.concat_ws(" ", "acq_date", "acq_time"))
    return view(s, d, "detections").groupBy("satellite").agg(newest.alias("newest")).withColumn("stale", F.col("newest") < "2024-01-30 1200")
