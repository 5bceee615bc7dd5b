"""Batch labelling: detections with their surroundings, history and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..contract import CONTRACT_COLUMNS, CONTRACT_TYPES, FLARE_TYPES, HEAT_TYPES, NEVER_DUG
from ..fixtures import view
from ..functions.rules import apply_rules
from ..functions.scalars import project
from ..operators import history, spatial
from ..storage import once, save


def exclude_renewables(context: DataFrame) -> DataFrame:
    drop = (F.col("power") == "plant") & F.col("plant_source").isin("solar", "wind")
    return context.where(~F.coalesce(drop, F.lit(False)))


def context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exclude_renewables(view(spark, sf_dir, "context_boxes"))


def projected(rows: DataFrame) -> DataFrame:
    x, y = project(F.col("latitude"), F.col("longitude"))
    return rows.withColumn("x", x).withColumn("y", y)


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected(history.with_grid(view(spark, sf_dir, "detections")))


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected(view(spark, sf_dir, "facilities"))


def places(rows: DataFrame) -> DataFrame:
    """Distinct positions as points: many detections share one."""
    return rows.select(F.struct("latitude", "longitude").alias("pid"), "x", "y").distinct()


def _by_place(found: DataFrame) -> DataFrame:
    return found.select("pid.latitude", "pid.longitude", *[c for c in found.columns if c != "pid"])


def polygon_tag(points: DataFrame, features: DataFrame) -> DataFrame:
    """(pid, osm_industrial_tag) of points inside a polygon; refinery wins, untyped is 'yes'."""
    tags = features.select(F.col("feature_id").alias("fid"), F.coalesce("industrial", F.lit("yes")).alias("tag"))
    inside = spatial.containing(points, spatial.box_segments(features.where("geom_type = 'Polygon'"), "feature_id"))
    return inside.join(tags, "fid").groupBy("pid").agg(F.min_by("tag", F.struct(F.col("tag") != "refinery", "tag")).alias("osm_industrial_tag"))


def feature_distance(points: DataFrame, features: DataFrame, name: str) -> DataFrame:
    """(pid, name): metres to the nearest feature, 0 inside a polygon."""
    points = save(points, "points")
    segments = spatial.box_segments(features, "feature_id")
    inside = spatial.containing(points, spatial.box_segments(features.where("geom_type = 'Polygon'"), "feature_id")).select("pid").distinct()
    near = spatial.nearest(points, segments, which=False).join(inside.withColumn("inside", F.lit(True)), "pid", "left")
    return near.select("pid", F.when(F.col("inside"), 0.0).otherwise(F.col("dist")).alias(name))


def nearest_facility(points: DataFrame, sites: DataFrame, types: list[str], distance: str, kind: str) -> DataFrame:
    """(pid, distance, kind) of the nearest facility of the listed types, ties to the smaller id."""
    wanted = sites.where(F.col("facility_type").isin(types))
    near = spatial.nearest(points, spatial.point_segments(wanted, "facility_id"))
    kinds = wanted.select(F.col("facility_id").alias("fid"), F.col("facility_type").alias(kind))
    return near.join(kinds, "fid").select("pid", F.col("dist").alias(distance), kind)


def coal_mines(sites: DataFrame) -> DataFrame:
    """Mines whose ground was ever dug; a null status is kept."""
    dug = ~F.coalesce(F.lower("status").isin(NEVER_DUG), F.lit(False))
    return sites.where((F.col("facility_type") == "coal_mine") & dug)


def nearest_coal(points: DataFrame, sites: DataFrame, features: DataFrame) -> DataFrame:
    """Distance to the edge of the circle of the nearest mine's area; mapped mines only where there is no mine at all."""
    mines = coal_mines(sites)
    near = spatial.nearest(points, spatial.point_segments(mines, "facility_id"))
    radius = mines.select(F.col("facility_id").alias("fid"), F.sqrt(F.coalesce("area_km2", F.lit(0.0)) * 1e6 / F.pi()).alias("radius"))
    gem = near.join(radius, "fid").select("pid", F.greatest(F.lit(0.0), F.col("dist") - F.col("radius")).alias("gem"))
    mapped = feature_distance(points, features.where("industrial = 'mine'"), "osm")
    both = points.select("pid").join(gem, "pid", "left").join(mapped, "pid", "left")
    source = F.when(F.col("gem").isNotNull(), "gem").when(F.col("osm").isNotNull(), "osm")
    return both.select("pid", F.coalesce("gem", "osm").alias("dist_to_coal_mine_m"), source.alias("nearest_coal_source"))


def brick_kilns(features: DataFrame) -> DataFrame:
    return features.where("industrial = 'brickyard' OR man_made = 'kiln'")


def _roles(**conditions):
    return F.explode(F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in conditions.items()]))).alias("role")


def alike(features: DataFrame, *attributes: str) -> DataFrame:
    """One feature, of the smallest id, for all that have the same place, kind and ``attributes``."""
    return features.groupBy("geom_type", "south", "north", "west", "east", *attributes).agg(F.min("feature_id").alias("feature_id"))


def surroundings(rows: DataFrame, sites: DataFrame, features: DataFrame) -> DataFrame:
    """(latitude, longitude, ...) all distances and tags, once for each position.

    The same as the operators above one by one, but every feature carries the roles it can play, so
    one bucket join finds the nearest of each role.
    """
    points = save(places(rows), "points")
    features = save(alike(features, "industrial", "man_made"), "features")
    kiln = F.coalesce((F.col("industrial") == "brickyard") | (F.col("man_made") == "kiln"), F.lit(False))
    mapped = features.select("feature_id", _roles(ind=F.lit(True), mine=F.coalesce(F.col("industrial") == "mine", F.lit(False)), kiln=kiln))
    sides = spatial.box_segments(features, "feature_id").join(mapped.withColumnRenamed("feature_id", "fid"), "fid")
    kind, dug = F.col("facility_type"), ~F.coalesce(F.lower("status").isin(NEVER_DUG), F.lit(False))
    known = sites.select("facility_id", "x", "y", _roles(flare=kind.isin(FLARE_TYPES), heat=kind.isin(HEAT_TYPES), coal=(kind == "coal_mine") & dug))
    spots = known.select(F.col("facility_id").alias("fid"), F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("x").alias("x2"), F.col("y").alias("y2"), "role")
    near = spatial.nearest_by_role(points, sides, ["ind", "mine", "kiln"], which=False).unionByName(
        spatial.nearest_by_role(points, spots, ["flare", "heat", "coal"])
    )
    radius = F.sqrt(F.coalesce("area_km2", F.lit(0.0)) * 1e6 / F.pi())
    near = near.join(sites.select(F.col("facility_id").alias("fid"), "facility_type", radius.alias("radius")), "fid", "left")
    of = lambda role, value: F.max(F.when(F.col("role") == role, value))
    wide = near.groupBy("pid").agg(
        *[of(r, F.col("dist")).alias(r) for r in ("ind", "mine", "kiln", "flare", "heat")],
        of("flare", F.col("facility_type")).alias("flare_type"), of("heat", F.col("facility_type")).alias("heat_type"),
        of("coal", F.greatest(F.lit(0.0), F.col("dist") - F.col("radius"))).alias("coal"),
    )
    shape = features.select(F.col("feature_id").alias("fid"), F.coalesce("industrial", F.lit("yes")).alias("tag"), kiln.alias("is_kiln"), F.coalesce(F.col("industrial") == "mine", F.lit(False)).alias("is_mine"))
    inside = spatial.containing(points, spatial.box_segments(features.where("geom_type = 'Polygon'"), "feature_id")).join(shape, "fid")
    inside = inside.groupBy("pid").agg(
        F.min_by("tag", F.struct(F.col("tag") != "refinery", "tag")).alias("osm_industrial_tag"), F.max("is_kiln").alias("in_kiln"), F.max("is_mine").alias("in_mine")
    )
    both = wide.join(inside, "pid", "left")
    mine = F.when(F.col("in_mine"), 0.0).otherwise(F.col("mine"))
    out = both.select(
        "pid", F.when(F.col("osm_industrial_tag").isNotNull(), 0.0).otherwise(F.col("ind")).alias("dist_to_industrial_m"), "osm_industrial_tag",
        F.col("flare").alias("dist_to_flare_capable_m"), F.col("flare_type").alias("nearest_flare_facility_type"),
        F.col("heat").alias("dist_to_heat_industry_m"), F.col("heat_type").alias("nearest_heat_facility_type"),
        F.coalesce("coal", mine).alias("dist_to_coal_mine_m"),
        F.when(F.col("coal").isNotNull(), "gem").when(mine.isNotNull(), "osm").alias("nearest_coal_source"),
        F.when(F.col("in_kiln"), 0.0).otherwise(F.col("kiln")).alias("dist_to_brick_kiln_m"),
    )
    return _by_place(out)


def with_landcover(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Class of the cell's pixel; 0 is no data."""
    known = cells.where("class_code <> 0").select("gi", "gj", F.col("class_code").alias("landcover_class"))
    return rows.join(known, ["gi", "gj"], "left")


def add_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = detections(spark, sf_dir)
    around = once(spark, sf_dir, "surroundings", lambda: surroundings(rows, facilities(spark, sf_dir), context(spark, sf_dir)))
    return with_landcover(rows.join(around, ["latitude", "longitude"], "left"), view(spark, sf_dir, "landcover_cells"))


def label_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = detections(spark, sf_dir)  # history needs the bare detections only
    return apply_rules(history.with_anomaly(history.with_recurrence(add_context(spark, sf_dir), rows), rows))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns: det_id, keys, surroundings, history, label and label_source. Written once, read by all that counts labels."""
    return once(spark, sf_dir, "labelled", lambda: label_all(spark, sf_dir))


def labelled_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    make = lambda: with_region(labelled(spark, sf_dir), boundary(spark, sf_dir), view(spark, sf_dir, "detections"))
    return once(spark, sf_dir, "labelled_by_region", make)


def contract(rows: DataFrame) -> DataFrame:
    """Exactly the contract's columns in their order and of their types; absent ones are null."""
    typed = lambda c: (F.col(c) if c in rows.columns else F.lit(None)).cast(CONTRACT_TYPES.get(c, "string")).alias(c)
    return rows.select(*map(typed, CONTRACT_COLUMNS))


def boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sides of the regions' outlines in degrees: several rings of thousands of corners, of which some are holes."""
    return view(spark, sf_dir, "boundary_sides").drop("ring")


def with_region(rows: DataFrame, sides: DataFrame, positions: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``state``: the first region by name that contains the position, else null. ``sides``: segments in degrees; ``positions``
    (default: rows) has all positions, where these come cheaper than the rows."""
    points = (rows if positions is None else positions).select(F.struct("latitude", "longitude").alias("pid"), F.col("longitude").alias("x"), F.col("latitude").alias("y")).distinct()
    inside = spatial.containing(points, sides, cell=0.02)
    return rows.join(_by_place(inside.groupBy("pid").agg(F.min("fid").alias("state"))), ["latitude", "longitude"], "left")
