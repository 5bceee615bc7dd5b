"""Rasters as tables of pixels: (tile, row, col, value), partitioned by tile, rows counted from a tile's south and columns from its west."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Metres of a degree of longitude at the equator, which web maps take everywhere.
DEGREE = 111_319.490793


class Raster:
    """Pixels of ``pixel`` degrees, ``side`` by ``side`` of them in a tile, in the folder ``path``. Value 0 and null are no data."""

    def __init__(self, spark: SparkSession, path: str, pixel: float, side: int):
        self.spark, self.path, self.pixel, self.side = spark, path, pixel, side

    def index(self, degrees: Column) -> Column:
        """Row or column of a latitude or longitude, counted from 0 degrees."""
        return F.floor(F.round(degrees / self.pixel, 9))

    def _placed(self, row: Column, col: Column) -> list[Column]:
        tile = F.concat_ws("_", F.floor(row / self.side).cast("string"), F.floor(col / self.side).cast("string"))
        return [tile.alias("tile"), F.pmod(row, F.lit(self.side)).cast("int").alias("row"), F.pmod(col, F.lit(self.side)).cast("int").alias("col")]

    def write(self, pixels: DataFrame) -> None:
        """``pixels``: row and col counted from 0 degrees, value."""
        rows = pixels.select(*self._placed(F.col("row"), F.col("col")), "value")
        rows.repartition("tile").sortWithinPartitions("tile", "row").write.mode("overwrite").partitionBy("tile").parquet(self.path)

    def _pixels_of(self, asked: DataFrame) -> DataFrame:
        """The pixels of the tiles in which ``asked`` has any: other tiles' files aren't opened. There are as many tiles as the earth has."""
        tiles = asked.select("tile").distinct().where("tile > ''")  # the comparison lets the optimizer prune partitions by this list
        pixels = self.spark.read.schema("row int, col int, value int, tile string").parquet(self.path)
        return pixels.join(F.broadcast(tiles), "tile", "left_semi").where("value <> 0")

    def at(self, points: DataFrame) -> DataFrame:
        """(pid, value) of each point's (pid, longitude, latitude) own pixel; no row without data."""
        asked = points.select("pid", *self._placed(self.index(F.col("latitude")), self.index(F.col("longitude"))))
        return asked.join(self._pixels_of(asked), ["tile", "row", "col"]).select("pid", "value")

    def majority(self, points: DataFrame, metres: float) -> DataFrame:
        """(pid, value): the most frequent value in the box of ``metres`` around each point, ties to the smaller value; no row without data.

        The box is that of a circle on a web map, which is narrower in degrees of latitude away from the equator. It may reach into other tiles."""
        wide, high = F.lit(metres / DEGREE), F.cos(F.radians("latitude")) * metres / DEGREE
        span = lambda c, reach: F.sequence(self.index(F.col(c) - reach), self.index(F.col(c) + reach))
        boxes = points.select("pid", F.explode(span("latitude", high)).alias("r"), span("longitude", wide).alias("cs")).select("pid", "r", F.explode("cs").alias("c"))
        asked = boxes.select("pid", *self._placed(F.col("r"), F.col("c")))
        counts = asked.join(self._pixels_of(asked), ["tile", "row", "col"]).groupBy("pid", "value").agg(F.count("*").alias("n"))
        return counts.groupBy("pid").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("value"))
