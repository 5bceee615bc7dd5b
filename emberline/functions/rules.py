"""Labelling rules as boolean Columns; every atom is false where its input is null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..contract import CROPLAND, NATURAL
from .scalars import landcover_code


def _recurrence() -> Column:
    return F.coalesce(F.col("recurrence_count"), F.lit(0))


def _near(column: str, metres: float) -> Column:
    return F.coalesce(F.col(column) <= metres, F.lit(False))


def gas_flare() -> Column:
    return _near("dist_to_flare_capable_m", 1_000) & (_recurrence() >= 5)


def industrial() -> Column:
    n, flare, source = _recurrence(), _near("dist_to_flare_capable_m", 1_000), F.lower(F.coalesce(F.col("nearest_coal_source"), F.lit("")))
    tagged = F.coalesce(F.col("osm_industrial_tag") != "", F.lit(False))
    steady_heat = _near("dist_to_heat_industry_m", 2_000) & ~flare & (n >= 2)
    single_day = (n == 1) & (_near("dist_to_industrial_m", 1) | _near("dist_to_heat_industry_m", 500))
    mapped_area = (n >= 2) & tagged & ~gas_flare()
    coal = (source == "gem") & _near("dist_to_coal_mine_m", 3_000) & (n >= 2)
    mapped_coal = (source == "osm") & _near("dist_to_coal_mine_m", 1_000) & (n >= 3)
    return steady_heat | single_day | mapped_area | coal | mapped_coal


def _away_from_industry() -> Column:
    return F.col("dist_to_industrial_m").isNull() | (F.col("dist_to_industrial_m") > 2_000)


def agricultural_burning() -> Column:
    return F.coalesce(landcover_code(F.col("landcover_class")).isin(CROPLAND), F.lit(False)) & _away_from_industry()


def wildfire() -> Column:
    return F.coalesce(landcover_code(F.col("landcover_class")).isin(NATURAL), F.lit(False)) & _away_from_industry()


RULES = {"gas flare": gas_flare, "industrial": industrial, "agricultural burning": agricultural_burning, "wildfire": wildfire}


def apply_rules(rows: DataFrame, offshore: bool = False, adopted: bool = True, unconfirmed: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with label and label_source. With ``offshore``, rows of region 'offshore' follow the persistence
    rule alone, and zones in ``unconfirmed`` never become gas flares."""
    matched = F.array_compact(F.array(*[F.when(rule(), F.lit(label)) for label, rule in RULES.items()]))
    out = rows.withColumn("_matched", matched)
    n = F.size("_matched")
    label = F.when(n == 1, F.get("_matched", F.lit(0))).otherwise("unknown")
    source = F.when(n == 1, "rule").when(n > 1, "conflict").otherwise("unknown")
    if offshore:
        at_sea = F.coalesce(F.col("region") == "offshore", F.lit(False))
        doubtful = F.coalesce(F.col("offshore_zone").isin(list(unconfirmed)), F.lit(False)) if unconfirmed else F.lit(False)
        flare = (_recurrence() >= 5) & F.lit(adopted) & ~doubtful
        label = F.when(at_sea, F.when(flare, "gas flare").otherwise("unknown")).otherwise(label)
        source = F.when(at_sea, F.when(doubtful, "offshore_unconfirmed").when(flare, "offshore_persistent").otherwise("unknown")).otherwise(source)
    return out.withColumn("label", label).withColumn("label_source", source).drop("_matched")
