"""Scalar Column functions over detections: keys, cleaning, dates, projection and distances."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from ..contract import GRID

# EPSG:7755 (India NSF LCC) on WGS 84.
_A, _F = 6378137.0, 1 / 298.257223563
_LAT0, _LON0, _LAT1, _LAT2, FALSE_ORIGIN = map(float, (24, 80, 12.472955, 35.1728044444444, 4_000_000))


def _constants() -> tuple[float, float, float, float]:
    """Eccentricity, cone constant, F and the radius at the origin (Snyder, USGS PP 1395)."""
    e = math.sqrt(_F * (2 - _F))
    m = lambda p: math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)
    t = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    p0, p1, p2 = (math.radians(p) for p in (_LAT0, _LAT1, _LAT2))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    f = m(p1) / (n * t(p1) ** n)
    return e, n, f, _A * f * t(p0) ** n


E, N, BIG_F, RHO0 = _constants()


def project(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Easting and northing in metres."""
    p = F.radians(lat)
    s = F.sin(p) * E
    t = F.tan(math.pi / 4 - p / 2) / F.pow((1 - s) / (1 + s), F.lit(E / 2))
    rho = F.pow(t, F.lit(N)) * (_A * BIG_F)
    theta = F.radians(lon - _LON0) * N
    return FALSE_ORIGIN + rho * F.sin(theta), FALSE_ORIGIN + RHO0 - rho * F.cos(theta)


def project_sql(lat: str, lon: str) -> tuple[str, str]:
    """The same for an oracle's text."""
    s = f"({E!r}::DOUBLE * sin(radians({lat})))"
    t = f"(tan({math.pi / 4!r}::DOUBLE - radians({lat}) / 2) / pow((1 - {s}) / (1 + {s}), {E / 2!r}::DOUBLE))"
    rho, theta = f"({_A * BIG_F!r}::DOUBLE * pow({t}, {N!r}::DOUBLE))", f"({N!r}::DOUBLE * radians({lon} - 80.0::DOUBLE))"
    return f"4000000.0::DOUBLE + {rho} * sin({theta})", f"4000000.0::DOUBLE + {RHO0!r}::DOUBLE - {rho} * cos({theta})"


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * 12742.0


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    return f"12742.0::DOUBLE * asin(sqrt(least({a}, 1.0::DOUBLE)))"


def grid_key(degrees: Column) -> Column:
    """Grid index, half to even."""
    return F.rint(degrees / GRID).cast("long")


def cell_id() -> Column:
    return F.concat_ws("_", "gi", "gj")


def clean_time(t: Column) -> Column:
    """HHMM with leading zeros; '626.0' and 626 are 0626."""
    return F.lpad(F.regexp_replace(t.cast("string"), r"\.0$", ""), 4, "0")


def five_decimals(x: Column) -> Column:
    return F.format_string("%.5f", F.round(x, 5))


def detection_key() -> Column:
    return F.concat_ws("|", five_decimals(F.col("latitude")), five_decimals(F.col("longitude")), "acq_date", clean_time(F.col("acq_time")), "satellite")


def clean_text(c: Column) -> Column:
    """Lower case without outer spaces; null is empty, and so is the text nan."""
    t = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(t == "nan", "").otherwise(t)


def any_of(multi: Column, wanted: list[str]) -> Column:
    """Whether one of the values between semicolons is wanted; null: no."""
    return F.coalesce(F.exists(F.split(F.lower(multi), ";"), lambda v: F.trim(v).isin(wanted)), F.lit(False))


def first_of(multi: Column) -> Column:
    return F.lower(F.trim(F.get(F.split(multi, ";"), F.lit(0))))


def landcover_code(c: Column) -> Column:
    """10, '10' and 10.0 are 10; anything that isn't a whole number is null."""
    n = c.cast("string").try_cast("double")
    return F.when(n == F.floor(n), n.cast("int"))


def lookup(c: Column, values: dict) -> Column:
    """Value of a fixed mapping, null where it has none."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), c)


def sighted(date: Column, time: Column) -> Column:
    """Timestamp of a UTC date and HHMM; a missing time counts as 00:00."""
    t = F.coalesce(clean_time(time), F.lit("0000"))
    return F.to_timestamp_ntz(F.concat(date, F.lit(" "), F.substring(t, 1, 2), F.lit(":"), F.substring(t, 3, 2)), F.lit("yyyy-MM-dd HH:mm"))
