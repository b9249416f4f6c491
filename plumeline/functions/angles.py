"""Angles, winds, distances and other numeric column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
EARTH_RADIUS_M = 6_371_000.0
WEAK_KG_H = 1000.0
NODATA = -9999.0
FILL_LIMIT = -9990.0
FIRST_BAND_NM = 381.0
LAST_BAND_NM = 2493.0
BAND_COUNT = 285
BANK_RATE_KG_H = 3000.0
MOLAR_MASS_G = 16.04
AIR_MOL_PER_M2 = 3.6055e5
BANK_PIXEL_M2 = 400.0


def wind_u(speed: Column, direction: Column) -> Column:
    """Eastward component of a wind given by the bearing it comes from."""
    return -speed * F.sin(F.radians(direction))


def wind_v(speed: Column, direction: Column) -> Column:
    return -speed * F.cos(F.radians(direction))


def wind_from(u: Column, v: Column) -> Column:
    """Bearing the wind comes from, 0 to 360."""
    return F.pmod(F.degrees(F.atan2(-u, -v)), F.lit(360.0))


def wind_to(u: Column, v: Column) -> Column:
    """Bearing the wind blows to, 0 to 360."""
    return F.pmod(F.degrees(F.atan2(u, v)), F.lit(360.0))


def relative_azimuth(u: Column, v: Column, sun_azimuth: Column, calm: float = 0.1) -> Column:
    """Wind heading minus sun azimuth on the circle; null in calm air or without an azimuth."""
    return F.when(
        (F.hypot(u, v) >= calm) & sun_azimuth.isNotNull(),
        F.pmod(F.degrees(F.atan2(u, v)) - sun_azimuth, F.lit(360.0)),
    )


def relative_azimuth_math(sun_azimuth: Column, heading_ccw: Column) -> Column:
    """The same angle when the wind heading is counted counter-clockwise from east."""
    return F.pmod(90.0 - sun_azimuth - heading_ccw, F.lit(360.0))


def circular_diff(a: Column, b: Column) -> Column:
    """Absolute difference on the 360 degree circle."""
    d = F.pmod(a - b, F.lit(360.0))
    return F.least(d, 360.0 - d)


def signed_circular_diff(a: Column, b: Column) -> Column:
    """Difference in [-180, 180)."""
    return F.pmod(a - b + 180.0, F.lit(360.0)) - 180.0


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres."""
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(h))


def flat_distance_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Equirectangular distance in kilometres, longitude scaled at the mean latitude."""
    dy = (lat1 - lat2) * 111.32
    dx = (lon1 - lon2) * 111.32 * F.cos(F.radians((lat1 + lat2) / 2))
    return F.hypot(dx, dy)


def air_mass_factor(sza: Column, vza: Column) -> Column:
    """Two-way slant path relative to the vertical."""
    return 1 / F.cos(F.radians(sza)) + 1 / F.cos(F.radians(vza))


def utm_epsg(lon: Column, lat: Column) -> Column:
    """EPSG code of the UTM zone of a point."""
    zone = F.floor((lon + 180) / 6) + 1
    return (F.when(lat >= 0, 32600).otherwise(32700) + zone).cast("int")


def band_index(nm: Column) -> Column:
    """1-based index of the band nearest to a wavelength."""
    step = (LAST_BAND_NM - FIRST_BAND_NM) / (BAND_COUNT - 1)
    return (F.bround((nm - FIRST_BAND_NM) / step) + 1).cast("int")


def reflectance(radiance: Column, irradiance: Column, sza: Column, sun_distance: Column) -> Column:
    """Top-of-atmosphere reflectance clipped to 0..1.5; radiance in the scanner's unit."""
    value = (
        math.pi * radiance * 10.0 * sun_distance * sun_distance / (irradiance * F.cos(F.radians(sza)))
    )
    return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.5))


def ime_kg(ppb_pixels: Column, pixel_m2: float = BANK_PIXEL_M2) -> Column:
    """Integrated mass in kilograms from the sum of a column map in ppb."""
    moles = ppb_pixels * AIR_MOL_PER_M2 * pixel_m2 / 1e9
    return moles * MOLAR_MASS_G / 1000.0


def ime_rate_kg_h(mass_kg: Column, wind_speed: Column, length_m: Column) -> Column:
    """Emission rate from integrated mass, effective wind and plume length."""
    return mass_kg * wind_speed / length_m * 3600.0


def scale_to_rate(value: Column, rate_kg_h: Column) -> Column:
    """A map simulated at the bank's rate, scaled to another rate."""
    return value * rate_kg_h / BANK_RATE_KG_H


def anniversary(day: Column, years_back: Column) -> Column:
    """The same month and day in an earlier year; 29 February becomes 28."""
    return F.add_months(day, (-12 * years_back).cast("int"))


def degree_cell(lon: Column, lat: Column, size: float = 1.0) -> Column:
    """Key of the grid cell of a point."""
    return F.struct(
        F.floor(lon / size).cast("int").alias("cx"), F.floor(lat / size).cast("int").alias("cy")
    )
