"""Space-weather conditions in words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Flux to assume where the feed has none.
FALLBACK_FLUX = 145.0


def space_conditions(kp: Column, xray_long: Column) -> Column:
    base = F.when(kp < 3, "Quiet").when(kp < 5, "Unsettled").when(kp < 7, "Storm").otherwise("Severe Storm")
    return F.concat(base, F.when(xray_long > 1e-5, " + Radio Blackout").otherwise(""))


def flux_or_fallback(flux: Column, fallback: float = FALLBACK_FLUX) -> Column:
    return F.when(flux > 0, flux).otherwise(F.lit(fallback))
