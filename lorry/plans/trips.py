"""Trip endpoints (R9, R9b) and the leg-destination listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorry.functions.columns import text_key
from lorry.operators.legs import trip_endpoints as _endpoints
from lorry.sources.tables import Tables


def trip_endpoints(t: Tables) -> DataFrame:
    """For every trip, the first leg's origin and the last leg's destination."""
    return _endpoints(t.legsum)


def trip_from(t: Tables) -> DataFrame:
    """The origin side only."""
    return _endpoints(t.legsum).select("trip_number", "trip_from")


def trip_to(t: Tables) -> DataFrame:
    """The destination side only."""
    return _endpoints(t.legsum).select("trip_number", "trip_to")


def leg_destinations(t: Tables) -> DataFrame:
    """Distinct upper-cased leg destinations in the source's text order:
    linguistic (not byte) order via the UNICODE collation, NULL last."""
    d = t.legsum.select(F.upper("legd_zone_desc").alias("leg_to")).distinct()
    return d.orderBy(text_key("leg_to"))
