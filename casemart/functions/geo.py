"""Spatial Column expressions: bounding box, candidate score, status cascades.

Rules are plain data (lists of terms, weights, thresholds) turned into one
Column, so scoring a billion candidates is a projection, not a Python loop.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from casemart.functions.text import as_column

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Approximate bounding box of the municipality (closed intervals).
MIN_LAT, MAX_LAT = -21.35, -21.05
MIN_LON, MAX_LON = -50.65, -50.25
# Municipal centre, used only as a plotting fallback.
FALLBACK_LAT, FALLBACK_LON = -21.2089, -50.4328
# Candidate score weights and vocabularies.
SCORE_IN_BBOX = 5
SCORE_CITY = 3
SCORE_STATE = 1
SCORE_TYPE = 2
SCORE_CLASS = 1
SCORE_UNPARSABLE = -1
CITY_TERMS = ["araçatuba", "aracatuba"]
STATE_TERMS = ["são paulo", "sao paulo"]
PREFERRED_TYPES = ["neighbourhood", "suburb", "quarter", "residential"]
PREFERRED_CLASSES = ["place", "boundary"]
# Query templates for a place name (city and state spelled as published).
QUERY_TEMPLATES = [
    "{name}, Araçatuba, São Paulo, Brasil",
    "Bairro {name}, Araçatuba, São Paulo, Brasil",
    "{name}, Araçatuba, SP, Brazil",
]
# Review threshold on the candidate score, and the confidence threshold used
# by the spatial status cascade.
REVIEW_SCORE_THRESHOLD = 5
CONFIDENCE_SCORE_THRESHOLD = 9
# Spatial status labels, in cascade order, and their quality labels.
STATUS_UNRESOLVED_NAME = "unresolved_name"
STATUS_NOT_GEOCODABLE = "not_geocodable_source_name"
STATUS_MANUAL_POINT = "manual_reference_point"
STATUS_MISSING_COORDS = "missing_coordinates"
STATUS_OUTSIDE_BBOX = "outside_bbox"
STATUS_LOW_CONFIDENCE = "low_confidence_geocoding"
STATUS_VALIDATED = "validated_geocoding"
STATUS_DRAFT = "draft_geocoding"
STATUS_GEOCODED = "geocoded"
QUALITY_BY_STATUS = {
    STATUS_MANUAL_POINT: "medium",
    STATUS_VALIDATED: "high",
    STATUS_DRAFT: "medium",
    STATUS_LOW_CONFIDENCE: "low",
    STATUS_OUTSIDE_BBOX: "low",
}
QUALITY_OTHERWISE = "unresolved"
MAPPABLE_STATUSES = [STATUS_MANUAL_POINT, STATUS_VALIDATED, STATUS_DRAFT]
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class BBox:
    min_lat: float = MIN_LAT
    max_lat: float = MAX_LAT
    min_lon: float = MIN_LON
    max_lon: float = MAX_LON

    def contains(self, lat: Column | str, lon: Column | str) -> Column:
        """Closed-interval test; NULL when a coordinate is NULL."""
        lat, lon = as_column(lat), as_column(lon)
        return (lat >= F.lit(self.min_lat)) & (lat <= F.lit(self.max_lat)) & \
               (lon >= F.lit(self.min_lon)) & (lon <= F.lit(self.max_lon))

    def contains_or_false(self, lat: Column | str, lon: Column | str) -> Column:
        """Same test, but a missing coordinate counts as outside."""
        return F.coalesce(self.contains(lat, lon), F.lit(False))


DEFAULT_BBOX = BBox()


@dataclass(frozen=True)
class ScoreRules:
    bbox: BBox = DEFAULT_BBOX
    in_bbox: int = SCORE_IN_BBOX
    city_terms: tuple = tuple(CITY_TERMS)
    city: int = SCORE_CITY
    state_terms: tuple = tuple(STATE_TERMS)
    state: int = SCORE_STATE
    preferred_types: tuple = tuple(PREFERRED_TYPES)
    type_bonus: int = SCORE_TYPE
    preferred_classes: tuple = tuple(PREFERRED_CLASSES)
    class_bonus: int = SCORE_CLASS
    unparsable: int = SCORE_UNPARSABLE


def _any_contains(text: Column, terms) -> Column:
    cond = F.lit(False)
    for t in terms:
        cond = cond | text.contains(t)
    return cond


def candidate_score(lat_text: Column | str, lon_text: Column | str,
                    display_name: Column | str, osm_class: Column | str,
                    osm_type: Column | str, rules: ScoreRules = ScoreRules()) -> Column:
    """Integer plausibility score of one geocoder candidate (max 12).

    Unparsable coordinates score -1; otherwise +5 inside the box, +3 when the
    city is named, +1 when the state is named, +2 for neighbourhood-like
    types, +1 for place/boundary classes.
    """
    lat = as_column(lat_text).cast("string").try_cast("double")
    lon = as_column(lon_text).cast("string").try_cast("double")
    name = F.lower(F.coalesce(as_column(display_name).cast("string"), F.lit("")))
    cls = F.lower(F.coalesce(as_column(osm_class).cast("string"), F.lit("")))
    typ = F.lower(F.coalesce(as_column(osm_type).cast("string"), F.lit("")))

    def pts(cond: Column, w: int) -> Column:
        return F.when(cond, F.lit(w)).otherwise(F.lit(0))

    total = (pts(rules.bbox.contains_or_false(lat, lon), rules.in_bbox)
             + pts(_any_contains(name, rules.city_terms), rules.city)
             + pts(_any_contains(name, rules.state_terms), rules.state)
             + pts(typ.isin(*rules.preferred_types), rules.type_bonus)
             + pts(cls.isin(*rules.preferred_classes), rules.class_bonus))
    return F.when(lat.isNull() | lon.isNull(), F.lit(rules.unparsable)).otherwise(total).cast("int")


def spatial_status(canonical_id: Column, use_for_geocoding: Column,
                   manual_lat: Column, manual_lon: Column,
                   lat: Column, lon: Column, inside_bbox: Column, score: Column,
                   source_mode: str,
                   confidence_threshold: int = CONFIDENCE_SCORE_THRESHOLD) -> Column:
    """First-match status cascade.  NULL flags and scores fall through
    (three-valued logic), exactly like a chained CASE."""
    return (
        F.when(canonical_id.isNull(), F.lit(STATUS_UNRESOLVED_NAME))
        .when(use_for_geocoding == F.lit(False), F.lit(STATUS_NOT_GEOCODABLE))
        .when(manual_lat.isNotNull() & manual_lon.isNotNull(), F.lit(STATUS_MANUAL_POINT))
        .when(lat.isNull() | lon.isNull(), F.lit(STATUS_MISSING_COORDS))
        .when(inside_bbox == F.lit(False), F.lit(STATUS_OUTSIDE_BBOX))
        .when(score < F.lit(confidence_threshold), F.lit(STATUS_LOW_CONFIDENCE))
        .when(F.lit(source_mode) == F.lit("validated"), F.lit(STATUS_VALIDATED))
        .when(F.lit(source_mode) == F.lit("draft"), F.lit(STATUS_DRAFT))
        .otherwise(F.lit(STATUS_GEOCODED))
    )


def spatial_quality(status: Column) -> Column:
    expr = None
    for st, q in QUALITY_BY_STATUS.items():
        expr = (F.when(status == F.lit(st), F.lit(q)) if expr is None
                else expr.when(status == F.lit(st), F.lit(q)))
    return expr.otherwise(F.lit(QUALITY_OTHERWISE))


def is_mappable(lat: Column, lon: Column, status: Column) -> Column:
    """Never NULL: coordinates present and a trusted status."""
    return F.when(lat.isNotNull() & lon.isNotNull() & status.isin(*MAPPABLE_STATUSES),
                  F.lit(True)).otherwise(F.lit(False))
