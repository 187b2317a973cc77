"""Schemas and fixed values shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


STRING, DOUBLE, FLOAT, INT, LONG, TS = (
    T.StringType(), T.DoubleType(), T.FloatType(), T.IntegerType(), T.LongType(), T.TimestampType(),
)

CANONICAL = _struct(
    ("event_id", STRING), ("source", STRING), ("title", STRING), ("text", STRING),
    ("lat", DOUBLE), ("lon", DOUBLE), ("ts", TS), ("country", STRING), ("raw_json", STRING),
)
# A landed stream record is a canonical row without its provenance column.
STREAM = T.StructType([f for f in CANONICAL.fields if f.name != "raw_json"])
ENRICHED = T.StructType(CANONICAL.fields + _struct(
    ("event_type", STRING), ("classify_conf", FLOAT), ("severity", FLOAT),
    ("geo_lat", DOUBLE), ("geo_lon", DOUBLE), ("geo_country", STRING),
).fields)
KEYWORDS = _struct(("year", STRING), ("country", STRING), ("term", STRING), ("count", INT))
LEAD_MATCHES = _struct(
    ("event_type", STRING), ("country", STRING), ("off_id", STRING), ("soc_id", STRING),
    ("off_source", STRING), ("soc_source", STRING), ("off_ts", TS), ("soc_ts", TS),
    ("delta_seconds", LONG), ("severity", FLOAT),
)
LEAD_SUMMARY = _struct(
    ("event_type", STRING), ("n_pairs", LONG), ("mean_delta_minutes", DOUBLE),
    ("median_delta_minutes", DOUBLE), ("p10_delta_minutes", DOUBLE), ("p90_delta_minutes", DOUBLE),
    ("n_social_first", LONG), ("n_official_first", LONG),
)
REGION_DATE = _struct(
    ("country", STRING), ("date_bucket", STRING), ("event_time", TS), ("event_id", STRING),
    ("source", STRING), ("event_type", STRING), ("severity", FLOAT), ("cluster_id", INT),
    ("title", STRING), ("lat", DOUBLE), ("lon", DOUBLE),
)
DOCUMENT_COLUMNS = [
    "event_id", "source", "title", "text", "lat", "lon", "ts", "country",
    "event_type", "classify_conf", "severity", "cluster_id",
]
CLUSTER_TERMS = _struct(("cluster_id", INT), ("token", STRING), ("n", LONG), ("rank", INT))
CITIES = _struct(
    ("name", STRING), ("latitude", DOUBLE), ("longitude", DOUBLE), ("countrycode", STRING), ("population", LONG),
)
COUNTRIES = _struct(("name", STRING), ("code", STRING))

# ---- raw feeds: only the fields a loader uses, so the JSON reader can skip the rest ----
_POINT = _struct(("coordinates", T.ArrayType(DOUBLE)))
USGS_RAW = _struct(("features", T.ArrayType(_struct(
    ("id", STRING),
    ("properties", _struct(("title", STRING), ("place", STRING), ("time", LONG))),
    ("geometry", _POINT),
))))
EONET_RAW = _struct(("events", T.ArrayType(_struct(
    ("id", STRING), ("title", STRING), ("description", STRING),
    # A point or a polygon: kept as JSON text and read in either shape.
    ("geometry", T.ArrayType(_struct(("coordinates", STRING), ("date", STRING)))),
))))
RELIEFWEB_RAW = _struct(("data", T.ArrayType(_struct(
    ("id", STRING),
    ("fields", _struct(
        ("title", STRING), ("body-html", STRING),
        ("date", _struct(("created", STRING))), ("primary_country", _struct(("iso3", STRING))),
    )),
))))
GDACS_RAW = _struct(("features", T.ArrayType(_struct(
    ("properties", _struct(
        ("eventid", STRING), ("name", STRING), ("description", STRING), ("fromdate", STRING), ("iso3", STRING),
    )),
    ("geometry", _POINT),
))))
GDELT_RAW = _struct(*[(f"c{i}", STRING) for i in range(61)])
POSTS_RAW = _struct(
    ("uri", STRING), ("author", _struct(("handle", STRING))),
    ("record", _struct(("text", STRING), ("createdAt", STRING))),
)

# ---- fixed values: these must equal the upstream data contract for results to agree ----
OFFICIAL_SOURCES = ["usgs", "eonet", "gdacs", "reliefweb"]
SOCIAL_SOURCES = ["social", "gdelt"]
FREE_TEXT_SOURCES = ["social", "reliefweb", "gdelt"]
LIVE_SOURCE = "bluesky_live"
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
SEVERITY_BANDS = ["very low", "low", "medium", "high", "critical"]
QUALITY_FLAGS = [
    "has_raw_coords", "has_geo_coords", "has_country", "has_geo_country", "has_text", "has_classify_conf",
]
QUALITY_LABELS = {
    "has_raw_coords": "raw coordinates",
    "has_geo_coords": "geoparse coordinates",
    "has_country": "country present",
    "has_geo_country": "geoparse country",
    "has_text": "non-empty text",
    "has_classify_conf": "classification confidence",
    "has_any_geo": "any geo coverage",
    "completeness_score": "overall completeness",
}
LEAD_WINDOW_SECONDS = 48 * 3600
KEYWORD_LEXICON = [
    "earthquake", "quake", "aftershock", "magnitude", "epicenter", "tsunami",
    "flood", "flooding", "deluge", "inundation",
    "hurricane", "cyclone", "typhoon", "tornado",
    "wildfire", "bushfire", "blaze",
    "volcano", "eruption", "lava",
    "landslide", "mudslide", "avalanche",
    "drought", "famine", "blizzard", "snowstorm",
    "evacuation", "evacuated", "displaced", "refugees",
    "casualties", "fatalities", "injured", "missing",
    "rescue", "relief", "shelter", "aid",
    "damage", "destroyed", "collapsed", "devastated",
    "warning", "alert", "advisory",
]
