"""Declared schemas of the tables that cross a file boundary."""

from pyspark.sql import types as T

# Coded values of the detection feed (fixed values).
SATELLITES = ("N", "N20", "N21")
INSTRUMENTS = ("VIIRS",)
CONFIDENCES = ("n", "l", "h")
DAY_NIGHT = ("D", "N")

DETECTION_FEED = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("bright_ti4", T.DoubleType()),
        T.StructField("scan", T.DoubleType()),
        T.StructField("track", T.DoubleType()),
        T.StructField("acq_date", T.DateType()),
        T.StructField("acq_time", T.StringType()),
        T.StructField("satellite", T.StringType()),
        T.StructField("instrument", T.StringType()),
        T.StructField("confidence", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("bright_ti5", T.DoubleType()),
        T.StructField("frp", T.DoubleType()),
        T.StructField("daynight", T.StringType()),
    ]
)

# Column order of the stored raw detections.
RAW_DETECTION_COLUMNS = (
    "country_id",
    "latitude",
    "longitude",
    "scan",
    "track",
    "acq_date",
    "acq_time",
    "satellite",
    "instrument",
    "version",
    "frp",
    "daynight",
    "bright_ti4",
    "bright_ti5",
    "confidence",
)

# The 19 columns of a settlement dump, in file order (fixed values).
SETTLEMENT_DUMP = T.StructType(
    [
        T.StructField("geonameid", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("asciiname", T.StringType()),
        T.StructField("alternatenames", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("feature_class", T.StringType()),
        T.StructField("feature_code", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("cc2", T.StringType()),
        T.StructField("admin1_code", T.StringType()),
        T.StructField("admin2_code", T.StringType()),
        T.StructField("admin3_code", T.StringType()),
        T.StructField("admin4_code", T.StringType()),
        T.StructField("population", T.LongType()),
        T.StructField("elevation", T.StringType()),
        T.StructField("dem", T.StringType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("modification_date", T.StringType()),
    ]
)

RINGS = "array<array<struct<x:double,y:double>>>"
EDGES = "array<struct<x1:double,y1:double,x2:double,y2:double>>"

AREA = f"id string, rings {RINGS}, xmin double, ymin double, xmax double, ymax double"

VALIDATION_RESULT = T.StructType(
    [
        T.StructField("firms_id", T.LongType()),
        T.StructField("acq_date", T.DateType()),
        T.StructField("before_date", T.DateType()),
        T.StructField("after_date", T.DateType()),
        T.StructField("burn_scar_detected", T.BooleanType()),
        T.StructField("burnt_pixel_count", T.LongType()),
        T.StructField("burnt_building_count", T.LongType()),
        T.StructField("no_data", T.BooleanType()),
        T.StructField("too_cloudy", T.BooleanType()),
        T.StructField("validation_try", T.IntegerType()),
    ]
)
