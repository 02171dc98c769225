"""Fixed schemas. Codes carry leading zeros, so nothing is ever inferred."""

from pyspark.sql import types as T

READING_FIELDS = [
    ("Latitude", T.DoubleType()),
    ("Longitude", T.DoubleType()),
    ("UTC", T.StringType()),
    ("Parameter", T.StringType()),
    ("Unit", T.StringType()),
    ("AQI", T.IntegerType()),
    ("Category", T.IntegerType()),
    ("SiteName", T.StringType()),
    ("AgencyName", T.StringType()),
    ("FullAQSCode", T.StringType()),
    ("IntlAQSCode", T.StringType()),
]

READING = T.StructType([T.StructField(name, kind, True) for name, kind in READING_FIELDS])

# PERMISSIVE reads put the text of unreadable records here, so they can be quarantined instead of vanishing.
CORRUPT = "_corrupt_record"
READING_WITH_CORRUPT = T.StructType(READING.fields + [T.StructField(CORRUPT, T.StringType(), True)])
