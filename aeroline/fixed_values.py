"""Values that are part of the data contract, kept in one place.

Everything in this module is a fixed value: it has to be exactly what upstream systems and existing tables
already use, or results stop matching. Logic that uses these values lives elsewhere.
"""

# Sentinel for "no valid number" in the feed, and the feed's minute-resolution timestamp format.
INVALID_NUMBER = -999
READING_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"

# Air quality category -> level of concern.
CONCERN_LEVELS = {
    1: "Good",
    2: "Moderate",
    3: "Unhealthy for Sensitive Groups",
    4: "Unhealthy",
    5: "Very Unhealthy",
    6: "Hazardous",
}

# Weekday number (1 = Sunday) -> name.
WEEKDAY_NAMES = {
    1: "Sunday",
    2: "Monday",
    3: "Tuesday",
    4: "Wednesday",
    5: "Thursday",
    6: "Friday",
    7: "Saturday",
}

# Pollutant codes used in requests -> names used in the data.
POLLUTANT_NAMES = {
    "PM25": "PM2.5",
    "PM10": "PM10",
    "OZONE": "OZONE",
    "NO2": "NO2",
    "CO": "CO",
    "SO2": "SO2",
}

# Quarantine labels in order of precedence, each with the column it is about.
REJECTION_LABELS = [
    ("INVALID_AQI", "aqi"),
    ("NULL_AQI", "aqi"),
    ("INVALID_CATEGORY", "category"),
    ("NULL_CATEGORY", "category"),
    ("NULL_SITE", "sitename"),
    ("NULL_PARAMETER", "parameter"),
    ("NULL_FULLAQSCODE", "fullaqscode"),
    ("NULL_INTLAQSCODE", "intlaqscode"),
    ("NULL_AGENCY", "agencyname"),
    ("NULL_LATITUDE", "latitude"),
    ("NULL_LONGITUDE", "longitude"),
    ("NULL_DATETIME", "utc"),
]
DUPLICATE_LABEL = "DUPLICATE"

# Marker for a NULL part of a surrogate key, and the watermark of an empty table.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"
BEGINNING_OF_TIME = "1900-01-01 00:00:00"

# Where the backfill ends, and the length of one backfill window.
BACKFILL_TARGET = "2019-09-01T00:00"
BACKFILL_WEEKS = 2

# Time zone of the local-time series.
LOCAL_TIME_ZONE = "US/Eastern"

# Regions in order of precedence as (region, lat_min, lat_max, lon_min, lon_max), bounds inclusive.
REGIONS = [
    ("Northeast", 36.5, 47.5, -80.0, -66.0),
    ("Midwest", 36.5, 49.5, -104.0, -80.0),
    ("South", 25.0, 36.5, -105.0, -75.0),
    ("West", 31.0, 49.5, -125.0, -104.0),
    ("Alaska", 51.0, 71.0, -170.0, -130.0),
    ("Hawaii", 18.5, 22.5, -161.0, -154.0),
]
NO_REGION = "Other"

# Request boxes as lon_min,lat_min,lon_max,lat_max.
REQUEST_BOXES = """
-149.834,61.1811,-147.31,64.8458
-157.871,19.2065,-155.055,21.3076
-120.644,34.3942,-119.515,35.3547
-121.156,35.4946,-119.504,36.8192
-119.404,33.9014,-118.179,35.0544
-119.313,35.2392,-118.418,36.6972
-122.398,36.9833,-121.599,37.7658
-122.519,37.7936,-121.642,38.5346
-121.575,36.8434,-120.68,38.6138
-120.48,36.8414,-118.294,37.9818
-118.171,32.7102,-117.124,34.0103
-117.089,32.6312,-116.064,33.9446
-118.127,34.0309,-116.391,34.511
-118.117,35.643,-116.848,36.8028
-116.016,32.4667,-112.339,34.6121
-112.294,33.0611,-112.003,33.8217
-116.032,35.7857,-115.176,36.5693
-115.149,35.1661,-112.107,37.1983
-123.359,38.6612,-121.338,40.1709
-124.277,40.2621,-121.576,42.3324
-124.264,42.4341,-123.053,44.6244
-123.037,42.5411,-121.273,44.7512
-123.82,44.9226,-122.772,46.1394
-122.738,44.7787,-121.527,45.8679
-124.61,46.6641,-122.463,48.9507
-122.456,46.7841,-121.603,48.76
-121.265,38.6833,-119.766,39.2504
-121.235,39.3279,-119.289,44.6306
-119.248,39.4725,-114.371,44.8902
-113.89,40.4964,-112.009,45.1819
-120.333,45.3009,-117.813,46.3802
-120.545,46.4744,-117.369,48.5447
-117.368,45.4264,-116.115,48.7056
-116.028,45.2064,-112.013,48.5103
-111.935,32.3806,-111.127,33.4124
-111.917,33.42,-111.33,35.2045
-110.996,31.3372,-109.389,32.25
-111.107,32.2558,-106.767,36.035
-106.683,31.7467,-106.324,31.8624
-106.288,28.7046,-100.451,31.6675
-99.5333,27.5174,-98.62,29.515
-98.5891,26.2262,-97.7131,30.4832
-106.751,31.8939,-106.426,35.2994
-106.409,31.8703,-102.335,35.6198
-101.665,32.4419,-97.7508,36.1589
-97.7125,25.9009,-94.8564,29.5831
-95.6358,29.6239,-93.8969,29.8025
-97.6917,29.8145,-95.3877,30.6274
-95.3261,29.8281,-93.285,30.6681
-97.6797,31.088,-96.7534,32.9192
-97.5777,32.9225,-96.7861,35.6128
-96.4592,32.0319,-92.2605,34.9061
-96.3608,35.4081,-93.2081,36.3559
-111.714,37.1983,-108.49,40.3414
-108.472,36.7422,-106.836,39.5418
-106.823,36.3833,-104.722,39.7419
-105.545,39.7511,-104.707,40.3861
-111.988,40.4838,-109.79,41.8428
-109.561,40.4147,-104.706,41.8055
-111.594,42.373,-109.563,42.9288
-111.987,43.4578,-109.455,48.5404
-109.069,42.5275,-105.287,44.2
-109.069,44.2,-105.287,45.8064
-104.598,37.7667,-99.7636,39.6385
-98.3789,36.5123,-96.6757,40.9183
-96.6714,37.677,-94.8583,41.5507
-103.658,41.8756,-100.768,46.8253
-103.514,46.9497,-101.428,48.6419
-97.9282,41.8322,-95.9281,42.7895
-100.287,44.3486,-95.0292,47.8782
-94.8389,36.9222,-92.3163,39.1175
-94.849,39.132,-92.3158,42.7431
-94.6933,43.1233,-92.4497,44.979
-94.1433,45.0083,-92.4784,48.4128
-92.0428,29.7639,-89.396,30.3009
-92.0461,30.315,-89.2922,34.0026
-89.0497,30.1103,-84.9903,33.0954
-88.7668,33.2811,-85.3233,34.5286
-82.74,27.0892,-82.3625,27.8539
-82.7578,27.8636,-82.2306,29.5662
-84.9457,30.0842,-82.445,32.9672
-84.7789,33.1787,-83.3575,34.3778
-91.1165,34.8206,-89.3819,38.5425
-88.625,35.1169,-87.2815,38.1139
-87.1375,34.6917,-85.7331,37.1314
-87.0558,37.7145,-85.6544,38.3938
-85.2943,34.785,-83.9416,35.9777
-83.9306,34.636,-82.4146,35.9803
-85.5744,36.0183,-83.2203,38.3986
-83.0662,36.5131,-82.4258,38.5081
-90.4759,38.6503,-89.9501,38.9013
-92.0061,39.0459,-89.6409,41.6992
-89.6072,38.7408,-86.99,40.6978
-89.5861,40.745,-86.9078,41.7547
-91.6878,41.7714,-87.8761,42.335
-87.8631,41.7558,-87.5453,42.5047
-90.6964,42.596,-87.81,44.2893
-92.1669,44.3069,-87.9939,47.9721
-86.5047,39.1594,-85.7668,40.0683
-85.6521,38.9675,-84.4077,40.1995
-84.4038,39.0828,-83.9429,40.0846
-83.8046,38.5483,-82.433,40.1111
-86.8911,40.4317,-85.6294,42.1978
-85.2459,40.2789,-82.6796,41.9956
-85.5419,42.2283,-83.0919,42.4631
-86.3111,42.7314,-82.4564,46.2889
-80.4838,25.4782,-80.0969,26.2906
-82.0003,26.294,-80.0589,27.94
-82.1733,28.0542,-80.6156,29.4891
-81.8408,29.6867,-79.96,32.8823
-82.0756,33.4333,-80.1989,35.2132
-82.0621,35.2411,-80.1439,36.0508
-80.0307,32.941,-76.6203,35.428
-79.8592,35.5909,-76.1812,36.8419
-82.1101,36.8912,-80.4572,39.9428
-80.2897,37.17,-78.31,39.9878
-77.7677,37.3444,-77.0128,38.8752
-78.0816,38.8947,-76.9534,39.9611
-76.8119,36.8556,-75.1632,38.9867
-76.8783,39.0284,-74.431,39.462
-76.6994,39.5513,-75.4919,40.0467
-75.414,39.4649,-74.1704,40.0089
-81.9239,40.1147,-80.5925,41.1062
-82.0957,41.1825,-80.5728,41.9597
-80.42,40.1469,-78.9158,40.6139
-80.485,40.6847,-78.4792,43.2189
-78.3889,40.2464,-75.4325,41.2662
-77.5576,41.4428,-75.5781,44.0878
-75.3411,40.0542,-74.1372,40.6331
-75.3283,40.6414,-74.0187,43.4556
-74.0051,40.2776,-73.0575,40.8535
-74.0097,40.868,-73.1036,41.8331
-73.0442,40.9617,-71.7197,42.1944
-71.62,41.3305,-70.0239,42.0997
-73.8589,42.2983,-72.2723,44.5284
-71.8786,42.2117,-71.1144,44.3081
-71.107,42.3252,-69.7977,43.7363
-70.8547,43.918,-67.6155,47.3553
""".split()
