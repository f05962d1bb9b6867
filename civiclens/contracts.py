"""Constants, names, patterns and formats that results depend on."""

from pyspark.sql import types as T

# Columns of the crime files.
CRIME_TIME = "TIME OCC"
CRIME_PLACE = "Premis Desc"
CRIME_DATE = "DATE OCC"
CRIME_LAT = "LAT"
CRIME_LON = "LON"
STREET = "STREET"

# Properties of a census block feature.
BLOCK_ZIP = "ZCTA20"
BLOCK_POPULATION = "POP20"
BLOCK_HOUSING = "HOUSING20"

# Columns of the income file; its text form keeps ZIP and income
# at these positions of a line with at least this many parts.
INCOME_ZIP = "Zip Code"
INCOME_MEDIAN = "Estimated Median Income"
INCOME_SEPARATOR = ";"
INCOME_ZIP_POSITION = 0
INCOME_MEDIAN_POSITION = 2
INCOME_MIN_PARTS = 3

# Columns of the station file. X is the longitude.
STATION_NAME = "DIVISION"
STATION_LAT = "Y"
STATION_LON = "X"

# Starts of the parts of a day in HHMM, and their labels in that
# order. The last part wraps midnight.
DAY_PART_STARTS = (500, 1200, 1700, 2100)
DAY_PART_LABELS = ("morning", "afternoon", "evening", "night")
DAY_PART_LABELS_GREEK = ("Πρωί", "Απόγευμα", "Βράδυ", "Νύχτα")

# Date layouts as (leading blank-separated tokens, pattern).
DATE_FORMATS = ((3, "yyyy MMM dd"), (1, "MM/dd/yyyy"))

# Characters that money text carries around its digits.
MONEY_NOISE = "[$,]"

# A timer line of a job log.
TIMER_LINE = r"^\[TIMER\] (.+): ([0-9.]+) s"

# Fixed value: mean Earth radius.
EARTH_RADIUS_KM = 6371.0


def feature_schema(properties: T.StructType) -> T.StructType:
    """Schema of a FeatureCollection document holding just these properties."""
    feature = T.StructType([T.StructField("properties", properties)])
    return T.StructType([T.StructField("features", T.ArrayType(feature))])


BLOCK_PROPERTIES = T.StructType(
    [
        T.StructField(BLOCK_ZIP, T.StringType()),
        T.StructField(BLOCK_POPULATION, T.LongType()),
        T.StructField(BLOCK_HOUSING, T.LongType()),
    ]
)
