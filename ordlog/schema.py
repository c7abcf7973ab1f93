"""Table shapes and fixed values of the record model."""

from __future__ import annotations

from pyspark.sql import types as T

RECORD = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("continent", T.StringType()),
    ]
)
LINE = T.StructType([T.StructField("value", T.StringType())])
LOG = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

FIELDS = tuple(RECORD.fieldNames())
KEYS = ("id", "name", "continent")

# The data contract of a generated record.
CONTINENTS = ("North America", "Asia", "South America", "Europe", "Africa", "Australia")
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
ADDRESS_CHARS = LETTERS + "0123456789 "
ID_LIMIT = 2147483647
NAME_LENGTH = (10, 15)
ADDRESS_LENGTH = (15, 20)
PREVIEW_ROWS = 5
REPORTED_VIOLATIONS = 3
SOURCE_TOPIC = "source"
SOURCE_PARTITIONS = 3
