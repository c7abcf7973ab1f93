"""Line <-> record: column expressions and the jobs built from them.

A line is ``id,name,address,continent`` without quoting. Only the first three commas
separate, so the last field keeps any further ones. The id is a plain base-10 int32.
A line that does not parse is never dropped unseen: it carries a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordlog.schema import FIELDS, KEYS

EMPTY, TOO_FEW, BAD_ID = "empty", "too_few_fields", "bad_id"

_INT = r"\A[+-]?[0-9]+\z"
_NUMBER_PREFIX = r"\A[ \t\n]*([+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?)"
_BLANKS = "".join(map(chr, range(0x21)))


def _up_to_comma(text: Column, n: int) -> Column:
    """What comes before the n-th comma, all of it if there are fewer; from the end for n < 0."""
    return F.substring_index(text, ",", n)


def fields(value: Column) -> list[Column]:
    """The four texts of a line, cut by bytes: nothing is decoded, and bytes that are no
    valid text come through as they are."""
    front = _up_to_comma(value, 3)
    return [
        _up_to_comma(value, 1),
        _up_to_comma(_up_to_comma(value, 2), -1),
        _up_to_comma(front, -1),
        F.substr(value.cast("binary"), F.octet_length(front) + 2).cast("string"),
    ]


def has_fields(value: Column) -> Column:
    """Three commas or more: then what comes before the third is not yet the whole line."""
    return F.octet_length(_up_to_comma(value, 3)) < F.octet_length(value)


def strict_int(text: Column) -> Column:
    """int32 or NULL. The pattern is needed, as a cast alone would accept blanks; a number
    in its usual form is spared it."""
    number = text.try_cast("int")
    return F.when((number.cast("string") == text) | text.rlike(_INT), number)


def lenient_number(text: Column) -> Column:
    """The leading number of a text, 0 where there is none."""
    return F.coalesce(F.regexp_extract(text, _NUMBER_PREFIX, 1).try_cast("double"), F.lit(0.0))


def normalize(value: Column) -> Column:
    """Strip every character up to U+0020 at both ends, not only spaces."""
    return F.btrim(value, F.lit(_BLANKS))


def serialize() -> Column:
    """A record as its line; the id comes out in canonical form."""
    texts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in FIELDS]
    return F.concat_ws(",", *texts)


def key_column(key: str) -> Column:
    if key not in KEYS:
        raise ValueError(f"unknown key {key!r}, expected one of {', '.join(KEYS)}")
    return F.col(key)


def key_text(key: str) -> Column:
    return key_column(key).cast("string")


def parse_all(lines: DataFrame, value: str = "value") -> DataFrame:
    """Every line with its fields and a ``reason``, which is NULL where it parsed.

    Only a line that parses has an id."""
    line = F.col(value)
    texts = fields(line)
    whole = has_fields(line)
    reason = F.when(line.isNull() | (line == ""), EMPTY).when(~whole, TOO_FEW).otherwise(BAD_ID)
    return lines.select(
        *lines.columns,
        F.when(whole, strict_int(texts[0])).alias("id"),
        *[t.alias(f) for t, f in zip(texts[1:], FIELDS[1:])],
    ).withColumn("reason", F.when(F.col("id").isNull(), reason))


def parse(lines: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The records of the lines that parse, with the columns named in ``keep``."""
    return parse_all(lines, value).filter(F.col("id").isNotNull()).select(*keep, *FIELDS)


def quarantine(lines: DataFrame, value: str = "value") -> DataFrame:
    """The lines that do not parse, with the reason."""
    return parse_all(lines, value).filter(F.col("id").isNull()).select(*lines.columns, "reason")


def quarantine_counts(lines: DataFrame, value: str = "value") -> DataFrame:
    return quarantine(lines, value).groupBy("reason").agg(F.count("*").alias("rows"))


def to_lines(records: DataFrame) -> DataFrame:
    return records.select(serialize().alias("value"))


def normalize_lines(lines: DataFrame) -> DataFrame:
    return lines.withColumn("value", normalize(F.col("value")))


def drop_empty(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("value").isNotNull() & (F.col("value") != ""))


def positional(lines: DataFrame) -> DataFrame:
    """Fields 1 (as a number), 2 and 4 of every line, parsed or not; missing ones are empty."""
    first, second, _, fourth = fields(F.col("value"))
    commas = F.length("value") - F.length(F.replace(F.col("value"), F.lit(",")))
    return lines.select(
        "value",
        lenient_number(first).alias("number"),
        F.when(commas >= 1, second).otherwise("").alias("second"),
        F.when(commas >= 3, fourth).otherwise("").alias("fourth"),
    )
