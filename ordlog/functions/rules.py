"""The data contract of generated records as rules, and the report on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordlog.functions.codec import parse_all
from ordlog.schema import ADDRESS_LENGTH, CONTINENTS, ID_LIMIT, NAME_LENGTH


@dataclass(frozen=True)
class RowRule:
    """Must hold for every row."""

    name: str
    holds: Column


@dataclass(frozen=True)
class TableRule:
    """Must hold for at least one row."""

    name: str
    holds: Column


def id_in_range(low: int = 0, limit: int = ID_LIMIT) -> Column:
    return (F.col("id") >= low) & (F.col("id") < limit)


def length_between(column: str, bounds: tuple[int, int]) -> Column:
    return F.length(column).between(*bounds)


def whole_match(column: str, pattern: str) -> Column:
    """The whole text matches, not just a part of it."""
    return F.col(column).rlike(rf"\A(?:{pattern})\z")


def has_digit(column: str) -> Column:
    return F.col(column).rlike(r"\p{Nd}")


def has_letter(column: str) -> Column:
    return F.col(column).rlike(r"\p{L}")


def has_space(column: str) -> Column:
    return F.contains(F.col(column), F.lit(" "))


def in_domain(column: str, domain: tuple[str, ...]) -> Column:
    return F.col(column).isin(*domain)


def record_rules(domain: tuple[str, ...] = CONTINENTS) -> list[RowRule | TableRule]:
    return [
        RowRule("id_range", id_in_range()),
        RowRule("name_length", length_between("name", NAME_LENGTH)),
        RowRule("name_letters", whole_match("name", "[a-zA-Z]+")),
        RowRule("address_length", length_between("address", ADDRESS_LENGTH)),
        RowRule("address_chars", whole_match("address", "[a-zA-Z0-9 ]+")),
        TableRule("address_some_digit", has_digit("address")),
        TableRule("address_some_letter", has_letter("address")),
        TableRule("address_some_space", has_space("address")),
        RowRule("continent_valid", in_domain("continent", domain)),
        *[TableRule(f"continent_present:{c}", F.col("continent") == c) for c in domain],
    ]


def rule_report(
    lines: DataFrame,
    expected_rows: int | Column | None = None,
    domain: tuple[str, ...] = CONTINENTS,
) -> DataFrame:
    """One row for each rule: rows checked, violations, passed. One scan serves all rules.

    Lines that do not parse fail the rule ``parses`` and are not held against the others.
    A table rule has one violation when no row fulfils it. ``row_count`` compares the
    number of lines with the expected one.
    """
    rules = record_rules(domain)
    parsed = F.col("reason").isNull()
    counts = [F.count("*").alias("_lines"), F.count_if(parsed).alias("_parsed")]
    for i, r in enumerate(rules):
        # a rule with no answer counts as broken
        kept = F.coalesce(r.holds, F.lit(False))
        counts.append(F.count_if(parsed & (~kept if isinstance(r, RowRule) else kept)).alias(f"_{i}"))
    row = lambda name, checked, bad: F.struct(
        F.lit(name).alias("rule"), checked.alias("checked"), bad.cast("bigint").alias("violations")
    )
    entries = [row("parses", F.col("_lines"), F.col("_lines") - F.col("_parsed"))]
    for i, r in enumerate(rules):
        n = F.col(f"_{i}")
        entries.append(row(r.name, F.col("_parsed"), n if isinstance(r, RowRule) else (n == 0).cast("int")))
    if expected_rows is not None:
        wanted = expected_rows if isinstance(expected_rows, Column) else F.lit(expected_rows)
        entries.append(row("row_count", F.col("_lines"), F.abs(F.col("_lines") - wanted)))
    report = parse_all(lines).agg(*counts).select(F.inline(F.array(*entries)))
    return report.withColumn("passed", F.col("violations") == 0)
