import random

import pytest
from pyspark.sql import functions as F

from ordlog.functions import codec
from ordlog.schema import CONTINENTS, FIELDS

INT_MAX, INT_MIN = 2**31 - 1, -(2**31)

VALID = [
    ("8,opal,3 Mill Row,Asia", (8, "opal", "3 Mill Row", "Asia")),
    ("-90,K,Quay 4 West,Europe", (-90, "K", "Quay 4 West", "Europe")),
    ("65536,Tourmaline,77,nowhere", (65536, "Tourmaline", "77", "nowhere")),
    ("3000,two words,no number,South America", (3000, "two words", "no number", "South America")),
    *[(f"{i},jet,9 Pier,{c}", (i, "jet", "9 Pier", c)) for i, c in enumerate(CONTINENTS)],
    ("1,,,", (1, "", "", "")),
    ("1,a,b,c,d", (1, "a", "b", "c,d")),
    ("1,a,b,c,d,,", (1, "a", "b", "c,d,,")),
    ("+5,a,b,c", (5, "a", "b", "c")),
    ("007,a,b,c", (7, "a", "b", "c")),
    ("-0,a,b,c", (0, "a", "b", "c")),
    ("-2147483648,a,b,c", (INT_MIN, "a", "b", "c")),
    ("2147483647,a,b,c", (INT_MAX, "a", "b", "c")),
    ("3, a ,\tb,c ", (3, " a ", "\tb", "c ")),
    ("4,é,漢字,𝒳\nnext", (4, "é", "漢字", "𝒳\nnext")),
]
MALFORMED = [
    (None, "empty"),
    ("", "empty"),
    ("one field", "too_few_fields"),
    ("6,six,sixth", "too_few_fields"),
    (",,", "too_few_fields"),
    ("__END__", "too_few_fields"),
    ("six,jet,9 Pier,Europe", "bad_id"),
    (",jet,9 Pier,Europe", "bad_id"),
    ("+,jet,9 Pier,Europe", "bad_id"),
    (" 5,jet,9 Pier,Europe", "bad_id"),
    ("5 ,jet,9 Pier,Europe", "bad_id"),
    ("5\n,jet,9 Pier,Europe", "bad_id"),
    ("1.5,jet,9 Pier,Europe", "bad_id"),
    ("1e3,jet,9 Pier,Europe", "bad_id"),
    ("2147483648,jet,9 Pier,Europe", "bad_id"),
    ("-2147483649,jet,9 Pier,Europe", "bad_id"),
    ("99999999999999999999,jet,9 Pier,Europe", "bad_id"),
    ("0x10,jet,9 Pier,Europe", "bad_id"),
]


@pytest.fixture(params=["true", "false"], ids=["ansi", "lenient"])
def ansi(request, spark):
    """The strictness of the session must not matter."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_valid_lines_parse(ansi, line_df):
    rows = codec.parse(line_df([v for v, _ in VALID]), keep=("value",)).collect()
    assert {r.value: tuple(r[f] for f in FIELDS) for r in rows} == dict(VALID)


def test_malformed_lines_are_kept_with_reason(ansi, line_df):
    every = line_df([v for v, _ in VALID] + [v for v, _ in MALFORMED])
    assert {(r.value, r.reason) for r in codec.quarantine(every).collect()} == set(MALFORMED)
    counts = {r.reason: r["rows"] for r in codec.quarantine_counts(every).collect()}
    assert counts == {"empty": 2, "too_few_fields": 4, "bad_id": 12}
    assert codec.parse(every).count() == len(VALID)
    assert codec.parse_all(every).count() == len(VALID) + len(MALFORMED)


@pytest.mark.parametrize(
    "line",
    [
        "12,opal,3 Mill Row,Europe",
        "-1,K,Quay 4 West,Asia",
        "2147483647,jet,9 Pier,nowhere",
        "6,,,",
        "6,x,,y,z",
    ],
)
def test_canonical_lines_round_trip(line_df, line):
    assert [r.value for r in codec.to_lines(codec.parse(line_df([line]))).collect()] == [line]


def test_serialize_makes_ids_canonical(line_df):
    out = codec.to_lines(codec.parse(line_df(["+5,a,b,c", "007,a,b,c", "-0,a,b,c"])))
    assert sorted(r.value for r in out.collect()) == ["0,a,b,c", "5,a,b,c", "7,a,b,c"]


def test_serialize_order_of_fields(record_df):
    out = codec.to_lines(record_df([(7, "n", "a", "c"), (8, None, None, None)]))
    assert [r.value for r in out.collect()] == ["7,n,a,c", "8,,,"]


def _reference_parse(line):
    """The contract in plain Python."""
    if not line:
        return None
    parts = line.split(",", 3)
    digits = parts[0][1:] if parts[0][:1] in ("+", "-") else parts[0]
    if len(parts) < 4 or not digits or any(c not in "0123456789" for c in digits):
        return None
    n = int(parts[0])
    return (n, *parts[1:]) if INT_MIN <= n <= INT_MAX else None


def test_parse_agrees_with_plain_python_on_random_lines(line_df):
    rng = random.Random(7)
    lines = ["".join(rng.choice(",,,0123456789+- aé\n\t") for _ in range(rng.randrange(14))) for _ in range(3000)]
    got = {(r.value, *[r[f] for f in FIELDS]) for r in codec.parse(line_df(lines), keep=("value",)).collect()}
    want = {(x, *p) for x in lines if (p := _reference_parse(x))}
    assert got == want and len(want) > 50


def test_normalize_strips_control_characters(line_df):
    lines = line_df([" \t1,a,b,c\r\n", "\x00x\x1f", "a b", " a ", "   "])
    out = sorted(r.value for r in codec.normalize_lines(lines).collect())
    assert out == sorted(["1,a,b,c", "x", "a b", " a ", ""])


def test_drop_empty(line_df):
    assert [r.value for r in codec.drop_empty(line_df(["", None, " ", "x"])).collect()] == [" ", "x"]


def test_keys(record_df):
    df = record_df([(7, "n", "a", "c")])
    row = df.select(*[codec.key_text(k).alias(k) for k in ("id", "name", "continent")]).first()
    assert tuple(row) == ("7", "n", "c")
    with pytest.raises(ValueError, match="unknown key"):
        codec.key_column("address")


def test_bytes_that_are_no_text_come_through(spark):
    lines = spark.sql("select cast(X'312C612C62E92C63E9' as string) value")
    row = codec.parse(lines).select(F.hex("name"), F.hex("address"), F.hex("continent")).first()
    assert tuple(row) == ("61", "62E9", "63E9")
    assert codec.to_lines(codec.parse(lines)).select(F.hex("value")).first()[0] == "312C612C62E92C63E9"


def test_positional_fields_and_lenient_numbers(line_df):
    lines = line_df(["12,b,c,d,e", "x", "3.5kg,b", "-2e1,b,c,", "", " +7 ,b,c,d"])
    got = {r.value: (r.number, r.second, r.fourth) for r in codec.positional(lines).collect()}
    assert got == {
        "12,b,c,d,e": (12.0, "b", "d,e"),
        "x": (0.0, "", ""),
        "3.5kg,b": (3.5, "b", ""),
        "-2e1,b,c,": (-20.0, "b", ""),
        "": (0.0, "", ""),
        " +7 ,b,c,d": (7.0, "b", "d"),
    }


def test_literal_empty_line_next_to_real_ones_does_not_raise(spark):
    """Folding of constants must not evaluate a cast that a filter should guard."""
    df = spark.range(1).select(F.lit("").alias("value")).unionByName(
        spark.range(1).select(F.lit("1,a,b,c").alias("value"))
    )
    assert codec.parse(df).count() == 1
