"""Golden rows for every cleaner (FIXTURES.md §D), incl. reference quirks."""

import pytest
from pyspark.sql import functions as F

from sluice.functions import cleaners as C
from sluice.functions import rules as R


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_normalize_phone(spark):
    cases = {
        "081234": "081234", "+62 812-345": "0812345", "812345": "0812345", "62": "0", "6.28E+11": "0811",
        "6.E+11": None, "E+11": None, "n/a": None, "NA": None, "N/A 0812": None, "NULL": None, "0": None,
        "abc": None, "٠١٢": None, None: None, "  ": None,
    }
    got = one_col(spark, list(cases), C.normalize_phone)
    assert got == list(cases.values())


def test_phone_valid_and_status(spark):
    got = one_col(spark, ["+62 812-3456-7890", "0812345", None, "", "(021) 5551234", "0811"], C.phone_is_valid)
    assert got == [True, False, False, False, True, False]
    df = spark.createDataFrame([(True, True), (False, False), (True, False), (False, True)], "a boolean, b boolean")
    assert [r[0] for r in df.select(C.phone_status("a", "b")).collect()] == ["valid", "invalid", "check", "check"]


def test_address(spark):
    df = spark.createDataFrame([(" a", "A", "b"), (None, "x", "X"), ("", " q ", "Q")], "a string, b string, c string")
    out = [tuple(r) for r in df.select(*C.clean_address(["a", "b", "c"])).collect()]
    assert out == [("A", None, "B"), (None, "X", None), (None, "Q", None)]


def test_name(spark):
    got = one_col(spark, ["o'brien  mc-donald", "12345", "Jo×n 3÷ Łuk é", None], C.clean_name)
    assert got == ["O'brien Mc-donald", None, "Jo×n ÷ Uk É", None]


def test_nik_postal(spark):
    assert one_col(spark, ["1234 5678-9012.3456", "123456789012345", None], C.clean_nik) == ["1234567890123456", None, None]
    assert one_col(spark, [" 12345 ", "123", "abcde", "12 345"], C.clean_postal_code) == ["12345", None, None, "12345"]


def test_coordinates(spark):
    df = spark.createDataFrame([("-6.25", "0.0"), ("-6.25", None), ("91", "106.75"), ("abc", "181"), ("NaN", "10")],
                               "la string, lo string")
    la, lo = C.clean_coordinates("la", "lo")
    out = [tuple(r) for r in df.select(la, lo).collect()]
    assert out == [(None, None), (-6.25, None), (None, 106.75), (None, None), (None, 10.0)]


def test_boolean_and_padded(spark):
    assert one_col(spark, [" yes ", "No", "maybe", None, "1", "FALSE"], C.clean_boolean) == [True, False, None, None, True, False]
    assert one_col(spark, [1, 0, 2], C.clean_boolean, "int") == [True, False, None]
    assert one_col(spark, ["y", "Y ", "X", None], lambda c: C.clean_padded_char(c, ["Y", "N"])) == ["y", None, None, None]
    assert one_col(spark, ["Y", "N"], lambda c: C.clean_padded_char(c, [])) == [None, None]
    assert one_col(spark, ["Y "], lambda c: C.clean_padded_char(c, ["Y"], rtrim=True)) == ["Y "]


def test_location(spark):
    assert one_col(spark, ["jakarta 1", "123", " kota-BOGOR "], C.clean_location) == ["Jakarta", "", "Kota-bogor"]
    assert one_col(spark, ["123"], lambda c: C.clean_location(c, blank_to_null_=True)) == [None]


def test_zero_to_null_text(spark):
    got = one_col(spark, ["0.0", "00", " 0 ", "", "0.4", "abc", None], lambda c: R.zero_to_null(c))
    assert got == [None, None, None, None, "0.4", "abc", None]


def test_rounding(spark):
    assert one_col(spark, [2.675, 123456789.55], lambda c: R.round_decimal(c, 2), "double")[1] is None
    assert str(one_col(spark, [2.675], lambda c: R.round_decimal(c, 2), "double")[0]) == "2.68"


def test_product_flags(spark):
    assert one_col(spark, ["xFG", "fg", None, "PRM1"], lambda c: C.code_flag(c, "FG")) == ["Y", "N", "N", "N"]


@pytest.mark.parametrize("fn", [C.clean_name, C.clean_nik, C.clean_postal_code, C.clean_boolean, C.clean_location])
def test_idempotent(spark, fn):
    vals = ["o'brien  mc-donald", " 12345 ", "1234 5678-9012.3456", " yes ", "jakarta 1", None, ""]
    once = one_col(spark, vals, fn)
    twice = one_col(spark, [None if v is None else str(v).lower() if isinstance(v, bool) else v for v in once], fn)
    assert [None if v is None else str(v) for v in twice] == [None if v is None else str(v) for v in once]


def test_vectorized_validator_hook(spark):
    from sluice.functions.phone_udf import vectorized_validator

    def strict(v):
        if not v.startswith("08"):
            raise ValueError("no")
        return len(v) >= 10

    valid = vectorized_validator(strict)
    got = one_col(spark, ["0812345678", "0812", "+62", None, ""], valid)
    assert got == [True, False, False, False, False]
