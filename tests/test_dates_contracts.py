"""Dates, contracts and validation (reference ETL and contract tests)."""

import datetime as dt

from pyspark.sql import functions as F

from cauce.functions.dates import age_at, parse_timestamp, weekday
from cauce.operators.contracts import ColumnContract as C
from cauce.operators.contracts import TableContract, apply_contract, split_by_contract
from cauce.operators.relational import split_valid

PATIENT_ID = r"P\d{6}"


def test_age_at_visit(spark):
    df = spark.createDataFrame([(dt.date(1990, 1, 15), dt.datetime(2024, 1, 15, 10, 0))], "b date, v timestamp")
    assert df.select(age_at("b", "v")).first()[0] == 34


def test_age_ignores_day_of_month(spark):
    df = spark.createDataFrame([(dt.date(1990, 3, 31), dt.datetime(2024, 3, 1))], "b date, v timestamp")
    assert df.select(age_at("b", "v")).first()[0] == 34


def test_timestamp_formats_all_parse(spark):
    vals = ["2024-01-01 10:00:00", "2024-01-01 10:00", "07/30/2025 11:45", "2024-01-01T10:00:00Z",
            "2024-01-01T10:00:00", "2024-01-01", "not a date"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    out = [r[0] for r in df.select(parse_timestamp("s")).collect()]
    assert all(o is not None for o in out[:6])
    assert out[6] is None
    assert out[2] == dt.datetime(2025, 7, 30, 11, 45)


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),)], "d date")  # Mon, Sun
    assert [r[0] for r in df.select(weekday("d")).collect()] == [0, 6]


def test_patient_id_regex(spark):
    contract = TableContract("patients", (C("patient_id", nullable=False, regex=PATIENT_ID),))
    valid, invalid = ["P000001", "P123456"], ["P00001", "A000001", "P000001a", "P0000000"]
    df = spark.createDataFrame([(v,) for v in valid + invalid], "patient_id string")
    ok, bad = split_by_contract(df, contract)
    assert sorted(r[0] for r in ok.select("patient_id").collect()) == sorted(valid)
    assert sorted(r[0] for r in bad.select("patient_id").collect()) == sorted(invalid)


def test_negative_amount_quarantined(spark):
    contract = TableContract("appointments", (
        C("appointment_id", nullable=False),
        C("amount_charged", dtype="double", negative=True, sentinel_above=500000.0)))
    df = spark.createDataFrame([("A1", -100.0), ("A2", 999999.0), ("A3", 350.0), ("A4", None)],
                               "appointment_id string, amount_charged double")
    chk = {r["appointment_id"]: r["reject_reason"] for r in apply_contract(df, contract).collect()}
    assert "amount_charged_negative" in chk["A1"]
    assert chk["A2"] == "amount_charged_sentinel"
    assert chk["A3"] == "" and chk["A4"] == ""


def test_several_reasons_in_order(spark):
    contract = TableContract("t", (C("a", nullable=False), C("b", dtype="int", min=1, max=5),
                                   C("c", values=("x", "y"))))
    df = spark.createDataFrame([(None, "9", "z")], "a string, b string, c string")
    assert apply_contract(df, contract).first()["reject_reason"] == "a_null;b_out_of_range;c_invalid_value"


def test_uncastable_is_invalid_type(spark):
    contract = TableContract("t", (C("b", dtype="int"),))
    df = spark.createDataFrame([("abc",), ("7",)], "b string")
    r = [x["reject_reason"] for x in apply_contract(df, contract).orderBy("b").collect()]
    assert r == ["", "b_invalid_type"]


def test_foreign_key_not_found(spark):
    contract = TableContract("orders", (C("cust", fk="customers"),))
    orders = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, cust int")
    parents = spark.createDataFrame([(10,), (10,)], "k int")   # duplicate parent keys must not multiply rows
    out = apply_contract(orders, contract, {"cust": parents}).orderBy("id").collect()
    assert [r["reject_reason"] for r in out] == ["", "cust_not_found", ""]


def test_split_valid_complete_and_disjoint(spark):
    rows = [(1, 2022, 45000, 385000.0), (2, 2022, 45000, 0.0), (3, None, 1000, 1.0), (4, 2028, 10, 5.0),
            (5, 2015, -500, 10.0), (6, 1985, 5, 5.0), (7, 2010, 5, -100.0)]
    df = spark.createDataFrame(rows, "vehicle_id int, year int, mileage int, price double")
    pred = (F.col("price") > 0) & F.col("year").between(1990, 2026) & (F.col("mileage") >= 0)
    ok, bad = split_valid(df, pred)
    ok_ids = {r[0] for r in ok.select("vehicle_id").collect()}
    bad_ids = {r[0] for r in bad.select("vehicle_id").collect()}
    assert ok_ids == {1}
    assert bad_ids == {2, 3, 4, 5, 6, 7}          # the null year is rejected, not lost
    assert ok_ids | bad_ids == set(range(1, 8)) and not ok_ids & bad_ids
