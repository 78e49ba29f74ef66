"""Readers, alias homologation and lookups (reference fixtures)."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.operators.relational import (homologate, integrate_with_rejects, keep_first, left_join_indicator,
                                        lookup_struct, sized_broadcast)
from cauce.sources.readers import alias_pairs, read_csv, read_csv_null_marker, read_csv_permissive


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_absences(spark, tmp_table_dir):
    p = f"{tmp_table_dir}/corpus.csv"
    _write(p, 'id,text\n1,__NULO__\n2,\n3,""\n4,   \n5,hola\n')
    got = {r["id"]: r["text"] for r in read_csv_null_marker(spark, p).collect()}
    assert got == {"1": None, "2": "", "3": "", "4": "   ", "5": "hola"}


def test_csv_semicolon_and_trimmed_headers(spark, tmp_table_dir):
    p = f"{tmp_table_dir}/bank.csv"
    _write(p, " age ;balance; y\n30;100;no\n")
    df = read_csv(spark, p, sep=";")
    assert df.columns == ["age", "balance", "y"] and df.first()["age"] == 30


def test_permissive_csv_keeps_corrupt_rows(spark, tmp_table_dir):
    p = f"{tmp_table_dir}/vehicles.csv"
    _write(p, "vehicle_id,brand,year,mileage,price\n1,VW,2022,45000,385000\n2,BMW,not-a-year,10,5\n")
    schema = T.StructType([T.StructField("vehicle_id", T.IntegerType()), T.StructField("brand", T.StringType()),
                           T.StructField("year", T.IntegerType()), T.StructField("mileage", T.IntegerType()),
                           T.StructField("price", T.DoubleType())])
    ok, bad = read_csv_permissive(spark, p, schema)
    assert [r["vehicle_id"] for r in ok.collect()] == [1]
    assert bad.count() == 1 and "not-a-year" in bad.first()["_corrupt_record"]


CATALOGUE = {
    "clinicas": [{"clinic_code": "CL01", "nombre": "Clinica Centro", "ciudad": "CDMX", "zona": "centro",
                  "aliases": ["CL-01", "cl01", "Centro"]},
                 {"clinic_code": "CL03", "nombre": "Clinica Sur", "ciudad": "CDMX", "zona": "sur", "aliases": []}],
    "especialidad_aliases": {"Medicina General": ["MEDICINA_GENERAL", "med gral", "medicina general"],
                             "Pediatría": ["ped", "pediatria"], "Traumatología": ["TRAUMA", "trauma"]},
}


def _catalogue(spark, tmp_table_dir):
    from cauce.sources.readers import read_alias_catalogue
    p = f"{tmp_table_dir}/catalogo.json"
    _write(p, json.dumps(CATALOGUE))
    return read_alias_catalogue(spark, p)


def test_specialty_homologation(spark, tmp_table_dir):
    _, specs = _catalogue(spark, tmp_table_dir)
    raw = spark.createDataFrame([("MEDICINA_GENERAL",), ("med gral",), ("ped",), ("TRAUMA",), ("oncologia",)], "s string")
    got = {r["s"]: r["clean"] for r in homologate(raw, "s", specs, "clean").collect()}
    assert got == {"MEDICINA_GENERAL": "Medicina General", "med gral": "Medicina General", "ped": "Pediatría",
                   "TRAUMA": "Traumatología", "oncologia": None}


def test_clinic_homologation(spark, tmp_table_dir):
    clinics, _ = _catalogue(spark, tmp_table_dir)
    raw = spark.createDataFrame([(" 'CL01' ",), ("CL03",), ("cl01",), ("CL-01",), ("Clinica Centro",)], "c string")
    out = [r["clean"] for r in homologate(raw, "c", clinics, "clean").collect()]
    assert sorted(out) == ["CL01", "CL01", "CL01", "CL01", "CL03"]


def test_brand_keeps_original_on_miss(spark):
    cat = spark.createDataFrame([("vw", "Volkswagen")], "alias_norm string, canonical string")
    raw = spark.createDataFrame([("VW",), ("Seat",)], "b string")
    got = {r["b"]: r["clean"] for r in homologate(raw, "b", cat, "clean", keep_original=True).collect()}
    assert got == {"VW": "Volkswagen", "Seat": "Seat"}


def test_vehicle_integration_rejects(spark):
    listings = spark.createDataFrame([(1, "VW", "Golf", 342000.0, "web"), (99, "VW", "Polo", 1.0, "web")],
                                     "vehicle_id int, brand string, model string, price double, source string")
    vehicles = spark.createDataFrame([(1, "Volkswagen")], "vehicle_id int, canonical_brand string")
    specs = spark.createDataFrame([(1, "Monterrey", "sedan")], "vehicle_id int, city string, category string")
    ok, bad = integrate_with_rejects(listings, [(vehicles, "vehicle_id", "vehicle_id_not_found"),
                                                (specs, "vehicle_id", "vehicle_specs_not_found")])
    r = ok.collect()
    assert len(r) == 1 and r[0]["price"] == 342000.0 and r[0]["city"] == "Monterrey"
    assert bad.first()["reject_reason"] == "vehicle_id_not_found;vehicle_specs_not_found"


def test_rate_lookup_last_wins_and_gap(spark):
    from cauce.operators.relational import dedupe_lookup
    rates = spark.createDataFrame([("CL01", "Pediatría", 400, 1), ("CL01", "Pediatría", 500, 2)],
                                  "clinic string, specialty string, tarifa int, seq int")
    r = dedupe_lookup(rates, ["clinic", "specialty"], "seq")
    appt = spark.createDataFrame([("A1", "CL01", "Pediatría", 500.0), ("A2", "CL09", "Pediatría", 10.0)],
                                 "id string, clinic string, specialty string, charged double")
    j = appt.join(r, ["clinic", "specialty"], "left").withColumn("gap", F.col("charged") - F.col("tarifa"))
    got = {x["id"]: (x["tarifa"], x["gap"]) for x in j.collect()}
    assert got == {"A1": (500, 0.0), "A2": (None, None)}


def test_left_join_indicator_suffixes(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "z")], "k int, v string")
    out = {r["k"]: (r["_merge"], r["v_right"]) for r in left_join_indicator(a, b, "k").collect()}
    assert out == {1: ("both", "z"), 2: ("left_only", None)}


def test_lookup_struct_nulls_on_miss(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    d = spark.createDataFrame([(1, "Mexico", 1900)], "k int, country string, founded int")
    got = {r["k"]: r["m"] for r in lookup_struct(a, d, "k", ["country", "founded"], "m").collect()}
    assert got[1]["country"] == "Mexico" and got[2]["country"] is None


def test_keep_first_is_deterministic(spark):
    df = spark.createDataFrame([("P1", 3, "c"), ("P1", 1, "a"), ("P1", 2, "b"), ("P2", 5, "e")], "k string, seq int, v string")
    got = {r["k"]: r["v"] for r in keep_first(df, "k", ["seq"]).collect()}
    assert got == {"P1": "a", "P2": "e"}
    got_last = {r["k"]: r["v"] for r in keep_first(df, "k", ["seq"], keep="last").collect()}
    assert got_last == {"P1": "c", "P2": "e"}


def test_sized_broadcast_respects_bound(spark):
    small = spark.range(10)
    big = spark.range(1000)
    j1 = spark.range(100).join(sized_broadcast(small, 100), "id")
    j2 = spark.range(100).join(sized_broadcast(big, 100), "id")
    assert "BroadcastHashJoin" in j1._jdf.queryExecution().executedPlan().toString()
    hint2 = j2._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in hint2.lower()
