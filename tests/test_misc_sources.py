"""Schema helpers, provenance, JSON records, forced-text CSV, sinks."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.operators.relational import conform, normalise_headers, numeric_columns, require_columns, with_provenance
from cauce.sources import sinks
from cauce.sources.readers import frame, read_csv, read_json_records


def test_require_columns(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    assert require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match="price"):
        require_columns(df, ["id", "price"])


def test_headers_numeric_conform(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "` Id ` int, Price double, Name string")
    n = normalise_headers(df)
    assert n.columns == ["id", "price", "name"] and numeric_columns(n) == ["id", "price"]
    out = conform(n, {"vehicle_name": "name", "vehicle_id": "id"})
    assert out.columns == ["vehicle_name", "vehicle_id"]


def test_provenance_one_timestamp(spark):
    df = with_provenance(spark.range(3), "clinic_db", "b1", "r1", "2024-01-01 00:00:00")
    assert df.select("ingested_at").distinct().count() == 1 and df.first()["source_system"] == "clinic_db"


def test_forced_text_column_keeps_bad_values(spark, tmp_table_dir):
    p = f"{tmp_table_dir}/churn.csv"
    os.makedirs(tmp_table_dir, exist_ok=True)
    with open(p, "w") as f:
        f.write("id,tenure,TotalCharges\n1,0, \n2,5,10.5\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("tenure", T.IntegerType()),
                           T.StructField("TotalCharges", T.StringType())])
    df = read_csv(spark, p, schema=schema)
    assert [r["TotalCharges"] for r in df.orderBy("id").collect()] == [" ", "10.5"]


def test_json_records(spark, tmp_table_dir):
    p = f"{tmp_table_dir}/specs.json"
    os.makedirs(tmp_table_dir, exist_ok=True)
    with open(p, "w") as f:
        json.dump([{"vehicle_id": 1, "city": "Monterrey"}, {"vehicle_id": 2, "city": "CDMX"}], f)
    assert read_json_records(spark, p).count() == 2


def test_frame_and_fingerprint_order_insensitive(spark):
    a = frame(spark, [(1, "x"), (2, "y")], "id int, v string")
    b = frame(spark, [(2, "y"), (1, "x")], "id int, v string").repartition(3)
    assert sinks.fingerprint(a).first() == sinks.fingerprint(b).first()
    assert sinks.same_rows(a, b)
    assert not sinks.same_rows(a, frame(spark, [(1, "x")], "id int, v string"))


def test_manifest_round_trip(spark, tmp_table_dir):
    sinks.write_manifest(spark, f"{tmp_table_dir}/m", {"seed": 42, "labels": [0, 1], "source": "x"})
    assert sinks.read_manifest(spark, f"{tmp_table_dir}/m") == {"seed": 42, "labels": [0, 1], "source": "x"}


def test_export_json_counts(spark, tmp_table_dir):
    assert sinks.export_json(spark.range(7), f"{tmp_table_dir}/out") == 7


def test_overwrite_partitions_only_touches_present(spark, tmp_table_dir):
    df = spark.createDataFrame([(1, 2020), (2, 2021)], "id int, year int")
    sinks.write_parquet(df, tmp_table_dir, ["year"])
    sinks.overwrite_partitions(spark.createDataFrame([(9, 2021)], "id int, year int"), tmp_table_dir, ["year"])
    got = sorted(tuple(r) for r in spark.read.parquet(tmp_table_dir).select("id", "year").collect())
    assert got == [(1, 2020), (9, 2021)]
