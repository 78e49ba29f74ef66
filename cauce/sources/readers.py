"""Readers (S01-S07, S25): CSV/JSON sources with the reference's conventions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.functions.strings import norm_key, strip_quotes

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, sep: str = ",", infer: bool = True,
             schema: T.StructType | str | None = None) -> DataFrame:
    """Header CSV, inferred or explicit types, header names trimmed.

    Inference costs an extra pass over the input; production jobs pass a schema.
    """
    r = spark.read.option("header", True).option("sep", sep)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", infer)
    df = r.csv(path)
    return df.toDF(*[c.strip() for c in df.columns])


def read_csv_permissive(spark: SparkSession, path: str, schema: T.StructType):
    """Malformed rows kept whole in ``_corrupt_record``; returns (readable, corrupt).

    The frame is persisted first: Spark forbids queries that reference only
    the corrupt-record column of a raw CSV scan, and both outputs reuse it.
    """
    if CORRUPT not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    df = (spark.read.option("header", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).schema(schema).csv(path)).persist()
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), df.filter(F.col(CORRUPT).isNotNull())


def read_csv_null_marker(spark: SparkSession, path: str, marker: str = "__NULO__",
                         cols=None) -> DataFrame:
    """The marker means null, an empty field means '', spaces are kept.

    Spark turns every empty field into null by default, so read all columns as
    text without ``nullValue`` and then map null -> '' and marker -> null.
    """
    df = (spark.read.option("header", True).option("inferSchema", False)
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .csv(path))
    cols = cols or df.columns
    return df.select([
        (F.when(F.col(c) == marker, F.lit(None)).otherwise(F.coalesce(F.col(c), F.lit(""))).alias(c)
         if c in cols else F.col(c)) for c in df.columns])


def read_json_records(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A JSON array of objects (one document per file)."""
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


CATALOGUE_SCHEMA = T.StructType([
    T.StructField("clinicas", T.ArrayType(T.StructType([
        T.StructField("clinic_code", T.StringType()),
        T.StructField("nombre", T.StringType()),
        T.StructField("ciudad", T.StringType()),
        T.StructField("zona", T.StringType()),
        T.StructField("aliases", T.ArrayType(T.StringType())),
    ]))),
    T.StructField("especialidad_aliases", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
])


def alias_pairs(catalogue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nested catalogue -> ``(alias_norm, canonical)`` for clinics and specialties.

    Every canonical value is also its own alias.  Aliases are normalised with
    the same ``lower(trim())`` used at lookup time and de-duplicated.
    """
    cl = catalogue.select(F.explode("clinicas").alias("c")).select(
        F.col("c.clinic_code").alias("canonical"),
        F.array_union(F.coalesce(F.col("c.aliases"), F.array().cast("array<string>")),
                      F.array(F.col("c.clinic_code"), F.col("c.nombre"))).alias("aliases"))
    clinics = cl.select(F.explode("aliases").alias("a"), "canonical") \
        .select(norm_key(strip_quotes(F.col("a"))).alias("alias_norm"), "canonical") \
        .filter(F.col("alias_norm") != "").distinct()
    sp = catalogue.select(F.explode("especialidad_aliases").alias("canonical", "aliases"))
    specs = sp.select(F.explode(F.array_union(F.col("aliases"), F.array(F.col("canonical")))).alias("a"),
                      "canonical") \
        .select(norm_key(F.col("a")).alias("alias_norm"), "canonical").distinct()
    return clinics, specs


def read_alias_catalogue(spark: SparkSession, path: str):
    """Read the JSON catalogue and flatten it (see :func:`alias_pairs`)."""
    return alias_pairs(spark.read.option("multiLine", True).schema(CATALOGUE_SCHEMA).json(path))


def frame(spark: SparkSession, rows, schema) -> DataFrame:
    """Small in-memory frame with an explicit schema."""
    return spark.createDataFrame(rows, schema)
