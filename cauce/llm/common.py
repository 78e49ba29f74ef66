"""Helpers shared by the corpus operators.

Every operator reads ``doc_id`` and ``text`` of a documents frame by name and
never touches its other columns, so extra columns may have any name.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cauce.session import ensure_checkpoint_dir, scratch_path, ship_package

#: The white space of the operators' word and line rules: [\x20\x09-\x0D].
WHITE = b" \t\n\r\x0b\x0c"
NULL_ID = (1 << 63) - 1


#: Rows of an Arrow batch: texts are long, and a batch lies in the JVM and in its Python worker at once.
ARROW_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result below the shared checkpoint folder and read it back.

    The files survive the loss of any executor and cut the lineage.  Column
    statistics of the files let Spark choose broadcast joins by real sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_or_last(column: str = "doc_id") -> Column:
    """The document id for ordering: a null id counts as one document after all others."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def text_hash(column: str = "text") -> Column:
    """128 bits that name a text (null and empty are one text)."""
    return F.unhex(F.md5(F.coalesce(F.col(column), F.lit(""))))


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def map_rows(df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` on dicts of Python lists; batches are handed over in parts of bounded text size."""
    struct = T._parse_datatype_string(schema)

    def run(batches):
        out = arrow_schema(struct)
        for cols in fn(_parts(batches)):
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x, type=f.type) for f, x in ((f, cols[f.name]) for f in out)],
                schema=out)

    return df.mapInArrow(run, struct)


PART_BYTES = 4 << 20


def _parts(batches) -> Iterator[dict]:
    """Cut Arrow batches so that one part holds about PART_BYTES, one row at least."""
    for b in batches:
        rows = max(1, int(b.num_rows * PART_BYTES / max(b.nbytes, 1)))
        for i in range(0, b.num_rows, rows):
            piece = b.slice(i, rows)
            yield {n: piece.column(k).to_pylist() for k, n in enumerate(piece.schema.names)}
