"""Driver tables mapped onto the reference's entities.

The appointments fact of the reference becomes an order fact:

=====================  ===========================
reference              here
=====================  ===========================
appointment            order (``o_orderkey``)
patient                customer (``o_custkey``)
clinic / branch        customer nation (``n_name``)
specialty / category   ``o_orderpriority``
amount charged         ``o_totalprice``
scheduled_at           ``o_orderdate``
status 'cancelada'     ``o_orderstatus = 'P'``
status 'no_show'       ``o_orderstatus = 'F'``
=====================  ===========================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.functions.dates import month_key
from cauce.operators.relational import sized_broadcast
from cauce.sources.tables import table

# Fixed values of the mapping.
EXCLUDED_STATUS = "P"
FLAG_STATUS = "F"
NATION_ROWS_MAX = 1000


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return table(spark, sf, name)


def nations(spark: SparkSession, sf: str) -> DataFrame:
    """Bounded dimension (25 rows): broadcast after the size check."""
    return sized_broadcast(t(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey"),
                           NATION_ROWS_MAX, cache_key=(sf, "nation"))


def order_fact(spark: SparkSession, sf: str) -> DataFrame:
    """orders ⋈ customer ⋈ nation with the fact's business names.

    orders ⋈ customer is a shuffle (or AQE broadcast) join on the customer
    key; nation is a checked broadcast.
    """
    o = t(spark, sf, "orders")
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = nations(spark, sf)
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
             .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
             .select(F.col("o_orderkey").alias("order_id"),
                     F.col("o_custkey").alias("customer_id"),
                     F.col("n_name").alias("branch"),
                     F.col("o_orderpriority").alias("category"),
                     F.col("c_mktsegment").alias("segment"),
                     F.col("o_orderstatus").alias("status"),
                     F.col("o_totalprice").alias("amount"),
                     F.col("o_orderdate").alias("ts"),
                     month_key("o_orderdate").alias("month")))


# The same fact as DuckDB SQL (a CTE prefix for oracles).
ORDER_FACT_SQL = """
fact AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, n.n_name AS branch,
         o.o_orderpriority AS category, c.c_mktsegment AS segment, o.o_orderstatus AS status,
         o.o_totalprice AS amount, o.o_orderdate AS ts, strftime(o.o_orderdate, '%Y-%m') AS month
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""
