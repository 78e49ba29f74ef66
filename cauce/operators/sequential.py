"""Order-dependent operators over a whole table without a single-partition window.

``Window.orderBy(x)`` with no partition moves every row to one task.  Here the
rows are range-partitioned on the order, each partition is scanned once in
order (``mapInArrow`` keeps running state across its Arrow batches), and the
cross-partition part is a table with one row per partition, which is tiny and
broadcast.  The range shuffle splits a hot key across partitions, so a key
holding a third of the rows does not end up in one task either.  The locally
scanned result is read twice, so it is checkpointed (eagerly) into the shared
folder named by ``spark.checkpoint.dir``.

The scans work on Arrow columns and only append to them: values and all other
columns keep their types and every bit (a pandas round trip would turn
nullable longs into doubles).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _same_key(a, b) -> bool:
    return all(x == y or x is None and y is None for x, y in zip(a, b))


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _join(first: pa.Array, rest: pa.Array) -> pa.Array:
    return pa.concat_arrays([first.cast(rest.type), rest])


def _same_as_previous(batch: pa.RecordBatch, cols, carry) -> np.ndarray:
    """Whether each row's ``cols`` equal the previous row's; ``carry`` maps them to the row before the batch (or is None)."""
    n = batch.num_rows
    same = np.ones(n, bool)
    for c in cols:
        now = _column(batch, c)
        before = _join(carry[c] if carry is not None else now.slice(0, 1), now.slice(0, n - 1))
        equal = pc.or_(pc.fill_null(pc.equal(now, before), False), pc.and_(pc.is_null(now), pc.is_null(before)))
        same &= equal.to_numpy(zero_copy_only=False)
    same[0] &= carry is not None
    return same


def _appended(batch: pa.RecordBatch, out: pa.Schema, *columns) -> pa.RecordBatch:
    n = batch.num_columns
    arrays = [pa.array(c, type=out.field(n + i).type) if isinstance(c, np.ndarray) else c.cast(out.field(n + i).type)
              for i, c in enumerate(columns)]
    return pa.RecordBatch.from_arrays([*[a.cast(f.type) for a, f in zip(batch.columns, out)], *arrays], schema=out)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _ordered(df: DataFrame, order_cols, partitions: int | None):
    cols = [F.col(c) for c in order_cols]
    r = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return r.sortWithinPartitions(*cols)


def running_totals(df: DataFrame, order_cols, sum_cols, prefix: str = "cum_",
                   partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in the total order ``order_cols``.

    ``order_cols`` must be a total order (add a unique key) for a defined result.
    """
    order_cols, sum_cols = list(order_cols), list(sum_cols)
    r = _ordered(df, order_cols, partitions)
    out_schema = T.StructType(r.schema.fields + [T.StructField("_pid", T.IntegerType())] +
                              [T.StructField(prefix + c, T.DoubleType()) for c in sum_cols])

    def local(it):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        out = _arrow(out_schema)
        acc = np.zeros(len(sum_cols))
        for batch in it:
            if not batch.num_rows:
                continue
            vals = [pc.fill_null(_column(batch, c).cast(pa.float64(), safe=False), 0.0).to_numpy() for c in sum_cols]
            sums = [np.cumsum(v) + a for v, a in zip(vals, acc)]
            acc = [x[-1] for x in sums]
            yield _appended(batch, out, np.full(batch.num_rows, pid, np.int32), *sums)

    # read twice (partition totals, then the final join): materialise once in the
    # shared checkpoint folder, which also cuts the lineage (survives executor loss)
    loc = r.mapInArrow(local, out_schema).checkpoint(eager=True)
    tot = loc.groupBy("_pid").agg(*[F.sum(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias("_t_" + c)
                                    for c in sum_cols])
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("_pid", *[F.coalesce(F.sum("_t_" + c).over(w), F.lit(0.0)).alias("_o_" + c)
                                for c in sum_cols])
    # one row per partition: bounded by the partition count
    res = loc.join(F.broadcast(offs), "_pid")
    for c in sum_cols:
        res = res.withColumn(prefix + c, F.col(prefix + c) + F.col("_o_" + c))
    return res.drop("_pid", *["_o_" + c for c in sum_cols])


def ordered_lag(df: DataFrame, part_cols, order_cols, value: str, name: str | None = None,
                partitions: int | None = None) -> DataFrame:
    """Previous ``value`` within ``part_cols`` in the order ``order_cols`` (LAG 1).

    Exact for a total order.  Each partition computes lags locally; the first
    row of a partition takes the last row of the previous partition when it
    belongs to the same ``part_cols`` group.
    """
    part_cols, order_cols = list(part_cols), list(order_cols)
    name = name or f"{value}_prev"
    keys = part_cols + order_cols
    r = _ordered(df, keys, partitions)
    vtype = df.schema[value].dataType
    out_schema = T.StructType(r.schema.fields + [T.StructField("_pid", T.IntegerType()),
                                                 T.StructField("_first", T.BooleanType()),
                                                 T.StructField("_last", T.BooleanType()),
                                                 T.StructField(name, vtype)])

    def local(it):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        out = _arrow(out_schema)
        carry, pending = None, None      # the last row so far; the batch held back until its successor shows
        for batch in it:
            n = batch.num_rows
            if not n:
                continue
            now = _column(batch, value)
            same = _same_as_previous(batch, part_cols, carry)
            before = _join(carry[value] if carry is not None else now.slice(0, 1), now.slice(0, n - 1))
            lag = pc.if_else(pa.array(same), before, pa.scalar(None, before.type))
            first = np.zeros(n, bool)
            first[0] = carry is None
            carry = {c: _column(batch, c).slice(n - 1, 1) for c in {*part_cols, value}}
            if pending is not None:
                yield _appended(pending[0], out, np.full(pending[0].num_rows, pid, np.int32), pending[1],
                                np.zeros(pending[0].num_rows, bool), pending[2])
            pending = batch, first, lag
        if pending is not None:
            last = np.zeros(pending[0].num_rows, bool)
            last[-1] = True
            yield _appended(pending[0], out, np.full(len(last), pid, np.int32), pending[1], last, pending[2])

    loc = r.mapInArrow(local, out_schema).checkpoint(eager=True)
    lasts = loc.filter("_last").select(F.col("_pid").alias("_src"),
                                       *[F.col(c).alias("_pk_" + c) for c in part_cols],
                                       F.col(value).alias("_pv"))
    # previous non-empty partition: the greatest source pid below each pid
    pids = loc.select("_pid").distinct()
    prev = pids.join(F.broadcast(lasts.select("_src")), F.col("_src") < F.col("_pid")) \
        .groupBy("_pid").agg(F.max("_src").alias("_src"))
    lasts = F.broadcast(prev.join(F.broadcast(lasts), "_src").drop("_src"))
    res = loc.join(lasts, "_pid", "left")
    same = F.lit(True)
    for c in part_cols:
        same = same & F.col(c).eqNullSafe(F.col("_pk_" + c))
    # rows after an empty partition see no previous row: a group that spans an
    # empty partition is impossible because range partitions are contiguous
    res = res.withColumn(name, F.when(F.col("_first") & same, F.col("_pv")).otherwise(F.col(name)))
    return res.drop("_pid", "_first", "_last", "_pv", *["_pk_" + c for c in part_cols])


def forward_fill(df: DataFrame, part_cols, order_cols, value: str, name: str | None = None,
                 partitions: int | None = None) -> DataFrame:
    """Last non-null ``value`` so far within ``part_cols`` in the order ``order_cols``.

    Each range partition fills locally.  A group that starts in an earlier
    partition receives its carried value from a summary with one row per
    partition (first key, last key, last filled value), resolved in partition
    order; that summary is bounded by the partition count.
    """
    part_cols, order_cols = list(part_cols), list(order_cols)
    name = name or f"{value}_filled"
    r = _ordered(df, part_cols + order_cols, partitions)
    vtype = df.schema[value].dataType
    out_schema = T.StructType(r.schema.fields + [T.StructField("_pid", T.IntegerType()),
                                                 T.StructField(name, vtype)])

    def local(it):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        out = _arrow(out_schema)
        carry = None                       # key columns and filled value of the last row so far
        for batch in it:
            n = batch.num_rows
            if not n:
                continue
            now = _column(batch, value)
            same = _same_as_previous(batch, part_cols, carry)
            # place 0 stands for the carried value, place i + 1 for row i
            places = np.arange(1, n + 1)
            start = np.maximum.accumulate(np.where(same, 0, places))
            given = np.maximum.accumulate(np.where(now.is_valid().to_numpy(zero_copy_only=False), places, 0))
            ok = (given >= start) & ((given > 0) | ((start == 0) & (carry is not None)))
            pool = _join(carry[name] if carry is not None else pa.nulls(1, now.type), now)
            filled = pool.take(pa.array(given, mask=~ok))
            carry = {c: _column(batch, c).slice(n - 1, 1) for c in part_cols} | {name: filled.slice(n - 1, 1)}
            yield _appended(batch, out, np.full(n, pid, np.int32), filled)

    loc = r.mapInArrow(local, out_schema).checkpoint(eager=True)
    key = F.struct(*[F.col(c) for c in part_cols])
    # position inside a range partition is the full (key, order) sort order
    order = F.struct(*[F.col(c) for c in part_cols + order_cols])
    summary = loc.groupBy("_pid").agg(F.min_by(key, order).alias("first_key"), F.max_by(key, order).alias("last_key"),
                                      F.max_by(F.col(name), order).alias("last_val")).collect()
    # resolve carries in partition order (one row per partition: bounded)
    rows, prev = [], None        # prev = (last_key, value carried out of the previous partition)
    for s in sorted(summary, key=lambda x: x["_pid"]):
        fk, lk = tuple(s["first_key"]), tuple(s["last_key"])
        carry_in = prev[1] if prev is not None and _same_key(prev[0], fk) else None
        if carry_in is not None:
            rows.append((s["_pid"], carry_in))
        out_val = s["last_val"]
        if out_val is None and _same_key(fk, lk):
            out_val = carry_in                      # whole partition is one key with no value of its own
        prev = (lk, out_val)
    if not rows:
        return loc.drop("_pid")
    carries = df.sparkSession.createDataFrame(rows, T.StructType([T.StructField("_pid", T.IntegerType()),
                                                                  T.StructField("_carry", vtype)]))
    firsts = loc.groupBy("_pid").agg(F.min_by(key, order).alias("_fk"))
    res = loc.join(F.broadcast(carries.join(firsts, "_pid")), "_pid", "left")
    same = F.lit(True)
    for c in part_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_fk.{c}"))
    res = res.withColumn(name, F.when(F.col(name).isNull() & same & F.col("_carry").isNotNull(), F.col("_carry"))
                         .otherwise(F.col(name)))
    return res.drop("_pid", "_carry", "_fk")
