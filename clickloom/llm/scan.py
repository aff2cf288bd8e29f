"""Running ranks, sums and neighbours over a table sorted across all tasks.

A window over a group sends the whole group to one task. Here the rows are range-partitioned by group and order, so a group
may lie over many tasks: each task scans its own stretch, and what the stretches before it add to its first group is worked out
from one row for each task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.common import staged

#: Sums of lanes are kept to 32 bits, so that they never overflow.
LANE = 0xFFFFFFFF


def _starts(columns: list[pa.Array], before: list | None) -> np.ndarray:
    """Whether each row has another group than the row before it. ``before`` is the group of the row before the first one."""
    n = len(columns[0]) if columns else 0
    new = np.zeros(n, dtype=bool)
    for k, c in enumerate(columns):
        if n > 1:
            new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
        if before is not None:
            new[0] |= c[0].as_py() != before[k]
    return new


def scan(rows: DataFrame, group: list[str], order: list[str], lanes: tuple[str, ...] = (), lag: str | None = None, name: str = "scan") -> DataFrame:
    """``rows`` with ``rank``, the number of rows of the same group before each one, and more of what is before it:
    ``<lane>_before``, the sum of a lane (a number from 0 to 2^32 - 1) modulo 2^32, and ``<lag>_before``, a number of the last such row.

    ``group`` columns are not NULL and come first in the order; no group means that all rows are one. In ``order`` NULLs are
    first; rows that tie in it must be equal. ``rows`` is a stored table, as it is read twice. No rows: none.
    """
    by = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    extra = [T.StructField("rank", T.LongType()), *[T.StructField(f"{c}_before", T.LongType()) for c in lanes]]
    extra += [T.StructField(f"{lag}_before", T.LongType())] if lag else []
    extra += [T.StructField("_part", T.IntegerType()), T.StructField("_at", T.LongType()), T.StructField("_first", T.BooleanType())]
    names = [*rows.columns, *[f.name for f in extra]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, first, before = TaskContext.get().partitionId(), 0, True, None
        ranks, sums, last = 0, np.zeros(len(lanes), dtype=np.uint64), None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = [batch.column(g) for g in group]
            new = _starts(keys, before) if group else np.zeros(n, dtype=bool)
            starts = np.flatnonzero(new)
            run_of = np.cumsum(new)
            begin = np.r_[0, starts][run_of]
            index = np.arange(n)
            rank = index - begin + np.where(run_of == 0, ranks, 0)
            columns = [pa.array(rank)]
            ends = []
            for k, c in enumerate(lanes):
                x = batch.column(c).to_numpy(zero_copy_only=False).astype(np.uint64)
                upto = np.cumsum(x, dtype=np.uint64)
                until = upto - x
                before_row = until - until[begin] + np.where(run_of == 0, sums[k], np.uint64(0))
                columns.append(pa.array((before_row & np.uint64(LANE)).astype(np.int64)))
                ends.append(before_row[-1] + x[-1])
            if lag:
                x = batch.column(lag).to_pylist()
                columns.append(pa.array([None if new[i] else (x[i - 1] if i else last) for i in range(n)], pa.int64()))
                last = x[-1]
            columns += [pa.array(np.full(n, part, dtype=np.int32)), pa.array(index + at), pa.array(first & (run_of == 0))]
            first = first and not len(starts)
            ranks, sums, at = int(rank[-1]) + 1, np.array(ends, dtype=np.uint64), at + n
            before = [k[n - 1].as_py() for k in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=names)

    schema = T.StructType([*rows.schema.fields, *extra])
    local = staged(rows.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(run, schema), name)
    # One row for each task of the sort.
    own = [F.col(g) for g in group] + [F.col("rank")] + [((F.col(f"{c}_before") + F.col(c)) % (LANE + 1)).alias(c) for c in lanes]
    own += [F.col(lag).alias("_lag")] if lag else []
    ends = local.groupBy("_part").agg(
        F.min_by(F.struct(F.lit(0), *group), "_at").alias("begin"), F.max_by(F.struct(F.lit(0), *own), "_at").alias("end")
    )
    # What earlier tasks hold of the group that a task begins with.
    carried, now = [], None
    for r in sorted(ends.collect(), key=lambda r: r["_part"]):
        begin, end = list(r["begin"])[1:], list(r["end"])[1:]
        key, found = end[: len(group)], [end[len(group)] + 1, *end[len(group) + 1 :]]
        if now and now[0] == begin:
            carried.append((r["_part"], *now[1]))
            if key == begin:
                found = [found[0] + now[1][0], *[(x + y) & LANE for x, y in zip(found[1 : 1 + len(lanes)], now[1][1:])], *found[1 + len(lanes) :]]
        now = (key, found)
    fields = ["_part int", "_rank bigint", *[f"_sum{k} bigint" for k in range(len(lanes))], *(["_last bigint"] if lag else [])]
    table = rows.sparkSession.createDataFrame(carried, ", ".join(fields))
    known = local.join(F.broadcast(table), "_part", "left")
    added = lambda c: F.when(F.col("_first"), F.coalesce(F.col(c), F.lit(0))).otherwise(F.lit(0))
    out = [(F.col("rank") + added("_rank")).alias("rank")]
    out += [((F.col(f"{c}_before") + added(f"_sum{k}")) % (LANE + 1)).alias(f"{c}_before") for k, c in enumerate(lanes)]
    if lag:
        out.append(F.when(F.col("_first") & (F.col("rank") == 0), F.col("_last")).otherwise(F.col(f"{lag}_before")).alias(f"{lag}_before"))
    return known.select(*rows.columns, *out)
