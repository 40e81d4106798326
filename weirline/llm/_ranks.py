"""Positions and running sums inside groups of any size, without a task that holds a group.

Rows are range-partitioned by (key, order) and sorted, so a group lies in consecutive partitions and only the first
group of a partition can have begun in an earlier one. Each task counts inside its partition; what the partitions
before add is one row a partition, worked out on the driver and broadcast (as many rows as partitions, whatever the
data).
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

from ._common import map_arrow, materialize

#: Running sums are kept modulo 2**61, so that adding two of them never overflows a long.
MASK = (1 << 61) - 1


def _counter(key: list[str], sums: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, last, first = TaskContext.get().partitionId(), 0, None, True
        k, held = 0, np.zeros(len(sums), np.uint64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            for c in key:
                column = batch.column(c)
                new[1:] |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[0] = at > 0 and tuple(batch.column(c)[0].as_py() for c in key) != last
            place = np.arange(n)
            start = np.maximum.accumulate(np.where(new, place, -1))
            going = start < 0  # the group that the batch before ended in
            count = np.where(going, place + k, place - start)
            out = []
            for j, c in enumerate(sums):
                total = np.cumsum(batch.column(c).to_numpy(zero_copy_only=False).astype(np.uint64))
                below = np.where(start > 0, total[np.maximum(start - 1, 0)], np.uint64(0))
                run_sum = np.where(going, total + held[j], total - below) & np.uint64(MASK)
                held[j] = run_sum[-1]
                out.append(pa.array(run_sum.astype(np.int64)))
            in_first = going & first
            first, k, last = bool(in_first[-1]), int(count[-1]) + 1, tuple(batch.column(c)[n - 1].as_py() for c in key)
            kept = [a for a, name in zip(batch.columns, batch.schema.names, strict=True) if name not in sums]
            names = [name for name in batch.schema.names if name not in sums]
            yield pa.RecordBatch.from_arrays([*kept, *out, pa.array(np.full(n, part, np.int64)), pa.array(place + at), pa.array(count), pa.array(in_first)], names=[*names, *sums, "__part", "__at", "__k", "__first"])
            at += n

    return run


def scan(rows: DataFrame, key: list[str], order: list[str], sums: list[str] | None = None, tag: str = "scan") -> DataFrame:
    """rows with `idx`, the place (from 0) inside the group of equal `key`, by `order`; each column of `sums` (long, 0 or more)
    becomes its running sum in the group, modulo 2**61. Key columns must not be null; nulls of order columns come first.

    The result reads a written table; release() it when nothing needs it any more.
    """
    sums = sums or []
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [c for c in rows.columns if c not in sums]
    schema = T.StructType([*(rows.schema[c] for c in names), *(T.StructField(c, T.LongType()) for c in (*sums, "__part", "__at", "__k")), T.StructField("__first", T.BooleanType())])
    table = materialize(map_arrow(rows.repartitionByRange(n, *key, *order).sortWithinPartitions(*key, *order), _counter(key, sums), schema), tag)
    # The end of each partition: how many rows its last group has there, and whether that group is its first as well.
    ends = table.groupBy("__part").agg(F.max_by(F.struct("__k", "__first", *sums), "__at").alias("last"), F.min_by(F.struct(*key), "__at").alias("head"), F.max_by(F.struct(*key), "__at").alias("tail")).collect()
    before, open_ = [], None
    for e in sorted(ends, key=lambda e: e["__part"]):
        goes_on = open_ is not None and open_[0] == e["head"]
        if goes_on:
            before.append((e["__part"], *open_[1]))
        here = (e["last"]["__k"] + 1, *(e["last"][c] for c in sums))
        if goes_on and e["last"]["__first"]:
            here = (here[0] + open_[1][0], *((a + b) & MASK for a, b in zip(here[1:], open_[1][1:], strict=True)))
        open_ = (e["tail"], here)
    added = rows.sparkSession.createDataFrame(before, T.StructType([T.StructField(c, T.LongType()) for c in ("__part", "__n", *(f"__add_{c}" for c in sums))]))
    joined = table.join(F.broadcast(added), "__part", "left")
    plus = lambda c: F.when(F.col("__first"), F.coalesce(F.col(c), F.lit(0))).otherwise(F.lit(0)).cast("long")
    out = joined.select(*names, *((F.col(c) + plus(f"__add_{c}")).bitwiseAND(F.lit(MASK)).alias(c) for c in sums), (F.col("__k") + plus("__n")).alias("idx"))
    out.weirline_path = table.weirline_path
    return out
