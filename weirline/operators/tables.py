"""Keyed last value, upsert and append: the data operators. Rows carry their order in a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_wins(rows: DataFrame, keys: list[str], order: Column, per: list[str] | None = None) -> DataFrame:
    """Of the rows with equal keys (NULL equals NULL) in each `per` group the last in order, whole.

    max_by aggregates partially before the shuffle, so a hot key shrinks where it is read.
    """
    by = [*(per or []), *keys]
    rest = [c for c in rows.columns if c not in by]
    if not rest:
        return rows.dropDuplicates(by)
    last = F.max_by(F.struct(*rest), order).alias("__last")
    return rows.groupBy(*by).agg(last).select(*by, "__last.*").select(*rows.columns)


def upsert(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """target with the rows of delta (one per key) in place of those with their keys; null keys match."""
    t, d = target.alias("t"), delta.select(*keys).alias("d")
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys]
    return t.join(d, same, "left_anti").unionByName(delta)


def append(target: DataFrame, delta: DataFrame) -> DataFrame:
    """target and delta, duplicates kept."""
    return target.unionByName(delta)


def serial_load(rows: DataFrame, keys: list[str], serial: str, order: str, failed: DataFrame | None = None, group: str = "serial_group") -> DataFrame:
    """What loading files one by one in serial order leaves: the last row per key among the files below
    their group's first failed one. failed: (group, serial) of failed files."""
    if failed is not None:
        first = failed.groupBy(group).agg(F.min(serial).alias("__stop"))
        # One row a group: Spark broadcasts it only where its own estimate says that it is small.
        rows = rows.join(first, group, "left").filter(F.coalesce(F.col(serial) < F.col("__stop"), F.lit(True))).drop("__stop")
    return last_wins(rows, keys, F.struct(serial, order))
