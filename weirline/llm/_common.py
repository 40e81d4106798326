"""Helpers shared by the training-data operators: written tables, skew-safe lookups."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package

#: The ASCII letters that case folding touches.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; a local one only where unset and Spark is local itself."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not current.isDefined():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="weirline-"))
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
    return current.get().rstrip("/")


def materialize(df: DataFrame, tag: str, by: str | None = None, **options: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: the lineage ends there,
    so a lost executor costs no more than a re-read. The table's place is in `.weirline_path`; by: a column
    whose values have a folder each."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/weirline-{tag}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path, partitionBy=by)
    out = spark.read.schema(df.schema).parquet(path).select(*df.columns) if by else spark.read.schema(df.schema).parquet(path)
    out.weirline_path = path
    return out


def stable(df: DataFrame) -> DataFrame:
    """df, written first if its rows come out of a shuffle, whose order a retried task may change: for operators
    that number rows by their place."""
    return materialize(df, "stable") if "Exchange" in df._jdf.queryExecution().executedPlan().toString() else df


def release(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for table in tables:
        _delete(table, table.weirline_path)


def _delete(table: DataFrame, place: str) -> None:
    context = table.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def release_part(table: DataFrame, by: str, *values: str) -> None:
    """Delete the rows with these values of a table written `by` the column."""
    for value in values:
        _delete(table, f"{table.weirline_path}/{by}={value}")


def lookup(rows: DataFrame, index: DataFrame, key: str, weight: str, total: int, heavy: int = 512) -> DataFrame:
    """Inner join of rows with an index that is unique by key; weight says how many rows a key has.

    Keys with more than total/heavy rows are fewer than `heavy`, whatever the data: those are
    broadcast, so a key with a third of all rows is never dealt to one task. The rest is shuffled.
    """
    limit = max(total // heavy, 100)
    hot = index.filter(F.col(weight) > limit)
    cold = index.filter(F.col(weight) <= limit)
    apart = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(apart.join(cold, key))


def id_text(name: str) -> Column:
    """An id as text; null counts as empty."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """df.mapInArrow with this package importable in the workers, which live on and give back what Arrow's pool holds for them."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
