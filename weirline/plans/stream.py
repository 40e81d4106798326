"""The change stream derived from the events table: partitions, offsets, files, ledger. The same in SQL.

In production offsets come with the data; here they are made from the event order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import naming
from ..session import shared_dir
from ..sources.sink import StagingSink
from ..sources.store import Store

PARTITIONS, BATCH, FILE = 4, 50, 200
#: The columns of the staged events.
EVENT = T.StructType().add("event_id", "long").add("ts", T.TimestampNTZType()).add("user_id", "long").add("event_type", "string").add("value", "double").add("props", "string")
#: Event identifiers a slice of the numbering, files a block of the file list.
SLICE, FILES_A_BLOCK = 65_536, 65_536
EPOCH, DB, REL, CLUSTER = 1_704_067_200_000, 13727, 54321, "c1024"
#: The clock of the queries: a literal, never the time of the run.
NOW = EPOCH + 10 * 86_400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def group_of(p: Column) -> Column:
    return naming.serial_group(F.lit(DB), F.lit(REL), F.concat(F.lit("events-p"), p.cast("string")))


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with partition, offset and file. Rows are numbered inside slices of the event order and shifted by the
    counts of the slices before, so the number of tasks grows with the data, not with the partitions. Both keys are
    set in every event; rows without them would have no place in the stream."""
    rows = table(spark, sf_dir, "events").withColumns({"p": _partition(), "slice": F.expr(f"event_id div {SLICE}")})
    counts = rows.groupBy("p", "slice").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("p").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    out = rows.join(counts.select("p", "slice", before.alias("before")), ["p", "slice"])
    offset = F.col("before") + F.row_number().over(W.partitionBy("p", "slice").orderBy("event_id")) - 1
    out = out.withColumn("offset", offset.cast("long")).withColumns({"seq": F.expr(f"offset div {FILE}"), "batch_start": F.expr(f"offset div {BATCH} * {BATCH}")})
    return out.drop("slice", "before").withColumns({"serial_group": group_of(F.col("p")), "serial_seq": naming.serial_seq(F.lit(EPOCH), F.col("seq"))})


def _partition() -> Column:
    return F.pmod("user_id", F.lit(PARTITIONS)).cast("long")


def _counted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files with the number of their group's files. A partition's offsets have no gaps, so its files follow from
    its number of events, counted in one scan; they are made in blocks that all tasks share."""
    n = table(spark, sf_dir, "events").groupBy(_partition().alias("p")).agg(F.count("*").alias("n")).withColumn("n_files", F.expr(f"(n - 1) div {FILE} + 1"))
    blocks = n.withColumn("block", F.explode(F.expr(f"sequence(0L, (n_files - 1) div {FILES_A_BLOCK})")))
    blocks = blocks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p", "block")
    out = blocks.withColumn("seq", F.explode(F.expr(f"sequence(block * {FILES_A_BLOCK}, least(block * {FILES_A_BLOCK} + {FILES_A_BLOCK - 1}, n_files - 1))")))
    start, end = F.col("seq") * FILE, F.least(F.col("seq") * FILE + FILE, F.col("n")) - 1
    out = out.select(group_of(F.col("p")).alias("serial_group"), "p", "seq", naming.serial_seq(F.lit(EPOCH), F.col("seq")).alias("serial_seq"), start.alias("start_offset"), end.alias("end_offset"), (end - start + 1).alias("n_rows"), "n_files")
    return out.withColumns({"epoch_ms": F.lit(EPOCH).cast("long"), "sealed_at_ms": F.lit(NOW).cast("long") - (F.lit(40) - F.col("seq")) * 1500})


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted_files(spark, sf_dir).drop("n_files")


def stage(spark: SparkSession, sf_dir: str) -> str:
    """Write the stream's files through the two-phase sink; the folder that holds a folder for each partition."""
    ends = files(spark, sf_dir).select("p", "seq", "start_offset", "end_offset")
    rows = stream(spark, sf_dir).join(ends, ["p", "seq"])
    name = naming.basename(F.lit(EPOCH), F.col("seq"), F.col("start_offset"), F.col("end_offset"), F.lit(True))
    rows = rows.withColumn("name", F.concat(F.lit("events-p"), F.col("p").cast("string"), F.lit("/"), name))
    store = Store(spark, f"{shared_dir(spark)}/weirline-staging-{uuid.uuid4().hex}")
    StagingSink(store).write(rows, EVENT.names, "name", ["offset"])
    return store.root


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each group's files the first 60 % are terminal, each seventh of them skipped; the next one failed."""
    f = _counted_files(spark, sf_dir)
    done = F.floor(F.col("n_files") * 0.6)
    status = F.when(F.col("seq") < done, F.when(F.col("seq") % 7 == 3, "SKIPPED").otherwise("FINISH")).when(F.col("seq") == done, "FAIL").otherwise("READY")
    ident = naming.identifier(F.lit(DB), F.lit(REL), F.concat(F.lit("events-p"), F.col("p").cast("string")), F.col("epoch_ms"), F.col("seq"))
    return f.withColumns({"status": status, "identifier": ident}).drop("n_files")


SQL = f"""
WITH s0 AS (SELECT *, CAST(user_id % {PARTITIONS} AS BIGINT) AS p FROM events),
s1 AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY event_id) - 1 AS "offset" FROM s0),
s AS (SELECT *, "offset" // {FILE} AS seq, ("offset" // {BATCH}) * {BATCH} AS batch_start, '{DB}:{REL}:events-p' || p AS serial_group, {EPOCH} * 1048576 + "offset" // {FILE} AS serial_seq FROM s1),
files AS (SELECT serial_group, p, seq, serial_seq, min("offset") AS start_offset, max("offset") AS end_offset, count(*) AS n_rows, CAST({EPOCH} AS BIGINT) AS epoch_ms, {NOW} - (40 - seq) * 1500 AS sealed_at_ms FROM s GROUP BY ALL),
ledger AS (SELECT *, CASE WHEN seq < done THEN (CASE WHEN seq % 7 = 3 THEN 'SKIPPED' ELSE 'FINISH' END) WHEN seq = done THEN 'FAIL' ELSE 'READY' END AS status, '{DB}:{REL}:events-p' || p || ':' || epoch_ms || ':' || seq AS identifier
           FROM (SELECT *, floor(count(*) OVER (PARTITION BY serial_group) * 0.6) AS done FROM files)),
marks AS (SELECT serial_group, max(serial_seq) AS watermark FROM ledger WHERE status IN ('FINISH', 'SKIPPED') GROUP BY 1)
"""
