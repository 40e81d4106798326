"""Queries over staged files and the job ledger: watermarks, recovery, lag, clean-up, order, the gate.

A ledger has a row per announced file: serial_group, serial_seq, identifier, end_offset, status. The
watermark of a group is the highest serial_seq of its terminal jobs; it is one row a group, and groups are
as many as streams, so Spark broadcasts it only when its own estimate says that it is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import naming

TERMINAL = ("FINISH", "SKIPPED")


def file_ranges(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.min("offset").alias("start_offset"), F.max("offset").alias("end_offset"), F.count("*").alias("n_rows"))


def watermarks(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("status").isin(*TERMINAL)).groupBy("serial_group").agg(F.max("serial_seq").alias("watermark"))


def confirmed(ledger: DataFrame) -> DataFrame:
    """The end offset of each group's highest terminal job; of equal ones the higher offset."""
    done = ledger.filter(F.col("status").isin(*TERMINAL))
    return done.groupBy("serial_group").agg(F.max("serial_seq").alias("serial_seq"), F.max_by("end_offset", F.struct("serial_seq", "end_offset")).alias("end_offset"))


def pending(files: DataFrame, marks: DataFrame) -> DataFrame:
    """Files above their group's watermark; without one all of them."""
    joined = files.join(marks, "serial_group", "left")
    return joined.filter(F.coalesce(F.col("serial_seq") > F.col("watermark"), F.lit(True)))


def recovery(files: DataFrame, marks: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Per group: next offset (over all files, of any epoch, and the saved state), highest epoch and
    seq, and the files to announce again in order. state: serial_group, resume_offset, max_epoch."""
    plan = files.groupBy("serial_group").agg(F.max(F.col("end_offset") + 1).alias("next_offset"), F.max(F.struct("epoch_ms", "seq")).alias("top"))
    back = pending(files, marks).groupBy("serial_group").agg(F.sort_array(F.collect_list("serial_seq")).alias("backfill"))
    out = plan.join(back, "serial_group", "left")
    resume = F.col("next_offset")
    if state is not None:
        out = out.join(state, "serial_group", "left")
        resume = F.greatest("next_offset", F.col("resume_offset") + 1)
    return out.select("serial_group", resume.alias("next_offset"), F.col("top.epoch_ms").alias("max_epoch"), F.col("top.seq").alias("max_seq"), F.coalesce("backfill", F.array().cast("array<bigint>")).alias("backfill"))


def lag(files: DataFrame, marks: DataFrame, now_ms: int) -> DataFrame:
    """Per group with files: how many are above the watermark and how long, in whole seconds, the oldest waits."""
    waiting = pending(files, marks).groupBy("serial_group").agg(F.count("*").alias("n"), F.min("sealed_at_ms").alias("oldest"))
    age = F.greatest(F.lit(0).cast("long"), F.expr(f"({now_ms}L - oldest) div 1000"))
    return files.select("serial_group").distinct().join(waiting, "serial_group", "left").select("serial_group", F.coalesce("n", F.lit(0)).alias("lag_files"), F.coalesce(age, F.lit(0)).alias("lag_seconds"))


def deletable(files: DataFrame, marks: DataFrame, now_ms: int, retain_ms: int, retain_min: int) -> DataFrame:
    """Files that clean-up may delete: at or below a known watermark, older than retain_ms, never the newest,
    the oldest first and only so many that retain_min stay."""
    per = W.partitionBy("serial_group")
    seen = files.join(marks, "serial_group").withColumns({"total": F.count("*").over(per), "newest": F.max("serial_seq").over(per)})
    able = seen.filter((F.col("serial_seq") < F.col("newest")) & (F.col("serial_seq") <= F.col("watermark")) & (F.lit(now_ms) - F.col("epoch_ms") > retain_ms))
    ranked = able.withColumn("nth", F.row_number().over(per.orderBy("serial_seq")))
    return ranked.filter(F.col("nth") <= F.col("total") - retain_min).select(*files.columns, "nth")


def repeated_seqs(files: DataFrame) -> DataFrame:
    return files.groupBy("serial_group", "epoch_ms", "seq").agg(F.count("*").alias("n")).filter("n > 1")


def order_breaks(files: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Consecutive files that break the order: within an epoch seq must rise by one, a later epoch starts at 0.

    With start_offset and end_offset in files also what is missing at each break, null where nothing is: the numbers
    missing_from to missing_to of the file's epoch, and the offsets missing_start to missing_end.
    """
    w = W.partitionBy("serial_group").orderBy(arrival)
    seen = files.withColumns({"prev_epoch": F.lag("epoch_ms").over(w), "prev_seq": F.lag("seq").over(w), "prev_end": F.lag("end_offset").over(w)})
    same, later = F.col("epoch_ms") == F.col("prev_epoch"), F.col("epoch_ms") > F.col("prev_epoch")
    fine = (same & (F.col("seq") == F.col("prev_seq") + 1)) | (later & (F.col("seq") == 0))
    broken = seen.filter(F.col("prev_epoch").isNotNull() & ~fine)
    if "start_offset" not in files.columns:
        return broken
    skipped = F.when(same & (F.col("seq") > F.col("prev_seq") + 1), F.col("prev_seq") + 1).when(later, F.lit(0)).cast("long")
    gap = F.col("start_offset") > F.col("prev_end") + 1
    return broken.withColumns({"missing_from": skipped, "missing_to": F.when(skipped.isNotNull(), F.col("seq") - 1), "missing_start": F.when(gap, F.col("prev_end") + 1), "missing_end": F.when(gap, F.col("start_offset") - 1)})


def islands(files: DataFrame) -> DataFrame:
    """Runs of files with consecutive numbers, in whatever order they came, repeated ones counted once: serial_group,
    epoch_ms, first_seq, last_seq, start_offset, end_offset, n_files."""
    rank = F.dense_rank().over(W.partitionBy("serial_group", "epoch_ms").orderBy("seq"))
    runs = files.withColumn("run", F.col("seq") - rank).groupBy("serial_group", "epoch_ms", "run")
    return runs.agg(F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.min("start_offset").alias("start_offset"), F.max("end_offset").alias("end_offset"), F.count_distinct("seq").alias("n_files")).drop("run")


def missing_ranges(files: DataFrame) -> DataFrame:
    """What is in no file of a group, though later files are there: for each hole serial_group, epoch_ms, the numbers
    missing_from to missing_to and the offsets missing_start to missing_end (null where none is).

    A later epoch starts at 0, so what lies before its first file is missing as well; before a group's first
    file nothing is, for clean-up deletes the oldest.
    """
    w = W.partitionBy("serial_group").orderBy("epoch_ms", "first_seq")
    before = W.partitionBy("serial_group").orderBy("epoch_ms", "first_seq").rowsBetween(W.unboundedPreceding, -1)
    seen = islands(files).withColumns({"prev_epoch": F.lag("epoch_ms").over(w), "prev_last": F.lag("last_seq").over(w), "reached": F.max("end_offset").over(before)})
    start = F.when(F.col("epoch_ms") == F.col("prev_epoch"), F.col("prev_last") + 1).otherwise(F.lit(0)).cast("long")
    gap = F.col("start_offset") > F.col("reached") + 1
    holes = seen.filter(F.col("prev_epoch").isNotNull() & (F.col("first_seq") > start))
    return holes.select("serial_group", "epoch_ms", start.alias("missing_from"), (F.col("first_seq") - 1).alias("missing_to"), F.when(gap, F.col("reached") + 1).alias("missing_start"), F.when(gap, F.col("start_offset") - 1).alias("missing_end"))


def gate(jobs: DataFrame, ledger: DataFrame, arrival: str | None = None) -> DataFrame:
    """The verdict on each submitted job: replay (at or below the watermark, or known by its identifier),
    violation (its place is held by another open job), or accept.

    arrival: a column that orders the jobs of this batch, no two alike. The jobs are then judged one after the other, as if each
    accepted one were in the ledger when the next comes: of several for one place the first is accepted, a later
    one is a replay if it has the same identifier and a violation if not; an identifier that was first seen in this batch at
    another place names two places, which is a violation.
    """
    known = ledger.select("identifier").distinct().withColumn("known", F.lit(True))
    held = ledger.filter(~F.col("status").isin(*TERMINAL)).groupBy("serial_group", "serial_seq").agg(F.lit(True).alias("held"))
    out = jobs.join(watermarks(ledger), "serial_group", "left").join(known, "identifier", "left").join(held, ["serial_group", "serial_seq"], "left")
    verdict = F.when(F.coalesce(F.col("serial_seq") <= F.col("watermark"), F.lit(False)), "replay").when(F.col("known"), "replay").when(F.col("held"), "violation")
    if arrival is None:
        return out.select(*jobs.columns, verdict.otherwise("accept").alias("verdict"))
    judged = out.select(*jobs.columns, verdict.alias("__settled"))
    # Minima, not windows: they shrink before the shuffle, so a job that is submitted very often is no hot group.
    place = F.struct("serial_group", "serial_seq")
    home = judged.filter(F.col("__settled").isNull()).groupBy("identifier").agg(F.min_by(place, F.struct(arrival, place)).alias("__home"))
    judged = judged.join(home, "identifier", "left")
    fresh = F.col("__settled").isNull() & F.col("__home").eqNullSafe(place)
    first = judged.filter(fresh).groupBy("serial_group", "serial_seq").agg(F.min(F.struct(F.col(arrival).alias("at"), F.col("identifier").alias("by"))).alias("__first"))
    judged = judged.join(first, ["serial_group", "serial_seq"], "left")
    late = F.when(F.col("__first.by") == F.col("identifier"), F.when(F.col("__first.at") == F.col(arrival), "accept").otherwise("replay")).otherwise("violation")
    return judged.select(*jobs.columns, F.coalesce("__settled", F.when(fresh, late).otherwise("violation")).alias("verdict"))


def job_row(files: DataFrame, db: Column, rel: Column, writer: Column) -> DataFrame:
    """Ledger rows of staged files, ready to load."""
    return files.withColumns({"identifier": naming.identifier(db, rel, writer, F.col("epoch_ms"), F.col("seq")), "status": F.lit("READY"), "attempts": F.lit(0)})
