"""The log of a job's executions, folded to its state: READY, RETRY, FINISH, FAIL or SKIPPED, with what comes next.

A job's events, in order, are `ok`, `transient` and `permanent` (how an execution ended) and `retry` and `skip` (what an
operator asked for). A transient failure is tried again after a pause that doubles, until there were more than retry_max of
them (null: without end); a permanent one is not. A `retry` begins a new round with all its attempts; a `skip` ends a job
that failed. What comes after the end of a job, or after the failure that ended a round, changes nothing.

The fold is done by positions: in a round the first of three events decides (the first `ok`, the first `permanent`, the
failure of number retry_max + 1), and the first round that ended well, or was skipped, decides the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Longest pause in seconds; the pauses double from one second on (fixed values, as config.backoff).
LONGEST, DOUBLINGS = 30, 5


def pause(attempt: Column) -> Column:
    """Seconds after the failed attempt of this number (from 1)."""
    return F.least(F.lit(LONGEST), F.pow(F.lit(2), F.least(attempt, F.lit(DOUBLINGS + 1)) - 1)).cast("long")


def pauses(n: Column) -> Column:
    """The sum of the first n pauses."""
    doubled = F.pow(F.lit(2), F.least(n, F.lit(DOUBLINGS))).cast("long") - 1
    return doubled + LONGEST * F.greatest(n - DOUBLINGS, F.lit(0))


def job_states(log: DataFrame) -> DataFrame:
    """identifier, status, attempts (of the last round), reason (permanent or retries, of a FAIL), next_at_ms (when a RETRY
    is due) and fail_at_ms (when it will have failed for good, if it goes on failing; null: never).

    log: identifier, retry_max (null: no limit), at_ms, event; a job's events are in the order of at_ms, then of event's text.
    A job has as many events as executions, so they fit a window of their own.
    """
    order = W.partitionBy("identifier").orderBy("at_ms", "event")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    seen = log.withColumns({"pos": F.row_number().over(order), "round": F.count_if(F.col("event") == "retry").over(so_far)})
    is_ = lambda name: F.col("event") == name
    nth = F.count_if(is_("transient")).over(W.partitionBy("identifier", "round").orderBy("pos"))
    seen = seen.withColumn("nth", nth)
    # A round's end: the position of what decides it, and how.
    decides = F.when(is_("ok"), "FINISH").when(is_("permanent"), "permanent").when(is_("transient") & (F.col("nth") > F.col("retry_max")), "retries")
    ends = F.min(F.when(decides.isNotNull(), F.struct("pos", decides.alias("how")))).over(W.partitionBy("identifier", "round"))
    seen = seen.withColumn("end", ends)
    live = F.col("end").isNull() | (F.col("pos") <= F.col("end.pos"))
    tried = is_("transient") | is_("permanent") | is_("ok")
    rounds = seen.groupBy("identifier", "round").agg(
        F.first("end").alias("end"),
        F.max("retry_max").alias("retry_max"),
        F.count_if(live & tried).alias("attempts"),
        F.max(F.when(live & tried, F.col("at_ms"))).alias("last_ms"),
        F.bool_or(is_("skip") & F.col("end").isNotNull() & (F.col("pos") > F.col("end.pos")) & (F.col("end.how") != "FINISH")).alias("skipped"),
    )
    how = F.col("end.how")
    status = F.when(how == "FINISH", "FINISH").when(F.col("skipped"), "SKIPPED").when(how.isNotNull(), "FAIL").when(F.col("attempts") > 0, "RETRY").otherwise("READY")
    rounds = rounds.withColumns({"status": status, "reason": F.when(status == "FAIL", how)})
    # The first round that settled the job, else the last one.
    settled = F.col("status").isin("FINISH", "SKIPPED")
    pick = F.coalesce(F.min(F.when(settled, F.struct("round", "status", "reason", "attempts", "last_ms", "retry_max"))), F.max(F.struct("round", "status", "reason", "attempts", "last_ms", "retry_max")))
    job = rounds.groupBy("identifier").agg(pick.alias("j")).select("identifier", "j.*")
    waits = F.col("status") == "RETRY"
    left = pauses(F.col("retry_max").cast("long")) - pauses(F.col("attempts") - 1)
    return job.select(
        "identifier",
        "status",
        F.col("attempts").cast("long").alias("attempts"),
        "reason",
        F.when(waits, F.col("last_ms") + 1000 * pause(F.col("attempts"))).alias("next_at_ms"),
        F.when(waits & F.col("retry_max").isNotNull(), F.col("last_ms") + 1000 * left).alias("fail_at_ms"),
    )
