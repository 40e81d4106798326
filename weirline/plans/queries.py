"""The registered queries of the engine and the DuckDB SQL of each that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import csv_dialect as csv
from ..functions import naming, secrets
from ..operators import attempts, folds, ledger, tables
from ..sources.reader import read_staged
from . import stream as st

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, stream_sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql or stream_sql:
            ORACLE[name] = sql or st.SQL + stream_sql
        return f

    return add


# ---- Keyed last value, upsert, append, serial load


@query("agg_1_dedup_last_wins", stream_sql='SELECT p, seq, user_id, event_id, "offset", event_type FROM (SELECT *, row_number() OVER (PARTITION BY p, seq, user_id ORDER BY "offset" DESC) AS k FROM s) WHERE k = 1')
def agg_1(spark, d):
    rows = st.stream(spark, d).select("p", "seq", "user_id", "event_id", "offset", "event_type")
    return tables.last_wins(rows, ["user_id"], F.col("offset"), ["p", "seq"])


_LINE = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS k FROM lineitem) WHERE k = 1"


@query("agg_1_dedup_composite", sql=_LINE)
def agg_1_composite(spark, d):
    order = F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    rows = st.table(spark, d, "lineitem").withColumn("__order", order)
    return tables.last_wins(rows, ["l_orderkey", "l_linenumber"], F.col("__order")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query("snk_9_upsert_merge", sql="""WITH delta AS (SELECT o_custkey, max_by(o_totalprice, o_orderkey) AS v FROM orders GROUP BY 1)
SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM delta)
UNION ALL SELECT o_custkey, 'from orders', CAST(0 AS INTEGER), v FROM delta""")
def snk_9(spark, d):
    target = st.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    orders = st.table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    last = tables.last_wins(orders, ["c_custkey"], F.col("o_orderkey"))
    delta = last.select("c_custkey", F.lit("from orders").alias("c_name"), F.lit(0).alias("c_nationkey"), F.col("o_totalprice").alias("c_acctbal"))
    return tables.upsert(target, delta, ["c_custkey"])


@query("snk_10_insert_only", sql="SELECT conv_id, turn, role FROM conversations UNION ALL SELECT conv_id, turn, role FROM conversations WHERE turn = 0")
def snk_10(spark, d):
    rows = st.table(spark, d, "conversations").select("conv_id", "turn", "role")
    return tables.append(rows, rows.filter("turn = 0"))


@query("jon_1_anti_delta", sql="SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def jon_1(spark, d):
    docs, delta = st.table(spark, d, "documents").select("doc_id", "source"), st.table(spark, d, "labels").select("doc_id")
    return docs.alias("t").join(delta.alias("d"), F.col("t.doc_id").eqNullSafe(F.col("d.doc_id")), "left_anti")


@query("str_10_serial_load", stream_sql="SELECT user_id, event_id, seq FROM (SELECT s.*, row_number() OVER (PARTITION BY user_id ORDER BY serial_seq DESC, \"offset\" DESC) AS k FROM s JOIN (SELECT serial_group, min(serial_seq) AS stop FROM ledger WHERE status = 'FAIL' GROUP BY 1) USING (serial_group) WHERE serial_seq < stop) WHERE k = 1")
def str_10(spark, d):
    rows = st.stream(spark, d).select("serial_group", "serial_seq", "offset", "user_id", "event_id", "seq")
    failed = st.ledger(spark, d).filter("status = 'FAIL'").select("serial_group", "serial_seq")
    return tables.serial_load(rows, ["user_id"], "serial_seq", "offset", failed).select("user_id", "event_id", "seq")


@query("set_1_concat_batches", stream_sql="SELECT p, batch_start, count(*) AS n FROM s GROUP BY 1, 2")
def set_1(spark, d):
    rows = st.stream(spark, d).select("p", "batch_start", "offset")
    parts = [rows.filter(F.col("batch_start") % (2 * st.BATCH) == k * st.BATCH) for k in (0, 1)]
    return parts[0].unionByName(parts[1]).groupBy("p", "batch_start").agg(F.count("*").alias("n"))


@query("prj_1_row_subset", stream_sql='SELECT p, seq, batch_start, "offset" FROM (SELECT *, row_number() OVER (PARTITION BY p, seq, user_id ORDER BY "offset" DESC) AS k FROM s) WHERE k = 1')
def prj_1(spark, d):
    rows = st.stream(spark, d).select("p", "seq", "batch_start", "offset", "user_id")
    return tables.last_wins(rows, ["user_id"], F.col("offset"), ["p", "seq"]).select("p", "seq", "batch_start", "offset").orderBy("p", "seq", "offset")


# ---- Files and their aggregates


@query("agg_2_file_ranges", stream_sql="SELECT serial_group, seq, start_offset, end_offset, n_rows FROM files")
def agg_2(spark, d):
    return ledger.file_ranges(st.stream(spark, d), ["serial_group", "seq"])


@query("agg_3_resume", stream_sql="SELECT serial_group, greatest(max(end_offset) + 1, 1001) AS next_offset FROM files GROUP BY 1")
def agg_3(spark, d):
    return st.files(spark, d).groupBy("serial_group").agg(F.greatest(F.max("end_offset") + 1, F.lit(1001)).cast("long").alias("next_offset"))


@query("agg_4_max_staged", stream_sql="SELECT serial_group, epoch_ms, seq FROM (SELECT *, row_number() OVER (PARTITION BY serial_group ORDER BY epoch_ms DESC, seq DESC) AS k FROM files) WHERE k = 1")
def agg_4(spark, d):
    return st.files(spark, d).groupBy("serial_group").agg(F.max(F.struct("epoch_ms", "seq")).alias("top")).select("serial_group", "top.*")


@query("agg_5_lag", stream_sql=f"SELECT f.serial_group, count(*) FILTER (serial_seq > watermark OR watermark IS NULL) AS lag_files, coalesce(greatest(0, ({st.NOW} - min(sealed_at_ms) FILTER (serial_seq > watermark OR watermark IS NULL)) // 1000), 0) AS lag_seconds FROM files f LEFT JOIN marks USING (serial_group) GROUP BY 1")
def agg_5(spark, d):
    return ledger.lag(st.files(spark, d), ledger.watermarks(st.ledger(spark, d)), st.NOW)


@query("agg_6_unstaged_age", stream_sql=f"SELECT serial_group, max({st.NOW} - sealed_at_ms) AS age_ms FROM ledger WHERE status IN ('READY', 'FAIL') GROUP BY 1")
def agg_6(spark, d):
    open_ = [st.ledger(spark, d).filter(F.col("status") == s) for s in ("READY", "FAIL")]
    return open_[0].unionByName(open_[1]).groupBy("serial_group").agg(F.max(F.lit(st.NOW).cast("long") - F.col("sealed_at_ms")).alias("age_ms"))


_EVENT_CELLS = ["event_id", "user_id", "event_type", "props"]
_EVENT_LINE = """event_id || ',' || user_id || ',"' || replace(replace(event_type, chr(0), ''), '"', '""') || '","' || replace(replace(props, chr(0), ''), '"', '""') || '"'"""


@query("agg_7_avg_row_bytes", stream_sql=f"SELECT p, seq, (sum(strlen({_EVENT_LINE}) + 1) + 42) / count(*) AS avg_bytes FROM s GROUP BY 1, 2")
def agg_7(spark, d):
    rows = st.stream(spark, d)
    schema = rows.select(*_EVENT_CELLS).schema
    head = len(csv.header_text(_EVENT_CELLS)) + 1
    line = F.octet_length(csv.row_text(schema)) + 1
    return rows.groupBy("p", "seq").agg(((F.sum(line) + head) / F.count("*")).alias("avg_bytes"))


@query("agg_8_confirmed", stream_sql="SELECT serial_group, max(serial_seq) AS serial_seq, max_by(end_offset, serial_seq) AS end_offset FROM ledger WHERE status IN ('FINISH', 'SKIPPED') GROUP BY 1")
def agg_8(spark, d):
    return ledger.confirmed(st.ledger(spark, d))


@query("agg_9_watermark", stream_sql="SELECT serial_group, watermark FROM marks")
def agg_9(spark, d):
    return ledger.watermarks(st.ledger(spark, d))


@query("src_8_group_watermark", stream_sql="SELECT g.serial_group, watermark FROM (SELECT DISTINCT serial_group FROM files UNION ALL SELECT '1:2:none') g LEFT JOIN marks USING (serial_group)")
def src_8(spark, d):
    groups = st.files(spark, d).select("serial_group").distinct().unionByName(spark.range(1).select(F.lit("1:2:none").alias("serial_group")))
    return groups.join(ledger.watermarks(st.ledger(spark, d)), "serial_group", "left")


@query("flt_1_backfill", stream_sql="SELECT serial_group, serial_seq FROM files LEFT JOIN marks USING (serial_group) WHERE watermark IS NULL OR serial_seq > watermark")
def flt_1(spark, d):
    return ledger.pending(st.files(spark, d), ledger.watermarks(st.ledger(spark, d))).select("serial_group", "serial_seq")


@query("flt_3_lag_files", stream_sql="SELECT serial_group, seq, sealed_at_ms FROM files JOIN marks USING (serial_group) WHERE serial_seq > watermark")
def flt_3(spark, d):
    return ledger.pending(st.files(spark, d), ledger.watermarks(st.ledger(spark, d))).select("serial_group", "seq", "sealed_at_ms")


@query("flt_4_offset_range", sql="SELECT event_id, user_id AS start_offset, event_id - 300 AS end_offset, user_id >= 0 AND event_id - 300 >= user_id AS valid FROM events")
def flt_4(spark, d):
    r = st.table(spark, d, "events").select("event_id", F.col("user_id").alias("start_offset"), (F.col("event_id") - 300).alias("end_offset"))
    return r.withColumn("valid", (F.col("start_offset") >= 0) & (F.col("end_offset") >= F.col("start_offset")))


_RANGES = """, r AS (SELECT serial_group, seq AS arrival, start_offset - (CASE WHEN seq % 5 = 4 THEN 250 ELSE 0 END) AS start_offset, end_offset - (CASE WHEN seq % 5 = 4 THEN 250 ELSE 0 END) AS end_offset FROM files)
, f AS (SELECT *, seq_no FROM (SELECT *, row_number() OVER (PARTITION BY serial_group ORDER BY arrival) AS seq_no FROM r))"""


@query("flt_5_rewind", stream_sql=None, sql=st.SQL.replace("WITH s0", "WITH RECURSIVE s0", 1) + _RANGES + """
, w AS (SELECT serial_group, arrival, start_offset, end_offset, seq_no, start_offset >= 0 AND end_offset >= start_offset AS accepted, CASE WHEN start_offset >= 0 AND end_offset >= start_offset THEN end_offset ELSE -1 END AS top FROM f WHERE seq_no = 1
  UNION ALL SELECT f.serial_group, f.arrival, f.start_offset, f.end_offset, f.seq_no, f.start_offset >= 0 AND f.end_offset >= f.start_offset AND f.start_offset > w.top, CASE WHEN f.start_offset >= 0 AND f.end_offset >= f.start_offset AND f.start_offset > w.top THEN f.end_offset ELSE w.top END FROM f JOIN w ON f.serial_group = w.serial_group AND f.seq_no = w.seq_no + 1)
SELECT serial_group, arrival, start_offset, end_offset, accepted FROM w""")
def flt_5(spark, d):
    back = F.when(F.col("seq") % 5 == 4, 250).otherwise(0)
    ranges = st.files(spark, d).select("serial_group", F.col("seq").alias("arrival"), (F.col("start_offset") - back).alias("start_offset"), (F.col("end_offset") - back).alias("end_offset"))
    return folds.rewind_check(ranges)


@query("str_12_recovery_plan", stream_sql="SELECT f.serial_group, max(end_offset) + 1 AS next_offset, max(epoch_ms) AS max_epoch, max_by(seq, serial_seq) AS max_seq, coalesce(list(serial_seq ORDER BY serial_seq) FILTER (watermark IS NULL OR serial_seq > watermark), []) AS backfill FROM files f LEFT JOIN marks USING (serial_group) GROUP BY 1")
def str_12(spark, d):
    return ledger.recovery(st.files(spark, d), ledger.watermarks(st.ledger(spark, d)))


_GC = f"""SELECT {{}} FROM (SELECT *, row_number() OVER (PARTITION BY serial_group ORDER BY serial_seq) AS nth FROM
(SELECT f.*, watermark, count(*) OVER (PARTITION BY serial_group) AS total, max(serial_seq) OVER (PARTITION BY serial_group) AS newest FROM files f JOIN marks USING (serial_group))
WHERE serial_seq < newest AND serial_seq <= watermark AND {st.NOW} - epoch_ms > 7 * 86400000) WHERE nth <= total - 9"""


@query("str_14_gc", stream_sql=_GC.format("serial_group, serial_seq, nth"))
def str_14(spark, d):
    return ledger.deletable(st.files(spark, d), ledger.watermarks(st.ledger(spark, d)), st.NOW, 7 * 86_400_000, 9).select("serial_group", "serial_seq", "nth")


@query("flt_2_gc_candidates", stream_sql=f"SELECT serial_group, serial_seq FROM files JOIN marks USING (serial_group) WHERE serial_seq <= watermark AND {st.NOW} - epoch_ms > 7 * 86400000")
def flt_2(spark, d):
    return ledger.deletable(st.files(spark, d), ledger.watermarks(st.ledger(spark, d)), st.NOW, 7 * 86_400_000, 0).select("serial_group", "serial_seq")


@query("lim_1_gc_budget", stream_sql=_GC.format("serial_group, count(*) AS n_delete") + " GROUP BY 1")
def lim_1(spark, d):
    return str_14(spark, d).groupBy("serial_group").agg(F.count("*").alias("n_delete"))


@query("srt_1_staged_order", stream_sql="SELECT serial_group, epoch_ms, seq, row_number() OVER (ORDER BY serial_group, epoch_ms, seq) AS place FROM files")
def srt_1(spark, d):
    # The place inside a group, on top of the sizes of the groups before it: no global window over rows.
    f = st.files(spark, d).select("serial_group", "epoch_ms", "seq")
    before = f.groupBy("serial_group").agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(W.orderBy("serial_group").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    place = F.row_number().over(W.partitionBy("serial_group").orderBy("epoch_ms", "seq"))
    return f.withColumn("nth", place).join(before, "serial_group").select("serial_group", "epoch_ms", "seq", (F.col("nth") + F.col("base")).alias("place")).orderBy("place")


@query("win_1_dup_seq", stream_sql="SELECT serial_group, epoch_ms, seq, count(*) AS n FROM (SELECT serial_group, epoch_ms, seq FROM files UNION ALL SELECT serial_group, epoch_ms, seq FROM files WHERE seq % 6 = 1) GROUP BY ALL HAVING count(*) > 1")
def win_1(spark, d):
    f = st.files(spark, d).select("serial_group", "epoch_ms", "seq")
    return ledger.repeated_seqs(f.unionByName(f.filter("seq % 6 = 1")))


@query("win_2_tripwire", stream_sql="""SELECT serial_group, epoch_ms, seq, prev_epoch, prev_seq FROM (SELECT *, lag(epoch_ms) OVER w AS prev_epoch, lag(seq) OVER w AS prev_seq FROM (SELECT serial_group, seq AS arrival, end_offset, epoch_ms + (seq // 8) AS epoch_ms, CASE WHEN seq % 8 = 5 THEN seq % 8 + 1 ELSE seq % 8 END AS seq FROM files) WINDOW w AS (PARTITION BY serial_group ORDER BY arrival))
WHERE prev_epoch IS NOT NULL AND NOT ((epoch_ms = prev_epoch AND seq = prev_seq + 1) OR (epoch_ms > prev_epoch AND seq = 0))""")
def win_2(spark, d):
    f = st.files(spark, d).select("serial_group", F.col("seq").alias("arrival"), "end_offset", (F.col("epoch_ms") + F.expr("seq div 8")).alias("epoch_ms"), F.expr("CASE WHEN seq % 8 = 5 THEN seq % 8 + 1 ELSE seq % 8 END AS seq"))
    return ledger.order_breaks(f).select("serial_group", "epoch_ms", "seq", "prev_epoch", "prev_seq")


_LOST = f"SELECT serial_group, p, epoch_ms + (seq // 16) AS epoch_ms, seq % 16 AS seq, start_offset, end_offset, seq AS arrival FROM files WHERE seq % 7 <> 3 AND seq % 23 NOT BETWEEN 15 AND 17"


def _lost(spark, d):
    f = st.files(spark, d).filter("seq % 7 != 3 AND seq % 23 NOT BETWEEN 15 AND 17")
    return f.select("serial_group", "p", (F.col("epoch_ms") + F.expr("seq div 16")).alias("epoch_ms"), F.expr("seq % 16").alias("seq"), "start_offset", "end_offset", F.col("seq").alias("arrival"))


@query("win_2_break_ranges", stream_sql=f"""SELECT serial_group, epoch_ms, seq, prev_epoch, prev_seq,
  CASE WHEN epoch_ms = prev_epoch AND seq > prev_seq + 1 THEN prev_seq + 1 WHEN epoch_ms > prev_epoch THEN 0 END AS missing_from, CASE WHEN (epoch_ms = prev_epoch AND seq > prev_seq + 1) OR epoch_ms > prev_epoch THEN seq - 1 END AS missing_to,
  CASE WHEN start_offset > prev_end + 1 THEN prev_end + 1 END AS missing_start, CASE WHEN start_offset > prev_end + 1 THEN start_offset - 1 END AS missing_end
FROM (SELECT *, lag(epoch_ms) OVER w AS prev_epoch, lag(seq) OVER w AS prev_seq, lag(end_offset) OVER w AS prev_end FROM (SELECT * FROM ({_LOST}) UNION ALL SELECT serial_group, p, epoch_ms, seq, start_offset, end_offset, arrival + 0.5 FROM ({_LOST}) WHERE arrival % 5 = 1) WINDOW w AS (PARTITION BY serial_group ORDER BY arrival))
WHERE prev_epoch IS NOT NULL AND NOT ((epoch_ms = prev_epoch AND seq = prev_seq + 1) OR (epoch_ms > prev_epoch AND seq = 0))""")
def win_2_ranges(spark, d):
    f = _lost(spark, d).withColumn("arrival", F.col("arrival").cast("double"))
    twice = f.filter("arrival % 5 = 1").withColumn("arrival", F.col("arrival") + 0.5)
    return ledger.order_breaks(f.unionByName(twice)).select("serial_group", "epoch_ms", "seq", "prev_epoch", "prev_seq", "missing_from", "missing_to", "missing_start", "missing_end")


@query("win_2_missing_ranges", stream_sql=f"""SELECT serial_group, epoch_ms, CASE WHEN epoch_ms = prev_epoch THEN prev_seq + 1 ELSE 0 END AS missing_from, seq - 1 AS missing_to,
  CASE WHEN start_offset > prev_end + 1 THEN prev_end + 1 END AS missing_start, CASE WHEN start_offset > prev_end + 1 THEN start_offset - 1 END AS missing_end
FROM (SELECT *, lag(epoch_ms) OVER w AS prev_epoch, lag(seq) OVER w AS prev_seq, max(end_offset) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end FROM ({_LOST}) WINDOW w AS (PARTITION BY serial_group ORDER BY epoch_ms, seq))
WHERE prev_epoch IS NOT NULL AND ((epoch_ms = prev_epoch AND seq > prev_seq + 1) OR (epoch_ms > prev_epoch AND seq > 0))""")
def win_2_missing(spark, d):
    f = _lost(spark, d)
    # In any order, some twice: holes depend on what is there, not on when it came.
    return ledger.missing_ranges(f.unionByName(f.filter("seq % 4 = 2")))


# ---- Staged files, written and read back


_STAGED = "SELECT p, seq, \"offset\" - seq * {0} AS place, event_id, ts, user_id, event_type, value, props FROM s"


def _placed(rows):
    p = F.regexp_extract("_file", r"events-p(\d+)/[^/]*$", 1).cast("long")
    return rows.select(p.alias("p"), naming.seq_of(F.col("_serial")).alias("seq"), F.col("_ord").alias("place"), *st.EVENT.names)


@query("snk_4_two_phase_sink", stream_sql=_STAGED.format(st.FILE))
def snk_4(spark, d):
    return _placed(read_staged(spark, st.stage(spark, d) + "/*", st.EVENT))


@query("src_9_staged_range", stream_sql=_STAGED.format(st.FILE) + f" WHERE (p, seq) IN (SELECT p, seq FROM files WHERE end_offset >= 450 AND start_offset <= 900 AND serial_seq > {st.EPOCH} * 1048576 + 2)")
def src_9(spark, d):
    return _placed(read_staged(spark, st.stage(spark, d) + "/*", st.EVENT, offsets=(450, 900), above=naming.encode(st.EPOCH, 2)))


# ---- The gate


_JOBS = """, jobs AS (SELECT serial_group, serial_seq, identifier FROM ledger UNION ALL SELECT serial_group, serial_seq, identifier || 'x' FROM ledger UNION ALL SELECT serial_group, serial_seq + 100, identifier || 'y' FROM ledger)"""


def _jobs(book: DataFrame) -> DataFrame:
    j = book.select("serial_group", "serial_seq", "identifier")
    return j.unionByName(j.withColumn("identifier", F.concat("identifier", F.lit("x")))).unionByName(j.withColumns({"identifier": F.concat("identifier", F.lit("y")), "serial_seq": F.col("serial_seq") + 100}))


@query("str_9_gate", stream_sql=_JOBS + """ SELECT j.*, CASE WHEN j.serial_seq <= watermark OR j.identifier IN (SELECT identifier FROM ledger) THEN 'replay' WHEN h.serial_seq IS NOT NULL THEN 'violation' ELSE 'accept' END AS verdict
FROM jobs j LEFT JOIN marks USING (serial_group) LEFT JOIN (SELECT DISTINCT serial_group, serial_seq FROM ledger WHERE status NOT IN ('FINISH', 'SKIPPED')) h ON j.serial_group = h.serial_group AND j.serial_seq = h.serial_seq""")
def str_9(spark, d):
    book = st.ledger(spark, d)
    return ledger.gate(_jobs(book), book)


# Each file's job comes three times: under a second identifier, under its own, under its own again; some from the ledger too.
_BATCH = """, jobs AS (SELECT serial_group, serial_seq, i.identifier || CASE WHEN k = seq % 3 THEN 'z' ELSE '' END AS identifier, i.seq * 3 + k AS arrival FROM ledger i, (SELECT unnest([0, 1, 2]) AS k) WHERE seq % 2 = 0 OR status = 'READY'),
book AS (SELECT * FROM ledger WHERE status <> 'READY' OR seq % 4 = 1),
m AS (SELECT serial_group, max(serial_seq) AS watermark FROM book WHERE status IN ('FINISH', 'SKIPPED') GROUP BY 1),
a AS (SELECT j.*, CASE WHEN j.serial_seq <= watermark OR j.identifier IN (SELECT identifier FROM book) THEN 'replay' WHEN h.serial_seq IS NOT NULL THEN 'violation' END AS settled FROM jobs j LEFT JOIN m USING (serial_group) LEFT JOIN (SELECT DISTINCT serial_group, serial_seq FROM book WHERE status NOT IN ('FINISH', 'SKIPPED')) h ON j.serial_group = h.serial_group AND j.serial_seq = h.serial_seq)"""


@query("str_9_gate_in_order", stream_sql=_BATCH + """ SELECT serial_group, serial_seq, identifier, arrival, coalesce(settled, CASE WHEN nth = 1 THEN 'accept' WHEN identifier = winner THEN 'replay' ELSE 'violation' END) AS verdict
FROM (SELECT *, row_number() OVER w AS nth, first_value(identifier) OVER w AS winner FROM a WINDOW w AS (PARTITION BY serial_group, serial_seq, settled IS NULL ORDER BY arrival))""")
def str_9_in_order(spark, d):
    whole = st.ledger(spark, d)
    jobs = whole.filter("seq % 2 = 0 OR status = 'READY'").withColumn("k", F.explode(F.array(*map(F.lit, (0, 1, 2)))))
    name = F.concat("identifier", F.when(F.col("k") == F.col("seq") % 3, F.lit("z")).otherwise(F.lit("")))
    jobs = jobs.select("serial_group", "serial_seq", name.alias("identifier"), (F.col("seq") * 3 + F.col("k")).alias("arrival"))
    return ledger.gate(jobs, whole.filter("status != 'READY' OR seq % 4 = 1"), "arrival")


# A log of executions: transient failures, for some a permanent one, an operator's retry or skip, then an execution that ends well.
_LOG = f""", log AS (SELECT identifier, CASE seq % 4 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 15 END AS retry_max, {st.EPOCH} + seq * 60000 + k * 1000 AS at_ms,
  CASE WHEN k < seq % 6 THEN 'transient' WHEN k = 6 AND seq % 5 = 1 THEN 'permanent' WHEN k = 7 AND seq % 7 = 2 THEN 'skip' WHEN k = 7 AND seq % 7 = 3 THEN 'retry' WHEN k = 8 AND seq % 7 = 3 THEN 'transient' WHEN k = 9 AND seq % 3 > 0 THEN 'ok' END AS event
  FROM ledger, (SELECT unnest(range(10)) AS k))"""


@query("str_11_attempts", stream_sql=_LOG.replace(", log AS", ", log0 AS") + """, log AS (SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY at_ms, event) AS pos FROM log0 WHERE event IS NOT NULL),
r AS (SELECT *, count(*) FILTER (event = 'retry') OVER (PARTITION BY identifier ORDER BY pos) AS round FROM log),
t AS (SELECT *, count(*) FILTER (event = 'transient') OVER (PARTITION BY identifier, round ORDER BY pos) AS nth FROM r),
e AS (SELECT identifier, round, min(pos) FILTER (event IN ('ok', 'permanent') OR (event = 'transient' AND nth > retry_max)) AS cut, max(retry_max) AS retry_max FROM t GROUP BY 1, 2),
o AS (SELECT e.identifier, e.round, e.retry_max, max(CASE WHEN pos = cut THEN CASE event WHEN 'ok' THEN 'FINISH' WHEN 'permanent' THEN 'permanent' ELSE 'retries' END END) AS how, count(*) FILTER (event NOT IN ('retry', 'skip') AND (cut IS NULL OR pos <= cut)) AS attempts,
      max(at_ms) FILTER (event NOT IN ('retry', 'skip') AND (cut IS NULL OR pos <= cut)) AS last_ms, count(*) FILTER (event = 'skip' AND pos > cut) AS skips FROM e JOIN t USING (identifier, round) GROUP BY 1, 2, 3),
j1 AS (SELECT *, CASE WHEN how = 'FINISH' THEN how WHEN how IS NOT NULL AND skips > 0 THEN 'SKIPPED' WHEN how IS NOT NULL THEN 'FAIL' WHEN attempts > 0 THEN 'RETRY' ELSE 'READY' END AS status FROM o),
j2 AS (SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY CASE WHEN status IN ('FINISH', 'SKIPPED') THEN round ELSE 1000 - round END) AS k FROM j1)
SELECT identifier, status, attempts, CASE WHEN status = 'FAIL' THEN how END AS reason, CASE WHEN status = 'RETRY' THEN last_ms + CAST(list_aggregate(list_transform(range(attempts, attempts + 1), lambda j: least(30, 2 ** (j - 1))), 'sum') * 1000 AS BIGINT) END AS next_at_ms,
  CASE WHEN status = 'RETRY' AND retry_max IS NOT NULL THEN last_ms + CAST(list_aggregate(list_transform(range(attempts, retry_max + 1), lambda j: least(30, 2 ** (j - 1))), 'sum') * 1000 AS BIGINT) END AS fail_at_ms FROM j2 WHERE k = 1""")
def str_11(spark, d):
    seq, k = F.col("seq"), F.col("k")
    book = st.ledger(spark, d).select("identifier", "seq").withColumn("k", F.explode(F.array(*map(F.lit, range(10)))))
    limit = F.when(seq % 4 == 0, 0).when(seq % 4 == 1, 2).when(seq % 4 == 2, 15)
    event = F.when(k < seq % 6, "transient").when((k == 6) & (seq % 5 == 1), "permanent").when((k == 7) & (seq % 7 == 2), "skip").when((k == 7) & (seq % 7 == 3), "retry").when((k == 8) & (seq % 7 == 3), "transient").when((k == 9) & (seq % 3 > 0), "ok")
    return attempts.job_states(book.select("identifier", limit.alias("retry_max"), (F.lit(st.EPOCH) + seq * 60_000 + k * 1000).alias("at_ms"), event.alias("event")).filter("event IS NOT NULL"))


@query("jon_3_known_jobs", stream_sql=_JOBS + " SELECT identifier FROM jobs WHERE identifier IN (SELECT identifier FROM ledger)")
def jon_3(spark, d):
    book = st.ledger(spark, d)
    return _jobs(book).join(book.select("identifier"), "identifier", "left_semi").select("identifier")


@query("jon_2_staged_watermark", stream_sql="SELECT f.serial_group, f.serial_seq, watermark FROM files f LEFT JOIN marks USING (serial_group)")
def jon_2(spark, d):
    return st.files(spark, d).join(ledger.watermarks(st.ledger(spark, d)), "serial_group", "left").select("serial_group", "serial_seq", "watermark")


# ---- Rotation: a fold; in SQL a recursion over the batches


_ROTATION = f""", b AS (SELECT serial_group, batch_start, count(*) AS n_rows, CAST(sum(strlen({_EVENT_LINE}) + 1) AS BIGINT) AS n_bytes FROM s GROUP BY 1, 2)
, f AS (SELECT *, row_number() OVER (PARTITION BY serial_group ORDER BY batch_start) AS nth FROM b)
, w AS (SELECT DISTINCT serial_group, CAST(0 AS BIGINT) AS batch_start, CAST(0 AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_bytes, CAST(0 AS BIGINT) AS nth, CAST(0 AS BIGINT) AS file_no, CAST(0 AS BIGINT) AS file_rows, CAST(0 AS BIGINT) AS file_bytes, CAST(128 AS DOUBLE) AS per_row, false AS sealed FROM b
  UNION ALL SELECT serial_group, batch_start, n_rows, n_bytes, nth, file_no, file_rows, file_bytes, per_row, file_rows * per_row >= 16384 AS sealed
  FROM (SELECT f.serial_group, f.batch_start, f.n_rows, f.n_bytes, f.nth, CASE WHEN sealed THEN file_no + 1 ELSE file_no END AS file_no, CASE WHEN sealed THEN 0 ELSE file_rows END + f.n_rows AS file_rows,
        CASE WHEN sealed THEN 0 ELSE file_bytes END + f.n_bytes AS file_bytes, CASE WHEN sealed THEN file_bytes / file_rows ELSE per_row END AS per_row FROM f JOIN w ON f.serial_group = w.serial_group AND f.nth = w.nth + 1))
SELECT serial_group, batch_start, n_rows, n_bytes, file_no FROM w WHERE nth > 0"""


@query("str_1_rotation", sql=st.SQL.replace("WITH s0", "WITH RECURSIVE s0", 1) + _ROTATION)
def str_1(spark, d):
    rows = st.stream(spark, d)
    batches = rows.groupBy("serial_group", "batch_start").agg(F.count("*").alias("n_rows"), F.sum(F.octet_length(csv.row_text(rows.select(*_EVENT_CELLS).schema)) + 1).alias("n_bytes"))
    return folds.rotation(batches, 16_384)


# ---- Names


def _names(spark, d) -> DataFrame:
    return st.files(spark, d).withColumn("compressed", F.col("seq") % 2 == 0)


_NAME = "lpad(CAST(epoch_ms AS VARCHAR), 13, '0') || '-' || lpad(CAST(seq AS VARCHAR), 7, '0') || '-o' || start_offset || '-' || end_offset || (CASE WHEN seq % 2 = 0 THEN '.csv.gz' ELSE '.csv' END)"


def _key():
    return naming.basename(F.col("epoch_ms"), F.col("seq"), F.col("start_offset"), F.col("end_offset"), F.col("compressed"))


@query("nam_1_encode", sql=f"SELECT event_id, {st.EPOCH} * 1048576 + event_id AS serial_seq FROM events")
def nam_1(spark, d):
    return st.table(spark, d, "events").select("event_id", naming.rolled_serial(F.lit(st.EPOCH), F.col("event_id")).alias("serial_seq"))


@query("nam_2_decode", sql=f"SELECT event_id, CAST({st.EPOCH} AS BIGINT) AS epoch_ms, event_id AS seq FROM events")
def nam_2(spark, d):
    # The epoch is the one that numbering began at: past 2^20 files the serial itself is in a later one.
    serial = naming.rolled_serial(F.lit(st.EPOCH), F.col("event_id"))
    rows = st.table(spark, d, "events").select("event_id", serial.alias("serial"))
    return rows.select("event_id", F.lit(st.EPOCH).cast("long").alias("epoch_ms"), naming.count_since(F.col("serial"), F.lit(st.EPOCH)).alias("seq"))


_MIXED = f""", n AS (SELECT {_NAME} AS name FROM files UNION ALL SELECT 'x' || ({_NAME}) FROM files UNION ALL SELECT '99999999999999999999-1-o0-1.csv')"""


def _mixed(spark, d) -> DataFrame:
    good = _names(spark, d).select(_key().alias("name"))
    return good.unionByName(good.select(F.concat(F.lit("x"), "name").alias("name"))).unionByName(spark.range(1).select(F.lit("99999999999999999999-1-o0-1.csv").alias("name")))


@query("nam_3_parse", stream_sql=_MIXED + r""" SELECT name, TRY_CAST(regexp_extract(name, '^(\d+)-(\d+)-o(\d+)-(\d+)\.csv(\.gz)?$', 1) AS BIGINT) AS epoch_ms, CASE WHEN TRY_CAST(regexp_extract(name, '^(\d+)-(\d+)-o(\d+)-(\d+)\.csv(\.gz)?$', 1) AS BIGINT) IS NULL THEN NULL ELSE TRY_CAST(regexp_extract(name, '^(\d+)-(\d+)-o(\d+)-(\d+)\.csv(\.gz)?$', 2) AS BIGINT) END AS seq FROM n""")
def nam_3(spark, d):
    return _mixed(spark, d).withColumn("f", naming.parse_basename(F.col("name"))).select("name", F.col("f.epoch_ms").alias("epoch_ms"), F.col("f.seq").alias("seq"))


@query("src_3_list_staged", stream_sql=_MIXED + r""" SELECT CASE WHEN regexp_matches(name, '^\d{1,19}-(\d+)-o(\d+)-(\d+)\.csv(\.gz)?$') THEN 'staged' ELSE 'unknown' END AS kind, count(*) AS n FROM n GROUP BY 1""")
def src_3(spark, d):
    kind = F.when(naming.parse_basename(F.col("name")).isNull(), "unknown").otherwise("staged")
    return _mixed(spark, d).groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("nam_4_object_key", stream_sql=f"SELECT p, seq, '{st.CLUSTER}/{st.DB}/{st.REL}/events-p' || p || '/' || {_NAME} AS object_key FROM files")
def nam_4(spark, d):
    folder = naming.staging_dir(F.lit(st.CLUSTER), F.lit(st.DB), F.lit(st.REL), F.concat(F.lit("events-p"), F.col("p").cast("string")))
    return _names(spark, d).select("p", "seq", F.concat(folder, F.lit("/"), _key()).alias("object_key"))


@query("nam_5_identifier", stream_sql="SELECT p, seq, identifier FROM ledger")
def nam_5(spark, d):
    return st.ledger(spark, d).select("p", "seq", "identifier")


@query("nam_6_groups", stream_sql=f"SELECT DISTINCT p, serial_group, '{st.CLUSTER}/{st.DB}/{st.REL}/events-p' || p AS staging_dir FROM files")
def nam_6(spark, d):
    writer = F.concat(F.lit("events-p"), F.col("p").cast("string"))
    return st.files(spark, d).select("p").distinct().select("p", naming.serial_group(F.lit(st.DB), F.lit(st.REL), writer).alias("serial_group"), naming.staging_dir(F.lit(st.CLUSTER), F.lit(st.DB), F.lit(st.REL), writer).alias("staging_dir"))


@query("nam_7_segments", sql=r"""SELECT name, regexp_matches(name, '^[A-Za-z0-9._-]{1,64}$') AND NOT regexp_matches(name, '^\.+$') AS segment, regexp_matches(name, '^[A-Za-z0-9._-]{1,64}$') AND NOT regexp_matches(name, '^\.+$') AND NOT starts_with(name, '_') AS writer
FROM (SELECT p_name AS name FROM part UNION ALL SELECT replace(p_name, ' ', '_') FROM part UNION ALL SELECT '_' || p_brand FROM part UNION ALL SELECT '..' UNION ALL SELECT '')""")
def nam_7(spark, d):
    part = st.table(spark, d, "part")
    extra = spark.range(1).select(F.explode(F.array(F.lit(".."), F.lit(""))).alias("name"))
    names = part.select(F.col("p_name").alias("name")).unionByName(part.select(F.replace("p_name", F.lit(" "), F.lit("_")).alias("name"))).unionByName(part.select(F.concat(F.lit("_"), "p_brand").alias("name"))).unionByName(extra)
    return names.select("name", naming.good_segment(F.col("name")).alias("segment"), naming.good_segment(F.col("name"), writer=True).alias("writer"))


@query("rec_1_next_epoch", sql=f"SELECT event_id, CASE WHEN {st.EPOCH} + event_id <= {st.EPOCH} + 500 THEN {st.EPOCH} + 501 ELSE {st.EPOCH} + event_id END AS epoch_ms FROM events")
def rec_1(spark, d):
    return st.table(spark, d, "events").select("event_id", naming.next_epoch(F.lit(st.EPOCH).cast("long") + F.col("event_id"), F.lit(st.EPOCH + 500).cast("long")).alias("epoch_ms"))


@query("rec_2_epoch_anchor", stream_sql="SELECT serial_group, greatest(max(epoch_ms), max(watermark) // 1048576, 5) AS anchor FROM files LEFT JOIN marks USING (serial_group) GROUP BY 1")
def rec_2(spark, d):
    f = st.files(spark, d).join(ledger.watermarks(st.ledger(spark, d)), "serial_group", "left")
    return f.groupBy("serial_group").agg(F.greatest(F.max("epoch_ms"), naming.epoch_of(F.max("watermark")), F.lit(5).cast("long")).alias("anchor"))


# ---- The CSV dialect


def _float_sql(c: str) -> str:
    return f"regexp_replace(CAST({c} AS VARCHAR), '\\.0$', '')"


def _text_sql(c: str) -> str:
    return f"""'"' || replace(replace({c}, chr(0), ''), '"', '""') || '"'"""


def _line_sql(name: str, cols: list[tuple[str, str]]) -> str:
    show = {"i": lambda c: f"CAST({c} AS VARCHAR)", "f": _float_sql, "t": _text_sql, "s": lambda c: f"CAST({c} AS VARCHAR)"}
    return "SELECT " + " || ',' || ".join(f"coalesce({show[k](c)}, '')" for c, k in cols) + f" AS line FROM {name}"


_TABLES = {
    "events": [("event_id", "i"), ("ts", "s"), ("user_id", "i"), ("event_type", "t"), ("value", "f"), ("props", "t")],
    "orders": [("o_orderkey", "i"), ("o_custkey", "i"), ("o_orderstatus", "t"), ("o_totalprice", "f"), ("o_orderdate", "s"), ("o_orderpriority", "t")],
    "lineitem": [("l_orderkey", "i"), ("l_partkey", "i"), ("l_suppkey", "i"), ("l_linenumber", "i"), ("l_quantity", "f"), ("l_extendedprice", "f"), ("l_discount", "f"), ("l_tax", "f"), ("l_returnflag", "t"), ("l_linestatus", "t"), ("l_shipdate", "s")],
    "documents": [("doc_id", "i"), ("text", "t"), ("lang", "t"), ("source", "t"), ("n_chars", "i")],
    "conversations": [("conv_id", "i"), ("turn", "i"), ("role", "t"), ("text", "t")],
    "customer": [("c_custkey", "i"), ("c_name", "t"), ("c_nationkey", "i"), ("c_acctbal", "f"), ("c_mktsegment", "t")],
    "pages": [("page_id", "i"), ("url", "t"), ("html", "t")],
}


def _render(name: str):
    def run(spark, d):
        rows = st.table(spark, d, name).select(*[c for c, _ in _TABLES[name]])
        return rows.select(csv.row_text(rows.schema).alias("line"))

    return run


for _name, _cols in _TABLES.items():
    query(f"csv_render_{_name}", sql=_line_sql(_name, _cols))(_render(_name))


@query("snk_2_header", sql="""SELECT '"event_id","ts","user_id","event_type","value","props"' AS header""")
def snk_2(spark, d):
    return spark.range(1).select(F.lit(csv.header_text([c for c, _ in _TABLES["events"]])).alias("header"))


@query("csv_1_quote", sql=f"SELECT page_id, {_text_sql('html')} AS cell FROM pages")
def csv_1(spark, d):
    return st.table(spark, d, "pages").select("page_id", csv.quote(F.col("html")).alias("cell"))


@query("csv_2_null_and_empty", sql=f"""SELECT doc_id, coalesce({_text_sql("CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '' ELSE lang END")}, '') AS cell FROM documents""")
def csv_2(spark, d):
    from pyspark.sql import types as T

    value = F.expr("CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '' ELSE lang END")
    return st.table(spark, d, "documents").select("doc_id", csv.cell(value, T.StringType()).alias("cell"))


@query("csv_3_bool", sql="SELECT doc_id, CASE WHEN toxic = 1 THEN 't' ELSE 'f' END AS cell FROM labels")
def csv_3(spark, d):
    return st.table(spark, d, "labels").select("doc_id", csv.bool_text(F.col("toxic") == 1).alias("cell"))


@query("csv_4_ints", sql="SELECT l_orderkey, CAST(l_partkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|' || CAST(-l_suppkey AS VARCHAR) AS cell FROM lineitem")
def csv_4(spark, d):
    return st.table(spark, d, "lineitem").select("l_orderkey", F.concat(csv.int_text(F.col("l_partkey")), F.lit("|"), csv.int_text(F.col("l_linenumber")), F.lit("|"), csv.int_text(-F.col("l_suppkey"))).alias("cell"))


@query("csv_5_floats", sql=f"SELECT o_orderkey, {_float_sql('o_totalprice')} AS cell FROM orders")
def csv_5(spark, d):
    return st.table(spark, d, "orders").select("o_orderkey", csv.float_text(F.col("o_totalprice")).alias("cell"))


@query("csv_6_decimal", sql="SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(20, 4)) AS VARCHAR) AS cell FROM orders")
def csv_6(spark, d):
    return st.table(spark, d, "orders").select("o_orderkey", csv.decimal_text(F.col("o_totalprice").cast("decimal(20, 4)")).alias("cell"))


@query("csv_7_date", sql="SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS cell FROM orders")
def csv_7(spark, d):
    return st.table(spark, d, "orders").select("o_orderkey", csv.date_text(F.col("o_orderdate").cast("date")).alias("cell"))


@query("csv_8_timestamp", sql="SELECT event_id, CAST(ts AS VARCHAR) AS cell, CAST(ts AS VARCHAR) || '+00' AS zoned FROM events")
def csv_8(spark, d):
    return st.table(spark, d, "events").select("event_id", csv.timestamp_text(F.col("ts")).alias("cell"), csv.timestamp_text(F.col("ts").cast("timestamp"), True).alias("zoned"))


@query("csv_9_bytea", sql=r"SELECT conv_id, turn, '\x' || lower(hex(encode(text))) AS cell FROM conversations")
def csv_9(spark, d):
    return st.table(spark, d, "conversations").select("conv_id", "turn", csv.bytes_text(F.encode("text", "UTF-8")).alias("cell"))


# ---- Credentials, endpoints, clock


@query("msk_1_mask", sql="SELECT c_custkey, c_masked FROM (SELECT c_custkey, CASE WHEN length(v) <= 8 THEN '******' WHEN length(v) <= 15 THEN left(v, 2) || '***' || right(v, 2) ELSE left(v, 3) || '***' || right(v, 3) END AS c_masked FROM (SELECT c_custkey, left(c_name, CAST(c_custkey % 20 AS INTEGER)) AS v FROM customer))")
def msk_1(spark, d):
    v = F.left("c_name", (F.col("c_custkey") % 20).cast("int"))
    return st.table(spark, d, "customer").select("c_custkey", secrets.mask(v).alias("c_masked"))


@query("snk_11_copy_options", sql="""SELECT s_suppkey, 'access_key_id=AK' || s_suppkey || ',secret_access_key=SK' || s_nationkey || ',format=csv,header=true,delimiter=","' || CASE WHEN s_suppkey % 2 = 0 THEN ',mode=upsert' ELSE '' END AS options FROM supplier""")
def snk_11(spark, d):
    s = st.table(spark, d, "supplier")
    mode = F.when(F.col("s_suppkey") % 2 == 0, F.lit(",mode=upsert")).otherwise(F.lit(""))
    return s.select("s_suppkey", F.concat(F.lit("access_key_id=AK"), F.col("s_suppkey").cast("string"), F.lit(",secret_access_key=SK"), F.col("s_nationkey").cast("string"), F.lit(',format=csv,header=true,delimiter=","'), mode).alias("options"))


@query("stg_1_staging_url", sql="SELECT n_nationkey, 's3.' || n_nationkey || '.test' AS endpoint, 'b' || n_regionkey AS bucket, CASE WHEN n_nationkey % 2 = 0 THEN 'p/' || n_nationkey ELSE '' END AS prefix FROM nation")
def stg_1(spark, d):
    n = F.col("n_nationkey").cast("string")
    url = F.concat(F.lit("s3://s3."), n, F.lit(".test/b"), F.col("n_regionkey").cast("string"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("/p/"), n, F.lit("/"))).otherwise(F.lit("")))
    return st.table(spark, d, "nation").select("n_nationkey", secrets.staging_url(url).alias("u")).select("n_nationkey", "u.*")


@query("stg_2_endpoint", sql="SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 's3' WHEN 1 THEN 'oss' WHEN 2 THEN 's3' END AS kind, CASE n_nationkey % 4 WHEN 0 THEN 'r' || n_nationkey WHEN 2 THEN 'ap-' || n_nationkey END AS region FROM nation")
def stg_2(spark, d):
    n = F.col("n_nationkey").cast("string")
    host = F.when(F.col("n_nationkey") % 4 == 0, F.concat(F.lit("https://s3."), F.lit("r"), n, F.lit(".amazonaws.com:443"))).when(F.col("n_nationkey") % 4 == 1, F.concat(F.lit("oss-cn-"), n, F.lit(".aliyuncs.com"))).when(F.col("n_nationkey") % 4 == 2, F.concat(F.lit("cos.ap-"), n, F.lit(".myqcloud.com"))).otherwise(F.concat(F.lit("minio"), n, F.lit(":9000")))
    return st.table(spark, d, "nation").select("n_nationkey", secrets.endpoint_kind(host).alias("k")).select("n_nationkey", F.col("k.kind").alias("kind"), F.col("k.region").alias("region"))


@query("log_1_clock", sql=f"SELECT event_id, strftime(make_timestamp(({st.EPOCH} + event_id * 777) * 1000), '%Y-%m-%d %H:%M:%S') AS clock FROM events")
def log_1(spark, d):
    return st.table(spark, d, "events").select("event_id", F.date_format(F.timestamp_millis(F.lit(st.EPOCH).cast("long") + F.col("event_id") * 777), "yyyy-MM-dd HH:mm:ss").alias("clock"))


_TYPE_NAMES = "CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' ELSE lower(column_type) END"
_DESCRIBE = "SELECT '{0}' AS table_name, CAST(row_number() OVER () AS INTEGER) AS ordinal, column_name, " + _TYPE_NAMES + " AS data_type, NOT ends_with(column_type, '[]') AS supported FROM (DESCRIBE {0})"


@query("src_6_catalog_columns", sql=" UNION ALL ".join(_DESCRIBE.format(t) for t in ("events", "orders", "embeddings")))
def src_6(spark, d):
    from pyspark.sql import types as T

    from ..types import WHITELIST

    rows = [(t, i, f.name, f.dataType.simpleString(), isinstance(f.dataType, WHITELIST)) for t in ("events", "orders", "embeddings") for i, f in enumerate(st.table(spark, d, t).schema, 1)]
    return spark.createDataFrame(rows, T.StructType.fromDDL("table_name string, ordinal int, column_name string, data_type string, supported boolean"))
