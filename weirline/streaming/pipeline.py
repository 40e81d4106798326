"""A structured stream into target tables: each micro-batch is one file per stream, staged, announced, loaded.

The checkpoint holds the source's offsets; the file's number is the micro-batch's, so a micro-batch that
runs again after a crash gives the same names, and the gate in the manifest drops what was loaded already.
"""

from __future__ import annotations

import logging
import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Config, Mode
from ..errors import SchemaError, WriterFenced
from ..functions import naming
from ..operators.tables import last_wins
from ..sources.sink import StagingSink
from ..sources.staging import read_files
from ..sources.store import Store
from ..types import TableSchema
from .lease import Lease
from .target import Target


log = logging.getLogger("weirline")

#: This process's streams by their folder: lease and query.
_live: dict[str, tuple[Lease, StreamingQuery]] = {}


def _keep(lease: Lease, query: StreamingQuery, interval: float) -> None:
    """Renew the lease while the query runs, also where no rows come; then release it."""
    try:
        while not query.awaitTermination(interval):
            lease.heartbeat()
    except WriterFenced:
        query.stop()
    except Exception as e:
        log.error("the stream ended: %s", str(e)[:300])
    lease.release()


def start(stream: DataFrame, config: Config, schema: TableSchema, epoch_ms: int, checkpoint: str, partition: str = "partition", offset: str = "offset", mode: Mode | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Run a stream of rows with a partition and an offset column. Partitions are streams of their own: each
    gets its own file, group and watermark; rows of one key belong in one partition."""
    config.check()
    mode = mode or config.mode
    schema.check(upsert=mode is Mode.UPSERT)
    spark = stream.sparkSession
    store = Store(spark, config.root)
    target = Target(spark, f"{store.root}/tables/{schema.db_id}/{schema.rel_id}", schema.columns, schema.key if mode is Mode.UPSERT else (), config.buckets)
    names = schema.columns.names
    if clash := {"_stream", "_offset", "_name"} & set(names):
        raise SchemaError(f"{', '.join(sorted(clash))} can't be the name of a column of a stream's table")
    folder = f"staging/{config.cluster_id}/{schema.db_id}/{schema.rel_id}"
    compressed = config.compression.value == "gzip"
    # One live query a table and checkpoint; a query that was overtaken ends at its next micro-batch.
    place = f"{store.root}/{folder}"
    if place in _live and not _live[place][1].isActive:
        _live.pop(place)[0].release()
    lease = Lease(store, f"{folder}/_meta/stream-lease.json", config.lock_lease_timeout, settle=config.lock_settle, wait=config.lock_wait)
    lease.acquire()

    sink = StagingSink(store, folder)
    try:
        # What a query before this one had committed to staging and didn't move.
        sink.recover()
    except BaseException:
        lease.release()
        raise
    # A stream's identifier is `p` and its partition's value; rows without one are the stream `null`.
    value = F.col(partition).cast("string")
    ident = F.when(value.isNull(), F.lit("null")).otherwise(F.concat(F.lit("p"), value))
    group = lambda p: f"{schema.db_id}:{schema.rel_id}:{p}"

    def one(rows: DataFrame, batch_id: int) -> None:
        seq = batch_id & naming.SEQ_MAX
        epoch = epoch_ms + (batch_id >> naming.SEQ_BITS)
        serial = naming.encode(epoch, seq)
        lease.heartbeat()
        # The table may have columns of these names, so they are taken under others.
        rows = rows.select(*names, ident.alias("_stream"), F.col(offset).alias("_offset")).persist()
        try:
            done = target.manifest()["applied"]
            ranges = rows.groupBy("_stream").agg(F.min("_offset").alias("lo"), F.max("_offset").alias("hi")).collect()
            due = {r["_stream"]: (r["lo"], r["hi"]) for r in ranges if serial > done.get(group(r["_stream"]), -1)}
            for p in due:
                naming.check_segment(p, writer=True)
            if not due:
                return
            file = {p: f"{p}/{epoch:013d}-{seq:07d}-o{lo}-{hi}.csv" + ".gz" * compressed for p, (lo, hi) in due.items()}
            # One row a stream, joined, so that the plan doesn't grow with the streams.
            data = rows.join(F.broadcast(spark.createDataFrame(sorted(file.items()), "_stream string, _name string")), "_stream")
            if mode is Mode.UPSERT:
                data = last_wins(data.select(*names, "_offset", "_name"), list(schema.key), F.col("_offset"), ["_name"])
            sink.write(data, names, "_name", ["_offset"], config.delimiter, compressed)
        finally:
            rows.unpersist()
        loaded = read_files(spark, sorted(store.uri(f"{folder}/{f}") for f in file.values()), schema.columns, config.delimiter)
        applied = {group(p): serial for p in due}
        lease.verify()
        if mode is Mode.UPSERT:
            # Streams share no keys by contract; where they do, the order of files and rows decides.
            target.upsert(last_wins(loaded, list(schema.key), F.struct("_file", "_ord")).select(*names), applied)
        else:
            target.append(loaded.select(*names), applied)

    out = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    try:
        query = out.trigger(**(trigger or {"processingTime": f"{config.rotate_interval_max:g} seconds"})).start()
    except BaseException:
        lease.release()
        raise
    _live[place] = lease, query
    threading.Thread(target=_keep, args=(lease, query, config.lock_heartbeat_interval), name="weirline-stream", daemon=True).start()
    return query
