"""One stream for many tables: a micro-batch's rows go by their tag to tables of different columns, keys and modes.

A row has a tag, a partition, an offset and its values as JSON. The files of all tables are rendered and written by one Spark job and
committed together (`sources.sink`), then entered in one page of the ledger; so a micro-batch is in staging for all its tables or
for none, and one that runs again gives the same files. The rows are read once, whatever the number of tables.

Defined results: rows without a partition are the stream `null` of their table, and others `p` and the partition's value, which
must be a path segment; a tag that no table has, a missing tag, values that don't parse and a partition that is no segment
stop the stream before anything is written, and name what is wrong. A field that JSON lacks is NULL.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import Mode
from ..errors import ConfigError, SchemaError
from ..functions import csv_dialect as csv
from ..functions import naming
from ..operators.tables import last_wins
from ..sources.reader import read_files
from ..sources.sink import StagingSink
from ..sources.store import Store
from ..types import TableSchema
from .target import Target

LEDGER = "tag string, stream string, serial_group string, serial_seq long, object string, start_offset long, end_offset long, n_rows long, n_bytes long"


@dataclass(frozen=True)
class Route:
    schema: TableSchema
    mode: Mode = Mode.UPSERT


class Demux:
    """Routes by tag; files below `folder` of a store, tables below `tables`."""

    def __init__(self, spark: SparkSession, store: Store, folder: str, routes: dict[str, Route], epoch_ms: int, delimiter: str = ",", compressed: bool = True, buckets: int = 4):
        if not routes:
            raise ConfigError("there is no route")
        places = [(r.schema.db_id, r.schema.rel_id) for r in routes.values()]
        if len(set(places)) < len(places):
            raise ConfigError("two tags have the same table")
        for r in routes.values():
            r.schema.check(r.mode is Mode.UPSERT)
        csv.check_delimiter(delimiter)
        self.spark, self.store, self.folder, self.routes, self.epoch_ms, self.delimiter, self.compressed = spark, store, folder, routes, epoch_ms, delimiter, compressed
        self.sink = StagingSink(store, folder)
        self.targets = {t: Target(spark, f"{store.root}/tables/{r.schema.db_id}/{r.schema.rel_id}", r.schema.columns, r.schema.key if r.mode is Mode.UPSERT else (), buckets) for t, r in routes.items()}

    def page(self, batch_id: int) -> str:
        return f"{self.folder}/ledger/{batch_id:019d}.json"

    def write(self, rows: DataFrame, batch_id: int, tag: str = "tag", partition: str = "partition", offset: str = "offset", values: str = "value") -> list[dict]:
        """Stage one micro-batch; its files' rows in the ledger."""
        known = self.store.get(self.page(batch_id))
        if known is not None:
            return [json.loads(line) for line in known.splitlines()]
        epoch, seq = self.epoch_ms + (batch_id >> naming.SEQ_BITS), batch_id & naming.SEQ_MAX
        part = F.col(partition).cast("string")
        stream = F.when(part.isNull(), F.lit("null")).otherwise(F.concat(F.lit("p"), part))
        taken = rows.select(F.col(tag).alias("tag"), stream.alias("stream"), F.col(offset).cast("long").alias("offset"), F.col(values).alias("value")).persist()
        try:
            # One row a stream of the micro-batch.
            ranges = taken.groupBy("tag", "stream").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).collect()
            files = {(r["tag"], r["stream"]): (r["lo"], r["hi"], self._name(r, epoch, seq)) for r in ranges}
            if not files:
                return []
            names = self.spark.createDataFrame([(*k, v[2]) for k, v in sorted(files.items())], "tag string, stream string, name string")
            named = taken.join(F.broadcast(names), ["tag", "stream"])
            lines = [self._lines(named, t) for t in sorted({k[0] for k in files})]
            made = {f.name: f for f in self.sink.commit(self.sink.prepare(reduce(DataFrame.unionByName, lines), self.compressed))}
        finally:
            taken.unpersist()
        out = []
        for (t, s), (lo, hi, name) in sorted(files.items()):
            out.append({"tag": t, "stream": s, "serial_group": self._group(t, s), "serial_seq": naming.encode(epoch, seq), "object": name, "start_offset": lo, "end_offset": hi, "n_rows": made[name].n_rows, "n_bytes": made[name].n_bytes})
        self.store.create(self.page(batch_id), "".join(json.dumps(r) + "\n" for r in out))
        return out

    def _group(self, tag: str, stream: str) -> str:
        s = self.routes[tag].schema
        return f"{s.db_id}:{s.rel_id}:{stream}"

    def _name(self, r, epoch: int, seq: int) -> str:
        if r["tag"] not in self.routes:
            raise SchemaError(f"there is no table for the tag {r['tag']!r}")
        naming.check_segment(r["stream"], writer=True)
        if r["lo"] is None or r["lo"] < 0:
            raise ConfigError(f"{r['lo']} is no offset")
        s = self.routes[r["tag"]].schema
        return f"{s.db_id}/{s.rel_id}/{r['stream']}/{epoch:013d}-{seq:07d}-o{r['lo']}-{r['hi']}.csv" + ".gz" * self.compressed

    def _lines(self, named: DataFrame, tag: str) -> DataFrame:
        """One table's rows as lines of their files; in an upsert the last of each key in a file."""
        route = self.routes[tag]
        columns = route.schema.columns
        # `_whole` holds what doesn't fit, which no column of a table may be called.
        if "_whole" in columns.names:
            raise SchemaError("_whole can't be the name of a column of a stream's table")
        parsed = F.from_json("value", T.StructType([*columns.fields, T.StructField("_whole", T.StringType())]), {"columnNameOfCorruptRecord": "_whole", "mode": "PERMISSIVE"})
        broken = F.raise_error(F.concat(F.lit(f"values of {tag} don't parse at offset "), F.col("offset").cast("string"))).cast("string")
        mine = named.filter(F.col("tag") == tag).select("name", "offset", parsed.alias("v"))
        checked = mine.withColumn("name", F.when(F.col("v").isNull() | F.col("v._whole").isNotNull(), broken).otherwise(F.col("name")))
        rows = checked.select(F.col("name").alias("_name"), F.col("offset").alias("_offset"), *(F.col("v").getField(f.name).alias(f.name) for f in columns))
        if route.mode is Mode.UPSERT:
            rows = last_wins(rows, list(route.schema.key), F.col("_offset"), ["_name"])
        return rows.select(F.col("_name").alias("name"), F.lit(csv.header_text(columns.names, self.delimiter)).alias("head"), csv.row_text(columns, self.delimiter).alias("line"), F.col("_offset").alias("o0"))

    def load(self, files: list[dict]) -> None:
        """Bring staged files into their tables; a file that is there already changes nothing."""
        for t in sorted({f["tag"] for f in files}):
            route, target = self.routes[t], self.targets[t]
            done = target.manifest()["applied"]
            due = [f for f in files if f["tag"] == t and f["serial_seq"] > done.get(f["serial_group"], -1)]
            if not due:
                continue
            rows = read_files(self.spark, [self.store.uri(f"{self.folder}/{f['object']}") for f in due], route.schema.columns, self.delimiter)
            applied = {f["serial_group"]: f["serial_seq"] for f in due}
            if route.mode is Mode.UPSERT:
                rows = last_wins(rows, list(route.schema.key), F.struct("_file", "_ord"))
                target.upsert(rows.select(*route.schema.columns.names), applied)
            else:
                target.append(rows.select(*route.schema.columns.names), applied)

    def ledger(self) -> DataFrame:
        """A row for each staged file."""
        folder = f"{self.folder}/ledger"
        return self.spark.read.schema(LEDGER).json(self.store.uri(folder)) if self.store.list(folder) else self.spark.createDataFrame([], LEDGER)

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict) -> StreamingQuery:
        """Stage and load until stopped; first what a driver before this one left between the phases is ended."""
        self.sink.recover()
        return stream.writeStream.foreachBatch(lambda rows, batch_id: self.load(self.write(rows, batch_id))).option("checkpointLocation", checkpoint).trigger(**trigger).start()
