"""An exactly-once sink for sealed files: a micro-batch's files are durable before the ledger says so, and each once.

For each micro-batch: write the files in two phases (`sources.sink`) under names that follow from the rows alone; then create the
ledger's page of this micro-batch, in one step, with a row for each file. A micro-batch that runs again after a crash finds its page
and does nothing, or gives the same files under the same names and the page that was missing. So a file in the ledger is
in staging, and no file is there twice, wherever the crash was.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import csv_dialect as csv
from ..functions import naming
from ..operators.tables import last_wins
from ..sources.sink import StagingSink
from ..sources.store import Store
from ..types import TableSchema
from .lag import LagBoard

LEDGER = "serial_group string, stream string, epoch_ms long, seq long, serial_seq long, identifier string, start_offset long, end_offset long, n_rows long, n_bytes long, object string, reason string, status string"


class StagedStream:
    """Files of one table below `folder` of a store, and their ledger beside them."""

    def __init__(self, store: Store, folder: str, schema: TableSchema, epoch_ms: int, upsert: bool = True, delimiter: str = ",", compressed: bool = True, board: LagBoard | None = None):
        schema.check(upsert)
        naming.encode(epoch_ms, 0)
        self.store, self.folder, self.schema, self.epoch_ms, self.upsert, self.delimiter, self.compressed = store, folder, schema, epoch_ms, upsert, delimiter, compressed
        self.sink, self.board = StagingSink(store, folder), board

    def page(self, batch_id: int) -> str:
        return f"{self.folder}/ledger/{batch_id:019d}.json"

    def write(self, sealed: DataFrame, batch_id: int) -> None:
        """One micro-batch (columns as `rotation.SEALED`); for foreachBatch."""
        if self.store.exists(self.page(batch_id)):
            return
        # Files roll over into the next epoch, as their numbers do.
        whole = sealed.withColumns({"epoch_ms": F.lit(self.epoch_ms) + F.shiftright("seq", naming.SEQ_BITS), "number": F.col("seq").bitwiseAND(F.lit(naming.SEQ_MAX))})
        name = F.concat("stream", F.lit("/"), naming.basename(F.col("epoch_ms"), F.col("number"), F.col("start_offset"), F.col("end_offset"), F.lit(self.compressed)))
        lines = whole.select(name.alias("name"), "key", "offset", "line", "reason")
        lines = lines.persist()
        try:
            reasons = {r["name"]: r["reason"] for r in lines.groupBy("name").agg(F.max("reason").alias("reason")).collect()}
            if reasons:
                kept = last_wins(lines.drop("reason"), ["key"], F.col("offset"), ["name"]) if self.upsert else lines
                head = F.lit(csv.header_text(self.schema.columns.names, self.delimiter)).alias("head")
                made = self.sink.commit(self.sink.prepare(kept.select("name", head, "line", F.col("offset").alias("o0")), self.compressed))
                self._enter(batch_id, [(f, reasons[f.name]) for f in made])
        finally:
            lines.unpersist()

    def _enter(self, batch_id: int, files: list) -> None:
        rows = []
        for f, reason in files:
            stream, _, base = f.name.partition("/")
            epoch, seq, start, end = (int(x) for x in naming.re.match(naming.BASENAME, base).groups()[:4])
            group = f"{self.schema.db_id}:{self.schema.rel_id}:{stream}"
            rows.append({"serial_group": group, "stream": stream, "epoch_ms": epoch, "seq": seq, "serial_seq": naming.encode(epoch, seq), "identifier": f"{group}:{epoch}:{seq}", "start_offset": start, "end_offset": end, "n_rows": f.n_rows, "n_bytes": f.n_bytes, "object": f.name, "reason": reason, "status": "READY"})
        # Where it is there already, it was this same micro-batch's.
        self.store.create(self.page(batch_id), "".join(json.dumps(r) + "\n" for r in rows))
        if self.board is not None:
            self.board.sealed(sorted((r["stream"], r["epoch_ms"], r["seq"]) for r in rows))

    def ledger(self, spark: SparkSession) -> DataFrame:
        """A row for each file that is durable."""
        folder = f"{self.folder}/ledger"
        return spark.read.schema(LEDGER).json(self.store.uri(folder)) if self.store.list(folder) else spark.createDataFrame([], LEDGER)

    def start(self, sealed: DataFrame, checkpoint: str, trigger: dict) -> StreamingQuery:
        """Run until stopped. First what a driver before this one left between the phases is ended."""
        self.sink.recover()
        return sealed.writeStream.foreachBatch(self.write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
