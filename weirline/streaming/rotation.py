"""Rotation as a keyed state operator: a stream's rows, kept until the file they fall in is full or old.

A group's open file is in the state store, its lines packed as they came, so what was taken is as durable as the stream's
checkpoint and a restart goes on inside the file. Rows are judged in blocks of `block` offsets: at the end of a block the
whole buffer is sealed if its estimated size reaches the limit (rows times the bytes per row of the file before). So files
depend on the rows and not on how micro-batches cut them, and are those of the batch fold (`operators.folds`). A timer
seals a file that has been open for `age` seconds, also where no row comes; its clock is the micro-batch's, which
the checkpoint keeps, so a micro-batch that runs again gives the same files.

A micro-batch's rows of a group, and a file, are held by one task: both are bounded, by the source's limit on a trigger and by the
limit on files. Sealed files leave as rows: their file's columns, and each line with its offset and key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..errors import ConfigError
from ..functions import csv_dialect as csv
from ..session import ship_package
from ..types import TableSchema

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SEALED = "stream string, seq long, start_offset long, end_offset long, reason string, offset long, key string, line string"
_OPEN = ["seq", "start", "top", "n_rows", "n_bytes", "row_bytes", "opened_ms", "timer_ms"]
_LINES = pa.schema([("offset", pa.int64()), ("key", pa.string()), ("line", pa.string())])


def pack(rows: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _LINES, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(pa.Table.from_pandas(rows[_LINES.names], _LINES, preserve_index=False))
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas()


class Rotator(StatefulProcessor):
    """State: the open file's figures (`_OPEN`; start is -1 where none is open) and its lines in packs."""

    def __init__(self, limit: int, age: float, block: int, default_row_bytes: int = 128):
        self.limit, self.age_ms, self.block, self.default = limit, int(age * 1000), block, float(default_row_bytes)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.figures = handle.getValueState("open", T.StructType([T.StructField(c, T.DoubleType() if c == "row_bytes" else T.LongType()) for c in _OPEN]))
        self.packs = handle.getListState("packs", T.StructType([T.StructField("data", T.BinaryType())]))

    def _load(self) -> dict:
        if not self.figures.exists():
            return dict(zip(_OPEN, (0, -1, -1, 0, 0, self.default, -1, -1), strict=True))
        return dict(zip(_OPEN, self.figures.get(), strict=True))

    def _save(self, f: dict) -> None:
        self.figures.update(tuple(f[c] for c in _OPEN))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        f = self._load()
        new = pd.concat(list(rows), ignore_index=True).drop_duplicates("offset").sort_values("offset")
        # What a source sends again was taken already.
        new = new[new["offset"] > f["top"]].reset_index(drop=True)
        offsets, sizes = new["offset"].to_numpy(), new["size"].to_numpy()
        block = offsets // self.block
        bounds = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(new)] if len(new) else [0]
        begun = 0  # where the lines begin that are in no pack yet
        for a, b in zip(bounds, bounds[1:], strict=False):
            if f["n_rows"] and f["top"] // self.block < block[a] and self._full(f):
                yield from self._seal(key, f, "size", new[begun:a])
                begun = a
            if not f["n_rows"]:
                f["start"], f["opened_ms"] = int(offsets[a]), timerValues.getCurrentProcessingTimeInMs()
            f["n_rows"], f["n_bytes"], f["top"] = f["n_rows"] + b - a, f["n_bytes"] + int(sizes[a:b].sum()), int(offsets[b - 1])
            if (f["top"] + 1) % self.block == 0 and self._full(f):
                yield from self._seal(key, f, "size", new[begun:b])
                begun = b
        if begun < len(new):
            self.packs.appendValue((pack(new[begun:]),))
        if f["n_rows"] and f["timer_ms"] < 0:
            f["timer_ms"] = f["opened_ms"] + self.age_ms
            self.handle.registerTimer(f["timer_ms"])
        self._save(f)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        f = self._load()
        if f["n_rows"] and f["timer_ms"] == expiredTimerInfo.getExpiryTimeInMs():
            f["timer_ms"] = -1  # it has run out
            yield from self._seal(key, f, "age", None)
            self._save(f)

    def _full(self, f: dict) -> bool:
        return f["n_rows"] * f["row_bytes"] >= self.limit

    def _seal(self, key, f: dict, reason: str, rest: pd.DataFrame | None) -> Iterator[pd.DataFrame]:
        """The open file's lines, those in packs first; then the next file is open, and empty."""
        for part in (*(unpack(p[0]) for p in self.packs.get()), *([rest] if rest is not None and len(rest) else [])):
            yield pd.DataFrame({"stream": key[0], "seq": f["seq"], "start_offset": f["start"], "end_offset": f["top"], "reason": reason, "offset": part["offset"].to_numpy(), "key": part["key"].to_numpy(), "line": part["line"].to_numpy()})
        self.packs.clear()
        if f["timer_ms"] >= 0:
            self.handle.deleteTimer(f["timer_ms"])
        f.update(seq=f["seq"] + 1, start=-1, row_bytes=f["n_bytes"] / f["n_rows"], n_rows=0, n_bytes=0, opened_ms=-1, timer_ms=-1)

    def close(self) -> None: ...


def rotated(stream: DataFrame, schema: TableSchema, partition: str, offset: str, limit: int, age: float, block: int = 1, delimiter: str = ",") -> DataFrame:
    """The rows of a stream as lines of sealed files: stream, seq, start_offset, end_offset, reason (size or age), offset, key, line.

    A partition is a stream of its own, `p` and its value, or `null` for rows without one. Offsets are unique in a
    partition, and a row whose offset is not above those taken before was taken before.
    """
    spark = stream.sparkSession
    if block < 1 or limit < 1 or age <= 0:
        raise ConfigError("block and limit are 1 or more, age is above 0")
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != PROVIDER:
        raise ConfigError(f"set spark.sql.streaming.stateStore.providerClass to {PROVIDER}")
    ship_package(spark)
    value = F.col(partition).cast("string")
    ident = F.when(value.isNull(), F.lit("null")).otherwise(F.concat(F.lit("p"), value))
    line = csv.row_text(schema.columns, delimiter)
    key = csv.row_text(T.StructType([schema.columns[k] for k in schema.key]), delimiter) if schema.key else F.lit("")
    rows = stream.select(ident.alias("stream"), F.col(offset).cast("long").alias("offset"), key.alias("key"), line.alias("line"))
    rows = rows.withColumn("size", (F.octet_length("line") + 1).cast("long"))
    return rows.groupBy("stream").transformWithStateInPandas(Rotator(limit, age, block), SEALED, "Append", "ProcessingTime")
