"""Packed columns, and steps of tasks that own ranges of keys.

Where a job moves tens of rows for every word of its input, rows of numbers are too dear. Here a row holds many
numbers: columns packed into one binary value, bytes of equal significance together, then compressed. Every
row is (bucket, source, kind, data). A bucket is a range of 64-bit keys; the partition that owns it gets every
row addressed to it, so a step is like a round of messages: owners read what was sent to them, and send.
Senders pack a key once, however often they saw it: a hot key is one number for each sender.
"""

from __future__ import annotations

import gc
import struct
import time
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import map_arrow, materialize, release_part

SCHEMA = "bucket int, source long, kind string, data binary"
_ARROW = pa.schema([("bucket", pa.int32()), ("source", pa.int64()), ("kind", pa.string()), ("data", pa.binary())])
_HEAD = struct.Struct("<3s?QQ")
#: Bytes of values in one batch that a task passes on.
BATCH_BYTES = 16 << 20
#: Bytes of a step's table from which on its shuffle's files are worth a collection of garbage.
WORTH_COLLECTING = 4 << 20
#: Bytes of input for each bucket: at least, so that messages between buckets stay large; at most, so that one fits a task.
LEAST_INPUT, MOST_INPUT = 8 << 20, 256 << 20

Row = tuple[int, int, str, bytes]


def pack(*columns: np.ndarray) -> bytes:
    out = []
    compress = zstandard.ZstdCompressor(level=1).compress
    for c in columns:
        c = np.ascontiguousarray(c)
        whole = c.view(f"<u{c.itemsize}")
        held = compress(b"".join([(whole >> whole.dtype.type(8 * k)).astype(np.uint8).tobytes() for k in range(c.itemsize)]))
        # Hashes of which some are frequent are smaller as they are.
        flat = compress(c.tobytes()) if c.dtype == np.uint64 else held
        if as_is := len(flat) < len(held):
            held = flat
        out += [_HEAD.pack(c.dtype.str.encode(), as_is, len(c), len(held)), held]
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    decompress = zstandard.ZstdDecompressor().decompress
    while at < len(data):
        kind, as_is, n, size = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        dtype = np.dtype(kind.decode())
        raw = decompress(data[at : at + size])
        at += size
        if as_is:
            out.append(np.frombuffer(raw, dtype))
            continue
        planes = np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, n)
        whole = planes[0].astype(f"<u{dtype.itemsize}")
        for k in range(1, dtype.itemsize):
            whole |= planes[k].astype(whole.dtype) << whole.dtype.type(8 * k)
        out.append(whole.view(dtype))
    return out


def joined(held: Iterable[bytes]) -> list[np.ndarray]:
    """The columns of several packed values, one after another."""
    return [np.concatenate(c) for c in zip(*map(unpack, held), strict=True)]


def owner(keys: np.ndarray, parts: int) -> np.ndarray:
    """The bucket of each key; buckets are in the order of the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def addressed(kind: str, source: int, parts: int, keys: np.ndarray, *columns: np.ndarray) -> Iterator[Row]:
    """Rows for the owners of ascending keys: the keys and their columns."""
    if not len(keys):
        return
    to = owner(keys, parts)
    edges = [0, *(np.flatnonzero(np.diff(to)) + 1).tolist(), len(keys)]
    for a, b in zip(edges, edges[1:], strict=False):
        yield int(to[a]), source, kind, pack(keys[a:b], *(c[a:b] for c in columns))


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of wanted numbers among ascending keys, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def batches_of(rows: Iterable[Row]) -> Iterator[pa.RecordBatch]:
    held: list[Row] = []
    size = 0

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], t) for k, t in enumerate(_ARROW.types)], schema=_ARROW)
        held.clear()
        return out

    for row in rows:
        held.append(row)
        size += len(row[3])
        if size > BATCH_BYTES:
            yield flush()
            size = 0
    yield flush()


def send(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[Row]]) -> DataFrame:
    """Rows from a function over a table's batches."""
    return map_arrow(df, lambda batches: batches_of(fn(batches)), SCHEMA)


def deal(*tables: DataFrame, parts: int) -> DataFrame:
    """All rows of the tables, each in the partition that its bucket names."""
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)
    return rows.repartitionById(parts, F.col("bucket"))


class Mail(dict):
    """What a bucket got: by kind, a list of (source, data)."""

    def __missing__(self, kind: str) -> list:
        return []

    def columns(self, kind: str, n: int) -> list[np.ndarray]:
        """The columns of all values of a kind, one after another; n empty ones if there are none."""
        held = [d for _, d in self[kind]]
        return joined(held) if held else [np.zeros(0, np.uint64)] * n


def owners(fn: Callable[[int, Mail], Iterable[Row]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[Row]]:
    """A function over a bucket's mail as one over batches of dealt rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
        at, mail = None, Mail()
        for batch in batches:
            for bucket, source, kind, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != at:
                    if at is not None:
                        yield from fn(at, mail)
                    at, mail = bucket, Mail()
                mail.setdefault(kind, []).append((source, data))
        if at is not None:
            yield from fn(at, mail)

    return run


def step(fn: Callable[[int, Mail], Iterable[Row]], tag: str, *tables: DataFrame, parts: int) -> DataFrame:
    """Deal the tables' rows to their owners and write what these send, a folder for each kind."""
    out = materialize(send(deal(*tables, parts=parts), owners(fn)), tag, by="kind", compression="none", **{"parquet.enable.dictionary": "false"})
    context = out.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(out.weirline_path)
    if path.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(path).getLength() > WORTH_COLLECTING:
        # The shuffles behind a written table aren't read again; their files go with the driver's garbage, once
        # the JVM knows what Python has let go.
        for _ in range(2):
            gc.collect()
            context._jvm.System.gc()
            time.sleep(0.3)
    return out


def buckets(df: DataFrame) -> int:
    """How many buckets a table's keys are dealt to: as many as shuffle partitions, if its files are large enough."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(min(wanted, -(-size // LEAST_INPUT)), min(-(-size // MOST_INPUT), 1 << 20) if size < 1 << 60 else 1, 1)


def kind_of(table: DataFrame, *kinds: str) -> DataFrame:
    return table.filter(F.col("kind").isin(*kinds))


def drop(table: DataFrame, *kinds: str) -> None:
    """Delete a step's rows of these kinds."""
    release_part(table, "kind", *kinds)


def fetch(table: DataFrame, kind: str) -> list[list[np.ndarray]]:
    """The values of a kind, which are small, at the driver."""
    return [unpack(bytes(r.data)) for r in kind_of(table, kind).select("data").collect()]
