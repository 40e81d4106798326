"""Staged files read back: the dialect's own record splitter, and scans that open only the files asked for.

Spark lists and opens the files (so any store it reads will do) and leaves out those whose names say that they are not
wanted before it opens one; a task inflates a file as its bytes say (gzip or plain, whatever its name is), block by block, and
splits records with array operations. A bare empty field is NULL and two quotes are the empty text, also in tables of one column, where a
row of NULL is an empty line.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SchemaError
from ..functions import csv_dialect as csv
from ..functions import naming
from ..session import ship_package

#: Bytes of a file that are inflated and split at once.
BLOCK = 4 << 20
QUOTE, NEWLINE = 34, 10
#: Rows that files share a batch for.
GATHERED = 10_000


def inflate(data: memoryview, block: int = BLOCK) -> Iterator[bytes]:
    """The bytes of an object in blocks: gzip, of one member or several, where it begins as such, else as they are."""
    if bytes(data[:2]) != b"\x1f\x8b":
        for i in range(0, len(data), block):
            yield bytes(data[i : i + block])
        return
    while len(data):
        unpack = zlib.decompressobj(31)
        rest = data
        while not unpack.eof:
            out = unpack.decompress(rest, block)
            rest = unpack.unconsumed_tail
            if not out and not rest and not unpack.eof:
                raise ValueError("a gzip member is cut off")
            if out:
                yield out
        data = memoryview(unpack.unused_data)


def split_records(text: bytes, width: int, delimiter: bytes) -> tuple[list[pa.Array], int]:
    """The whole records of a text that begins with one: their fields as `width` arrays, and where the last one ends."""
    raw = np.frombuffer(text, np.uint8)
    quotes = raw == QUOTE
    inside = np.cumsum(quotes, dtype=np.int64) & 1  # after the byte
    plain = inside == 0
    ends = np.flatnonzero(plain & (raw == NEWLINE))
    if not len(ends):
        return [pa.array([], pa.string()) for _ in range(width)], 0
    stop = int(ends[-1]) + 1
    marks = raw == delimiter[0]
    for k in range(1, len(delimiter)):
        marks[:-k] &= raw[k:] == delimiter[k]
        marks[-k:] = False
    seps = np.flatnonzero((plain & (marks | (raw == NEWLINE)))[:stop])
    is_end = raw[seps] == NEWLINE
    if len(seps) % width or is_end.sum() * width != len(seps) or not is_end[width - 1 :: width].all():
        raise ValueError(f"a record has not {width} fields")
    first = np.concatenate(([0], seps[:-1] + np.where(is_end[:-1], 1, len(delimiter))))
    # Of a field's quotes stay the second ones of pairs: those that close a run and are followed by another.
    body = raw[:stop]
    keep = ~quotes[:stop] | ((inside[:stop] == 0) & np.concatenate((quotes[1:stop], [False])))
    keep[seps] = False
    for k in range(1, len(delimiter)):
        keep[seps[~is_end] + k] = False
    kept = np.concatenate(([0], np.cumsum(keep, dtype=np.int64)))
    offsets = np.concatenate((kept[first], kept[-1:]))
    known = np.packbits(seps > first, bitorder="little")
    fields = pa.StringArray.from_buffers(len(seps), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(body[keep].tobytes()), pa.py_buffer(known.tobytes()))
    return [fields.take(pa.array(np.arange(k, len(seps), width))) for k in range(width)], stop


def records(blocks: Iterator[bytes], width: int, delimiter: bytes) -> Iterator[list[pa.Array]]:
    """The records of a file, without its header, as arrays of fields."""
    held, header = b"", True
    for block in blocks:
        held += block
        fields, stop = split_records(held, width, delimiter)
        held = held[stop:]
        if stop:
            yield [f.slice(1) for f in fields] if header else fields
            header = False
    if held:
        # The last record, where no newline ends it.
        fields, stop = split_records(held + b"\n", width, delimiter)
        if stop <= len(held):
            raise ValueError("a quoted field is not closed")
        yield [f.slice(1) for f in fields] if header else fields


def gathered(batches: Iterator[pa.RecordBatch], rows: int = GATHERED, size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about so many rows or bytes: small files would have a batch each."""
    held, n, n_bytes = [], 0, 0
    for batch in batches:
        held.append(batch)
        n, n_bytes = n + batch.num_rows, n_bytes + batch.nbytes
        if n >= rows or n_bytes >= size:
            yield pa.concat_batches(held)
            held, n, n_bytes = [], 0, 0
    if held:
        yield pa.concat_batches(held)


def _split(width: int, delimiter: bytes):
    names = [*(f"c{k}" for k in range(width)), "_file", "_ord"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return gathered(split(batches))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                path, at = batch.column(0)[k].as_py(), 0
                try:
                    for fields in records(inflate(memoryview(batch.column(1)[k].as_buffer())), width, delimiter):
                        n = len(fields[0])
                        yield pa.RecordBatch.from_arrays([*fields, pa.array([path] * n, pa.string()), pa.array(np.arange(at, at + n))], names=names)
                        at += n
                except (ValueError, zlib.error) as e:
                    raise ValueError(f"{path} is damaged: {e}") from e

    return run


def _check(schema: T.StructType, delimiter: str) -> None:
    if not len(schema):
        raise SchemaError("files have a column at least")
    csv.check_delimiter(delimiter)


def _typed(files: DataFrame, schema: T.StructType, delimiter: str) -> DataFrame:
    """files (path, content) as typed rows with `_file` and `_ord`."""
    ship_package(files.sparkSession)
    width = len(schema)
    raw = files.mapInArrow(_split(width, delimiter.encode()), ", ".join([*(f"c{k} string" for k in range(width)), "_file string", "_ord long"]))
    return raw.select(*(csv.parse_cell(F.col(f"c{k}"), f.dataType).alias(f.name) for k, f in enumerate(schema)), "_file", "_ord")


def read_files(spark: SparkSession, uris: list[str], schema: T.StructType, delimiter: str = ",") -> DataFrame:
    """Staged files as typed rows, with `_file` and `_ord` (the place in the file, from 0)."""
    _check(schema, delimiter)
    files = spark.read.format("binaryFile").load(uris).select(F.col("_metadata.file_path").alias("path"), "content")
    return _typed(files, schema, delimiter)


def read_staged(spark: SparkSession, folder: str, schema: T.StructType, delimiter: str = ",", offsets: tuple[int | None, int | None] = (None, None), above: int | None = None, upto: int | None = None) -> DataFrame:
    """The rows of a folder's staged files with `_file`, `_ord`, `_serial` (epoch and number in one) and the file's `_start` and `_end`.

    offsets: only files that overlap this inclusive range; above, upto: only files whose serial is above, or at most, these.
    Files outside are not read; objects that are no staged files are passed over.
    """
    _check(schema, delimiter)
    part = lambda name: naming.parse_basename(F.col("_metadata.file_name")).getField(name)
    serial = naming.try_serial(part("epoch_ms"), part("seq"))
    wanted: list[Column] = [serial.isNotNull()]
    if offsets[0] is not None:
        wanted.append(part("end_offset") >= offsets[0])
    if offsets[1] is not None:
        wanted.append(part("start_offset") <= offsets[1])
    if above is not None:
        wanted.append(serial > above)
    if upto is not None:
        wanted.append(serial <= upto)
    files = spark.read.format("binaryFile").load(folder)
    for w in wanted:
        files = files.filter(w)
    rows = _typed(files.select(F.col("_metadata.file_path").alias("path"), "content"), schema, delimiter)
    said = naming.parse_basename(F.substring_index("_file", "/", -1))
    return rows.withColumn("__said", said).withColumns({"_serial": naming.try_serial(F.col("__said.epoch_ms"), F.col("__said.seq")), "_start": F.col("__said.start_offset"), "_end": F.col("__said.end_offset")}).drop("__said")
