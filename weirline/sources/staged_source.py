"""Staged files as a stream: planned by their names, read by the executors, each stream no faster than it may.

The offset of the stream is the last file taken of each sub-folder (a stream of its own), so planning lists names
and opens nothing, and a micro-batch that runs again after a crash gets the files it had. Every file is an input partition of its own and is
inflated and split where it is read; no row passes the driver. Per trigger a stream gives at most `files_per_trigger` files
and begins none beyond `bytes_per_trigger`, so a stream that is far behind neither holds up the others nor grows a micro-batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..errors import ConfigError
from ..functions import csv_dialect as csv
from ..functions import naming
from ..session import ship_package
from .reader import inflate, records

#: Hadoop settings that the Python side needs for S3, under the names that Spark's logs redact.
S3 = {"fs.s3a.access.key": "access_key", "fs.s3a.secret.key": "secret_key", "fs.s3a.session.token": "session_token", "fs.s3a.endpoint": "endpoint_override", "fs.s3a.endpoint.region": "region"}
_SAID = ["_stream", "_epoch", "_seq", "_start", "_end", "_ord"]


def open_store(root: str, settings: dict[str, str]) -> tuple[pafs.FileSystem, str]:
    """The file system of a root and the path in it; s3a:// with Hadoop's settings for it."""
    scheme, sep, rest = root.partition("://")
    if not sep:
        return pafs.LocalFileSystem(), root.rstrip("/")
    if scheme in ("s3", "s3a", "s3n"):
        known = {ours: settings[theirs] for theirs, ours in S3.items() if settings.get(theirs)}
        return pafs.S3FileSystem(**known), rest.rstrip("/")
    fs, path = pafs.FileSystem.from_uri(root)
    return fs, path.rstrip("/")


@dataclass
class StagedPartition(InputPartition):
    path: str
    stream: str
    epoch_ms: int
    seq: int
    start: int
    end: int


class StagedSource(DataSource):
    """Options: path; width (columns); delimiter; files_per_trigger, bytes_per_trigger (of each stream; no limit if left out)."""

    @classmethod
    def name(cls) -> str:
        return "weirline_staged"

    def schema(self) -> T.StructType:
        out = T.StructType()
        for k in range(int(self.options["width"])):
            out = out.add(f"c{k}", "string")
        return out.add("_stream", "string").add("_epoch", "long").add("_seq", "long").add("_start", "long").add("_end", "long").add("_ord", "long")

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:  # noqa: N802
        return StagedReader(dict(self.options))


class StagedReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.options, self.root = options, options["path"]
        self.width, self.delimiter = int(options["width"]), options.get("delimiter", ",").encode()
        self.most_files, self.most_bytes = (int(options[k]) if options.get(k) else None for k in ("files_per_trigger", "bytes_per_trigger"))
        if any(x is not None and x < 1 for x in (self.most_files, self.most_bytes)):
            raise ConfigError("limits of a trigger are 1 or more")
        #: The offsets that are planned, and the last ones given out that are not.
        self.planned: dict[str, str] = {}
        self.given: dict[str, str] | None = None

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def listing(self) -> dict[str, list[tuple[int, int, int, int, str, int]]]:
        """Each stream's files in order: epoch, seq, start, end, path, size."""
        fs, path = open_store(self.root, self.options)
        out: dict[str, list] = {}
        for info in fs.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True)):
            stream, _, base = info.path[len(path) + 1 :].rpartition("/")
            m = re.match(naming.BASENAME, base)
            if info.type is pafs.FileType.File and m and "/" not in stream and stream[:1] not in "_.":
                out.setdefault(stream, []).append((*(int(x) for x in m.groups()[:4]), info.path, info.size))
        return {s: sorted(f) for s, f in out.items()}

    @staticmethod
    def _at(offset: dict, stream: str) -> tuple[int, int]:
        epoch, _, seq = offset.get(stream, "-1:-1").partition(":")
        return int(epoch), int(seq)

    def latestOffset(self) -> dict:  # noqa: N802
        """As far as one trigger may go beyond what is planned."""
        if self.given is not None:
            # Spark asked again without planning: what was given out is nothing new to it, as after a restart.
            self.planned = self.given
        end = dict(self.planned)
        for stream, files in self.listing().items():
            n = size = 0
            for epoch, seq, _, _, _, length in files:
                if (epoch, seq) <= self._at(self.planned, stream):
                    continue
                if n == self.most_files or n and self.most_bytes is not None and size + length > self.most_bytes:
                    break
                n, size, end[stream] = n + 1, size + length, f"{epoch}:{seq}"
        self.given = end
        return end

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.planned, self.given = {s: max((o.get(s, "-1:-1") for o in (self.planned, end)), key=lambda x: tuple(map(int, x.split(":")))) for s in self.planned | end}, None
        out = []
        for stream, files in self.listing().items():
            low, high = self._at(start, stream), self._at(end, stream)
            out += [StagedPartition(path, stream, e, s, a, b) for e, s, a, b, path, _ in files if low < (e, s) <= high]
        return out

    def commit(self, end: dict) -> None: ...

    def read(self, partition: StagedPartition) -> Iterator[pa.RecordBatch]:
        fs, _ = open_store(self.root, self.options)
        names = [*(f"c{k}" for k in range(self.width)), *_SAID]
        with fs.open_input_file(partition.path) as f:
            data = f.read_buffer()
        at = 0
        for fields in records(inflate(memoryview(data)), self.width, self.delimiter):
            n = len(fields[0])
            said = [pa.array([partition.stream] * n, pa.string()), *(pa.array(np.full(n, x, np.int64)) for x in (partition.epoch_ms, partition.seq, partition.start, partition.end)), pa.array(np.arange(at, at + n))]
            yield pa.RecordBatch.from_arrays([*fields, *said], names=names)
            at += n


def staged_stream(spark: SparkSession, folder: str, schema: T.StructType, delimiter: str = ",", files_per_trigger: int | None = None, bytes_per_trigger: int | None = None) -> DataFrame:
    """The files below a folder (a sub-folder for each stream) as a stream of typed rows, with `_stream`, the file's `_epoch`,
    `_seq`, `_start` and `_end`, and `_ord`, the row's place in it."""
    csv.check_delimiter(delimiter)
    ship_package(spark)
    spark.dataSource.register(StagedSource)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    limits = {"files_per_trigger": files_per_trigger, "bytes_per_trigger": bytes_per_trigger}
    options = {"path": folder, "width": str(len(schema)), "delimiter": delimiter} | {k: str(v) for k, v in limits.items() if v is not None}
    if folder.startswith(("s3a://", "s3n://", "s3://")):
        options |= {k: v for k in S3 if (v := conf.get(k))}
    raw = spark.readStream.format("weirline_staged").options(**options).load()
    return raw.select(*(csv.parse_cell(F.col(f"c{k}"), f.dataType).alias(f.name) for k, f in enumerate(schema)), *_SAID)
