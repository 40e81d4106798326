"""A two-phase sink for staged files, on any store that Spark itself can write.

Prepare: one Spark job renders rows in the JVM and writes each file under an attempt's own folder; Spark's commit protocol
gives a file the output of exactly one of its task's attempts, so a killed or speculative task leaves nothing. The folders that
Spark makes carry what the tasks have to say (name, rows, bytes): they are the commit messages, and they come from
the executors through the store, whatever it is. A file has one such folder, for on some stores each costs as much as the file.
On a local disk Hadoop starts two processes for each file it creates, so there the tasks write files of other names themselves, each
attempt of a task its own, and what they have to say comes back as the rows of the one attempt that Spark takes.
Commit: the driver writes one record that lists the attempt's files, and moves these to their names, which are theirs
for good: writing a file again gives the same object. From the record on the attempt is never lost: `recover` ends the
moves of a driver that died between them. An attempt without a record never happened; its folder is deleted.
"""

from __future__ import annotations

import json
import os
import time
import uuid
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SchemaError, StorageError
from ..functions import csv_dialect as csv
from ..session import ship_package
from .store import Store

#: Relative names of files: segments of these characters, none of dots alone.
NAME = r"^(?!.*(^|/)\.+(/|$))[A-Za-z0-9._=-]+(/[A-Za-z0-9._=-]+)*$"
#: The column whose values have a folder each: short, because a folder's name has at most 255 bytes on many stores.
SAID = "f"
#: Moves that run at once.
MOVES = 16


@dataclass(frozen=True)
class StagedObject:
    """A file of an attempt: its name, where the attempt holds it, its rows, its bytes before compression and in the store."""

    name: str
    held: str
    n_rows: int
    n_bytes: int
    stored_bytes: int


@dataclass(frozen=True)
class Attempt:
    ident: str
    files: list[StagedObject]


def _checked(name: Column) -> Column:
    return F.when(name.rlike(NAME), name).otherwise(F.raise_error(F.concat(F.lit("no name for a staged file: "), F.coalesce(name, F.lit("NULL")))).cast("string"))


def rendered(rows: DataFrame, columns: list[str], name: str, order: list[str], delimiter: str = ",") -> DataFrame:
    """Rows as lines: name, head (the file's header), line, and their order in `o0`, `o1`, ..."""
    schema = T.StructType([rows.schema[c] for c in columns])
    if not len(schema):
        raise SchemaError("a file needs a column")
    head = F.lit(csv.header_text(columns, delimiter)).alias("head")
    return rows.select(F.col(name).alias("name"), head, csv.row_text(schema, delimiter).alias("line"), *(F.col(c).alias(f"o{k}") for k, c in enumerate(order)))


def dealt(lines: DataFrame) -> DataFrame:
    """The lines of files: said (the whole file's rows, bytes and name, in each line), line; a file is in one partition, in
    order, and its first line has the header before it."""
    keys = [c for c in lines.columns if c not in ("name", "head", "line")] or ["line"]
    lines = lines.withColumn("name", _checked(F.col("name"))).repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), "name")
    per = W.partitionBy("name")
    size = F.sum(F.octet_length("line") + 1).over(per) + F.octet_length("head") + 1
    counted = lines.withColumns({"rows": F.count("*").over(per), "bytes": size, "first": F.row_number().over(per.orderBy(*keys)) == 1})
    text = F.when(F.col("first"), F.concat("head", F.lit("\n"), "line")).otherwise(F.col("line"))
    counted = counted.withColumn(SAID, F.concat_ws(",", F.col("rows").cast("string"), F.col("bytes").cast("string"), "name"))
    # Ordered by the folders first, so that the writer needs no sort of its own, which would not keep the order.
    return counted.sortWithinPartitions(SAID, F.desc("first"), *keys).select(SAID, text.alias("line"))


class _LocalFile:
    """A file that is being written on a local disk."""

    def __init__(self, top: str, said: str, compressed: bool):
        self.said, self.held = said, f"{SAID}={quote(said, safe=',')}/{uuid.uuid4().hex}"
        path = f"{top}/{self.held}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        self._out, self._gzip = open(path, "xb"), zlib.compressobj(wbits=31) if compressed else None  # noqa: SIM115

    def write(self, data: bytes) -> None:
        self._out.write(self._gzip.compress(data) if self._gzip else data)

    def close(self) -> tuple[str, str, int]:
        """What `dealt` says of the file, where it is, its bytes."""
        with self._out as out:
            if self._gzip:
                out.write(self._gzip.flush())
            return self.said, self.held, out.tell()


def _write_here(top: str, compressed: bool):
    """Of the rows of `dealt`: their files, written below `top`, as rows (said, held, stored)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, made = None, []
        for batch in batches:
            runs, at = pc.run_end_encode(batch.column(0)), 0
            for said, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                if file is None or file.said != said:
                    made += [file.close()] if file else []
                    file = _LocalFile(top, said, compressed)
                file.write("\n".join([*batch.column(1).slice(at, end - at).to_pylist(), ""]).encode())
                at = end
        made += [file.close()] if file else []
        yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["said", "held", "stored"])

    return run


class StagingSink:
    """Writes files below `base` of a store; names are relative to it."""

    def __init__(self, store: Store, base: str = ""):
        self.store, self.base = store, base
        at = base + "/" if base else ""
        self._at, self._attempts, self._commits = at, f"{at}_attempts", f"{at}_commits"

    def prepare(self, lines: DataFrame, compressed: bool = True) -> Attempt:
        """Phase one: write the files of `lines` (see `rendered`) under a new attempt. If it fails nothing is left."""
        ident = f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex}"
        folder = f"{self._attempts}/{ident}"
        try:
            top = self.store.local(folder)
            if top is None:
                options = {"lineSep": "\n", "compression": "gzip" if compressed else "none", "maxRecordsPerFile": "0"}
                dealt(lines).write.options(**options).partitionBy(SAID).text(self.store.uri(folder))
                said = self._said(folder)
            else:
                ship_package(lines.sparkSession)
                rows = dealt(lines).mapInArrow(_write_here(top, compressed), "said string, held string, stored long").collect()
                said = [(r.said, f"{folder}/{r.held}", r.stored) for r in rows]
            return Attempt(ident, self._messages(said))
        except BaseException:
            self.abort(ident)
            raise

    def _said(self, folder: str) -> list[tuple[str, str, int]]:
        """What the folders say, their files and these files' bytes."""
        return [(unquote(key[len(folder) + 1 :].split("/")[0].removeprefix(f"{SAID}=")), key, size) for key, size in self.store.below(folder)]

    def _messages(self, said: list[tuple[str, str, int]]) -> list[StagedObject]:
        """What the tasks left: one object a file."""
        out = []
        for text, key, size in said:
            rows, n_bytes, name = text.split(",", 2)
            out.append(StagedObject(name, key, int(rows), int(n_bytes), size))
        out.sort(key=lambda f: f.name)
        for a, b in zip(out, out[1:], strict=False):
            if a.name == b.name:
                raise StorageError(f"{a.name} was written twice by one attempt")
        return out

    def commit(self, attempt: Attempt) -> list[StagedObject]:
        """Phase two: from here on the files are going to be there, whoever moves them."""
        record = f"{self._commits}/{attempt.ident}.json"
        if not self.store.create(record, json.dumps([asdict(f) for f in attempt.files])):
            raise StorageError(f"attempt {attempt.ident} is committed already")
        self._publish(attempt)
        return attempt.files

    def _publish(self, attempt: Attempt) -> None:
        """Move the files to their names, those of a folder in order, and forget the attempt."""
        folders: dict[str, list[StagedObject]] = {}
        for f in attempt.files:
            folders.setdefault(f.name.rpartition("/")[0], []).append(f)
        with ThreadPoolExecutor(min(MOVES, max(len(folders), 1))) as pool:
            list(pool.map(self._move_all, folders.values()))
        self.store.delete(f"{self._attempts}/{attempt.ident}")
        self.store.delete(f"{self._commits}/{attempt.ident}.json")

    def _move_all(self, files: list[StagedObject]) -> None:
        for f in files:
            target = f"{self._at}{f.name}"
            try:
                self.store.move(f.held, target)
            except (StorageError, Py4JJavaError):
                # A move that was done before: by this driver, whose answer was lost, or by the one that died.
                if self.store.exists(f.held) or not self.store.exists(target):
                    raise

    def abort(self, ident: str) -> None:
        self.store.delete(f"{self._attempts}/{ident}")

    def write(self, rows: DataFrame, columns: list[str], name: str, order: list[str], delimiter: str = ",", compressed: bool = True) -> list[StagedObject]:
        """Both phases for rows whose file is in the column `name`."""
        return self.commit(self.prepare(rendered(rows, columns, name, order, delimiter), compressed))

    def recover(self) -> list[str]:
        """What a driver that died left behind: end what it had committed, delete what it had not; the names that were
        committed. Only for the one that holds these names, for an attempt of a live driver looks like one that was left."""
        done = []
        for name, _ in self.store.list(self._commits):
            if name.endswith(".json"):
                files = [StagedObject(**f) for f in self.store.get_json(f"{self._commits}/{name}") or []]
                self._publish(Attempt(name.removesuffix(".json"), files))
                done += [f.name for f in files]
        for name, _ in self.store.folders(self._attempts):
            self.abort(name)
        return sorted(done)
