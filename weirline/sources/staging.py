"""Staged files: written under names that carry their order, listed, and read back.

Files are rendered and written by Spark in the JVM, in two phases (`sink`), and read by `reader`. A file's bytes depend on
its rows alone.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import naming
from .reader import read_files, read_staged
from .sink import StagingSink
from .store import Store

__all__ = ["list_staged", "read_files", "read_staged", "write_files"]


def write_files(rows: DataFrame, columns: list[str], uri: str, order: list[str], delimiter: str = ",", compressed: bool = True, root: str | None = None) -> DataFrame:
    """Write rows as files, one per value of the `uri` column; returns uri, n_rows, n_bytes. root: the folder that all
    files are in; without one, that of the first file. Writing again gives the same objects."""
    spark = rows.sparkSession
    schema = "uri string, n_rows long, n_bytes long"
    if root is None:
        least = rows.agg(F.min(uri)).first()[0]
        if least is None:
            return spark.createDataFrame([], schema)
        root = least.rpartition("/")[0]
    store = Store(spark, root)
    named = rows.withColumn(uri, F.when(F.startswith(uri, F.lit(root + "/")), F.substring(uri, F.lit(len(root) + 2), F.length(uri))))
    made = StagingSink(store).write(named, columns, uri, order, delimiter, compressed)
    return spark.createDataFrame([(f"{root}/{f.name}", f.n_rows, f.n_bytes) for f in made], schema)


def list_staged(store: Store, folder: str) -> tuple[list[dict], list[str]]:
    """The staged files of a folder in order, and the names that are none."""
    staged, odd = [], []
    for name, size in store.list(folder):
        m = re.match(naming.BASENAME, name)
        numbers = [int(x) for x in m.groups()[:4]] if m else []
        if m and numbers[0] < 1 << 63 and numbers[1] < 1 << 32 and max(numbers[2:]) < 1 << 63:
            staged.append({"name": name, "n_bytes": size, "epoch_ms": numbers[0], "seq": numbers[1], "start_offset": numbers[2], "end_offset": numbers[3], "compressed": bool(m[5])})
        else:
            odd.append(name)
    return sorted(staged, key=lambda f: (f["epoch_ms"], f["seq"])), odd
