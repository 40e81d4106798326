"""A target table: a log of parts under numbered manifests.

A load adds one part, the rows of its files; it rewrites nothing. Reading takes the last row of each key over
the parts in their order (an insert-only table: all rows). FANOUT parts of one level that follow each other are
merged into one of the next level, so a row is written again only as often as the table has levels. A manifest
is never changed: a commit creates the one with the next number, and of several writers at once one succeeds
while the others take up its parts and try again. The newest manifest also holds the last serial_seq applied for
each group, so loading a file again changes nothing.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import StorageError
from ..operators.tables import last_wins
from ..sources.store import Store

MANIFESTS = "manifests"
#: Parts of one level that are merged; manifests that stay readable behind the newest; tries of a commit.
FANOUT, KEEP, TRIES = 8, 16, 100
EMPTY = {"version": 0, "key": None, "parts": [], "applied": {}}


class Target:
    """buckets: files of a part, dealt by key; it may differ from load to load."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: tuple[str, ...], buckets: int = 64):
        self.spark, self.store, self.schema, self.key, self.buckets = spark, Store(spark, root), schema, key, buckets

    def _versions(self) -> list[int]:
        return sorted(int(m[1]) for name, _ in self.store.list(MANIFESTS) if (m := re.fullmatch(r"(\d+)\.json", name)))

    def manifest(self) -> dict:
        """The newest one. A table whose manifests are gone but for its data is damaged, not empty."""
        for _ in range(TRIES):
            versions = self._versions()
            if not versions:
                if self.store.folders("data"):
                    raise StorageError(f"{self.store.root} has data but no manifest")
                return json.loads(json.dumps(EMPTY))
            held = self.store.get_json(f"{MANIFESTS}/{versions[-1]:012d}.json")
            if held is not None:
                return held
        raise StorageError(f"{self.store.root}: its manifests change faster than they can be read")

    def applied(self, group: str) -> int:
        return self.manifest()["applied"].get(group, -1)

    def _rows(self, parts: list[dict]) -> DataFrame:
        """The rows of parts, of each key the last one."""
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        if not self.key or len(parts) == 1:
            return self.spark.read.schema(self.schema).parquet(*(f"{self.store.root}/{p['path']}" for p in parts))
        # Parts are few (FANOUT a level), and each is read with its place in the order.
        rows = None
        for place, p in enumerate(parts):
            part = self.spark.read.schema(self.schema).parquet(f"{self.store.root}/{p['path']}").withColumn("__place", F.lit(place))
            rows = part if rows is None else rows.unionByName(part)
        return last_wins(rows, list(self.key), F.col("__place")).select(*self.schema.names)

    def read(self) -> DataFrame:
        return self._rows(self.manifest()["parts"])

    def _write(self, rows: DataFrame) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        rows = rows.select(*self.schema.names)
        dealt = rows.repartition(self.buckets, *[F.col(f"`{k}`") for k in self.key]) if self.key else rows
        dealt.write.parquet(f"{self.store.root}/{folder}")
        return folder

    def _commit(self, change: Callable[[dict], dict | None]) -> bool:
        """Create the next manifest from the newest one, as often as another writer was faster; change gives None
        where nothing is left to do."""
        for _ in range(TRIES):
            held = self.manifest()
            following = change(held)
            if following is None:
                return False
            following["version"] = held["version"] + 1
            if self.store.create(f"{MANIFESTS}/{following['version']:012d}.json", json.dumps(following)):
                return True
        raise StorageError(f"{self.store.root}: other writers were faster {TRIES} times")

    def _add(self, rows: DataFrame, applied: dict[str, int]) -> None:
        done = lambda m: all(m["applied"].get(g, -1) >= s for g, s in applied.items())
        held = self.manifest()
        if done(held):
            return
        if not held["version"]:
            # The first manifest comes before any data, so data without one means that it was lost.
            self.store.create(f"{MANIFESTS}/{1:012d}.json", json.dumps(EMPTY | {"version": 1}))
        folder = self._write(rows)

        def change(m: dict) -> dict | None:
            if done(m):
                return None
            if m["key"] is not None and tuple(m["key"]) != self.key:
                raise StorageError(f"the table's key is {m['key']}, not {list(self.key)}")
            top = m["applied"] | {g: max(s, m["applied"].get(g, -1)) for g, s in applied.items()}
            return m | {"key": list(self.key), "parts": [*m["parts"], {"path": folder, "level": 0}], "applied": top}

        if not self._commit(change):
            self.store.delete(folder)
            return
        while self.merge():
            pass

    def upsert(self, delta: DataFrame, applied: dict[str, int]) -> None:
        """delta: one row a key. applied: the serial_seq that each group has reached with it."""
        self._add(delta, applied)

    def append(self, delta: DataFrame, applied: dict[str, int]) -> None:
        self._add(delta, applied)

    def merge(self) -> bool:
        """Merge the newest FANOUT parts, if they are of one level, into one; whether that was done."""
        old = self.manifest()["parts"][-FANOUT:]
        if len(old) < FANOUT or len({p["level"] for p in old}) > 1:
            return False
        folder = self._write(self._rows(old))

        def change(m: dict) -> dict | None:
            parts = m["parts"]
            at = next((k for k in range(len(parts)) if parts[k : k + FANOUT] == old), None)
            if at is None:  # another writer has merged them
                return None
            return m | {"parts": [*parts[:at], {"path": folder, "level": old[0]["level"] + 1}, *parts[at + FANOUT :]]}

        if self._commit(change):
            return True
        self.store.delete(folder)
        return False

    def vacuum(self, now_ms: int, older_ms: int = 3_600_000) -> list[str]:
        """Delete manifests behind the newest KEEP, and data that none of the rest names and that is older than older_ms (what
        is younger may belong to a load that hasn't committed yet)."""
        versions = self._versions()
        for v in versions[:-KEEP]:
            self.store.delete(f"{MANIFESTS}/{v:012d}.json")
        held = [self.store.get_json(f"{MANIFESTS}/{v:012d}.json") for v in versions[-KEEP:]]
        live = {p["path"] for m in held if m for p in m["parts"]}
        gone = [f"data/{name}" for name, changed in self.store.folders("data") if f"data/{name}" not in live and now_ms - changed > older_ms]
        return [g for g in gone if self.store.delete(g)]
